"""Token counts with a whole-token shortcut.

Offline, on the driver, every vocabulary string that ends a word is put through the merges; those that come out as
one token are proved whole. Texts are normalised and cut into pre-tokens in the JVM, each distinct pre-token of a task
is looked at once: a proved one counts 1, only the rest are merged. No row is shuffled.

The JVM's lower-casing and patterns are used only where they provably agree with the library: texts whose code points
are all below U+0250, but for U+0130 (whose lower case has two code points), and that hold no special string. Any
other text goes to the library whole.

Cases: a null text is empty: 0 bytes, 0 tokens. Nulls in doc_id stay, repeated rows are each counted, other columns
are ignored. The vocabulary file is a parameter, and has to be at that path on driver and executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.batches import bounded

from ._store import tidy

#: The library's pre-tokenising pattern with its white space spelt out, the texts the JVM may cut, and
#: the pre-tokens that a task remembers.
_SPACE = r"\t-\r \x85\xa0"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+"
PLAIN = r"^[\x00-\x{12f}\x{131}-\x{24f}]*$"
REMEMBERED = 300_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def proved_whole(path: str, ending: str = "</w>") -> list[str]:
    """The pre-tokens that the merges turn into one token, among the vocabulary strings that end a word."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    byte = {v: k for k, v in byte_letters().items()}
    out = []
    for piece in tokenizer.get_vocab(with_added_tokens=False):
        word = piece.removesuffix(ending)
        if word and word != piece and all(c in byte for c in word) and len(tokenizer.model.tokenize(word)) == 1:
            try:
                out.append(bytes(byte[c] for c in word).decode())
            except UnicodeDecodeError:  # part of a character: never a pre-token
                continue
    return out


def counts(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and n_whole (pre-tokens counted by the shortcut) of every row."""
    path = path or default_path()
    from tokenizers import Tokenizer

    special = [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]
    whole = pa.array(proved_whole(path))

    def run(batches):
        tokenizer, letters, known = Tokenizer.from_file(path), byte_letters(), {}
        sure = dict.fromkeys(whole.to_pylist(), -1)
        for batch in batches:
            words, text = batch.column("words"), batch.column("text")
            flat = pc.dictionary_encode(words.flatten())
            if len(known) > REMEMBERED:
                known = {}
            each = np.empty(len(flat.dictionary), np.int64)
            for k, word in enumerate(flat.dictionary.to_pylist()):
                n = sure.get(word) or known.get(word)
                if n is None:
                    n = known[word] = len(tokenizer.model.tokenize("".join(letters[b] for b in word.encode())))
                each[k] = n
            idx = flat.indices.to_numpy() if len(flat) else np.zeros(0, np.int64)
            edge = np.concatenate([[0], np.cumsum(pc.fill_null(words.value_lengths(), 0).to_numpy())])
            total = lambda x, e=edge: (t := np.concatenate([[0], np.cumsum(x)]))[e[1:]] - t[e[:-1]]
            n, short = total(np.abs(each[idx])), total((each[idx] < 0).astype(np.int64))
            odd = np.flatnonzero(words.is_null().to_numpy(zero_copy_only=False) & text.is_valid().to_numpy(zero_copy_only=False))
            for d in odd.tolist():
                n[d] = len(tokenizer.encode(text[d].as_py(), add_special_tokens=False).ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit), pa.array(short)], ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_whole"])

    bounded(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    plain = text.rlike(PLAIN)
    for s in special:
        plain = plain & ~F.contains(text, F.lit(s))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.when(~plain, text).alias("text"), F.when(plain, F.regexp_extract_all(F.lower(text), F.lit(PATTERN), F.lit(0))).alias("words"),
    )
    return rows.mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_whole long")


def query(spark, sf_dir: str) -> DataFrame:
    return counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
