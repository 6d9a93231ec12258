"""The corpus pipeline: stages applied to documents, each written as Parquet and reread by the next.

Each stage works on all rows that its predecessor kept, and all but the last return the columns of documents. The
last returns doc_id, n_tokens, ids, and digests of the ids and of the decoded bytes.

Cases: null and empty texts pass all stages, and their ids are empty; a text whose lines all repeat earlier ones goes in line
dedup. Rows with a null id are never copies of others and stay unless they are toxic, contaminated, or lose all their lines. Rows of one
id and text are treated alike; rows of one id are one document in near-duplicate detection. Very long texts are worked on
whole. Without labels, or with labels of one kind, nothing is toxic; without benchmark items nothing is contaminated; an empty table
gives an empty table. Columns besides doc_id and text may have any names and come through unchanged, but n_chars, which follows a shortened text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillgrid.llm import bytebpe, decontaminate, linededup, neardup, toxicity
from quillgrid.llm._store import Tables


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of lines that repeat an earlier place go, and documents that consist of them alone; copies of documents are left to the next stage."""
    return linededup.drop_repeats(docs, leave_revisions=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id."""
    return neardup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text."""
    return bytebpe.encode(docs, with_ids=True).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: Fitted models and tokenizers are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs, tables = spark.read.parquet(f"{sf_dir}/documents.parquet"), Tables(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = tables.keep(out) if k < len(STAGES) - 1 else out
    return docs
