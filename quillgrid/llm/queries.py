"""The queries of this package by name, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from . import ann, bytebpe, decontaminate, linededup, lm, neardup, preference, quality, tokencount, toxicity

QUERIES = {
    "op1_lm": lm.query,
    "op2_neardup": neardup.query,
    "op3_ann": ann.query,
    "op4_line_dedup": linededup.query,
    "op5_quality": quality.query,
    "op6_preference": preference.query,
    "op7_byte_bpe": bytebpe.query,
    "op8_toxicity": toxicity.query,
    "op9_token_count": tokencount.query,
    "op10_decontaminate": decontaminate.query,
}

ORACLES = {
    "op6_preference": preference.SQL,
    "op10_decontaminate": decontaminate.SQL,
}
