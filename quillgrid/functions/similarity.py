"""The matching-blocks ratio of two strings, which Spark has no function for, as an Arrow batch function."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def alike(a: str, b: str, least: float) -> bool:
    """Whether the ratio is `least` or more; lengths alone settle most pairs, as no more than the shorter can match."""
    return a == b or (2 * min(len(a), len(b)) >= least * (len(a) + len(b)) and ratio(a, b) >= least)


def ratio(a: str, b: str) -> float:
    """2 M / T of difflib; not symmetric, so the order of arguments counts."""
    return 1.0 if a == b else difflib.SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    return pd.Series([known.get(p) or known.setdefault(p, ratio(*p)) if p[0] is not None and p[1] is not None else None for p in zip(a, b, strict=True)], dtype=float)


def similarity(a: Column, b: Column) -> Column:
    return _ratio(a, b)
