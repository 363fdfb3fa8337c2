"""Multi-value (delimited) answer cells: split once, then count, flag or explode.

A cell such as ``"ChatGPT;GitHub Copilot"`` is split into an ``array<string>`` once; every
count and indicator reads that array, so the split is not repeated per indicator.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .recode import safe_name, unique_names


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_items(c, sep: str = ";") -> Column:
    """``array<string>`` of the raw items (no trimming); null cell -> null array."""
    return F.split(_col(c), re.escape(sep))


def is_missing(c) -> Column:
    """Null or the literal ``NA`` text the survey writes for no answer."""
    c = _col(c)
    return c.isNull() | (c == "NA")


def count_items(c, sep: str = ";", drop: Iterable[str] = (), drop_empty: bool = False) -> Column:
    """Number of items in a cell; missing -> 0.

    ``drop`` removes listed answers (e.g. the free-text "Other" choice) and ``drop_empty``
    removes empty items.  Without either, ``size(split('', ';'))`` is 1: an empty cell
    counts as one item, exactly as a plain split does.
    """
    arr = split_items(c, sep)
    drop = list(drop)
    if drop or drop_empty:
        def keep(x):
            cond = F.lit(True)
            for d in drop:
                cond = cond & (x != F.lit(d))
            if drop_empty:
                cond = cond & (x != F.lit(""))
            return cond
        arr = F.filter(arr, keep)
    return F.when(is_missing(c), F.lit(0)).otherwise(F.size(arr))


def indicator(arr: Column, value: str) -> Column:
    """0/1 flag for an exact item match in an already split array; null array -> 0."""
    return F.when(F.array_contains(arr, F.lit(value)), F.lit(1)).otherwise(F.lit(0))


def multi_hot(df: DataFrame, c: str, values: Sequence[str], prefix: str, sep: str = ";") -> DataFrame:
    """Add one ``<prefix><safe_name(v)>`` 0/1 column per value, from a single split."""
    names = unique_names([prefix + safe_name(v) for v in values])
    arr = split_items(c, sep)
    tmp = f"__items_{prefix}"
    out = df.withColumn(tmp, arr)
    out = out.withColumns({n: indicator(F.col(tmp), v) for n, v in zip(names, values)})
    return out.drop(tmp)


def clean_items(c, sep: str = ";") -> Column:
    """Split, trim white space and control characters off each item, drop empties (the input of
    explode-style counts)."""
    edge = r"^[\x00-\x20]+|[\x00-\x20]+$"
    return F.filter(F.transform(split_items(c, sep), lambda x: F.regexp_replace(x, edge, "")), lambda x: x != F.lit(""))


def explode_items(df: DataFrame, c: str, out: str, keep: Sequence[str], sep: str = ";") -> DataFrame:
    """One row per trimmed, non-empty item of ``c``; null cells yield no rows."""
    return df.where(F.col(c).isNotNull()).select(*keep, F.explode(clean_items(c, sep)).alias(out))
