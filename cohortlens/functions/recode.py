"""Column-expression builders for recoding answers (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import ROLE_PREFIX, SYMBOL_NAMES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordinal_encode(c, mapping: Mapping[str, int], default: int | None = None) -> Column:
    """Map answer text to an ordinal; unmatched (and null) -> ``default``."""
    c = _col(c)
    expr = None
    for answer, code in mapping.items():
        expr = F.when(c == answer, F.lit(code)) if expr is None else expr.when(c == answer, F.lit(code))
    return expr.otherwise(F.lit(default).cast("int"))


def recode_sentinels(c, sentinels: Mapping[str, int]) -> Column:
    """Sentinel strings to fixed ints, anything else its whole number (bad text -> null)."""
    c = _col(c)
    expr = None
    for text, code in sentinels.items():
        expr = F.when(c == text, F.lit(code)) if expr is None else expr.when(c == text, F.lit(code))
    return expr.otherwise(whole_number(c))


def whole_number(c) -> Column:
    """Integer of a number or of its text, fraction cut off (``"7.9"`` -> 7); else null."""
    return _col(c).try_cast("double").try_cast("int")


def bucketize(c, bounds: Sequence[tuple[str, float | None]], closed: str = "right") -> Column:
    """Label by the first bound the value satisfies.

    ``closed="right"``: value <= bound (the usage bins); ``closed="left"``: value < bound
    (the experience bins).  ``None`` is the open last bucket.
    """
    c = _col(c)
    expr = None
    for label, bound in bounds:
        if bound is None:
            return (expr.otherwise(F.lit(label))) if expr is not None else F.lit(label)
        cond = (c <= bound) if closed == "right" else (c < bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def first_item(c, sep: str = ";", default: str = "Unknown") -> Column:
    """First item of a delimited cell; a null cell becomes ``default``."""
    c = _col(c)
    return F.when(c.isNotNull(), F.split(c, re.escape(sep)).getItem(0)).otherwise(F.lit(default))


def slug(text: str, spoken: Mapping[str, str]) -> str:
    """Letters and digits of a text with single underscores between, after the ``spoken`` symbols
    are written out."""
    for symbol, name in spoken.items():
        text = text.replace(symbol, name)
    return "_".join(re.findall(r"[A-Za-z0-9]+", text))


def safe_name(s: str) -> str:
    """Column-safe suffix for an answer text: ``GitHub Copilot`` -> ``github_copilot``."""
    return slug(s.lower(), SYMBOL_NAMES)


def role_column_name(role: str) -> str:
    """Share-column name of a role: ``Developer, back-end`` -> ``dev_back_end_pct``."""
    lead = "_" if role[:1] and not role[0].isalnum() else ""
    return lead + slug(role, ROLE_PREFIX) + "_pct"


def unique_names(names: Sequence[str]) -> list[str]:
    """Reject collisions instead of silently overwriting a column."""
    seen: dict[str, int] = {}
    for n in names:
        if n in seen:
            raise ValueError(f"derived column name collision: {n!r}")
        seen[n] = 1
    return list(names)


def round_half_up(c, digits: int) -> Column:
    """HALF_UP rounding on a DECIMAL, returned as double.

    The value first snaps to 8 decimals, which absorbs last-bit noise of the double
    (summation order, interpolation formula), so an exact tie such as x.725 rounds the same
    way whichever engine or plan computed it.
    """
    return F.round(_col(c).cast("decimal(38,8)"), digits).cast("double")


def round_sig(c, digits: int = 6) -> Column:
    """Round to ``digits`` significant digits (for comparing fitted statistics)."""
    c = _col(c)
    e = F.floor(F.log10(F.abs(c)))
    scale = F.pow(F.lit(10.0), e)
    return F.when(c == 0, F.lit(0.0)).otherwise(
        F.round((c / scale).cast("decimal(38,15)"), digits - 1).cast("double") * scale
    )
