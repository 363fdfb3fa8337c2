"""The cleaning funnel: select, keep full-time employed, trim outcomes, encode answers.

All steps are row-local, so the whole funnel is one projection plus one filter that
Catalyst fuses into the scan stage (no shuffle).  ``clean_funnel`` reports how many rows
survive each step in a single pass with cumulative conditional counts.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.multivalue import count_items
from ..functions.recode import ordinal_encode, recode_sentinels, whole_number
from ..spec import EMPLOYED_MARKER, SURVEY, SurveySpec


def select_survey(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """Project the survey columns the pipeline reads, renaming raw names where present.

    Names are backticked, so a source column with a space (or a dot) resolves.
    """
    back = {new: old for old, new in spec.renames.items()}
    present = set(df.columns)
    cols = []
    for name in spec.selected:
        src = back.get(name)
        if src is not None and src in present:
            cols.append(F.col(f"`{src}`").alias(name))
        elif name in present:
            cols.append(F.col(f"`{name}`"))
        elif name not in spec.optional:
            raise ValueError(f"survey column {name!r} missing")
    return df.select(*cols)


def employed_full_time(c="Employment", marker: str = EMPLOYED_MARKER) -> Column:
    """Substring test, so combined answers ("Employed, full-time;Student, ...") pass."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & c.contains(marker)


def in_open_range(c, lo, hi) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c > lo) & (c < hi)


def derived_columns(spec: SurveySpec = SURVEY) -> dict[str, Column]:
    """Recoded columns, in output order, computed from the selected survey columns."""
    ordinal = {name: ordinal_encode(c, levels, default=default) for name, (c, levels, default) in spec.ordinals.items()}
    first = {name: ordinal.pop(name) for name in ("org_size_int",) if name in ordinal}
    return {
        "salary_usd": F.col(spec.roles["salary"]).try_cast("double"),
        "years_code_pro": recode_sentinels(spec.roles["years"], spec.years_sentinels),
        **first,
        "job_sat_int": whole_number(spec.roles["job_sat"]),
        **ordinal,
        "ai_ben_count": count_items(spec.roles["benefits"], sep=spec.separator, drop=[spec.other_answer], drop_empty=True),
    }


def funnel_steps(spec: SurveySpec = SURVEY) -> list[tuple[str, Column]]:
    """(step name, condition) of the spec's cleaning steps, in its order."""
    steps = {
        "employed_full_time": lambda: employed_full_time(spec.roles["employment"], spec.employed_marker),
        "outcomes_present": lambda: reduce(and_, [F.col(c).isNotNull() for c in spec.outcome_columns], F.lit(True)),
        "salary_in_range": lambda: F.col("salary_usd").isNotNull() & in_open_range("salary_usd", *spec.salary_bounds),
        "years_known": lambda: F.col("years_code_pro").isNotNull(),
        "job_sat_in_range": lambda: F.col("job_sat_int").isNotNull() & F.col("job_sat_int").between(*spec.job_sat_bounds),
    }
    steps |= {name.removesuffix("_int") + "_known": lambda name=name: F.col(name).isNotNull() for name in spec.ordinals}
    if unknown := [name for name in spec.funnel if name not in steps]:
        raise ValueError(f"no cleaning steps {unknown}; there are {list(steps)}")
    return [(name, steps[name]()) for name in spec.funnel]


def clean(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """Selected columns + 9 recoded columns, only rows passing every funnel step."""
    out = select_survey(df, spec).withColumns(derived_columns(spec))
    conditions = [cond for _, cond in funnel_steps(spec)]
    return out.where(reduce(and_, conditions)) if conditions else out


def clean_funnel(df: DataFrame, spec: SurveySpec = SURVEY) -> DataFrame:
    """Rows left after each cleaning step: ``(step_no, step, rows_left)``, one scan."""
    staged = select_survey(df, spec).withColumns(derived_columns(spec))
    aggs = [F.count(F.lit(1)).alias("s0")]
    names = ["raw"]
    cum = None
    for i, (name, cond) in enumerate(funnel_steps(spec), start=1):
        cum = cond if cum is None else cum & cond
        aggs.append(F.count_if(F.coalesce(cum, F.lit(False))).alias(f"s{i}"))
        names.append(name)
    wide = staged.agg(*aggs)
    pairs = ", ".join(f"{i}, '{n}', s{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (step_no, step, rows_left)")
