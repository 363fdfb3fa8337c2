"""The survey file itself: a quoted, multi-line CSV with ``NA`` for missing answers.

``multiLine`` CSV cannot be split, so one task reads a whole file.  At scale, read it once
with an explicit schema and stage it to Parquet (``stage_survey_csv``); every later job then
scans splittable, column-pruned Parquet in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# FIXED VALUES: the reader options of the survey file.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": "NA",
    "mode": "DROPMALFORMED",
    "multiLine": "true",
    "escape": '"',
}


def survey_schema(columns, numeric=("ResponseId", "ConvertedCompYearly", "JobSat")) -> T.StructType:
    """All-string schema except the numeric survey columns (no inference job at read)."""
    fields = []
    for c in columns:
        if c == "ResponseId":
            fields.append(T.StructField(c, T.LongType()))
        elif c in numeric:
            fields.append(T.StructField(c, T.DoubleType()))
        else:
            fields.append(T.StructField(c, T.StringType()))
    return T.StructType(fields)


def read_survey_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    infer: bool = False) -> DataFrame:
    """Read the survey CSV with the survey's options.

    ``schema`` fixes the types (and makes surplus-field rows malformed, so they are
    dropped).  ``infer=True`` reproduces schema inference, at the cost of one extra pass.
    """
    reader = spark.read.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of the file's first record (one line is read)."""
    first = spark.read.text(path).limit(1).first()
    if first is None:
        return []
    line = spark.createDataFrame([(first[0],)], "line string")
    return [c for c in line.select(F.from_csv("line", F.lit(", ".join(f"c{i} STRING" for i in range(first[0].count(",") + 1))))).first()[0]
            if c is not None]


def stage_survey_csv(spark: SparkSession, path: str) -> DataFrame:
    """The survey file parsed once, with the schema of its header, as a Parquet table in the shared folder."""
    return materialize(read_survey_csv(spark, path, schema=survey_schema(header_columns(spark, path))), "survey")
