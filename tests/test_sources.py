"""Survey CSV reader, sinks and read-back."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortlens.sources import read_catalogue, read_survey_csv, read_table_dir, survey_schema, write_labelled, write_tables
from cohortlens.spec import SELECTED_COLUMNS


def test_csv_reader_quotes_newlines_na_and_malformed(spark):
    d = tempfile.mkdtemp(prefix="cohortlens-csv-")
    path = os.path.join(d, "survey.csv")
    with open(path, "w") as f:
        f.write("ResponseId,Country,ConvertedCompYearly,DevType\n")
        f.write('1,"Line one\nline two",50000,"He said ""hi"""\n')
        f.write("2,NA,NA,x\n")
        f.write("3,C,7,y,SURPLUS\n")
        f.write("4,D,8,z\n")
    schema = survey_schema(["ResponseId", "Country", "ConvertedCompYearly", "DevType"])
    rows = {r.ResponseId: r for r in read_survey_csv(spark, path, schema=schema).collect()}
    assert set(rows) == {1, 2, 4}  # the row with a surplus field is dropped
    assert rows[1].Country == "Line one\nline two" and rows[1].DevType == 'He said "hi"'
    assert rows[2].Country is None and rows[2].ConvertedCompYearly is None
    assert rows[4].ConvertedCompYearly == 8.0


def test_csv_schema_inference_option(spark):
    d = tempfile.mkdtemp(prefix="cohortlens-csv-")
    path = os.path.join(d, "s.csv")
    with open(path, "w") as f:
        f.write("ResponseId,JobSat\n1,7.5\n2,NA\n")
    df = read_survey_csv(spark, path, infer=True)
    assert dict(df.dtypes)["JobSat"] == "double"


def test_write_tables_and_read_back(spark):
    d = tempfile.mkdtemp(prefix="cohortlens-out-")
    t = spark.createDataFrame([("Remote", 1.5), ("Hybrid (some remote, some in-person)", 2.5)], "k string, v double")
    for fmt in ("csv", "parquet"):
        root = os.path.join(d, fmt)
        paths = write_tables({"t": t}, root, fmt=fmt)
        back = read_table_dir(spark, paths["t"], fmt=fmt, schema=t.schema if fmt == "csv" else None)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, t.collect()))
        parts = [p for p in os.listdir(paths["t"]) if p.startswith("part-")]
        assert len(parts) == 1


def test_catalogue_is_published_as_a_whole(spark, tmp_path):
    """A run that ends half-way leaves the earlier tables readable, all of them of one run."""
    root = str(tmp_path / "report")
    first = {f"t{i}": spark.createDataFrame([(1, i)], "run int, i int") for i in range(19)}
    assert read_catalogue(spark, root) == {}
    write_tables(first, root, fmt="csv")
    held = read_catalogue(spark, root)
    broken = {f"t{i}": spark.createDataFrame([(2, i)], "run int, i int") for i in range(19)}
    broken["t9"] = broken["t9"].selectExpr("assert_true(false) is null as run", "i")
    with pytest.raises(Exception):
        write_tables(broken, root, fmt="csv")
    for got in (held, read_catalogue(spark, root)):
        assert sorted((t.first().run, t.first().i) for t in got.values()) == [(1, i) for i in range(19)]
    second = {n: t.withColumn("run", F.lit(3)) for n, t in first.items()}
    write_tables(second, root, fmt="parquet", labelled=spark.createDataFrame([(1, 2)], "ResponseId int, features int"))
    now = read_catalogue(spark, root)
    assert {t.first().run for n, t in now.items() if n != "labelled_developers"} == {3} and now["labelled_developers"].columns == ["ResponseId"]
    assert held["t0"].first().run == 1  # a reader of the earlier catalogue goes on
    write_tables(first, root)
    assert len([p for p in os.listdir(root) if p.startswith("catalogue-")]) == 2
    assert not [p for p in os.listdir(root) if p.startswith("draft-")]


def test_write_labelled_drops_vectors(spark):
    from pyspark.ml.feature import VectorAssembler
    d = tempfile.mkdtemp(prefix="cohortlens-out-")
    df = spark.createDataFrame([(1, 2.0)], "ResponseId long, x double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    write_labelled(df, os.path.join(d, "lab.parquet"))
    assert spark.read.parquet(os.path.join(d, "lab.parquet")).columns == ["ResponseId", "x"]


def test_survey_schema_covers_selected():
    s = survey_schema(SELECTED_COLUMNS)
    assert [f.name for f in s.fields] == SELECTED_COLUMNS


def test_survey_csv_to_clean(spark):
    import csv

    from cohortlens.operators.clean import clean
    from edge_rows import COLUMNS, edge_rows

    rows, keep = edge_rows()
    d = tempfile.mkdtemp(prefix="cohortlens-csv-")
    path = os.path.join(d, "survey.csv")
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL, doublequote=True)
        w.writerow(COLUMNS)
        for r in rows:
            w.writerow(["NA" if v is None else v for v in r])
    raw = read_survey_csv(spark, path, infer=True)
    assert "AIToolCurrently Using" in raw.columns
    got = {r.ResponseId for r in clean(raw).collect()}
    assert got == keep


def test_survey_csv_is_parsed_once_with_the_header_schema(spark, tmp_path):
    from cohortlens.sources.survey_csv import stage_survey_csv

    path = tmp_path / "s.csv"
    path.write_text('ResponseId,JobSat,"AI, tools",DevType\n1,7.5,x,"a\nb"\n2,NA,,z\n')
    df = stage_survey_csv(spark, str(path))
    path.unlink()  # later reads come from the staged table
    assert df.dtypes == [("ResponseId", "bigint"), ("JobSat", "double"), ("AI, tools", "string"), ("DevType", "string")]
    assert [tuple(r) for r in df.orderBy("ResponseId").collect()] == [(1, 7.5, "x", "a\nb"), (2, None, None, "z")]
