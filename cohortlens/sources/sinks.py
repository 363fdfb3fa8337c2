"""Result sinks: report catalogues, published as a whole, and the labelled per-respondent table.

A catalogue is written under a folder of its own, ``<root>/run-<id>/<table>``, and becomes the
current one when its manifest, ``<root>/catalogue-<number>.json``, is renamed into place: one
file, so a run that ends half-way, or a reader in between, finds the tables of one run only.
Manifests are numbered; the one with the largest number counts, and two runs that end together
get two numbers.  The folders of the current and the previous catalogue stay for readers that
hold them; older ones go.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VECTOR_COLUMNS = ("features_raw", "features", "reg_features")
LABELLED = "labelled_developers"
_MANIFEST = re.compile(r"catalogue-([0-9]{10})\.json$")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Overwrite ``path`` with ``df``.

    ``single_file`` coalesces to one part: only for already-aggregated tables, because
    ``coalesce(1)`` also narrows the stage that produces the rows.
    """
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_labelled(df: DataFrame, path: str) -> None:
    """Per-respondent table without the ML vector columns, as Parquet (keeps types)."""
    df.drop(*[c for c in VECTOR_COLUMNS if c in df.columns]).write.mode("overwrite").parquet(path)


def _files(spark: SparkSession, root: str):
    """The file system that holds ``root``, and its class of paths."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(conf), path


def _manifests(spark: SparkSession, root: str) -> dict[int, dict]:
    """Published manifests by number."""
    fs, path = _files(spark, root)
    if not fs.exists(path(root)):
        return {}
    found = [f.getPath() for f in fs.listStatus(path(root)) if _MANIFEST.search(f.getPath().getName())]
    names = {int(_MANIFEST.search(p.getName())[1]): p.toString() for p in found}
    return {k: json.loads("".join(r[0] for r in spark.read.text(p, wholetext=True).collect())) for k, p in names.items()}


def _publish(spark: SparkSession, root: str, manifest: dict) -> None:
    fs, path = _files(spark, root)
    draft = path(f"{root}/draft-{uuid.uuid4().hex}.json")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps(manifest, indent=1).encode()))
    finally:
        out.close()
    k = max(_manifests(spark, root), default=0) + 1
    while not fs.rename(draft, path(f"{root}/catalogue-{k:010d}.json")):  # the number was taken meanwhile
        k += 1
    for old, other in sorted(_manifests(spark, root).items())[:-2]:
        fs.delete(path(f"{root}/catalogue-{old:010d}.json"), False)
        fs.delete(path(f"{root}/{other['run']}"), True)


def write_tables(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet", single_file: bool = True,
                 labelled: DataFrame | None = None) -> dict[str, str]:
    """Write a report catalogue (and the labelled rows), publish it, and return the tables' paths by name."""
    spark = next(iter([*tables.values(), *([labelled] if labelled is not None else [])])).sparkSession
    root, run = root.rstrip("/"), f"run-{uuid.uuid4().hex}"
    told = {}
    for name, df in tables.items():
        write_table(df, f"{root}/{run}/{name}", fmt=fmt, single_file=single_file)
        told[name] = {"format": fmt, "schema": df.schema.jsonValue()}
    if labelled is not None:
        write_labelled(labelled, f"{root}/{run}/{LABELLED}")
        told[LABELLED] = {"format": "parquet", "schema": None}
    _publish(spark, root, {"run": run, "tables": told})
    return {name: f"{root}/{run}/{name}" for name in told}


def read_catalogue(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current catalogue under ``root`` by name (none published: no tables)."""
    root = root.rstrip("/")
    found = _manifests(spark, root)
    if not found:
        return {}
    current = found[max(found)]
    schema = lambda t: T.StructType.fromJson(t["schema"]) if t["schema"] else None
    return {name: read_table_dir(spark, f"{root}/{current['run']}/{name}", t["format"], schema(t))
            for name, t in current["tables"].items()}


def read_table_dir(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: T.StructType | None = None) -> DataFrame:
    """Read a written table folder back (all part files, not just the first)."""
    if fmt == "csv":
        r = spark.read.option("header", "true")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
        return r.csv(path)
    return spark.read.parquet(path)
