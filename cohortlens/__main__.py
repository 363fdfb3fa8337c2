"""Console entry: run the whole analysis and print (and optionally write) every table.

    python -m cohortlens --csv survey.csv [--out output/report] [--k 3]
    python -m cohortlens --sf-dir /root/testdata/sf0.01        # respondents view
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="cohortlens")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--csv", default="data/dataset.csv", help="survey CSV file or folder")
    src.add_argument("--sf-dir", help="folder of driver tables (respondents view)")
    p.add_argument("--out", default="output/report", help="write every table under this folder; '' writes none")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--k", type=int, default=3)
    p.add_argument("--no-sweep", action="store_true")
    p.add_argument("--master", default="local[*]")
    a = p.parse_args(argv)

    from .plans.pipeline import run
    from .session import get_session

    spark = get_session(a.master)
    if not a.sf_dir:
        from .sources.survey_csv import stage_survey_csv
        raw = stage_survey_csv(spark, a.csv)  # the file cannot be split: it is parsed once
    else:
        from .sources import raw_survey_shape, respondents
        raw = raw_survey_shape(respondents(spark, a.sf_dir))
    tables = run(raw, k=a.k, ks=None if a.no_sweep else range(2, 9), out_dir=a.out or None, fmt=a.format)
    for name, df in tables.items():
        if name == "labelled":
            continue
        print(f"\n== {name}")
        df.show(truncate=False)
    tables.release()
    spark.stop()


if __name__ == "__main__":
    main()
