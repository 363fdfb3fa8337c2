"""Survey-shaped respondents derived from the driver tables (orders ⋈ customer ⋈ nation).

One respondent per order.  The text below is plain ANSI SQL with only integer arithmetic,
``CASE`` and ``concat_ws``, so the *same* text runs in Spark SQL and in DuckDB; that is what
lets every cohort query be checked against a DuckDB oracle.  Its work grows with
``orders``: nothing here is a fixed sample.

Spark side: the three tables are passed to ``spark.sql`` as DataFrame arguments (no global
temp views), pruned to the columns the text reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

# FIXED VALUES: fixture text shared by Spark and the DuckDB oracle.  The two renamed
# survey columns already carry their pipeline names (AIToolActivities, AIProducts).
_HASHED = """h AS (
  SELECT o.o_orderkey AS k, o.o_totalprice, o.o_orderstatus, o.o_orderpriority, n.n_name,
         (o.o_orderkey * 2654435761) % 4294967296 % 3 AS seg,
         ((o.o_orderkey + 7919)  * 2654435761) % 4294967296 % 97  AS r1,
         ((o.o_orderkey + 15838) * 2654435761) % 4294967296 % 101 AS r2,
         ((o.o_orderkey + 23757) * 2654435761) % 4294967296 % 103 AS r3,
         ((o.o_orderkey + 31676) * 2654435761) % 4294967296 % 107 AS r4,
         ((o.o_orderkey + 39595) * 2654435761) % 4294967296 % 109 AS r5,
         ((o.o_orderkey + 47514) * 2654435761) % 4294967296 % 113 AS r6
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey)"""

_SELECT = """SELECT k AS ResponseId,
  CASE WHEN r1 < 2 THEN NULL WHEN seg = 2 OR r1 < 40 THEN 'Yes' WHEN r1 < 60 THEN 'No, but I plan to soon' WHEN r1 < 95 THEN 'No, and I don''t plan to' ELSE 'Prefer not to say' END AS AISelect,
  CASE r2 % 8 WHEN 0 THEN 'Very favorable' WHEN 1 THEN 'Favorable' WHEN 2 THEN 'Indifferent' WHEN 3 THEN 'Unsure' WHEN 4 THEN 'Unfavorable' WHEN 5 THEN 'Very unfavorable' WHEN 6 THEN CASE WHEN seg = 0 THEN 'Unfavorable' ELSE 'Favorable' END END AS AISent,
  CASE (r3 + seg) % 7 WHEN 0 THEN 'Highly trust' WHEN 1 THEN 'Somewhat trust' WHEN 2 THEN 'Neither trust nor distrust' WHEN 3 THEN 'Somewhat distrust' WHEN 4 THEN 'Highly distrust' WHEN 5 THEN 'Other' END AS AIAcc,
  CASE r4 % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'I''m not sure' WHEN 2 THEN 'No' WHEN 3 THEN 'Maybe' END AS AIThreat,
  CASE WHEN r5 % 11 = 0 THEN NULL WHEN r5 % 11 = 1 THEN 'NA' ELSE concat_ws(';', CASE WHEN r5 % 2 = 0 OR seg = 2 THEN 'Increase productivity' END, CASE WHEN r5 % 3 = 0 OR seg = 2 THEN 'Greater efficiency' END, CASE WHEN r5 % 5 < 2 THEN 'Speed up learning' END, CASE WHEN r5 % 7 = 0 THEN 'Other (please specify):' END) END AS AIBen,
  CASE WHEN seg = 0 AND r6 % 2 = 0 THEN NULL ELSE concat_ws(';', CASE WHEN r6 % 2 = 0 OR seg = 2 THEN 'Writing code' END, CASE WHEN r6 % 3 = 0 OR seg = 2 THEN 'Debugging and getting help' END, CASE WHEN r6 % 5 = 0 THEN 'Testing code' END, CASE WHEN r6 % 7 = 0 THEN 'Other (please specify):' END) END AS AIToolActivities,
  CASE WHEN seg = 0 AND r1 % 3 < 2 THEN NULL ELSE concat_ws(';', 'ChatGPT', CASE WHEN r2 % 2 = 0 OR seg = 2 THEN 'GitHub Copilot' END, CASE WHEN r3 % 3 = 0 THEN 'Google Gemini' END, CASE WHEN r4 % 4 = 0 THEN 'Claude' END, CASE WHEN r5 % 5 = 0 AND seg = 2 THEN 'Codeium' END, CASE WHEN r6 % 9 = 0 THEN 'Tabnine' END, CASE WHEN r1 % 8 = 0 THEN 'Bing AI' END, CASE WHEN r2 % 9 = 1 THEN 'Visual Studio Intellicode' END, CASE WHEN r3 % 10 = 1 THEN 'Perplexity AI' END, CASE WHEN r4 % 11 = 1 THEN 'Amazon Q' END, CASE WHEN r5 % 12 = 1 THEN 'Other (please specify):' END) END AS AIProducts,
  CASE WHEN r2 = 0 THEN NULL ELSE concat_ws(';', CASE WHEN r1 % 2 = 0 THEN 'Python' END, CASE WHEN r2 % 2 = 0 THEN 'JavaScript' END, CASE WHEN r3 % 4 = 0 THEN 'Java' END, CASE WHEN r4 % 5 = 0 THEN 'C#' END, CASE WHEN r5 % 6 = 0 THEN 'C++' END, CASE WHEN r6 % 3 = 0 THEN 'HTML/CSS' END, CASE WHEN r6 % 4 = 0 THEN 'Bash/Shell (all shells)' END, CASE WHEN r1 % 3 = 0 THEN 'TypeScript' END, CASE WHEN r2 % 7 = 0 THEN 'Go' END, CASE WHEN r3 % 8 = 0 THEN 'Rust' END, CASE WHEN r4 % 9 = 0 THEN 'Kotlin' END, CASE WHEN r5 % 2 = 0 THEN 'SQL' END) END AS LanguageHaveWorkedWith,
  CASE r3 % 11 WHEN 0 THEN 'Just me - I am a freelancer, sole proprietor, etc.' WHEN 1 THEN '2 to 9 employees' WHEN 2 THEN '10 to 19 employees' WHEN 3 THEN '20 to 99 employees' WHEN 4 THEN '100 to 499 employees' WHEN 5 THEN '500 to 999 employees' WHEN 6 THEN '1,000 to 4,999 employees' WHEN 7 THEN '5,000 to 9,999 employees' WHEN 8 THEN '10,000 or more employees' WHEN 9 THEN 'I don''t know' END AS OrgSize,
  CASE WHEN r4 = 0 THEN 'More than 50 years' WHEN r4 < 5 THEN 'Less than 1 year' WHEN r4 > 103 THEN NULL ELSE CAST(r4 % 41 AS VARCHAR(10)) END AS YearsCodePro,
  CASE WHEN r5 = 3 THEN NULL WHEN r5 = 4 THEN 5000.0 ELSE o_totalprice END AS ConvertedCompYearly,
  CASE WHEN r6 > 110 THEN NULL ELSE r6 % 12 END AS JobSat,
  n_name AS Country,
  CASE WHEN r2 % 13 = 0 THEN NULL ELSE concat_ws(';', CASE WHEN r2 < 24 THEN 'Developer, full-stack' WHEN r2 < 42 THEN 'Developer, back-end' WHEN r2 < 54 THEN 'Developer, front-end' WHEN r2 < 64 THEN 'Engineering manager' WHEN r2 < 73 THEN 'Data scientist or machine learning specialist' WHEN r2 < 81 THEN 'Developer, desktop or enterprise applications' WHEN r2 < 88 THEN 'Developer, mobile' WHEN r2 < 93 THEN 'Developer, embedded applications or devices' WHEN r2 < 97 THEN 'Database administrator' ELSE 'Academic researcher' END, CASE WHEN r3 % 6 = 0 THEN 'DevOps specialist' END) END AS DevType,
  CASE WHEN r1 % 10 = 0 THEN 'Student, full-time' WHEN r1 % 10 = 1 THEN 'Employed, full-time;Independent contractor, freelancer, or self-employed' ELSE 'Employed, full-time' END AS Employment,
  CASE WHEN r4 % 17 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Remote' WHEN o_orderstatus = 'O' THEN 'Hybrid (some remote, some in-person)' ELSE 'In-person' END AS RemoteWork,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'I am a developer by profession' WHEN '2-HIGH' THEN 'I am not primarily a developer, but I write code sometimes as part of my work/studies' WHEN '3-MEDIUM' THEN 'I used to be a developer by profession, but no longer am' WHEN '4-NOT SPECIFIED' THEN 'I code primarily as a hobby' ELSE 'I am learning to code' END AS MainBranch
FROM h"""
# end of fixed values


def respondents_cte(orders: str = "orders", customer: str = "customer", nation: str = "nation") -> str:
    """``h AS (...), respondents AS (...)`` for use after ``WITH`` in an oracle query."""
    return _HASHED.format(orders=orders, customer=customer, nation=nation) + ",\nrespondents AS (\n" + _SELECT + "\n)"


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The respondents table for the driver tables under ``sf_dir``."""
    # dealt by the join key: the join with customer needs that anyway unless customer is small,
    # and the heavy row work after it is then spread whatever the input's files are
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority").repartition("o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    text = "WITH " + _HASHED + "\n" + _SELECT
    return spark.sql(text, orders=orders, customer=customer, nation=nation)


def raw_survey_shape(df: DataFrame) -> DataFrame:
    """Respondents under the survey file's own column names (one of them contains a space)."""
    from ..spec import RENAMES

    back = {new: old for old, new in RENAMES.items()}
    return df.select(*[df[c].alias(back.get(c, c)) for c in df.columns])
