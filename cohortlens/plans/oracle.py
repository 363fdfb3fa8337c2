"""DuckDB oracle SQL for the registered queries.

Each text starts from the shared respondents CTE (the same fixture text Spark runs) and
re-derives every stage independently in SQL: cleaning, counts, indicators, z-scores,
seeded centres, nearest-centre assignment, labels, bins.  It shares no code path with the
Spark operators beyond the fixed answer vocabularies.
"""

from __future__ import annotations

from ..functions.recode import safe_name
from ..sources.respondents import respondents_cte
from ..spec import (AI_ACC_LEVELS, AI_SELECT_LEVELS, AI_SENT_LEVELS, AI_THREAT_LEVELS, AI_TOOLS,
                    ARCHETYPE_ORDER, CLUSTER_FEATURES, CORRELATION_COLUMNS, CORRELATION_DISPLAY_ORDER,
                    COUNTRY_SHORT_NAMES, LANGUAGES, MAIN_BRANCH_ALIASES, MAIN_BRANCH_VALUES,
                    ORG_SIZE_LEVELS, OTHER_ANSWER, RANK_FEATURE, REGRESSION_FEATURES, REMOTE_WORK_VALUES, USAGE_BINS)

USAGE = [label for label, _ in USAGE_BINS]
# FIXED VALUES: the eight most frequent roles of the respondents view at sf0.001 and sf0.01, as column names (a view
# takes no PIVOT whose columns depend on the data).
WIDE_ROLES = ["Academic_researcher", "Data_scientist_or_machine_learning_specialist", "dev_back_end",
              "dev_desktop_or_enterprise_applications", "dev_front_end", "dev_full_stack", "dev_mobile", "Engineering_manager"]
Z = ["z_" + c for c in CLUSTER_FEATURES]
RAW_COLUMNS = ["ResponseId", "AISelect", "AISent", "AIAcc", "AIThreat", "AIBen", "AIToolActivities",
               "AIProducts", "LanguageHaveWorkedWith", "OrgSize", "YearsCodePro", "ConvertedCompYearly",
               "JobSat", "Country", "DevType", "Employment", "RemoteWork", "MainBranch"]
DERIVED = ["salary_usd", "years_code_pro", "org_size_int", "job_sat_int", "ai_select_int", "ai_acc_int",
           "ai_threat_int", "ai_sent_int", "ai_ben_count"]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ident(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def rhu(expr: str, d: int) -> str:
    """HALF_UP rounding on a DECIMAL, returned as DOUBLE."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {d}) AS DOUBLE)"


def rsig(expr: str, digits: int = 6) -> str:
    """Round to significant digits (same arithmetic as ``round_sig``)."""
    e = f"pow(10.0, floor(log10(abs({expr}))))"
    return (f"(CASE WHEN {expr} = 0 THEN 0.0 ELSE "
            f"CAST(round(CAST(({expr}) / {e} AS DECIMAL(38,15)), {digits - 1}) AS DOUBLE) * {e} END)")


def case_map(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {col} = {lit(k)} THEN {v}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def count_items(col: str, filtered: bool) -> str:
    arr = f"string_split({col}, ';')"
    if filtered:
        arr = f"list_filter({arr}, lambda x: x <> {lit(OTHER_ANSWER)} AND x <> '')"
    return f"CASE WHEN {col} IS NULL OR {col} = 'NA' THEN 0 ELSE CAST(len({arr}) AS INTEGER) END"


def indicator(col: str, value: str) -> str:
    return f"CASE WHEN list_contains(string_split({col}, ';'), {lit(value)}) THEN 1 ELSE 0 END"


def usage_bin(col: str = "ai_product_count") -> str:
    parts = []
    for label, bound in USAGE_BINS:
        parts.append(f"ELSE {lit(label)}" if bound is None else f"WHEN {col} <= {bound} THEN {lit(label)}")
    return "CASE " + " ".join(parts) + " END"


def experience_bin(col: str = "years_code_pro") -> str:
    return (f"CASE WHEN {col} < 5 THEN 'Junior_0to4' WHEN {col} < 11 THEN 'Mid_5to10' "
            f"ELSE 'Senior_11plus' END")


def primary_role(col: str = "DevType") -> str:
    return f"CASE WHEN {col} IS NOT NULL THEN string_split({col}, ';')[1] ELSE 'Unknown' END"


def employed(col: str = "Employment") -> str:
    return f"({col} IS NOT NULL AND contains({col}, 'Employed, full-time'))"


STAGED = f"""staged AS (
  SELECT *,
    TRY_CAST(ConvertedCompYearly AS DOUBLE) AS salary_usd,
    CASE WHEN YearsCodePro = 'More than 50 years' THEN 50 WHEN YearsCodePro = 'Less than 1 year' THEN 0
         ELSE TRY_CAST(trunc(TRY_CAST(YearsCodePro AS DOUBLE)) AS INTEGER) END AS years_code_pro,
    {case_map('OrgSize', ORG_SIZE_LEVELS)} AS org_size_int,
    TRY_CAST(trunc(JobSat) AS INTEGER) AS job_sat_int,
    {case_map('AISelect', AI_SELECT_LEVELS)} AS ai_select_int,
    {case_map('AIAcc', AI_ACC_LEVELS, '2')} AS ai_acc_int,
    {case_map('AIThreat', AI_THREAT_LEVELS, '0')} AS ai_threat_int,
    {case_map('AISent', AI_SENT_LEVELS, '2')} AS ai_sent_int,
    {count_items('AIBen', True)} AS ai_ben_count
  FROM respondents)"""

FUNNEL = [
    ("employed_full_time", employed()),
    ("outcomes_present", "(ConvertedCompYearly IS NOT NULL AND JobSat IS NOT NULL AND AISelect IS NOT NULL)"),
    ("salary_in_range", "(salary_usd IS NOT NULL AND salary_usd > 5000 AND salary_usd < 1000000)"),
    ("years_known", "(years_code_pro IS NOT NULL)"),
    ("org_size_known", "(org_size_int IS NOT NULL)"),
    ("job_sat_in_range", "(job_sat_int IS NOT NULL AND job_sat_int BETWEEN 0 AND 10)"),
    ("ai_select_known", "(ai_select_int IS NOT NULL)"),
]

CLEAN = "clean AS (SELECT * FROM staged WHERE " + " AND ".join(c for _, c in FUNNEL) + ")"

TOOL_COLS = ["uses_" + safe_name(t) for t in AI_TOOLS]
LANG_COLS = ["lang_" + safe_name(v) for v in LANGUAGES]

FEAT = ("feat AS (SELECT *, "
        f"CAST({count_items('AIProducts', False)} AS INTEGER) AS ai_product_count, "
        f"{count_items('AIToolActivities', True)} AS ai_task_count, "
        + ", ".join(f"{indicator('AIProducts', t)} AS {c}" for t, c in zip(AI_TOOLS, TOOL_COLS)) + ", "
        + ", ".join(f"{indicator('LanguageHaveWorkedWith', v)} AS {c}" for v, c in zip(LANGUAGES, LANG_COLS))
        + " FROM clean)")

ZSTATS = ("zstats AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}"
                                            for c in CLUSTER_FEATURES) + " FROM feat)")
ZT = ("z AS (SELECT feat.*, " + ", ".join(
    f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END AS z_{c}" for c in CLUSTER_FEATURES)
    + " FROM feat CROSS JOIN zstats)")

CENTRES = ("centres AS (SELECT CAST(dense_rank() OVER (ORDER BY ai_select_int) - 1 AS INTEGER) AS cluster, "
           + ", ".join(f"avg({c}) AS {c}" for c in Z) + " FROM z GROUP BY ai_select_int)")
DIST = ("dist AS (SELECT z.ResponseId, c.cluster, "
        + " + ".join(f"(z.{c} - c.{c}) * (z.{c} - c.{c})" for c in Z) + " AS d FROM z CROSS JOIN centres c)")
ASSIGN = ("assign AS (SELECT ResponseId, cluster AS prediction, d FROM (SELECT *, row_number() OVER "
          "(PARTITION BY ResponseId ORDER BY d, cluster) AS rn FROM dist) WHERE rn = 1)")
LABELS = ("labels AS (SELECT cluster AS prediction, rank, CASE WHEN rank = 0 THEN 'Traditional Engineer' "
          "WHEN rank = n - 1 THEN 'AI Power User' WHEN n = 3 AND rank = 1 THEN 'AI Experimenter' "
          "WHEN rank = 1 THEN 'Light AI User' ELSE 'AI Experimenter (tier ' || rank || ')' END AS archetype "
          "FROM (SELECT cluster, CAST(row_number() OVER (ORDER BY z_ai_product_count, cluster) - 1 AS INTEGER) "
          "AS rank, count(*) OVER () AS n FROM centres))")
LABELLED = ("labelled AS (SELECT z.*, a.prediction, l.archetype FROM z JOIN assign a USING (ResponseId) "
            "JOIN labels l USING (prediction))")
BINNED = (f"binned AS (SELECT *, {usage_bin()} AS ai_usage_bin, {experience_bin()} AS experience_bin, "
          f"{primary_role()} AS primary_role FROM labelled)")

STAGES = [("staged", STAGED), ("clean", CLEAN), ("feat", FEAT), ("zstats", ZSTATS), ("z", ZT),
          ("centres", CENTRES), ("dist", DIST), ("assign", ASSIGN), ("labels", LABELS),
          ("labelled", LABELLED), ("binned", BINNED)]


def upto(stage: str | None, extra: list[str] = ()) -> str:
    """``WITH`` clause with the respondents CTE and every stage up to ``stage``."""
    ctes = [respondents_cte()]
    if stage is not None:
        for name, text in STAGES:
            ctes.append(text)
            if name == stage:
                break
    ctes.extend(extra)
    return "WITH " + ",\n".join(ctes) + "\n"


def grouped(by: str, select: list[str], src: str = "binned", where: str | None = None) -> str:
    w = f" WHERE {where}" if where else ""
    return f"SELECT {by}, " + ", ".join(select) + f" FROM {src}{w} GROUP BY {by}"


def pivot_mean_sql(row: str, src: str, measure: str = "salary_usd", digits: int = 0) -> str:
    cols = ", ".join(f"{rhu(f'avg(CASE WHEN ai_usage_bin = {lit(u)} THEN {measure} END)', digits)} AS {ident(u)}"
                     for u in USAGE)
    return f"SELECT {row}, {cols} FROM {src} GROUP BY {row}"


def topk_sql(col: str, k: int, src: str, exclude: list[str] = ()) -> str:
    ex = "".join(f" AND {col} <> {lit(e)}" for e in exclude)
    return (f"SELECT {col}, count(*) AS count FROM {src} WHERE {col} IS NOT NULL{ex} GROUP BY {col} "
            f"ORDER BY count DESC, {col} ASC LIMIT {k}")


def corr_expr(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"covar_samp({a}, {b}) / (stddev_samp(CASE WHEN {both} THEN {a} END) * "
            f"stddev_samp(CASE WHEN {both} THEN {b} END))")


def corr_pairs_cte(cols: list[str], src: str, name: str = "pairs") -> str:
    ps = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    wide = "SELECT " + ", ".join(f"{corr_expr(a, b)} AS c{i}" for i, (a, b) in enumerate(ps)) + f" FROM {src}"
    rows = " UNION ALL ".join(
        f"SELECT {i} AS pair_no, {lit(a)} AS var_a, {lit(b)} AS var_b, floor(c{i} * 1000 + 0.5) / 1000 AS pearson_corr FROM cw"
        for i, (a, b) in enumerate(ps))
    return f"cw AS ({wide}), {name} AS ({rows})"


def ols_ctes(src: str, label: str, feats: list[str]) -> str:
    """Centred cross-products, a Cholesky factor, the solve and the inverse diagonal,
    each a one-row CTE of scalar expressions (p is small)."""
    p = len(feats)
    xs = list(feats)
    means = ("om AS (SELECT count(*) AS n, avg(" + label + ") AS my, "
             + ", ".join(f"avg({x}) AS m{i}" for i, x in enumerate(xs))
             + f" FROM {src} WHERE {label} IS NOT NULL AND "
             + " AND ".join(f"{x} IS NOT NULL" for x in xs) + ")")
    cross = []
    for i in range(p):
        for j in range(i + 1):
            cross.append(f"sum(({xs[i]} - m{i}) * ({xs[j]} - m{j})) AS s{i}_{j}")
        cross.append(f"sum(({xs[i]} - m{i}) * ({label} - my)) AS sy{i}")
    cross.append(f"sum(({label} - my) * ({label} - my)) AS syy")
    cp = ("cp AS (SELECT om.*, " + ", ".join(cross) + f" FROM {src} CROSS JOIN om WHERE {label} IS NOT NULL AND "
          + " AND ".join(f"{x} IS NOT NULL" for x in xs) + " GROUP BY ALL)")
    ctes = [means, cp]
    prev = "cp"
    # Cholesky: L[i][j]
    for j in range(p):
        cols = []
        diag = f"sqrt(s{j}_{j}" + "".join(f" - L{j}_{k} * L{j}_{k}" for k in range(j)) + ")"
        cols.append(f"{diag} AS L{j}_{j}")
        ctes.append(f"ch{j}a AS (SELECT *, {diag} AS L{j}_{j} FROM {prev})")
        prev = f"ch{j}a"
        below = []
        for i in range(j + 1, p):
            below.append(f"(s{i}_{j}" + "".join(f" - L{i}_{k} * L{j}_{k}" for k in range(j)) + f") / L{j}_{j} AS L{i}_{j}")
        if below:
            ctes.append(f"ch{j}b AS (SELECT *, {', '.join(below)} FROM {prev})")
            prev = f"ch{j}b"
    # forward solve L w = sy, then back solve L^T b = w
    for i in range(p):
        ctes.append(f"fw{i} AS (SELECT *, (sy{i}" + "".join(f" - L{i}_{k} * w{k}" for k in range(i))
                    + f") / L{i}_{i} AS w{i} FROM {prev})")
        prev = f"fw{i}"
    for i in reversed(range(p)):
        ctes.append(f"bw{i} AS (SELECT *, (w{i}" + "".join(f" - L{k}_{i} * b{k}" for k in range(i + 1, p))
                    + f") / L{i}_{i} AS b{i} FROM {prev})")
        prev = f"bw{i}"
    # inverse of L (lower): M[i][j]
    for j in range(p):
        ctes.append(f"iv{j}_{j} AS (SELECT *, 1.0 / L{j}_{j} AS M{j}_{j} FROM {prev})")
        prev = f"iv{j}_{j}"
        for i in range(j + 1, p):
            ctes.append(f"iv{i}_{j} AS (SELECT *, -(" + " + ".join(f"L{i}_{k} * M{k}_{j}" for k in range(j, i))
                        + f") / L{i}_{i} AS M{i}_{j} FROM {prev})")
            prev = f"iv{i}_{j}"
    sse = "syy - (" + " + ".join(f"b{i} * sy{i}" for i in range(p)) + ")"
    inv_diag = [" + ".join(f"M{i}_{j} * M{i}_{j}" for i in range(j, p)) for j in range(p)]
    ctes.append(f"fit AS (SELECT *, {sse} AS sse, ({sse}) / (n - {p} - 1) AS sigma2, "
                + ", ".join(f"{inv_diag[j]} AS v{j}" for j in range(p)) + f" FROM {prev})")
    return ",\n".join(ctes)


def ols_coefficients_sql(src_with: str, src: str, label: str, feats: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {lit(f)} AS feature, {rsig(f'b{i}')} AS coefficient, {rsig(f'sqrt(sigma2 * v{i})')} AS std_error, "
        f"{rsig(f'b{i} / sqrt(sigma2 * v{i})')} AS t_stat FROM fit" for i, f in enumerate(feats))
    return src_with + ", " + ols_ctes(src, label, feats) + "\n" + rows


def ols_marks_sql(src_with: str, src: str, label: str, feats: list[str]) -> str:
    """Coefficients with two-sided p-values of Student's t and what is read off them.

    p is the incomplete beta function at (freedom / 2, 1/2), or one less that at the mirrored place, by the steps of
    its continued fraction in a recursive query."""
    rows = " UNION ALL ".join(f"SELECT {lit(f)} AS feature, b{i} AS coefficient, sqrt(sigma2 * v{i}) AS std_error, "
                              f"b{i} / sqrt(sigma2 * v{i}) AS t_stat, CAST(n - {len(feats)} - 1 AS DOUBLE) AS freedom FROM fit"
                              for i, f in enumerate(feats))
    odd = "-(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))"
    even = "(k + 1) * (b - k - 1) * x / ((a + 2 * k + 1) * (a + 2 * k + 2))"
    return (src_with.replace("WITH ", "WITH RECURSIVE ", 1) + ", " + ols_ctes(src, label, feats) + f""",
coefs AS ({rows}),
placed AS (
  SELECT *, freedom / (freedom + t_stat * t_stat) AS z, z > (freedom / 2 + 1) / (freedom / 2 + 2.5) AS mirrored,
    CASE WHEN mirrored THEN 0.5 ELSE freedom / 2 END AS a, CASE WHEN mirrored THEN freedom / 2 ELSE 0.5 END AS b,
    CASE WHEN mirrored THEN 1 - z ELSE z END AS x FROM coefs),
lentz AS (
  SELECT feature, a, b, x, 0 AS k, CAST(1 AS DOUBLE) AS c, 1 / (1 - (a + b) * x / (a + 1)) AS d, 1 / (1 - (a + b) * x / (a + 1)) AS h FROM placed
  UNION ALL
  SELECT feature, a, b, x, k, c, d, h * c * d FROM (
    SELECT feature, a, b, x, k + 1 AS k, 1 + t2 / c1 AS c, 1 / (1 + t2 * d1) AS d, h * c1 * d1 AS h FROM (
      SELECT *, 1 + t1 / c AS c1, 1 / (1 + t1 * d) AS d1 FROM (
        SELECT *, {even} AS t1, {odd.replace('k', '(k + 1)')} AS t2 FROM lentz WHERE k < 2000)))),
told AS (
  SELECT p.*, exp(p.a * ln(p.x) + p.b * ln(1 - p.x) - ln(p.a) + lgamma(p.a + p.b) - lgamma(p.a) - lgamma(p.b)) * h AS share
  FROM placed p JOIN lentz l ON l.feature = p.feature AND l.k = 2000),
valued AS (SELECT *, CASE WHEN mirrored THEN 1 - share ELSE share END AS p FROM told)
SELECT feature, {rsig('coefficient')} AS coefficient, {rsig('std_error')} AS std_error, {rsig('t_stat')} AS t_stat, {rsig('p')} AS p_value,
  CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS significance,
  CASE WHEN p >= 0.05 OR coefficient = 0 THEN 'not_significant' WHEN coefficient < 0 THEN 'negative' ELSE 'positive' END AS direction,
  CASE WHEN coefficient >= 0 THEN 'positive: not supported' WHEN p < 0.01 THEN 'supported' WHEN p < 0.05 THEN 'weak support'
    ELSE 'not significant' END AS verdict
FROM valued""")


def ols_fit_sql(src_with: str, src: str, label: str, feats: list[str]) -> str:
    p = len(feats)
    icpt = "my - (" + " + ".join(f"b{i} * m{i}" for i in range(p)) + ")"
    r2 = "(1 - sse / syy)"
    return (src_with + ", " + ols_ctes(src, label, feats) + "\n"
            f"SELECT {rsig(icpt)} AS intercept, {rsig(r2)} AS r2, "
            f"{rsig(f'1 - (1 - {r2}) * (n - 1) / (n - {p} - 1)')} AS r2_adj, {rsig('sqrt(sse / n)')} AS rmse, "
            f"CAST(n AS BIGINT) AS n FROM fit")


def ols_fitted_sql(src_with: str, src: str, label: str, feats: list[str], keep: list[str], out: str) -> str:
    value = "my + " + " + ".join(f"b{i} * (r.{x} - m{i})" for i, x in enumerate(feats))
    return (src_with + ", " + ols_ctes(src, label, feats) + ",\n"
            f"fitted AS (SELECT {', '.join('r.' + k for k in keep)}, {value} AS v FROM {src} r CROSS JOIN fit WHERE r.{label} IS NOT NULL AND "
            + " AND ".join(f"r.{x} IS NOT NULL" for x in feats) + f")\nSELECT {', '.join(keep)}, {rsig('v')} AS {out} FROM fitted")


def silhouette_sql(src: str, pred: str, cols: list[str]) -> str:
    sq = " + ".join(f"{c} * {c}" for c in cols)
    cs = (f"cs AS (SELECT {pred} AS cid, count(*) AS n, " + ", ".join(f"sum({c}) AS s{i}" for i, c in enumerate(cols))
          + f", sum({sq}) AS psi FROM {src} GROUP BY {pred})")
    dot = " + ".join(f"p.{c} * cs.s{i}" for i, c in enumerate(cols))
    psq = " + ".join(f"p.{c} * p.{c}" for c in cols)
    pd_ = (f"pd AS (SELECT p.__rid, p.{pred} AS own, cs.cid, cs.n, ({psq}) + cs.psi / cs.n - 2 * ({dot}) / cs.n AS dis "
           f"FROM (SELECT row_number() OVER () AS __rid, * FROM {src}) p CROSS JOIN cs)")
    pt = ("pt AS (SELECT __rid, max(CASE WHEN cid = own THEN n END) AS own_n, "
          "max(CASE WHEN cid = own THEN dis * n / (n - 1) END) AS a, min(CASE WHEN cid <> own THEN dis END) AS b "
          "FROM pd GROUP BY __rid)")
    body = ("SELECT " + rhu("avg(CASE WHEN own_n <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 "
                            "ELSE 0.0 END)", 9) + " AS silhouette FROM pt")
    return cs + ", " + pd_ + ", " + pt + "\n" + body


def kmeans_ctes(src: str, key: str, cols: list[str], ks: list[int], max_iter: int, seed: int = 42) -> list[str]:
    """K-Means from hash-chosen starts as a recursive query: ``pts``, ``scales`` (m_*, s_*, w_*), ``moves`` (all
    steps), ``models`` (the last one) and ``own`` (nearest centre of each point under it)."""
    d = range(len(cols))
    xs, d2 = ", ".join(f"x{i}" for i in d), " + ".join(f"w{i} * ((p.x{i} - c.c{i}) * (p.x{i} - c.c{i}))" for i in d)
    nearest = ("SELECT k, id, min_by(j, (dist, j)) AS j, min(dist) AS dist FROM "
               f"(SELECT c.k, c.j, p.id, {d2} AS dist FROM {{c}} c CROSS JOIN pts p CROSS JOIN scales) GROUP BY k, id")
    step = (f"SELECT it.step + 1, it.k, it.j, " + ", ".join(f"CASE WHEN n IS NULL THEN c{i} ELSE t{i} / n END" for i in d)
            + " FROM moves it LEFT JOIN (SELECT a.k, a.j, CAST(count(*) AS DOUBLE) AS n, "
            + ", ".join(f"CAST(sum(x{i}) AS DOUBLE) AS t{i}" for i in d)
            + f" FROM ({nearest.format(c='moves')}) a JOIN pts ON pts.id = a.id GROUP BY a.k, a.j) s ON s.k = it.k AND s.j = it.j "
            + f"WHERE it.step < {max_iter}")
    return [
        f"pts AS MATERIALIZED (SELECT {key} AS id, " + ", ".join(f"CAST({c} AS BIGINT) AS x{i}" for i, c in enumerate(cols))
        + f" FROM {src} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols) + ")",
        "scales AS MATERIALIZED (SELECT *, " + ", ".join(f"CASE WHEN s{i} = 0 THEN 0.0 ELSE 1 / (s{i} * s{i}) END AS w{i}" for i in d)
        + " FROM (SELECT " + ", ".join(
            f"CAST(sum(x{i}) AS DOUBLE) / count(*) AS m{i}, sqrt(CAST(count(*) * sum(x{i} * x{i}) - sum(x{i}) * sum(x{i}) AS DOUBLE) "
            f"/ (CAST(count(*) AS DOUBLE) * (count(*) - 1))) AS s{i}" for i in d) + " FROM pts))",
        f"starts AS (SELECT row_number() OVER (ORDER BY min(sha256('{seed}:' || id))) - 1 AS j, {xs} FROM pts GROUP BY {xs})",
        "moves AS (SELECT 0 AS step, k, CAST(j AS INTEGER) AS j, " + ", ".join(f"CAST(x{i} AS DOUBLE) AS c{i}" for i in d)
        + f" FROM starts JOIN (SELECT unnest({list(ks)}) AS k) ON j < k UNION ALL {step})",
        f"models AS MATERIALIZED (SELECT * FROM moves WHERE step = {max_iter})",
        f"own AS MATERIALIZED ({nearest.format(c='models')})"]


def kmeans_sweep_ctes(d: int) -> list[str]:
    """``sweep``: k, wssse and silhouette of the models, from each cluster's sums."""
    norm = " + ".join(f"w{i} * x{i} * x{i}" for i in range(d))
    dot = " + ".join(f"w{i} * p.x{i} * s.t{i}" for i in range(d))
    return [
        "sums AS (SELECT k, j, count(*) AS n, " + ", ".join(f"sum(x{i}) AS t{i}" for i in range(d))
        + f", sum({norm}) AS q FROM own JOIN pts USING (id) CROSS JOIN scales GROUP BY k, j)",
        f"apart AS (SELECT o.k, o.id, o.j, s.j AS other, s.n, ({norm}) + s.q / s.n - 2 * ({dot}) / s.n AS dis "
        "FROM own o JOIN pts p USING (id) JOIN sums s ON s.k = o.k CROSS JOIN scales)",
        "each AS (SELECT k, id, max(CASE WHEN other = j THEN n END) AS n, max(CASE WHEN other = j THEN dis * n / (n - 1) END) AS a, "
        "min(CASE WHEN other <> j THEN dis END) AS b FROM apart GROUP BY k, id)",
        "sweep AS (SELECT k, wssse, silhouette FROM (SELECT k, avg(CASE WHEN n <= 1 THEN 0.0 WHEN greatest(a, b) > 0 "
        "THEN (b - a) / greatest(a, b) ELSE 0.0 END) AS silhouette FROM each GROUP BY k) "
        "JOIN (SELECT k, sum(dist) AS wssse FROM own GROUP BY k) USING (k))"]


def position_sql(col: str, order: list[str]) -> str:
    arr = "[" + ", ".join(lit(v) for v in order) + "]"
    return f"CAST(list_position({arr}, {col}) AS INTEGER)"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    raw = ", ".join(RAW_COLUMNS)
    q["survey_select"] = upto(None) + f"SELECT {raw} FROM respondents"
    q["clean"] = upto("clean") + f"SELECT {raw}, {', '.join(DERIVED)} FROM clean"

    cum, aggs = [], ["count(*) AS s0"]
    for i, (_, cond) in enumerate(FUNNEL, start=1):
        cum.append(cond)
        aggs.append(f"sum(CASE WHEN COALESCE({' AND '.join(cum)}, false) THEN 1 ELSE 0 END) AS s{i}")
    names = ["raw"] + [n for n, _ in FUNNEL]
    q["clean_funnel"] = upto("staged", [f"fz AS (SELECT {', '.join(aggs)} FROM staged)"]) + " UNION ALL ".join(
        f"SELECT {i} AS step_no, {lit(n)} AS step, CAST(s{i} AS BIGINT) AS rows_left FROM fz" for i, n in enumerate(names))

    q["years_recode"] = upto("staged") + "SELECT ResponseId, YearsCodePro, years_code_pro FROM staged"
    q["ordinal_orgsize"] = upto("staged") + "SELECT ResponseId, OrgSize, org_size_int FROM staged WHERE org_size_int IS NOT NULL"
    q["ordinal_aiselect"] = upto("staged") + "SELECT ResponseId, AISelect, ai_select_int FROM staged WHERE ai_select_int IS NOT NULL"
    q["ordinal_defaults"] = upto("staged") + "SELECT ResponseId, ai_acc_int, ai_threat_int, ai_sent_int FROM staged"
    q["bin_usage"] = upto("feat") + f"SELECT ResponseId, ai_product_count, {usage_bin()} AS ai_usage_bin FROM feat"
    q["bin_experience"] = upto("clean") + f"SELECT ResponseId, years_code_pro, {experience_bin()} AS experience_bin FROM clean"
    q["primary_role"] = upto(None) + f"SELECT ResponseId, {primary_role()} AS primary_role FROM respondents"
    q["filter_employed"] = upto(None) + f"SELECT ResponseId, Employment FROM respondents WHERE {employed()}"
    q["filter_salary_range"] = upto("staged") + ("SELECT ResponseId, salary_usd FROM staged WHERE salary_usd IS NOT NULL "
                                                 "AND salary_usd > 5000 AND salary_usd < 1000000")
    q["filter_topk_semi"] = upto("clean", [f"topc AS ({topk_sql('Country', 5, 'clean')})"]) + \
        "SELECT ResponseId, Country FROM clean WHERE Country IN (SELECT Country FROM topc)"
    q["trim_p99"] = upto("clean") + ("SELECT ResponseId, salary_usd FROM clean WHERE salary_usd <= "
                                     "(SELECT quantile_cont(salary_usd, 0.99) FROM clean)")

    q["mv_count_filtered"] = upto("staged") + \
        f"SELECT ResponseId, ai_ben_count, {count_items('AIToolActivities', True)} AS ai_task_count FROM staged"
    q["mv_count_raw"] = upto(None) + f"SELECT ResponseId, {count_items('AIProducts', False)} AS ai_product_count FROM respondents"
    q["multi_hot_products"] = upto(None) + "SELECT ResponseId, " + ", ".join(
        f"{indicator('AIProducts', t)} AS {c}" for t, c in zip(AI_TOOLS, TOOL_COLS)) + " FROM respondents"
    q["multi_hot_languages"] = upto(None) + "SELECT ResponseId, " + ", ".join(
        f"{indicator('LanguageHaveWorkedWith', v)} AS {c}" for v, c in zip(LANGUAGES, LANG_COLS)) + " FROM respondents"
    explode = ("SELECT ResponseId, unnest(list_filter(list_transform(string_split(DevType, ';'), lambda x: trim(x)), "
               "lambda x: x <> '')) AS dev_role FROM {src} WHERE DevType IS NOT NULL")
    q["mv_explode"] = upto(None) + explode.format(src="respondents")

    q["zscore_features"] = upto("z") + "SELECT ResponseId, " + ", ".join(f"{rhu(c, 9)} AS {c}" for c in Z) + " FROM z"
    q["assign_fixed_centers"] = upto("assign") + "SELECT ResponseId, prediction FROM assign"
    q["wssse_fixed"] = upto("assign") + f"SELECT {rsig('sum(d)', 8)} AS wssse, count(*) AS n FROM assign"
    q["silhouette_fixed"] = upto("labelled") + ", " + silhouette_sql("labelled", "prediction", Z)
    q["label_clusters"] = upto("labels") + "SELECT prediction, rank, archetype FROM labels"

    B = upto("binned")
    q["cluster_sizes"] = B + "SELECT prediction, archetype, count(*) AS count FROM binned GROUP BY prediction, archetype"
    q["salary_by_archetype"] = B + grouped("archetype", [
        "count(salary_usd) AS n", f"{rhu('avg(salary_usd)', 2)} AS mean_salary",
        f"{rhu('stddev_samp(salary_usd)', 2)} AS stddev_salary",
        f"{rhu('quantile_cont(salary_usd, 0.25)', 2)} AS p25_salary",
        f"{rhu('quantile_cont(salary_usd, 0.5)', 2)} AS median_salary",
        f"{rhu('quantile_cont(salary_usd, 0.75)', 2)} AS p75_salary"])
    q["salary_by_archetype_exact"] = q["salary_by_archetype"]
    q["jobsat_by_archetype"] = B + grouped("archetype", [
        "count(job_sat_int) AS n", f"{rhu('avg(job_sat_int)', 3)} AS mean_job_sat",
        f"{rhu('stddev_samp(job_sat_int)', 3)} AS stddev_job_sat",
        f"{rhu('quantile_cont(job_sat_int, 0.5)', 1)} AS median_job_sat"])
    q["ai_tool_adoption"] = B + grouped("archetype", [
        "count(*) AS n", f"{rhu('avg(ai_product_count)', 2)} AS avg_products",
        f"{rhu('avg(ai_task_count)', 2)} AS avg_tasks"] + [f"{rhu(f'avg({c}) * 100', 1)} AS {c}_pct" for c in TOOL_COLS])
    q["tech_stack"] = B + grouped("archetype", [f"{rhu(f'avg({c}) * 100', 1)} AS {c}_pct" for c in LANG_COLS])
    from ..spec import PROFILE_MEANS, SUMMARY_MEANS
    q["profile_by_archetype"] = B + grouped("archetype", [f"{rhu(f'avg({c})', d)} AS {a}" for c, a, d in PROFILE_MEANS])

    def share(col, values, aliases):
        return ["count(*) AS total"] + [
            f"{rhu(f'CAST(sum(CASE WHEN {col} = {lit(v)} THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*)', 1)} AS {ident(a)}"
            for v, a in zip(values, aliases)]
    q["remote_work_mix"] = B + grouped("archetype", share("RemoteWork", REMOTE_WORK_VALUES,
                                                          [v + "_pct" for v in REMOTE_WORK_VALUES]),
                                       where="RemoteWork IS NOT NULL")
    q["main_branch_mix"] = B + grouped("archetype", share("MainBranch", MAIN_BRANCH_VALUES, MAIN_BRANCH_ALIASES),
                                       where="MainBranch IS NOT NULL")
    q["share_pivot_remote"] = q["remote_work_mix"]
    role_ctes = [f"topr AS ({topk_sql('primary_role', 8, 'binned', ['Unknown'])})",
                 "tot AS (SELECT archetype, count(*) AS total FROM binned GROUP BY archetype)",
                 "cells AS (SELECT archetype, primary_role, count(*) AS n FROM binned WHERE primary_role IN "
                 "(SELECT primary_role FROM topr) GROUP BY archetype, primary_role)"]
    q["primary_role_mix"] = upto("binned", role_ctes) + (
        f"SELECT c.archetype, c.primary_role, c.n, t.total, {rhu('CAST(c.n AS DOUBLE) * 100.0 / t.total', 1)} AS pct "
        "FROM cells c JOIN tot t USING (archetype)")
    q["primary_role_mix_scan"] = q["primary_role_mix"]
    q["topk_roles"] = B + topk_sql("primary_role", 8, "binned", ["Unknown"])
    q["topk_countries"] = upto("clean") + topk_sql("Country", 5, "clean")
    q["summary_by_archetype"] = B + grouped("archetype", ["count(*) AS developers"] + [
        f"{rhu(f'avg({c})', d)} AS {a}" for c, a, d in SUMMARY_MEANS])

    def top_per_group(src, col, out):
        return (f"SELECT archetype, {out}, count FROM (SELECT archetype, {col} AS {out}, CAST(count(*) AS BIGINT) AS count, "
                f"row_number() OVER (PARTITION BY archetype ORDER BY count(*) DESC, {col} ASC) AS rn FROM {src} "
                f"WHERE {col} IS NOT NULL GROUP BY archetype, {col}) WHERE rn <= 5")
    q["top_countries"] = B + top_per_group("binned", "Country", "country")
    q["top_devroles"] = upto("binned", [
        "roles AS (SELECT archetype, unnest(list_filter(list_transform(string_split(DevType, ';'), lambda x: trim(x)), "
        "lambda x: x <> '')) AS dev_role0 FROM binned WHERE DevType IS NOT NULL)"]) + top_per_group("roles", "dev_role0", "dev_role")

    q["deep_salary_by_usage"] = B + grouped("ai_usage_bin", [
        "count(*) AS n", f"{rhu('avg(salary_usd)', 0)} AS mean_salary",
        f"{rhu('quantile_cont(salary_usd, 0.5)', 0)} AS median_salary",
        f"{rhu('avg(years_code_pro)', 1)} AS mean_years_exp", f"{rhu('avg(job_sat_int)', 2)} AS mean_job_sat",
        f"{rhu('avg(org_size_int)', 2)} AS mean_org_size"])
    q["salary_by_usage_scan"] = q["deep_salary_by_usage"]
    q["salary_exp_x_usage"] = B + pivot_mean_sql("experience_bin", "binned")
    q["counts_exp_x_usage"] = B + "SELECT experience_bin, " + ", ".join(
        f"NULLIF(count(CASE WHEN ai_usage_bin = {lit(u)} THEN 1 END), 0) AS {ident(u)}" for u in USAGE) + \
        " FROM binned GROUP BY experience_bin"
    q["salary_country_x_usage"] = upto("binned", [
        f"topc AS ({topk_sql('Country', 5, 'binned')})",
        "bc AS (SELECT * FROM binned WHERE Country IN (SELECT Country FROM topc))"]) + pivot_mean_sql("Country", "bc")
    q["salary_role_x_usage"] = upto("binned", [
        f"topr AS ({topk_sql('primary_role', 8, 'binned')})",
        "br AS (SELECT * FROM binned WHERE primary_role IN (SELECT primary_role FROM topr))"]) + pivot_mean_sql("primary_role", "br")

    q["pivot_mean_scan"] = q["salary_role_x_usage"]
    F_ = upto("feat")
    q["corr_pairs"] = F_ + ", " + corr_pairs_cte(CORRELATION_COLUMNS, "feat") + "\nSELECT var_a, var_b, pearson_corr FROM pairs"
    q["corr_ranked"] = F_ + ", " + corr_pairs_cte(CORRELATION_COLUMNS, "feat") + (
        "\nSELECT CAST(row_number() OVER (ORDER BY var_a <> 'salary_usd', abs(pearson_corr) DESC, pair_no) AS INTEGER) "
        "AS position, var_a, var_b, pearson_corr FROM pairs")
    diag = " UNION ALL ".join(f"SELECT {lit(c)} AS var_a, {lit(c)} AS var_b, 1.0 AS pearson_corr" for c in CORRELATION_DISPLAY_ORDER)
    q["corr_matrix"] = F_ + ", " + corr_pairs_cte(CORRELATION_COLUMNS, "feat") + (
        ", m AS (SELECT var_a, var_b, pearson_corr FROM pairs UNION ALL SELECT var_b, var_a, pearson_corr FROM pairs "
        f"UNION ALL {diag})\nSELECT {position_sql('var_a', CORRELATION_DISPLAY_ORDER)} AS position, var_a AS variable, "
        + ", ".join(f"max(CASE WHEN var_b = {lit(c)} THEN pearson_corr END) AS {c}" for c in CORRELATION_DISPLAY_ORDER)
        + " FROM m GROUP BY var_a")
    q["ols_coefficients"] = ols_coefficients_sql(F_.rstrip("\n"), "feat", "salary_usd", REGRESSION_FEATURES)
    q["ols_fit_stats"] = ols_fit_sql(F_.rstrip("\n"), "feat", "salary_usd", REGRESSION_FEATURES)

    q["ols_marks"] = ols_marks_sql(F_.rstrip("\n"), "feat", "salary_usd", REGRESSION_FEATURES)
    sal = B.rstrip("\n") + ", sal AS (" + q["salary_by_archetype"][len(B):] + "), js AS (" + \
        q["jobsat_by_archetype"][len(B):] + ")\n"
    q["canonical_order"] = B + (f"SELECT prediction, archetype, count(*) AS count, "
                                f"{position_sql('archetype', ARCHETYPE_ORDER)} AS position FROM binned GROUP BY prediction, archetype")
    q["headline_outcomes"] = sal + ("SELECT COALESCE(sal.archetype, js.archetype) AS archetype, mean_salary, median_salary, "
                                    f"mean_job_sat, {position_sql('COALESCE(sal.archetype, js.archetype)', ARCHETYPE_ORDER)} "
                                    "AS position FROM sal FULL JOIN js ON sal.archetype = js.archetype")
    q["simpson_deltas"] = upto("binned", [
        "cl AS (SELECT experience_bin, ai_usage_bin, count(*) AS n, avg(salary_usd) AS m FROM binned GROUP BY ALL)"]) + (
        f"SELECT experience_bin, ai_usage_bin, n, {rhu('m', 0)} AS mean_salary, "
        f"{rhu(f'm - max(CASE WHEN ai_usage_bin = {lit(USAGE[0])} THEN m END) OVER (PARTITION BY experience_bin)', 0)} "
        "AS delta_vs_none FROM cl")
    role_pivot = q["salary_role_x_usage"]
    rp_with, rp_body = role_pivot.rsplit("\n", 1)
    q["role_heatmap_k"] = rp_with + f", rp AS ({rp_body})\n" + (
        "SELECT upper(substr(replace(primary_role, 'Developer, ', ''), 1, 1)) || "
        "lower(substr(replace(primary_role, 'Developer, ', ''), 2)) AS role, "
        + ", ".join(f"{ident(u)} / 1000 AS {ident(u)}" for u in USAGE) + " FROM rp")
    cp_with, cp_body = q["salary_country_x_usage"].rsplit("\n", 1)
    short = "CASE " + " ".join(f"WHEN Country = {lit(k)} THEN {lit(v)}" for k, v in COUNTRY_SHORT_NAMES.items()) + " ELSE Country END"
    from ..operators.figures import COUNTRY_DISPLAY_ORDER
    q["country_display"] = cp_with + f", cpv AS ({cp_body}), cps AS (SELECT {short} AS country, " + \
        ", ".join(ident(u) for u in USAGE) + " FROM cpv)\n" + \
        f"SELECT country, {', '.join(ident(u) for u in USAGE)}, {position_sql('country', COUNTRY_DISPLAY_ORDER)} AS position FROM cps"
    q["box_stats"] = upto("binned", [
        "bt AS (SELECT archetype, salary_usd FROM binned WHERE salary_usd IS NOT NULL AND salary_usd <= "
        "(SELECT quantile_cont(salary_usd, 0.99) FROM binned WHERE salary_usd IS NOT NULL))",
        "bq AS (SELECT archetype, quantile_cont(salary_usd, 0.25) AS q1, quantile_cont(salary_usd, 0.5) AS median, "
        "quantile_cont(salary_usd, 0.75) AS q3 FROM bt GROUP BY archetype)"]) + (
        f"SELECT archetype, count(*) AS n, {rhu('q1', 2)} AS q1, {rhu('median', 2)} AS median, {rhu('q3', 2)} AS q3, "
        f"{rhu('min(CASE WHEN salary_usd >= q1 - 1.5 * (q3 - q1) THEN salary_usd END)', 2)} AS whisker_low, "
        f"{rhu('max(CASE WHEN salary_usd <= q3 + 1.5 * (q3 - q1) THEN salary_usd END)', 2)} AS whisker_high, "
        f"{position_sql('archetype', ARCHETYPE_ORDER)} AS position "
        "FROM bt JOIN bq USING (archetype) GROUP BY archetype, q1, median, q3")

    def recursive(ctes):
        return upto("feat", ctes).replace("WITH ", "WITH RECURSIVE ", 1)

    n_features, rank = len(CLUSTER_FEATURES), CLUSTER_FEATURES.index(RANK_FEATURE)
    q["k_sweep"] = recursive(kmeans_ctes("feat", "ResponseId", CLUSTER_FEATURES, list(range(2, 9)), 20) + kmeans_sweep_ctes(n_features)) + (
        f"SELECT k, {rsig('wssse', 8)} AS wssse, {rhu('silhouette', 8)} AS silhouette, "
        f"{rhu('coalesce(lag(wssse) OVER (ORDER BY k) - wssse, 0.0)', 3)} AS delta_cost FROM sweep")
    final = kmeans_ctes("feat", "ResponseId", CLUSTER_FEATURES, [3], 40) + [
        "zc AS (SELECT j, " + ", ".join(f"CASE WHEN s{i} = 0 THEN 0.0 ELSE (c{i} - m{i}) / s{i} END AS z{i}" for i in range(n_features))
        + " FROM models CROSS JOIN scales)",
        "named AS (SELECT *, CASE r WHEN 1 THEN 'Traditional Engineer' WHEN 2 THEN 'AI Experimenter' ELSE 'AI Power User' END AS archetype "
        f"FROM (SELECT *, row_number() OVER (ORDER BY z{rank}, j) AS r FROM zc))"]
    q["kmeans_final"] = recursive(final) + ("SELECT o.j AS prediction, archetype, count(*) AS count FROM own o JOIN named n ON n.j = o.j "
                                            "GROUP BY o.j, archetype")
    from ..operators.figures import CENTROID_DISPLAY
    q["centroid_heatmap"] = recursive(final) + "SELECT archetype, " + ", ".join(
        f"{rhu(f'z{i}', 3)} AS {c}" for i, c in enumerate(CENTROID_DISPLAY)) + f", {position_sql('archetype', ARCHETYPE_ORDER)} AS position FROM named"

    # the same operators on the driver tables
    q["orders_price_summary"] = ("SELECT o_orderpriority, count(o_totalprice) AS n, "
                                 f"{rhu('avg(o_totalprice)', 2)} AS mean_price, {rhu('stddev_samp(o_totalprice)', 2)} AS stddev_price, "
                                 f"{rhu('quantile_cont(o_totalprice, 0.25)', 2)} AS p25_price, "
                                 f"{rhu('quantile_cont(o_totalprice, 0.5)', 2)} AS median_price, "
                                 f"{rhu('quantile_cont(o_totalprice, 0.75)', 2)} AS p75_price FROM orders GROUP BY o_orderpriority")
    q["orders_status_mix"] = "SELECT o_orderpriority, count(*) AS total, " + ", ".join(
        f"{rhu(f'CAST(sum(CASE WHEN o_orderstatus = {lit(s)} THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*)', 1)} AS {s}_pct"
        for s in ("F", "O", "P")) + " FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY o_orderpriority"
    prios = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    q["orders_year_x_priority"] = "SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, " + ", ".join(
        f"{rhu(f'avg(CASE WHEN o_orderpriority = {lit(p)} THEN o_totalprice END)', 2)} AS {ident(p)}" for p in prios) + \
        " FROM orders GROUP BY 1"
    q["lineitem_top_types_per_brand"] = (
        "SELECT p_brand, p_type, count FROM (SELECT p_brand, p_type, CAST(count(*) AS BIGINT) AS count, "
        "row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type ASC) AS rn FROM lineitem "
        "JOIN part ON l_partkey = p_partkey WHERE p_type IS NOT NULL GROUP BY p_brand, p_type) WHERE rn <= 3")
    li = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    q["lineitem_corr"] = "WITH " + corr_pairs_cte(li, "lineitem") + "\nSELECT var_a, var_b, pearson_corr FROM pairs"
    q["ols_fitted"] = ols_fitted_sql(F_.rstrip("\n"), "feat", "salary_usd", REGRESSION_FEATURES, ["ResponseId", "salary_usd"], "salary_predicted")
    name = "regexp_replace(replace(primary_role, 'Developer, ', 'dev_'), '[^A-Za-z0-9]+', '_', 'g')"
    q["primary_role_by_archetype"] = (
        "SELECT archetype, total, " + ", ".join(f"coalesce({r}_pct, 0.0) AS {r}_pct" for r in WIDE_ROLES)
        + f" FROM (PIVOT (SELECT archetype, total, rtrim({name}, '_') || '_pct' AS role, pct FROM (" + q["primary_role_mix"]
        + ")) ON role IN (" + ", ".join(lit(r + "_pct") for r in WIDE_ROLES) + ") USING first(pct) GROUP BY archetype, total)")
    q["lineitem_ols"] = ols_coefficients_sql("WITH li AS (SELECT * FROM lineitem)", "li", "l_extendedprice",
                                             ["l_quantity", "l_discount", "l_tax"])
    ecols = [f"e{i}" for i in range(64)]
    q["embeddings_silhouette"] = ("WITH flat AS (SELECT label, " + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)) + " FROM embeddings), "
        + silhouette_sql("flat", "label", ecols))
    e64 = [f"e{i}" for i in range(64)]
    q["embeddings_zscore"] = ("WITH flat AS (SELECT vec_id, " + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)) + " FROM embeddings), "
        "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in e64) + " FROM flat)\n"
        "SELECT vec_id, " + ", ".join(
            rhu(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END", 9) + f" AS z_{c}" for c in e64)
        + " FROM flat CROSS JOIN st")
    return q


ORACLE = build()
