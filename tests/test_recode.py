from pyspark.sql import functions as F

from cohortlens.functions.multivalue import count_items, explode_items, multi_hot
from cohortlens.functions.recode import (bucketize, first_item, ordinal_encode, recode_sentinels,
                                         role_column_name, round_half_up, safe_name, unique_names)
from cohortlens.operators.clean import clean, clean_funnel, select_survey
from cohortlens.operators.features import add_bins, build_features
from cohortlens.spec import AI_TOOLS, LANGUAGES, ORG_SIZE_LEVELS, YEARS_SENTINELS

from edge_rows import SCHEMA, edge_rows


def test_safe_name():
    got = [safe_name(t) for t in AI_TOOLS] + [safe_name(v) for v in LANGUAGES]
    assert got == ["chatgpt", "github_copilot", "google_gemini", "bing_ai", "visual_studio_intellicode", "claude",
                   "codeium", "perplexity_ai", "tabnine", "amazon_q", "python", "javascript", "typescript", "java",
                   "csharp", "cpp", "go", "rust", "kotlin", "sql", "html_css", "bash_shell_all_shells"]
    assert safe_name("F#") == "fsharp" and safe_name("Node.js") == "node_dot_js"
    assert safe_name("  __a--b__ ") == "a_b"


def test_role_column_name_and_collisions():
    assert role_column_name("Developer, back-end") == "dev_back_end_pct"
    assert role_column_name("Data scientist or machine learning specialist") == \
        "Data_scientist_or_machine_learning_specialist_pct"
    assert role_column_name("Developer, QA or test") == "dev_QA_or_test_pct"
    try:
        unique_names([role_column_name("a b"), role_column_name("a-b")])
    except ValueError:
        pass
    else:
        raise AssertionError("collision not rejected")


def test_recoders(spark):
    df = spark.createDataFrame([("More than 50 years",), ("Less than 1 year",), ("7",), ("abc",), (None,)], "y string")
    got = [r[0] for r in df.select(recode_sentinels("y", YEARS_SENTINELS)).collect()]
    assert got == [50, 0, 7, None, None]
    o = spark.createDataFrame([("2 to 9 employees",), ("I don't know",), (None,)], "o string")
    assert [r[0] for r in o.select(ordinal_encode("o", ORG_SIZE_LEVELS)).collect()] == [2, None, None]
    assert [r[0] for r in o.select(ordinal_encode("o", ORG_SIZE_LEVELS, default=0)).collect()] == [2, 0, 0]


def test_bins_and_first_item(spark):
    df = spark.createDataFrame([(0, 0, "a;b"), (2, 4, None), (3, 5, "x"), (4, 10, ""), (5, 11, ";y")],
                               "p int, y int, d string")
    from cohortlens.spec import EXPERIENCE_BINS, USAGE_BINS
    rows = df.select(bucketize("p", USAGE_BINS, "right"), bucketize("y", EXPERIENCE_BINS, "left"),
                     first_item("d")).collect()
    assert [tuple(r) for r in rows] == [
        ("0_None", "Junior_0to4", "a"), ("1_Light_1to2", "Junior_0to4", "Unknown"),
        ("2_Moderate_3to4", "Mid_5to10", "x"), ("2_Moderate_3to4", "Mid_5to10", ""),
        ("3_Heavy_5plus", "Senior_11plus", "")]


def test_count_items_asymmetry(spark):
    df = spark.createDataFrame([(None,), ("NA",), ("",), ("a;;b",), ("a;a",), ("a;Other (please specify):",)], "c string")
    raw = [r[0] for r in df.select(count_items("c")).collect()]
    filt = [r[0] for r in df.select(count_items("c", drop=["Other (please specify):"], drop_empty=True)).collect()]
    assert raw == [0, 0, 1, 3, 2, 2]  # empty cell counts 1; duplicates count twice
    assert filt == [0, 0, 0, 2, 2, 1]


def test_multi_hot_exact_items(spark):
    df = spark.createDataFrame([("Java;JavaScript",), ("C#;C++",), (None,), ("ChatGPTx",)], "l string")
    out = multi_hot(df, "l", ["Java", "JavaScript", "C#", "C++", "ChatGPT"], "lang_").collect()
    assert [tuple(r)[1:] for r in out] == [(1, 1, 0, 0, 0), (0, 0, 1, 1, 0), (0, 0, 0, 0, 0), (0, 0, 0, 0, 0)]


def test_explode_items_trims_and_drops_empty(spark):
    df = spark.createDataFrame([(1, "a; b ;;c"), (2, None), (3, "")], "id int, d string")
    got = sorted(tuple(r) for r in explode_items(df, "d", "item", keep=["id"]).collect())
    assert got == [(1, "a"), (1, "b"), (1, "c")]


def test_round_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [1.01, 2.5, -2.5, None]
    assert [r[0] for r in df.select(round_half_up("x", 0)).collect()] == [1.0, 3.0, -3.0, None]


def test_clean_edge_rows(spark):
    rows, keep = edge_rows()
    raw = spark.createDataFrame(rows, SCHEMA)
    c = clean(raw)
    got = {r.ResponseId: r for r in c.collect()}
    assert set(got) == keep
    assert "AIToolActivities" in c.columns and "AIProducts" in c.columns and "AIComplex" in c.columns
    assert got[14].job_sat_int == 7 and got[16].job_sat_int == 10 and got[13].job_sat_int == 0
    assert got[7].salary_usd == 5000.01
    assert got[36].years_code_pro == 50 and got[37].years_code_pro == 0
    assert got[34].org_size_int == 1 and got[35].org_size_int == 9
    assert (got[18].ai_select_int, got[19].ai_select_int, got[1].ai_select_int) == (1, 0, 2)
    assert (got[23].ai_acc_int, got[23].ai_threat_int, got[23].ai_sent_int) == (2, 0, 2)
    assert (got[24].ai_acc_int, got[24].ai_threat_int, got[24].ai_sent_int) == (2, 0, 2)
    assert (got[25].ai_acc_int, got[25].ai_threat_int, got[25].ai_sent_int) == (4, 2, 2)
    assert (got[26].ai_acc_int, got[26].ai_threat_int, got[26].ai_sent_int) == (0, 1, 0)
    assert [got[i].ai_ben_count for i in (27, 28, 29, 30, 31)] == [0, 0, 0, 2, 2]

    f = {r.ResponseId: r for r in build_features(c).collect()}
    assert [f[i].ai_product_count for i in (27, 28, 29, 30, 31)] == [0, 0, 1, 2, 1]
    assert [f[i].ai_task_count for i in (27, 28, 29, 30)] == [0, 0, 0, 1]
    assert f[31].uses_chatgpt == 0 and f[30].uses_chatgpt == 1 and f[1].uses_github_copilot == 1
    assert (f[1].lang_java, f[1].lang_javascript, f[31].lang_csharp, f[31].lang_cpp) == (1, 1, 1, 1)
    assert f[27].lang_python == 0

    b = {r.ResponseId: r for r in add_bins(build_features(c)).collect()}
    assert b[40].primary_role == "Unknown" and b[41].primary_role == "a"


def test_funnel_monotone_and_consistent(spark):
    rows, keep = edge_rows()
    raw = spark.createDataFrame(rows, SCHEMA)
    f = [r.rows_left for r in clean_funnel(raw).orderBy("step_no").collect()]
    assert f[0] == len(rows) and f[-1] == len(keep)
    assert all(a >= b for a, b in zip(f, f[1:]))


def test_select_survey_renames_space_column(spark):
    rows, _ = edge_rows()
    raw = spark.createDataFrame(rows, SCHEMA)
    s = select_survey(raw)
    assert s.columns[7:9] == ["AIToolActivities", "AIProducts"]
    assert s.where(F.col("AIToolActivities") == "w;d").count() > 0


def test_text_numbers_lose_their_fraction_not_the_row(spark):
    from cohortlens.functions.recode import recode_sentinels, whole_number

    df = spark.createDataFrame([("7.0",), ("7.9",), ("-1.5",), ("x",), (None,), ("99999999999",)], "s string")
    want = [7, 7, -1, None, None, None]
    assert [r[0] for r in df.select(whole_number("s")).collect()] == want
    assert [r[0] for r in df.select(recode_sentinels("s", {"x": 50})).collect()] == [7, 7, -1, 50, None, None]


def test_items_are_trimmed_of_tabs_and_newlines(spark):
    from cohortlens.functions.multivalue import explode_items

    df = spark.createDataFrame([(1, "\tA ;\n; B\n")], "id int, d string")
    assert [r.role for r in explode_items(df, "d", "role", ["id"]).collect()] == ["A", "B"]
