"""Survey specification: the answer vocabularies and column roles the pipeline runs on.

Every operator in the library takes columns and value lists as arguments; ``SURVEY``
bundles the values for the developer-survey configuration.  Another survey is another
``SurveySpec``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES.  These must equal the survey's answer texts and the report's
# naming exactly, or rows are silently mis-coded.  Natural order, as asked.
# ---------------------------------------------------------------------------

AI_TOOLS = [
    "ChatGPT",
    "GitHub Copilot",
    "Google Gemini",
    "Bing AI",
    "Visual Studio Intellicode",
    "Claude",
    "Codeium",
    "Perplexity AI",
    "Tabnine",
    "Amazon Q",
]

LANGUAGES = [
    "Python",
    "JavaScript",
    "TypeScript",
    "Java",
    "C#",
    "C++",
    "Go",
    "Rust",
    "Kotlin",
    "SQL",
    "HTML/CSS",
    "Bash/Shell (all shells)",
]

ORG_SIZE_LEVELS = {
    "Just me - I am a freelancer, sole proprietor, etc.": 1,
    "2 to 9 employees": 2,
    "10 to 19 employees": 3,
    "20 to 99 employees": 4,
    "100 to 499 employees": 5,
    "500 to 999 employees": 6,
    "1,000 to 4,999 employees": 7,
    "5,000 to 9,999 employees": 8,
    "10,000 or more employees": 9,
}

AI_SELECT_LEVELS = {
    "Yes": 2,
    "No, but I plan to soon": 1,
    "No, and I don't plan to": 0,
}

AI_ACC_LEVELS = {
    "Highly trust": 4,
    "Somewhat trust": 3,
    "Neither trust nor distrust": 2,
    "Somewhat distrust": 1,
    "Highly distrust": 0,
}

AI_THREAT_LEVELS = {
    "Yes": 2,
    "I'm not sure": 1,
    "No": 0,
}

AI_SENT_LEVELS = {
    "Very favorable": 4,
    "Favorable": 3,
    "Indifferent": 2,
    "Unsure": 2,
    "Unfavorable": 1,
    "Very unfavorable": 0,
}

YEARS_SENTINELS = {
    "More than 50 years": 50,
    "Less than 1 year": 0,
}

EMPLOYED_MARKER = "Employed, full-time"
OTHER_ANSWER = "Other (please specify):"
SALARY_BOUNDS = (5000, 1000000)  # both exclusive
JOB_SAT_BOUNDS = (0, 10)  # both inclusive

REMOTE_WORK_VALUES = [
    "Remote",
    "Hybrid (some remote, some in-person)",
    "In-person",
]

MAIN_BRANCH_VALUES = [
    "I am a developer by profession",
    "I am not primarily a developer, but I write code sometimes as part of my work/studies",
    "I used to be a developer by profession, but no longer am",
    "I code primarily as a hobby",
    "I am learning to code",
]
MAIN_BRANCH_ALIASES = [
    "professional_pct",
    "occasional_pct",
    "former_pct",
    "hobbyist_pct",
    "learning_pct",
]

# usage bins: label -> inclusive upper bound on ai_product_count (None = open)
USAGE_BINS = [
    ("0_None", 0),
    ("1_Light_1to2", 2),
    ("2_Moderate_3to4", 4),
    ("3_Heavy_5plus", None),
]
# experience bins: label -> exclusive upper bound on years_code_pro (None = open)
EXPERIENCE_BINS = [
    ("Junior_0to4", 5),
    ("Mid_5to10", 11),
    ("Senior_11plus", None),
]
UNKNOWN_ROLE = "Unknown"

ARCHETYPE_FIRST = "Traditional Engineer"
ARCHETYPE_LAST = "AI Power User"
ARCHETYPE_MIDDLE_OF_THREE = "AI Experimenter"
ARCHETYPE_SECOND = "Light AI User"
ARCHETYPE_TIER = "AI Experimenter (tier {rank})"
ARCHETYPE_FALLBACK = "Cluster {id}"
ARCHETYPE_ORDER = ["Traditional Engineer", "AI Experimenter", "AI Power User"]

COUNTRY_SHORT_NAMES = {
    "United States of America": "USA",
    "United Kingdom of Great Britain and Northern Ireland": "UK",
}

CLUSTER_FEATURES = [
    "ai_select_int",
    "ai_product_count",
    "ai_task_count",
    "ai_acc_int",
    "ai_threat_int",
    "ai_sent_int",
    "ai_ben_count",
    "years_code_pro",
    "org_size_int",
]
# index of the coordinate clusters are ranked on (ai_product_count)
RANK_FEATURE = "ai_product_count"

CORRELATION_COLUMNS = [
    "salary_usd",
    "ai_product_count",
    "ai_task_count",
    "ai_ben_count",
    "years_code_pro",
    "org_size_int",
    "job_sat_int",
    "ai_acc_int",
    "ai_threat_int",
    "ai_sent_int",
]
CORRELATION_DISPLAY_ORDER = [
    "salary_usd",
    "years_code_pro",
    "org_size_int",
    "job_sat_int",
    "ai_product_count",
    "ai_task_count",
    "ai_ben_count",
    "ai_acc_int",
    "ai_threat_int",
    "ai_sent_int",
]

REGRESSION_LABEL = "salary_usd"
REGRESSION_FEATURES = [
    "ai_product_count",
    "ai_task_count",
    "years_code_pro",
    "org_size_int",
]

# significance stars: (upper p bound exclusive, mark); the rest is "ns"
SIGNIFICANCE_MARKS = [(0.001, "***"), (0.01, "**"), (0.05, "*")]

# raw source column -> name used by the pipeline
RENAMES = {
    "AIToolCurrently Using": "AIToolActivities",
    "AISearchDevHaveWorkedWith": "AIProducts",
}

SELECTED_COLUMNS = [
    "ResponseId",
    "AISelect",
    "AISent",
    "AIAcc",
    "AIComplex",
    "AIThreat",
    "AIBen",
    "AIToolActivities",
    "AIProducts",
    "LanguageHaveWorkedWith",
    "OrgSize",
    "YearsCodePro",
    "ConvertedCompYearly",
    "JobSat",
    "Country",
    "DevType",
    "Employment",
    "RemoteWork",
    "MainBranch",
]
# FIXED VALUES: how symbols in answer texts read in column names.
SYMBOL_NAMES = {"c++": "cpp", "c#": "csharp", "f#": "fsharp", ".": "_dot_"}
ROLE_PREFIX = {"Developer, ": "dev_"}

# what a survey column is used for -> its name
COLUMN_ROLES = {
    "employment": "Employment",
    "salary": "ConvertedCompYearly",
    "job_sat": "JobSat",
    "years": "YearsCodePro",
    "benefits": "AIBen",
    "products": "AIProducts",
    "tasks": "AIToolActivities",
    "languages": "LanguageHaveWorkedWith",
    "country": "Country",
    "dev_roles": "DevType",
}
# cleaning steps in order; "<x>_known" is a step for every ordinal "<x>_int"
FUNNEL = [
    "employed_full_time",
    "outcomes_present",
    "salary_in_range",
    "years_known",
    "org_size_known",
    "job_sat_in_range",
    "ai_select_known",
]
# columns that must have an answer at all
OUTCOME_COLUMNS = [
    "ConvertedCompYearly",
    "JobSat",
    "AISelect",
]
# output names and digits of the profile table
PROFILE_MEANS = [
    ("years_code_pro", "avg_years_exp", 2),
    ("org_size_int", "avg_org_size_score", 2),
    ("ai_acc_int", "avg_ai_trust_0_4", 3),
    ("ai_threat_int", "avg_ai_threat_0_2", 3),
    ("ai_sent_int", "avg_ai_sentiment_0_4", 3),
    ("ai_ben_count", "avg_perceived_benefits", 3),
]
# output names and digits of the summary table
SUMMARY_MEANS = [
    ("salary_usd", "avg_salary_usd", 0),
    ("job_sat_int", "avg_job_sat_0_10", 2),
    ("ai_product_count", "avg_ai_products", 2),
    ("ai_task_count", "avg_ai_tasks", 2),
    ("years_code_pro", "avg_years_exp", 1),
    ("ai_acc_int", "avg_ai_trust_0_4", 2),
]
# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SurveySpec:
    """Column roles and vocabularies of one survey configuration."""

    id_col: str = "ResponseId"
    selected: tuple = tuple(SELECTED_COLUMNS)
    optional: tuple = ("AIComplex",)
    renames: dict = field(default_factory=lambda: dict(RENAMES))
    ai_tools: tuple = tuple(AI_TOOLS)
    languages: tuple = tuple(LANGUAGES)
    cluster_features: tuple = tuple(CLUSTER_FEATURES)
    rank_feature: str = RANK_FEATURE
    correlation_columns: tuple = tuple(CORRELATION_COLUMNS)
    regression_label: str = REGRESSION_LABEL
    regression_features: tuple = tuple(REGRESSION_FEATURES)
    separator: str = ";"
    employed_marker: str = EMPLOYED_MARKER
    salary_bounds: tuple = tuple(SALARY_BOUNDS)
    job_sat_bounds: tuple = tuple(JOB_SAT_BOUNDS)
    years_sentinels: dict = field(default_factory=lambda: dict(YEARS_SENTINELS))
    other_answer: str = OTHER_ANSWER
    #: derived column -> (survey column, answer levels, value for other answers)
    ordinals: dict = field(default_factory=lambda: {
        "org_size_int": ("OrgSize", ORG_SIZE_LEVELS, None), "ai_select_int": ("AISelect", AI_SELECT_LEVELS, None),
        "ai_acc_int": ("AIAcc", AI_ACC_LEVELS, 2), "ai_threat_int": ("AIThreat", AI_THREAT_LEVELS, 0),
        "ai_sent_int": ("AISent", AI_SENT_LEVELS, 2)})
    usage_bins: tuple = tuple(USAGE_BINS)
    experience_bins: tuple = tuple(EXPERIENCE_BINS)
    #: what a survey column is used for -> its name
    roles: dict = field(default_factory=lambda: dict(COLUMN_ROLES))
    #: names of the cleaning steps, in order; a survey without a column leaves its step out
    funnel: tuple = tuple(FUNNEL)
    outcome_columns: tuple = tuple(OUTCOME_COLUMNS)
    #: (column, answers, output columns) of the tables of shares
    remote_work: tuple = ("RemoteWork", tuple(REMOTE_WORK_VALUES), tuple(v + "_pct" for v in REMOTE_WORK_VALUES))
    main_branch: tuple = ("MainBranch", tuple(MAIN_BRANCH_VALUES), tuple(MAIN_BRANCH_ALIASES))
    #: (column, output name, digits)
    profile_means: tuple = tuple(PROFILE_MEANS)
    summary_means: tuple = tuple(SUMMARY_MEANS)


SURVEY = SurveySpec()
