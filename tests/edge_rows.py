"""Hand-written survey rows covering every recode branch (FIXTURES §A)."""

from pyspark.sql import types as T

COLUMNS = ["ResponseId", "Employment", "ConvertedCompYearly", "JobSat", "AISelect", "AIAcc", "AIThreat",
           "AISent", "AIComplex", "AIBen", "AIToolCurrently Using", "AISearchDevHaveWorkedWith",
           "LanguageHaveWorkedWith", "OrgSize", "YearsCodePro", "Country", "DevType", "RemoteWork", "MainBranch"]

SCHEMA = T.StructType([T.StructField("ResponseId", T.LongType()), T.StructField("Employment", T.StringType()),
                       T.StructField("ConvertedCompYearly", T.StringType()), T.StructField("JobSat", T.DoubleType())]
                      + [T.StructField(c, T.StringType()) for c in COLUMNS[4:]])

FT = "Employed, full-time"
GOOD = dict(Employment=FT, ConvertedCompYearly="50000", JobSat=7.0, AISelect="Yes", AIAcc="Somewhat trust",
            AIThreat="No", AISent="Favorable", AIComplex="x", AIBen="a;b", **{"AIToolCurrently Using": "w;d"},
            AISearchDevHaveWorkedWith="ChatGPT;GitHub Copilot", LanguageHaveWorkedWith="Java;JavaScript",
            OrgSize="20 to 99 employees", YearsCodePro="7", Country="A", DevType="Developer, back-end",
            RemoteWork="Remote", MainBranch="I am a developer by profession")


def row(rid, **over):
    d = dict(GOOD)
    d.update(over)
    d["ResponseId"] = rid
    return tuple(d[c] for c in COLUMNS)


def edge_rows():
    """(rows, expected set of surviving ids)."""
    rows, keep = [], set()

    def add(rid, survives, **over):
        rows.append(row(rid, **over))
        if survives:
            keep.add(rid)

    add(1, True)
    add(2, True, Employment="Employed, full-time;Student, part-time")
    add(3, False, Employment="Student, full-time")
    add(4, False, Employment=None)
    add(5, False, ConvertedCompYearly=None)
    add(6, False, ConvertedCompYearly="5000")
    add(7, True, ConvertedCompYearly="5000.01")
    add(8, True, ConvertedCompYearly="999999.99")
    add(9, False, ConvertedCompYearly="1000000")
    add(10, False, ConvertedCompYearly="abc")
    add(11, False, JobSat=None)
    add(12, False, JobSat=-1.0)
    add(13, True, JobSat=0.0)
    add(14, True, JobSat=7.9)
    add(15, True, JobSat=10.0)
    add(16, True, JobSat=10.9)
    add(17, False, JobSat=11.0)
    add(18, True, AISelect="No, but I plan to soon")
    add(19, True, AISelect="No, and I don't plan to")
    add(20, False, AISelect="No, and I don’t plan to")  # curly quote: unknown answer
    add(21, False, AISelect="Prefer not to say")
    add(22, False, AISelect=None)
    add(23, True, AIAcc="Something else", AIThreat="Maybe", AISent="Whatever")
    add(24, True, AIAcc=None, AIThreat=None, AISent=None)
    add(25, True, AIAcc="Highly trust", AIThreat="Yes", AISent="Unsure")
    add(26, True, AIAcc="Highly distrust", AIThreat="I'm not sure", AISent="Very unfavorable")
    add(27, True, AIBen=None, **{"AIToolCurrently Using": None}, AISearchDevHaveWorkedWith=None,
        LanguageHaveWorkedWith=None)
    add(28, True, AIBen="NA", **{"AIToolCurrently Using": "NA"}, AISearchDevHaveWorkedWith="NA")
    add(29, True, AIBen="", **{"AIToolCurrently Using": ""}, AISearchDevHaveWorkedWith="")
    add(30, True, AIBen="a;;b", **{"AIToolCurrently Using": "a;Other (please specify):"},
        AISearchDevHaveWorkedWith="ChatGPT;Other (please specify):")
    add(31, True, AIBen="a;a", AISearchDevHaveWorkedWith="ChatGPTx", LanguageHaveWorkedWith="C#;C++")
    add(32, False, OrgSize="I don't know")
    add(33, False, OrgSize=None)
    add(34, True, OrgSize="Just me - I am a freelancer, sole proprietor, etc.")
    add(35, True, OrgSize="10,000 or more employees")
    add(36, True, YearsCodePro="More than 50 years")
    add(37, True, YearsCodePro="Less than 1 year")
    add(38, False, YearsCodePro="abc")
    add(39, False, YearsCodePro=None)
    add(40, True, DevType=None, Country=None, RemoteWork=None, MainBranch=None)
    add(41, True, DevType="a; b ;;c", RemoteWork="Somewhere else")
    return rows, keep
