"""The cleaning rules against their truth tables and against Python's text methods."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapfold.functions import cleaning

NAMES = [
    ("  o'brien ", "O'Brien"),
    ("MARY-JANE", "Mary-Jane"),
    ("mcDONALD 3rd", "Mcdonald 3Rd"),
    ("", ""),
    ("  ", ""),
    (None, None),
    ("josé ÁLVAREZ", "José Álvarez"),
    ("ßtraße", "Sstraße"),
    ("ﬁn", "Fin"),
]
EMAILS = [
    (" A@X.Com ", "a@x.com"),
    ("user_no_domain", None),
    ("USER_NO_DOMAIN ", None),
    ("", None),
    ("bobexample.com", "bob@example.com"),
    ("bob.example.net", "bob.@example.net"),
    ("example.org", None),
    ("bob.gmail.com", None),
    ("@", "@"),
    (None, None),
]
PHONES = [
    ("(394)387-1194x172", "3943871194172"),
    ("+1-277-766-4858x8890", "127776648588890"),
    ("n/a", None),
    ("", None),
    (None, None),
    ("٣٩٤", "٣٩٤"),
]
SALARIES = [
    ("$7516", 7516),
    ("6409", 6409),
    ("-500", 500),
    ("$1,234.50", 123450),
    ("6409.0", 64090),
    ("abc", None),
    ("", None),
    (None, None),
    ("٣٩٤", 394),
    ("000000000000000000007", 7),
]
ADDRESSES = [
    ("5771 Diana Unions\nNorth Richard, IL", "5771 Diana Unions North Richard, IL"),
    (" UNKNOWN\n", None),
    ("\n", None),
    ("", None),
    (None, None),
    ("a\r\nb", "a\r b"),
]
DATES = [
    ("2024-1-5", dt.date(2024, 1, 5)),
    (" 2024-01-05 ", dt.date(2024, 1, 5)),
    ("2024-02-30", None),
    ("2023-02-29", None),
    ("01/02/2024", None),
    ("24-01-05", None),
    ("2024-01-05 00:00", None),
    ("", None),
    ("12024-01-05", None),
    (None, None),
    ("2024-13-01", None),
    ("2024-00-01", None),
    ("2024-01-0", None),
    ("0000-01-01", None),
    ("2024-01- 5", dt.date(2024, 1, 5)),
    ("2024-01-05T00:00:00", None),
    ("2024-01", None),
]


@pytest.mark.parametrize(
    "rule, cases",
    [
        (cleaning.clean_names, NAMES),
        (cleaning.clean_email, EMAILS),
        (cleaning.clean_phone, PHONES),
        (cleaning.clean_salary, SALARIES),
        (cleaning.clean_address, ADDRESSES),
        (cleaning.clean_date, DATES),
    ],
)
def test_truth_tables(spark, rule, cases):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x string")
    rows = df.select("i", "x", rule(F.col("x")).alias("y")).orderBy("i").collect()
    assert [(r.x, r.y) for r in rows] == cases


def test_salary_out_of_range_aborts(spark):
    df = spark.createDataFrame([("$3000000000",)], "x string")
    with pytest.raises(PySparkException):
        df.select(cleaning.clean_salary(F.col("x"))).collect()


EMPLOYMENT = [
    ("any", "2024-01-05", "2023-01-05", None, None, True),
    ("any", "2024-01-05", "2024-01-05", "2024-01-05", "2024-01-05", False),
    ("Terminated", None, None, None, None, True),
    ("Active", None, None, None, None, False),
    (None, None, None, None, None, False),
    ("Terminated", "garbage", "garbage", None, None, False),
    ("Terminated", "2024-01-05", None, "2024-01-05", None, False),
    ("Active", "2024-01-05", "2024-06-01", "2024-01-05", "2024-06-01", False),
    ("Terminated", "garbage", "2024-06-01", None, "2024-06-01", False),
    ("Terminated", None, "garbage", None, None, False),
]


def test_employment_dates(spark):
    df = spark.createDataFrame(
        [(i, *row[:3]) for i, row in enumerate(EMPLOYMENT)],
        "i int, status string, s string, e string",
    )
    start, end, flag = cleaning.clean_employment_dates(F.col("status"), F.col("s"), F.col("e"))
    got = df.select("*", start.alias("a"), end.alias("b"), flag.alias("f")).orderBy("i").collect()
    text = lambda d: None if d is None else d.isoformat()
    assert [(r.status, r.s, r.e, text(r.a), text(r.b), r.f) for r in got] == EMPLOYMENT


def test_strip_removes_what_python_strips(spark):
    spaces = "".join(c for c in map(chr, range(1, 0x110000)) if c.isspace())
    assert sorted(spaces) == sorted(cleaning.WHITESPACE)
    df = spark.createDataFrame([(spaces + "a\t b" + spaces,)], "x string")
    assert df.select(cleaning.strip(F.col("x"))).first()[0] == "a\t b"


LETTERS = "abzABZ ßıİΣσςé́É'-3_#\t\nǆǅ中文ﬁ’ÀñÑДЖжΑΩªº\U00010400\U00010428.:ŉა"


@settings(
    max_examples=5,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(st.text(alphabet=LETTERS, max_size=14), min_size=150, max_size=300))
def test_names_follow_python_title(spark, texts):
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    rows = df.select("x", cleaning.clean_names(F.col("x")).alias("y")).collect()
    assert [(r.x, r.y) for r in rows] == [(x, x.strip().title()) for x in texts]


def test_names_over_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("text", cleaning.clean_names(F.col("text")).alias("y")).collect()
    assert rows and all(r.y == r.text.strip().title() for r in rows)
