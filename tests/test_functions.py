from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions import decode_path, lenient_cast, parse_mixed_date, period_start

DATES = [
    ("2024-01-05 00:00:00", date(2024, 1, 5)),
    ("2024-01-05", date(2024, 1, 5)),
    ("java.util.GregorianCalendar[time=?,YEAR=2024,MONTH=0,DAY_OF_MONTH=5]", date(2024, 1, 5)),
    ("java.util.GregorianCalendar[time=?,YEAR=2024,MONTH=11,WEEK_OF_MONTH=5,DAY_OF_MONTH=31]", date(2024, 12, 31)),
    ("YEAR=2024,MONTH=1,DAY_OF_MONTH=30", None),
    ("YEAR=2024,MONTH=1", None),
    ("01/07/2024", date(2024, 1, 7)),
    ("1/8/2024", None), ("01/07/2024 00:00", None), ("13/40/2024", None), ("07.01.2024", None), ("2024-13-01", None),
    ("2024", None), ("45296", None), ("Werte aus KW1 2024", None), ("", None), (None, None),
]


def test_parse_mixed_date(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "i int, t string")
    rows = df.select("i", parse_mixed_date(F.col("t")).alias("d")).orderBy("i").collect()
    assert [r.d for r in rows] == [d for _, d in DATES]


CASTS = [
    ("123", 123, 123.0), ("123.0", 123, 123.0), (" 12 ", 12, 12.0), ("+7", 7, 7.0),
    ("3.7", 3, 3.7), ("-3.7", -3, -3.7), (".5", 0, 0.5), ("-.5", 0, -0.5), ("5.", 5, 5.0),
    ("1e3", None, 1000.0), ("12d", None, 12.0), ("2147483648", None, 2147483648.0), ("2147483647", 2147483647, 2147483647.0),
    ("1.234,5", None, None), ("abc", None, None), ("", None, None), (" ", None, None), ("NaN", None, None),
    ("nan", None, None), ("Infinity", None, float("inf")), ("-inf", None, float("-inf")), (None, None, None),
    ("1e400", None, float("inf")),
]


def test_lenient_cast(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASTS)], "i int, t string")
    rows = df.select("i", lenient_cast(F.col("t"), "int").alias("n"), lenient_cast(F.col("t"), "double").alias("x"),
                     lenient_cast(F.col("t"), "string").alias("s")).orderBy("i").collect()
    assert [(r.s, r.n, r.x) for r in rows] == CASTS


def test_lenient_cast_equals_the_cast_without_ansi(spark):
    texts = [c[0] for c in CASTS if c[0] not in ("NaN", "nan")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", lenient_cast(F.col("t"), "int").alias("n"), lenient_cast(F.col("t"), "double").alias("x"))
    got = {r.t: (r.n, r.x) for r in got.collect()}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = df.select("t", F.col("t").cast("int").alias("n"), F.col("t").cast("double").alias("x")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == {r.t: (r.n, r.x) for r in want}


def test_lenient_cast_bigint_is_exact(spark):
    cases = [("9007199254740993", 9007199254740993), ("9223372036854775807.9", 9223372036854775807),
             ("9223372036854775808", None), ("-.5", 0), ("-12.7", -12), ("x", None), ("1234567890123456789", 1234567890123456789)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    assert [r[0] for r in df.select(lenient_cast(F.col("t"), "bigint")).collect()] == [n for _, n in cases]


def test_decode_path(spark):
    cases = [("s3://b/K%C3%BCche+1/a%20b.xlsx", "s3://b/Küche+1/a b.xlsx"), ("a%zz%20b", "a%zz b"), ("100%", "100%"),
             ("plain", "plain"), (None, None), ("%2B", "+")]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    assert [r[0] for r in df.select(decode_path(F.col("t"))).collect()] == [want for _, want in cases]


def test_period_start(spark):
    df = spark.createDataFrame([(date(2024, 5, 16),)], "d date")
    row = df.select(*[period_start(F.col("d"), g).alias(g) for g in ("week", "month", "quarter", "year")]).first()
    assert tuple(row) == (date(2024, 5, 13), date(2024, 5, 1), date(2024, 4, 1), date(2024, 1, 1))


FORMS = [
    lambda d: d.isoformat(),
    lambda d: f"{d.isoformat()} 00:00:00",
    lambda d: d.strftime("%m/%d/") + f"{d.year:04d}",
    lambda d: f"x[YEAR={d.year:04d},MONTH={d.month - 1},WEEK_OF_YEAR=1,DAY_OF_MONTH={d.day}]",
]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.dates(min_value=date(1900, 1, 1), max_value=date(2999, 12, 31)), min_size=50, max_size=80))
def test_every_written_form_comes_back(spark, days):
    rows = [(form(d), d) for d in days for form in FORMS]
    df = spark.createDataFrame(rows, "t string, d date")
    assert df.filter(~parse_mixed_date(F.col("t")).eqNullSafe(F.col("d"))).count() == 0
