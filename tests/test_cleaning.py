"""Hand-worked answers for every cleaning expression, dirty edges included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardrisk.functions import cleaning as C


def apply(spark, values, make, kind="string"):
    """The expression's answer for each value, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_clean_amount(spark):
    given = ["$1,204.55", "-$50.00", " $7 ", "", None, "abc", "$12,345,678.90"]
    assert apply(spark, given, C.clean_amount) == [1204.55, -50.0, 7.0, 0.0, 0.0, 0.0, 12345678.9]


def test_clean_label(spark):
    given = ["Yes", " yes ", "1", "TRUE", "No", "", None, "2"]
    assert apply(spark, given, C.clean_label) == [1, 1, 1, 1, 0, 0, 0, 0]


def test_int_or(spark):
    given = ["12", "12.7", "-3", "1e3", "bad", "", None, " 5 ", "99999999999"]
    assert apply(spark, given, lambda c: C.int_or(c, -1)) == [12, 12, -3, 1000, -1, -1, -1, 5, -1]


@pytest.mark.parametrize(
    "text,hour,minute",
    [("07:45", 7, 45), (None, 0, 0), ("0730", 730, 0), ("", 0, 0), ("25:61", 25, 61), ("x:y", 0, 0), ("9:05:33", 9, 5)],
)
def test_time_parts(spark, text, hour, minute):
    h, m = C.time_parts(F.col("v"))
    assert apply(spark, [text], lambda c: F.array(h, m)) == [[hour, minute]]


def test_imputation(spark):
    given = [" ca ", "", "   ", None, "Mexico"]
    assert apply(spark, given, C.imputed_flag) == [0, 1, 1, 1, 0]
    assert apply(spark, given, C.impute_category) == ["CA", "UNKNOWN", "UNKNOWN", "UNKNOWN", "MEXICO"]
    assert apply(spark, given, lambda c: C.impute_category(c, upper=False))[0] == "ca"


def test_trim_takes_spaces_only(spark):
    assert apply(spark, ["\tCA "], C.impute_category) == ["\tCA"]


def test_clean_zip(spark):
    given = ["4917.0", "91750", None, " ", "123456", "7"]
    assert apply(spark, given, C.clean_zip) == ["04917", "91750", "00000", "00000", "12345", "00007"]


def test_errors(spark):
    given = [None, "", " ", " Bad PIN "]
    assert apply(spark, given, C.error_flag) == [0, 0, 0, 1]
    assert apply(spark, given, C.error_type) == ["NONE", "NONE", "NONE", "Bad PIN"]


def test_device_json(spark):
    given = [
        '{"network":{"vpn":true,"ip":"1.2.3.4"},"geo":{"lat":1.5,"lon":2.5},"hardware":{"os":"iOS"}}',
        '{"network":{"vpn":false},"geo":null}',
        "{bad",
        None,
    ]
    fields = C.device_fields(C.parse_device(F.col("v")))
    rows = apply(spark, given, lambda c: F.struct(*[v.alias(k) for k, v in fields.items()]))
    assert tuple(rows[0]) == (1, "1.2.3.4", "iOS", 1.5, 2.5, 0, 0)
    for row in rows[1:]:
        assert tuple(row) == (0, "0.0.0.0", "UNKNOWN", None, None, 1, 1)


def test_amount_and_outlier_features(spark):
    made = C.amount_features(F.col("v")) | C.outlier_features(F.col("v"), F.lit(100.0))
    (row,) = apply(spark, [-150.0], lambda c: F.struct(*[v.alias(k) for k, v in made.items()]), "double")
    assert row.asDict() == {
        "amount_abs": 150.0, "amount_log": pytest.approx(5.017279836814924), "is_refund": 1,
        "is_outlier": 1, "amount_capped": 100.0,
    }


def test_channel_flags(spark):
    rows = spark.createDataFrame(
        [("ONLINE", "CA", 5), ("LAGOS", "NIGERIA", 6), ("X", "UNKNOWN", 22), ("X", "TX", 21)], "c string, s string, h int"
    )
    flags = C.channel_flags(F.col("c"), F.col("s"), F.col("h"))
    got = [tuple(r) for r in rows.select(*flags.values()).collect()]
    assert got == [(1, 0, 1), (0, 1, 0), (0, 1, 1), (0, 0, 0)]


def test_haversine(spark):
    rows = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 180.0), (51.5074, -0.1278, 48.8566, 2.3522), (1.0, None, 1.0, 1.0), (5.0, 5.0, 5.0, 5.0)],
        "a double, b double, c double, d double",
    )
    km = C.haversine_km(*[F.col(c) for c in "abcd"])
    got = [r[0] for r in rows.select(km).collect()]
    assert got[0] == pytest.approx(20015.09, abs=0.01)
    assert got[1] == pytest.approx(343.56, abs=0.5)
    assert got[2:] == [-1.0, 0.0]


@pytest.mark.parametrize(
    "parts,expected",
    [
        ((2019, 2, 28), dt.date(2019, 2, 28)),
        ((2019, 2, 31), dt.date(2019, 2, 1)),
        ((2020, 2, 29), dt.date(2020, 2, 29)),
        ((2019, 13, 5), dt.date(2000, 1, 1)),
        ((2019, 4, -1), dt.date(2019, 4, 1)),
        ((12345, 1, 1), dt.date(2000, 1, 1)),
        ((-5, 1, 1), dt.date(2000, 1, 1)),
    ],
)
def test_assemble_date(spark, parts, expected):
    row = spark.createDataFrame([parts], "y int, m int, d int")
    assert row.select(C.assemble_date(F.col("y"), F.col("m"), F.col("d"))).first()[0] == expected


def test_assemble_timestamp(spark):
    rows = spark.createDataFrame([(7, 45), (25, 0), (3, 61)], "h int, m int")
    date = F.lit("2019-02-01").cast("date")
    text = F.date_format(C.assemble_timestamp(date, F.col("h"), F.col("m")), "yyyy-MM-dd HH:mm:ss")
    assert [r[0] for r in rows.select(text).collect()] == ["2019-02-01 07:45:00", None, None]


def test_calendar_starts_on_sunday(spark):
    parts = C.calendar_parts(F.col("v"))
    rows = apply(
        spark, [dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 12, 28)], lambda c: F.array(*parts.values()), "date"
    )
    assert rows == [[1, 1, 7], [2, 0, 8], [7, 1, 363]]


def test_message_coercion(spark):
    given = ["4917.0", "7", "x", "", None]
    assert apply(spark, given, C.coerce_int) == [4917, 7, 0, 0, 0]
    assert apply(spark, given, C.coerce_double) == [4917.0, 7.0, 0.0, 0.0, 0.0]
    assert apply(spark, [" a ", " ", "", None], C.coerce_text) == ["a", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_amounts_that_are_no_numbers_are_zero(spark):
    from pyspark.sql import functions as F

    from cardrisk.functions import cleaning

    rows = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("$1,200.5",), (None,)], "v string")
    got = [tuple(r) for r in rows.select(cleaning.clean_amount(F.col("v")), cleaning.coerce_double(F.col("v"))).collect()]
    assert got == [(0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (1200.5, 0.0), (0.0, 0.0)]
