import pytest
from pyspark.sql import functions as F

from reviewlens import functions as fn


def values(spark, data, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_parse_rating(spark):
    texts = ["4.5", " 2.5\t", "1e1", ".5", "3.", "-2", "nan", "inf", "4.5f", "0x10", "1e999", "", None, "bad"]
    assert values(spark, texts, fn.parse_rating) == [
        4.5, 2.5, 10.0, 0.5, 3.0, -2.0, None, None, None, None, None, None, None, None,
    ]


def test_two_decimals_rounds_ties_up_whatever_the_noise(spark):
    noisy = [2.675, 2.6750000000000003, 2.6749999999999994, 2.674, 2.6749, 1.005]
    assert values(spark, noisy, fn.two_decimals, "double") == [2.68, 2.68, 2.68, 2.67, 2.67, 1.01]


def test_clean_key(spark):
    assert values(spark, ["  a b ", "\t\n", "", None], fn.clean_key) == ["a b", None, None, None]


def test_one_line(spark):
    assert values(spark, ["a\tb\nc"], fn.one_line) == ["a b c"]


def test_star_and_half_step(spark):
    assert values(spark, [1.0, 1.4, 2.5, 4.5, 4.9], fn.star, "double") == [1, 1, 3, 5, 5]
    assert values(spark, [1.0, 1.4, 2.5, 4.9], fn.half_step, "double") == [1.0, 1.0, 2.5, 4.5]


def test_length_buckets_at_their_edges(spark):
    lengths = [0, 99, 100, 299, 300, 599, 600, 899, 900, None]
    assert values(spark, lengths, fn.length_bucket, "int") == [
        "Very Short", "Very Short", "Short", "Short", "Medium", "Medium", "Long", "Long", "Very Long", None,
    ]
    assert values(spark, list(fn.LENGTH_LABELS), fn.bucket_ordinal) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        fn.length_bucket(F.lit(1), [1, 2], ["only one"])


def test_first_available_date(spark):
    details = [
        '{"Date First Available": "March 5, 2019"}',
        '{"Date First Available":   "July 15, 2020", "x": "y"}',
        '{"Date First Available": "5 March 2019"}',
        "{}",
        None,
    ]
    assert [str(d) if d else None for d in values(spark, details, fn.first_available_date)] == [
        "2019-03-05", "2020-07-15", None, None, None,
    ]


def test_correlation_bands(spark):
    cases = {
        -1.0: "Strong Negative", -0.5: "Strong Negative", -0.49: "Moderate Negative",
        -0.3: "Moderate Negative", 0.0: "Weak/No Correlation", 0.29: "Weak/No Correlation",
        0.3: "Moderate Positive", 0.5: "Strong Positive", None: "undefined",
    }
    assert values(spark, list(cases), fn.correlation_band, "double") == list(cases.values())


def test_safe_corr_of_a_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "x double, y double")
    assert df.agg(fn.safe_corr(F.col("x"), F.col("y"))).first()[0] is None


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(fn.percent(F.lit(1), F.lit(0))).first()[0] is None


def test_joined_text_keeps_nested_values_as_json(spark):
    df = spark.sql("select array('a', null, 'b') a, named_struct('k', 1) s, 5 n")
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.select(*[fn.joined_text(F.col(c), types[c]) for c in "asn"]).first()
    assert tuple(row) == ("a b", '{"k":1}', "5")
