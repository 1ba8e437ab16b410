from pyspark.sql import functions as F

from tallyloom.functions import frames, numeric, recode, text


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column).first()[0]


def test_to_number_rejects_what_no_survey_means(spark):
    texts = ["1.5", " 3 ", "1.0d", "2f", "abc", "", None, "NaN", "inf", "-4", "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(numeric.to_number("t")).collect()]
    assert got == [1.5, 3.0, None, None, None, None, None, None, float("inf"), -4.0, 1000.0]
    assert one(spark, numeric.to_number("t", finite=True), t="inf") is None


def test_ratio_has_no_value_for_zero(spark):
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numeric.ratio(F.lit(1), F.lit(4), 100.0)) == 25.0


def test_codes_and_bands(spark):
    assert one(spark, text.normalize_code("c"), c=" '2' ") == "2"
    assert one(spark, text.normalize_code("c"), c="''") == ""
    assert one(spark, text.normalize_code("c"), c="'<NA>'") is None
    labels = [one(spark, recode.band("v", [1, 50, 100], ["a", "b"]), v=v) for v in (1, 50, 51, 100, 101, 0)]
    assert labels == ["a", "a", "b", "b", None, None]
    assert one(spark, recode.recode("c", {"1": "x"}), c="2") is None
    assert one(spark, recode.recode("c", {"1": "x"}, keep=True), c="2") == "2"
    assert one(spark, recode.label_rank("c", ["b", "a"]), c="zz") == 99


def test_calendar_factor(spark):
    f = lambda m, y: one(spark, recode.calendar_factor("m", "y", 2024), m=m, y=y)
    assert [f(1, 2024), f(3, 2024), f(4, 2024), f(1, 2025), f(3, 2025)] == [0.0, 2 / 3, 1.0, 1.0, 1 / 3]


def test_weight_columns_are_ordered_and_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "W10 double, W02 double, W1 double")
    assert frames.weight_columns(df, "W") == ["W1", "W02", "W10"]
    try:
        frames.weight_columns(df, "W", 3)
    except ValueError as error:
        assert "expected 3" in str(error)
    else:
        raise AssertionError("a gap in the numbering must fail")


def test_entities(spark):
    assert one(spark, text.decode_entities("t"), t="a&amp;lt;b &#233;&#8364; &copy;") == "a&lt;b é€ ©"


def test_search_treats_wildcards_as_text(spark):
    df = spark.createDataFrame([("100% sure",), ("100 sure",)], "t string")
    assert df.filter(text.contains_text("t", "0%")).count() == 1


def test_entities_are_read_once(spark):
    assert one(spark, text.decode_entities("t"), t="&#38;lt; &#x27;q&#X1F600;&eacute;&amp;amp; & &;") == "&lt; 'q\U0001f600&eacute;&amp; & &;"
    assert one(spark, text.decode_entities("t"), t="&lt;&gt;") == "<>"
