import random

import pytest
from pyspark.sql import functions as F

from answerloom.functions import text
from answerloom.functions.features import dollar_count, has_display_math
from answerloom.functions.numbers import int_or_zero, percent, thousands
from tests import spec

PINNED = {
    "a < b and c > d": "a   d",
    "<p>hi</p>": "hi",
    "<a\nb>c": "c",
    "x &lt; y": "x &lt; y",
    "a\r\nb\rc": "a\nb\nc",
    "a  \n\n\n\n\nb": "a\n\n\nb",
    "\xa0x\u3000": "x",
    "\\(x\\) and \\[y\\]": "$x$ and $$y$$",
    "\\\\[4pt]": "\\$$4pt]",
    "\u200b  x": "  x",
    "\\\u200b[y]": "\\[y]",
    "e\u0301": "\xe9",
    "\n\t": "",
    "": "",
    None: "",
    "<>b>c": "<>b>c".replace("<>b>", " ").strip(),
    "1 < 2": "1 < 2",
}
PIECES = [
    *"ab <>\n\n\n\r\t$\\[]()&;",
    *"\x0b\x0c\x1c\x85\xa0\u1680\u2003\u2028\u3000\u200b\u200d\ufeff\u0301\u0338\u212b\u1112\u1161\u11ab\U0001f600",
    "\\[",
    "\\)",
    "<b>",
    "\r\n",
    "   ",
]


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("t"))).collect()]


def test_pinned_cases(spark):
    assert column(spark, PINNED, text.clean_text) == [spec.clean(t) for t in PINNED]
    expected = {t: o for t, o in PINNED.items() if t != "<>b>c"}
    assert column(spark, expected, text.clean_text) == list(expected.values())


def test_fuzz_against_the_plain_statement(spark):
    rng = random.Random(7)
    values = ["".join(rng.choices(PIECES, k=rng.randrange(40))) for _ in range(5000)]
    assert column(spark, values, text.clean_text) == [spec.clean(v) for v in values]


def test_long_runs_take_linear_time(spark):
    n = 1_000_000
    values = ["x" + " " * n + "y", "<" * n, "x" + "\n " * n + "y", "<b" * n + ">", "\u3000" * n]
    assert [len(v) for v in column(spark, values, text.clean_text)] == [n + 2, n, 6, 0, 0]


def test_cleaning_is_planned_once(spark):
    frame = spark.createDataFrame([("q", "a")], "Q string, A string")
    plan = text.with_cleaned(frame, "Q", "A").filter("length(Q) > 1 AND length(A) < 9")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Normalizer") == 2 and "Python" not in shown


def test_token_count(spark):
    values = ["", " ", "a", " a\n\u2003b  c ", None]
    assert column(spark, values, text.token_count) == [0, 0, 1, 3, None]


@pytest.mark.parametrize("value,count,display", [("$$a$", 3, True), ("", 0, False), ("$", 1, False), ("a", 0, False)])
def test_math_features(spark, value, count, display):
    assert column(spark, [value], dollar_count) == [count]
    assert column(spark, [value], has_display_math) == [display]


def test_integers_from_text(spark):
    values = ["7", " 7 ", "7.9", "-3", "n/a", "", None, "99999999999", "1e2", "true", "1e99", "NaN", "1d"]
    assert column(spark, values, int_or_zero) == [7, 7, 7, -3, 0, 0, 0, 0, 100, 0, 0, 0, 0]


def test_report_numbers(spark):
    row = spark.range(1).select(
        percent(F.lit(1), F.lit(4)), percent(F.lit(0), F.lit(0)), thousands(F.lit(1234567)), text.preview(F.lit("abc"), 2)
    )
    assert tuple(row.first()) == (25.0, 0.0, "1,234,567", "ab")


def test_cleaned_text_can_be_aggregated_once_projected(spark):
    frame = spark.createDataFrame([("<b>aa",), (None,)], "t string")
    assert frame.select(text.clean_text(F.col("t")).alias("t")).agg(F.max(F.length("t"))).first()[0] == 2
    assert text.with_cleaned(frame, "t").agg(F.max(F.length("t"))).first()[0] == 2
