"""Golden vectors of the text expressions."""

import math

import pytest
from pyspark.sql import functions as F

from ordinalis.functions import text as tx
from ordinalis.functions.ordinal import digitize, round_half_even
from ordinalis.plans.features import text_features


def column(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_keywords(spark):
    got = column(spark, ["bagusé push Keep keep", "bagusKeep x", "challenging bagus", "PUSH", "pupushsh", None],
                 tx.replace_keywords)
    assert got == ["good good great keep", "good x", "troublesome good", "PUSH", "pugoodsh", None]


def test_days(spark):
    got = column(spark, ["0 days 05:06:00", "-1 days +23:00:00", "12", "  7 days", "+3 days", "1.5 days", "05:06:00",
                         "", None, "1_000 days", "٣ days", "99999999999999999999 days"], tx.leading_days)
    assert got == [0, -1, 12, 7, 3, None, None, None, None, None, None, None]


@pytest.mark.parametrize("text, expected", [
    ("", True), (None, True), ("😀👍", True), ("👍🏽", True), ("❤️", False), ("👍 ", False), ("5", False), ("#", False),
    ("👍\n", False), ("a", False)])
def test_emoji_only(spark, text, expected):
    assert column(spark, [text], tx.is_emoji_only) == [expected]


def test_flags(spark):
    def flag(name, value):
        return column(spark, [value], lambda c: tx.contains(c, tx.REPLY_PATTERNS[name]))[0]

    assert flag("has_sorry", "SORRY") == flag("has_sorry", "ſorry") == 1
    assert flag("has_thanks", "THANKS") == 1
    assert flag("has_bank_handle", "x@bankXcoXid!") == 1
    assert flag("has_bank_handle", "@BANK.co.id") == 0
    assert flag("has_bank_handle", "@BANK.co.id\r") == 1
    assert flag("has_bank_handle", "@BANK.co.id\n") == 0


def test_rounding_and_bins(spark):
    assert column(spark, [0.5, 1.5, 2.5, -0.5], round_half_even, "double") == [0, 2, 2, 0]
    cuts = [0.5, 1.5, 2.5, 3.5]
    got = column(spark, [-1.0, 0.5, 1.4, 3.5, 9.0, float("nan"), None], lambda c: digitize(c, cuts), "double")
    assert got == [0, 1, 1, 4, 4, 4, None]


def test_importance_edge_cases(spark):
    rows = spark.createDataFrame([(0, 0), (10, 0), (10, -1), (10, 3)], "n int, thumbs long")
    got = [r[0] for r in rows.select(tx.importance(F.col("n"), F.col("thumbs"))).collect()]
    assert got[:3] == [0.0, 0.0, None] and got[3] == pytest.approx(math.log(11) * math.log(4))


def test_working_column_is_cleaned_and_raw_review_decides_on_emoji(spark):
    rows = spark.createDataFrame(
        [(1, "👍", "thumb", None, "3 days", 1), (2, "bagus!", "push it?", "Sorry", None, 0), (3, None, None, None, None, 0)],
        "id long, review string, translated_review string, replyContent string, timeToReply string, thumbsUpCount long")
    got = {r.id: r for r in text_features(rows, "translated_review").collect()}
    assert [got[i].text for i in (1, 2, 3)] == ["great", "good it?", "great"]
    assert got[2].has_question_mark == 1 and got[2].has_sorry == 1 and got[1].days_to_reply == 3
    assert got[3].replyContent == "" and got[2].review == "bagus!"
