"""Casts, trimming, rounding and exact sums on awkward cells."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyroom.functions import exprs as X
from tallyroom.functions.text import strip_accents, term_marks, with_pairs, words


def cells(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, c string")
    return [r[0] for r in df.select(expression.alias("v"), "i").orderBy("i").select("v").collect()]


def test_safe_int(spark):
    given = ["1.5", "2.5", "-2.5", "1e2", " 7 ", "", "abc", "1.5d", "99999999999", "nan", None]
    assert cells(spark, given, X.safe_int("c")) == [2, 3, -3, 100, 7, None, None, None, None, None, None]


def test_safe_double(spark):
    got = cells(spark, ["1.5", "1.5d", "2f", "inf", "-inf", "NaN", "", "1e3", "0x10"], X.safe_double("c"))
    assert got[0] == 1.5 and got[1] is None and got[2] is None
    assert got[3] == math.inf and got[4] == -math.inf and math.isnan(got[5])
    assert got[6:] == [None, 1000.0, None]


def test_safe_timestamp_keeps_the_wall_clock(spark):
    given = ["2018-07-31 18:30:39+01:00", "2018-07-31T18:30:39Z", "2018-07-31", "2017", "2017-02", "soon", "", None]
    assert cells(spark, given, X.safe_timestamp("c")) == [
        dt.datetime(2018, 7, 31, 18, 30, 39),
        dt.datetime(2018, 7, 31, 18, 30, 39),
        dt.datetime(2018, 7, 31),
        None, None, None, None, None,
    ]


def test_safe_date(spark):
    got = cells(spark, ["2018-07-31 10:00:00", "2018-02-30", "2018", None], X.safe_date("c", "ignored"))
    assert got == [dt.date(2018, 7, 31), None, None, None]


def test_trimming(spark):
    given = ["  Ab  ", "\tAb", "   ", None]
    assert cells(spark, given, X.clean_lower("c")) == ["ab", "\tab", "", None]
    assert cells(spark, given, X.clean_upper("c")) == ["AB", "\tAB", "", None]
    assert cells(spark, given, X.blank_to_null("c")) == ["Ab", "\tAb", None, None]


def test_round_half_away(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (0.125,), (None,)], "c double")
    assert [r[0] for r in df.select(X.round_half_away("c", 2)).collect()] == [1.0, 2.5, -2.5, 0.13, None]
    assert [r[0] for r in df.select(X.round_half_away("c", 0)).collect()] == [1.0, 3.0, -3.0, 0.0, None]


def test_days_count_midnights(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-01-01 23:59:00' a, timestamp_ntz'2020-01-02 00:01:00' b")
    assert df.select(X.days_between("a", "b")).first()[0] == 1
    assert df.select(X.days_between("b", "a")).first()[0] == -1


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    keys = {r[0] for r in df.select(X.surrogate_key("x", "y")).collect()}
    assert len(keys) == 3


def test_exact_sum_in_any_order(spark):
    values = [round(random.Random(7).uniform(0, 1e5), 2) for _ in range(5000)]
    noisy = [v + 0.1 - 0.1 for v in values]  # off by rounding errors only
    want = round(sum(round(v * 100) for v in values) / 100, 2)
    for order in (noisy, noisy[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(7)
        assert df.select(X.exact_sum("v")).first()[0] == want


@pytest.mark.parametrize(
    ("values", "check"),
    [
        ([1.0, float("nan")], math.isnan),
        ([1.0, float("inf")], lambda s: s == math.inf),
        ([0.1234567, 1.0], lambda s: s == pytest.approx(1.1234567, abs=1e-12)),
        ([1e300, 1.0], lambda s: s == 1e300),
        ([None, None], lambda s: s is None),
        ([None, 2.5], lambda s: s == 2.5),
        ([9e14, 9e14], lambda s: s == 1.8e15),
    ],
)
def test_exact_sum_edges(spark, values, check):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert check(df.select(X.exact_sum("v")).first()[0])


def test_exact_avg_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert df.select(X.exact_avg("v")).first()[0] == 1.5
    assert df.where("v > 5").select(X.exact_avg("v")).first()[0] is None


def test_words_and_pairs(spark):
    df = spark.createDataFrame([("Ça va, l'été ﬁn_1 a x²!",), ("",), ("ascii only text",)], "t string")
    got = [r.w for r in df.select(words(F.col("t")).alias("w")).collect()]
    assert got == [["ca", "va", "ete", "fin_1", "x2"], [], ["ascii", "only", "text"]]
    pairs = df.select(words(F.col("t")).alias("w")).select(with_pairs(F.col("w")).alias("p")).collect()
    assert pairs[2].p == ["ascii", "only", "text", "ascii only", "only text"]
    assert pairs[1].p == []


def test_accents_keep_null(spark):
    assert cells(spark, ["é", None, "e"], strip_accents(F.col("c"))) == ["e", None, "e"]


def test_term_marks(spark):
    df = spark.createDataFrame([(["b", "a", "b"],)], "t array<string>")
    rows = df.select(F.inline(term_marks(F.col("t")))).groupBy("term").sum().collect()
    assert {(r.term, r["sum(total)"], r["sum(docs)"]) for r in rows} == {("a", 1, 1), ("b", 2, 1)}


def test_accents_in_runs_of_other_characters(spark):
    import unicodedata

    texts = ["cafe\u0301 \u00e9t\u00e9 \ufb01n \u00bd", "\u0391\u0301\u0314\u0308 \uac00\u11a8 \u1e69\u0307", "\u00e9" * 40 + "x" + "\u0151" * 3]
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert cells(spark, texts, strip_accents(F.col("c"))) == want
