"""Languages: the kernel against sets of n-grams, the fit against the formula, held-out accuracy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from tallyroom.llm import queries, string_kernel
from tallyroom.llm.string_kernel import Landmarks, Model, fit, language_of, presence

SCHEMA = "doc_id bigint, text string, lang string, source string, score string, found string, code string, at string"


def folded(text):
    return " " + "".join(c.lower() if c.isalpha() else " " for c in text) + " "


def test_kernel_counts_shared_grams():
    texts = ["the cat sat", "The CAT, sat; the cat", "où est le chat 12", "zzz"]

    def own(t):
        t = folded(t)
        return {t[i : i + n] for n in string_kernel.GRAMS for i in range(len(t) - n + 1)}

    assert [len(presence(t)) for t in texts] == [len(own(t)) for t in texts]
    k = np.stack([Landmarks(texts).kernel(t) for t in texts])
    assert np.allclose(k, [[len(own(a) & own(b)) / np.sqrt(len(own(a)) * len(own(b))) for b in texts] for a in texts])


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "one two three four " * 50 + "quixotic"
    whole = presence(text)
    monkeypatch.setattr(string_kernel, "_PIECE", 64)
    assert np.array_equal(whole, presence(text))


def test_fit_is_ridge_regression_on_landmarks(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = fit(docs, train, rows=1 << 20, landmarks=16)
    rows = {(r.lang, r.text) for r in docs.where(train).select("lang", "text").collect()}
    code = {r.text: r.c for r in docs.select("text", F.xxhash64("text").alias("c")).collect()}
    marks = []
    for lang in sorted(model.langs):
        marks += sorted((t for x, t in rows if x == lang and len(t.encode()) <= string_kernel.LANDMARK_BYTES), key=code.get)[:4]
    lm = Landmarks(marks)
    k_mm = np.stack([lm.kernel(t) for t in marks])
    k = np.stack([lm.kernel(t) for _, t in rows])
    y = np.array([[1.0 if x == lang else -1.0 for lang in model.langs] for x, _ in rows])
    # Nyström ridge without the root: coefficients on the landmarks.
    a = np.linalg.solve(k.T @ k + string_kernel.RIDGE * len(rows) * k_mm, k.T @ y)
    assert np.allclose(model.margins([t for _, t in rows]), k @ a, atol=1e-3)


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op12_string_kernel_language"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_tables(spark):
    odd = [None, "", " ", "12 !?", "ж", "the cat and the dog", "der Hund und die Katze", "der Hund und die Katze", "the " * 50_000, "12"]
    langs = ["en", "en", None, "en", "ru", "en", "de", "de", "en", "xx"]
    df = spark.createDataFrame([(i, t, x, "a", "b", "c", "d", "e") for i, (t, x) in enumerate(zip(odd, langs))], SCHEMA)
    model = fit(df, F.lit(True))
    assert model.langs == ["de", "en", "ru"]  # by number of texts, then name; "xx" has no letter to learn from
    got = {r.doc_id: r.out for r in df.withColumn("out", language_of(spark, model, F.col("text"))).collect()}
    assert [got[i].lang for i in range(len(odd))] == ["und"] * 4 + ["ru", "en", "de", "de", "en", "und"]
    assert all((x.score == 0) == (x.lang == "und") and 0 <= x.score <= 1 for x in got.values())
    for nothing in (fit(df.limit(0), F.lit(True)), fit(df.withColumn("lang", F.lit(None).cast("string")), F.lit(True)), fit(df, F.lit(None).cast("boolean"))):
        assert nothing.langs == [] and nothing.classify(odd)[0] == ["und"] * len(odd)
    only = fit(df.where("doc_id = 6"), F.lit(True))
    assert only.classify(["anything"])[0] == ["de"]
    assert Model(["de"], only.codes, only.weights).classify(["qqq"])[0] == ["de"]
    copies = spark.createDataFrame([("der Hund", "de")] * 300 + [("the dog", "en")], "text string, lang string")
    assert fit(copies, F.lit(True), rows=2).classify(["the dog", "der Hund"])[0] == ["en", "de"]
