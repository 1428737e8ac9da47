"""Split, fingerprint, text weights, metrics, gate, registry and scoring."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallyroom.operators import learning as L
from tallyroom.operators import metrics as M
from tallyroom.plans import learning as P
from tallyroom.plans import scoring as S
from tallyroom.streaming.score import score_stream


def test_guard(spark):
    df = spark.createDataFrame([(0,), (1,), (1,)], "satisfied int")
    assert L.guard(df, min_rows=3) == 3
    with pytest.raises(L.TrainingRefused, match="50000"):
        L.guard(df)
    with pytest.raises(L.TrainingRefused, match="two classes"):
        L.guard(df.where("satisfied = 1"), min_rows=1)


def test_fingerprint_ignores_order_and_sees_changes(spark):
    rows = [(i, None if i % 5 == 0 else f"t{i}") for i in range(200)]
    prints = [
        L.fingerprint(spark.createDataFrame(r, "id int, t string").repartition(k), ["id", "t"]).first().fingerprint
        for r, k in ((rows, 1), (rows[::-1], 5), ([*rows[:-1], (199, "x")], 1), ([(0, ""), *rows[1:]], 1))
    ]
    assert prints[0] == prints[1] and len(set(prints)) == 3


def test_split_is_stratified_and_repeatable(spark):
    rows = [(i, int(i % 10 == 0)) for i in range(1000)]
    one = L.stratified_split(spark.createDataFrame(rows, "id int, y int"), "id", "y")
    two = L.stratified_split(spark.createDataFrame(rows[::-1], "id int, y int").repartition(6), "id", "y")
    counts = {(r.y, r.is_test): r["count"] for r in one.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, True): 180, (0, False): 720, (1, True): 20, (1, False): 80}
    assert one.where("is_test").exceptAll(two.where("is_test")).count() == 0


def test_scaling(spark):
    values = [1.0, None, 3.0, 10.0]
    df = spark.createDataFrame([(v, 7.0) for v in values], "x double, c double")
    filled = np.array([1, 3, 3, 10.0])
    got = [r.x for r in L.scale(df, ["x", "c"], center=True).collect()]
    assert got == pytest.approx(((filled - filled.mean()) / filled.std()).tolist())
    assert [r.x for r in L.scale(df, ["x"], center=False).collect()] == pytest.approx((filled / filled.std()).tolist())
    assert [r.c for r in L.scale(df, ["c"], center=True).collect()] == [0.0] * 4
    assert [r.x for r in L.median_impute(df, ["x"]).collect()] == filled.tolist()


def test_tfidf_by_hand(spark):
    texts = ["Été été chaud", "ete froid", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {(r.id, r.term): r.weight for r in L.tfidf(df, "id", "t", max_features=3, min_df=1).collect()}
    # corpus counts: ete 3, then one each; the cut keeps the smallest terms
    idf = {"ete": math.log(5 / 3) + 1, "chaud": math.log(5 / 2) + 1, "ete chaud": math.log(5 / 2) + 1}
    first = {"ete": 2 * idf["ete"], "chaud": idf["chaud"], "ete chaud": idf["ete chaud"]}
    norm = math.sqrt(sum(v * v for v in first.values()))
    want = {(0, t): v / norm for t, v in first.items()} | {(1, "ete"): 1.0}
    assert got == pytest.approx(want)


def test_vocabulary_counts_only_pairs_that_can_be_chosen(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", f"rare{i}"]) for _ in range(12)) for i in range(60)]
    texts += ["tie one", "tie two"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    total, docs = Counter(), Counter()
    for text in texts:
        w = text.split()
        terms = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        total.update(terms)
        docs.update(set(terms))
    counted = []
    count = L.term_counts
    monkeypatch.setattr(L, "term_counts", lambda d, terms="terms": counted.append(count(d, terms)) or counted[-1])
    for k in (3, 20):
        want = sorted((-n, t, docs[t]) for t, n in total.items() if docs[t] >= 3)[:k]
        for listed in (L.vocabulary(L.with_terms(df, "t"), "terms", k, 3), L.vocabulary(L.with_terms(df, "t", "terms", (1, 1)), "terms", k, 3, (1, 2))):
            assert [(-r.n_total, r.term, r.n_docs) for r in listed.collect()] == want
            # Pairs of words that are too rare are never counted.
            assert not [r.term for r in counted[-1].collect() if "rare" in r.term]


def test_tfidf_without_common_terms(spark):
    df = spark.createDataFrame([(1, "solo words here")], "id int, t string")
    assert L.tfidf(df, "id", "t").count() == 0
    assert [r.terms for r in L.with_terms(df, "t", "terms", (1, 1)).collect()] == [["solo", "words", "here"]]


def test_metrics_by_hand(spark):
    pairs = [(1, 1)] * 5 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 4
    df = spark.createDataFrame(pairs, "label int, prediction int")
    row = M.classification_metrics(df).first()
    assert row.accuracy == pytest.approx(9 / 12) and row.f1 == pytest.approx(10 / 13)
    assert row.recall_unsatisfied == pytest.approx(4 / 5) and row.precision_unsatisfied == pytest.approx(4 / 6)
    lonely = M.classification_metrics(df.where("label = 1 AND prediction = 1")).first()
    assert (lonely.precision_unsatisfied, lonely.f1_unsatisfied) == (0.0, 0.0)


def test_auc_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 1), rng.choice([0.1, 0.2, 0.5, rng.random()])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label int, score double").repartition(5)
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df, key="id").first().roc_auc == pytest.approx(want, abs=1e-12)
    assert M.roc_auc(df.where("label = 1")).first().roc_auc is None


@pytest.mark.parametrize(
    ("new", "old", "promote", "reason"),
    [
        ((0.84, 0.9, 0.9, 0.9), None, False, "accuracy"),
        ((0.85, 0.9, 0.49, 0.9), None, False, "recall"),
        ((0.85, 0.9, 0.5, 0.62), None, False, "f1 of class 0"),
        ((0.85, 0.9, 0.5, 0.63), None, True, "no champion"),
        ((0.85, 0.9, 0.5, 0.63), (0.901, 0.505), True, "as good"),
        ((0.85, 0.9, 0.5, 0.63), (0.903, 0.5), False, "worse"),
        ((0.85, 0.9, 0.5, 0.63), (0.9, 0.52), False, "worse"),
    ],
)
def test_gate(spark, new, old, promote, reason):
    candidate = spark.createDataFrame([("m", *new)], "model string, accuracy double, f1 double, recall_unsatisfied double, f1_unsatisfied double")
    rival = spark.createDataFrame([("m", *old)], "model string, f1 double, recall_unsatisfied double") if old else None
    row = P.promotion_gate(candidate, rival).first()
    assert row.promote is promote and row.reason.startswith(reason)


def reviews(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        good = rng.random() < 0.6
        text = rng.choice(["ótimo produto", "muito bom"]) if good else rng.choice(["péssimo atraso", "não chegou"])
        rows.append((f"r{i}", text, None if i % 9 == 0 else rng.randint(-15, 2) + (0 if good else 12), len(text), True, rng.randint(0, 4), int(good)))
    return spark.createDataFrame(
        rows,
        "review_id string, review_comment_message string, delivery_delay_days int, review_comment_length int, "
        "has_comment boolean, payment_type_encoded int, satisfied int",
    )


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    store = P.ModelStore(str(tmp_path_factory.mktemp("models")))
    cfg = P.TrainConfig(min_rows=100)
    return store, cfg, P.train_and_register(spark, reviews(spark), store, cfg)


def test_training_learns_and_registers(spark, trained):
    store, cfg, result = trained
    assert result["status"] == "trained" and result["promoted"] and result["version"] == 1
    assert result["metrics"]["accuracy"] > 0.95 and result["metrics"]["roc_auc"] > 0.95
    run = P.runs(spark, store).first()
    assert run.params["tfidf_max_features"] == "500" and run.metrics["f1"] > 0.95 and "macro avg" in run.report


def test_same_data_is_skipped_and_new_data_replaces_the_champion(spark, trained):
    store, cfg, first = trained
    again = P.train_and_register(spark, reviews(spark).repartition(7), store, cfg)
    assert again["status"] == "skipped" and again["version"] == 1 and again["fingerprint"] == first["fingerprint"]
    fresh = P.train_and_register(spark, reviews(spark, seed=2), store, cfg)
    assert fresh["status"] == "trained" and fresh["version"] == 2
    stages = {r.version: r.stage for r in P.current_stages(P.registry_events(spark, store)).collect()}
    assert stages[2] == ("Production" if fresh["promoted"] else None)
    assert stages[1] == ("Archived" if fresh["promoted"] else "Production")


def test_champion_falls_back_to_the_highest_production_version(spark):
    events = spark.createDataFrame(
        [("m", v, "stage", s, f"2024-0{v}", f"run{v}", f"p{v}") for v, s in ((1, "Production"), (2, "Production"), (3, "Staging"))],
        P.EVENT_SCHEMA,
    )
    assert P.champion(events, "m").first().version == 2
    alias = spark.createDataFrame([("m", 1, "alias", "champion", "2024-09", None, None)], P.EVENT_SCHEMA)
    assert P.champion(events.union(alias), "m").first().version == 1
    assert P.champion(events, "other").first() is None


def test_saved_model_scores_like_before(spark, trained):
    store, cfg, _ = trained
    model, _ = P.load_champion(spark, store, cfg.model_name)
    requests = spark.createDataFrame(
        [(" muito bom ", -10.0, 999, False, 0), ("péssimo atraso", 12.0, 0, False, 1), ("x", None, 0, True, 0)],
        "review_comment_message string, delivery_delay_days double, review_comment_length int, has_comment boolean, payment_type_encoded int",
    )
    scored, rejected = S.score_requests(model, requests, cfg)
    rows = sorted(scored.collect(), key=lambda r: r.delivery_delay_days)
    assert [r.satisfied for r in rows] == [True, False]
    assert rows[0].review_comment_length == 9 and rows[0].received_length == 999
    assert all(r.probability == round(r.probability, 4) for r in rows)
    assert rejected.first().reason.startswith("delivery_delay_days missing")


def test_numeric_model(spark, tmp_path):
    cfg = P.TrainConfig(use_text=False, min_rows=100, gate=P.GateConfig(0, 0, 0))
    result = P.train_and_register(spark, reviews(spark), P.ModelStore(str(tmp_path)), cfg)
    assert result["metrics"]["accuracy"] > 0.8 and result["promoted"]


def test_missing_model_is_refused(spark, tmp_path):
    with pytest.raises(LookupError):
        P.load_champion(spark, P.ModelStore(str(tmp_path)), "m")
    with pytest.raises(LookupError):
        S.score_requests(None, spark.range(1))
    with pytest.raises(LookupError):
        score_stream(spark, None, "a", "b", "c")


REQUEST = "review_comment_message string, delivery_delay_days double, review_comment_length int, has_comment boolean, payment_type_encoded int"


def stub():
    return SQLTransformer(
        statement="SELECT *, CASE WHEN delivery_delay_days = -20 AND review_comment_length = 0 AND has_comment = 0 "
        "AND payment_type_encoded = 0 THEN 0.748D WHEN delivery_delay_days = 20 AND review_comment_length = 280 THEN 0.004D "
        "WHEN delivery_delay_days < 0 THEN 0.7D ELSE 0.2D END AS p FROM __THIS__"
    )


class Rule(SQLTransformer):
    """Stub with class and probability vector."""

    def _transform(self, df):
        from pyspark.ml.functions import array_to_vector

        scored = stub().transform(df)
        return scored.withColumn("prediction", (F.col("p") >= 0.5).cast("double")).withColumn(
            "probability", array_to_vector(F.array(1 - F.col("p"), F.col("p")))
        )


NUMERIC = P.TrainConfig(use_text=False)


def test_known_requests(spark):
    rows = [("", -20.0, 0, False, 0), ("", 20.0, 280, True, 1), ("", 3.0, 85, True, 0)]
    scored, _ = S.score_requests(Rule(), spark.createDataFrame(rows, REQUEST), NUMERIC)
    got = {r.delivery_delay_days: (r.satisfied, r.probability) for r in scored.collect()}
    # the given length and flag are not used: the second is scored on its empty text
    assert got == {-20.0: (True, 0.748), 20.0: (False, 0.2), 3.0: (False, 0.2)}


def test_column_order_does_not_matter(spark):
    df = spark.createDataFrame([("", -20.0, 0, False, 0)], REQUEST)
    turned = df.select(*reversed(df.columns))
    for given in (df, turned):
        assert S.score_requests(Rule(), given, NUMERIC)[0].first().probability == 0.748


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        (("", -1.0, 0, False, 99), "payment_type_encoded outside"),
        (("", -1.0, 0, False, -1), "payment_type_encoded outside"),
        (("", -1.0, -5, False, 0), "review_comment_length below"),
        (("", None, None, None, None), "delivery_delay_days missing"),
        (("", -1.0, 0, True, 4), None),
        ((None, -1.0, 0, False, 0), None),
    ],
)
def test_validation(spark, row, reason):
    valid, rejected = S.validate_requests(spark.createDataFrame([row], REQUEST))
    if reason is None:
        assert (valid.count(), rejected.count()) == (1, 0)
    else:
        assert valid.count() == 0 and rejected.first().reason.startswith(reason)


def test_frame_without_required_columns_is_rejected(spark):
    valid, rejected = S.validate_requests(spark.createDataFrame([(-10.0,)], "delivery_delay_days double"))
    assert valid.count() == 0 and "has_comment missing" in rejected.first().reason


def test_summary_clamps(spark):
    df = spark.createDataFrame([(True, 1.2, "x" * 60), (False, -0.1, "")], "satisfied boolean, probability double, review_comment_message string")
    high, low = S.summarise(df).collect()
    assert (high.label, high.satisfied_share, high.confidence, len(high.comment_preview)) == ("satisfied", 1.0, 1.0, 50)
    assert (low.label, low.satisfied_share, low.confidence, low.comment_preview) == ("unsatisfied", 0.0, 1.0, "no comment")


def test_stream_scores_once_and_keeps_rejects(spark, tmp_path):
    src, out, state = (f"{tmp_path}/{n}" for n in ("src", "out", "state"))
    spark.createDataFrame([("", -20.0, 7, True, 0), ("", 1.0, 0, False, 77)], REQUEST).write.json(src)
    for _ in range(2):
        score_stream(spark, Rule(), src, out, state, cfg=NUMERIC).awaitTermination()
    audit = spark.read.parquet(f"{out}/audit").collect()
    assert [(r.review_comment_length, r.has_comment, r.satisfied, r.probability) for r in audit] == [(7, True, True, 0.748)]
    assert spark.read.parquet(f"{out}/rejected").count() == 1
