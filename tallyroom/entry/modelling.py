"""Registered queries: text, splits, training, metrics, gate and scoring."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.entry.adapters import entity, spread, table, with_sql
from tallyroom.entry.book import plain, query
from tallyroom.functions.exprs import round_half_away
from tallyroom.functions.text import words
from tallyroom.operators import learning as L
from tallyroom.operators import metrics as M
from tallyroom.plans import learning, scoring
from tallyroom.sources.durable import durable, shared_root
from tallyroom.sources.readers import new_batch_id

_TERMS = r"""
WITH tokens AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}') AS w FROM documents)
, terms AS (SELECT doc_id, unnest(w) AS term FROM tokens
    UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM tokens)
, tf AS (SELECT doc_id, term, count(*) AS n FROM terms GROUP BY doc_id, term)
, vocabulary AS (SELECT term, CAST(sum(n) AS BIGINT) AS n_total, count(*) AS n_docs FROM tf GROUP BY term
    HAVING count(*) >= 5 ORDER BY n_total DESC, term ASC LIMIT 500)"""


@query(
    "tokenise",
    r"""
SELECT doc_id, len(w) AS n_words, array_to_string(w, ' ') AS words FROM (
    SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}') AS w FROM documents)""",
)
def tokenise(spark: SparkSession, d: str) -> DataFrame:
    listed = spread(table(spark, d, "documents"), "doc_id").select("doc_id", words(F.col("text")).alias("w"))
    return plain(listed.select("doc_id", F.size("w").alias("n_words"), F.concat_ws(" ", "w").alias("words")))


@query("tfidf_vocabulary", _TERMS + " SELECT term, n_total, n_docs FROM vocabulary")
def tfidf_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    documents = spread(table(spark, d, "documents"), "doc_id")
    return L.vocabulary(L.with_terms(documents, "text", ngrams=(1, 1)), ngrams=(1, 2))


@query(
    "tfidf_vectors",
    _TERMS
    + """
, weighted AS (SELECT doc_id, term, n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + n_docs)) + 1) AS v
    FROM tf JOIN vocabulary USING (term))
SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS weight FROM weighted""",
)
def tfidf_vectors(spark: SparkSession, d: str) -> DataFrame:
    vectors = L.tfidf(spread(table(spark, d, "documents"), "doc_id"), "doc_id", "text")
    return vectors.withColumn("weight", round_half_away("weight", 6))


@query(
    "stratified_split",
    """
SELECT o_orderkey, o_orderstatus, rn <= floor(n * 0.2 + 0.5) AS is_test FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY b, o_orderkey) AS rn,
        count(*) OVER (PARTITION BY o_orderstatus) AS n
    FROM (SELECT o_orderkey, o_orderstatus,
        CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 12) AS BIGINT) AS b FROM orders))""",
)
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return L.stratified_split(orders, "o_orderkey", "o_orderstatus")


@query(
    "class_balance_guard",
    with_sql("labelled_reviews")
    + """
SELECT count(*) AS n_rows, count(DISTINCT satisfied) AS n_classes, CAST(sum(satisfied) AS BIGINT) AS n_positive,
    round(avg(satisfied), 6) AS positive_share
FROM labelled_reviews""",
)
def class_balance_guard(spark: SparkSession, d: str) -> DataFrame:
    facts = L.guard_facts(entity(spark, d, "labelled_reviews"))
    return facts.withColumn("positive_share", round_half_away("positive_share", 6))


@query(
    "median_impute_scale",
    """
WITH raw AS (SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS quantity,
    l_extendedprice AS price FROM lineitem)
, filled AS (SELECT l_orderkey, l_partkey, coalesce(quantity, (SELECT quantile_cont(quantity, 0.5) FROM raw)) AS quantity,
    price FROM raw)
SELECT l_orderkey, l_partkey,
    round((quantity - (SELECT avg(quantity) FROM filled)) / (SELECT stddev_pop(quantity) FROM filled), 4) AS quantity,
    round((price - (SELECT avg(price) FROM filled)) / (SELECT stddev_pop(price) FROM filled), 4) AS price
FROM filled""",
)
def median_impute_scale(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    scaled = L.scale(items, ["quantity", "price"], center=True)
    return scaled.withColumns({c: round_half_away(c, 4) for c in ("quantity", "price")})


@query(
    "data_fingerprint",
    """
SELECT n_rows, sha256(n_rows || '-' || a || '-' || b) AS fingerprint FROM (
    SELECT count(*) AS n_rows, sum(CAST('0x' || substr(h, 1, 12) AS BIGINT)) AS a,
        sum(CAST('0x' || substr(h, 13, 12) AS BIGINT)) AS b
    FROM (SELECT md5(concat_ws(chr(31), CAST(doc_id AS VARCHAR), coalesce(lang, chr(30)),
        coalesce(CASE WHEN source <> 'web' THEN source END, chr(30)), text)) AS h FROM documents))""",
)
def data_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    documents = spread(table(spark, d, "documents"), "doc_id").withColumn(
        "source", F.when(F.col("source") != "web", F.col("source"))
    )
    return L.fingerprint(documents, ["doc_id", "lang", "source", "text"])


@query(
    "fingerprint_of_new_batches",
    """
SELECT n_rows, sha256(n_rows || '-' || a || '-' || b) AS fingerprint FROM (
    SELECT count(*) AS n_rows, sum(CAST('0x' || substr(h, 1, 12) AS BIGINT)) AS a,
        sum(CAST('0x' || substr(h, 13, 12) AS BIGINT)) AS b
    FROM (SELECT md5(concat_ws(chr(31), CAST(doc_id AS VARCHAR), coalesce(lang, chr(30)), text)) AS h FROM documents))""",
)
def fingerprint_of_new_batches(spark: SparkSession, d: str) -> DataFrame:
    """Parts of some batches are kept; only the others are read for the whole."""
    documents, columns = table(spark, d, "documents"), ["doc_id", "lang", "text"]
    early = documents.where(F.col("source") < "src2")
    known = durable(L.fingerprint_by_batch(early, columns, "source"), "batch-parts")
    return L.combined_fingerprint(L.add_new_batches(known, documents, columns, "source"))


_CELLS = (
    with_sql("pseudo_scores")
    + """
, cells AS (SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM pseudo_scores)"""
)


@query(
    "classification_metrics",
    _CELLS
    + """
SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, 2 * tp / (2 * tp + fp + fn) AS f1, tp / (tp + fp) AS precision,
    tp / (tp + fn) AS recall, tn / (tn + fn) AS precision_unsatisfied, tn / (tn + fp) AS recall_unsatisfied,
    2 * tn / (2 * tn + fp + fn) AS f1_unsatisfied,
    (2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2 AS f1_macro
FROM cells""",
)
def classification_metrics(spark: SparkSession, d: str) -> DataFrame:
    return M.classification_metrics(entity(spark, d, "pseudo_scores"))


@query(
    "classification_report",
    _CELLS
    + """
, per AS (SELECT '0' AS name, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fp + fn) AS f, tn + fp AS s FROM cells
    UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM cells)
SELECT name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', round((tp + tn) / (tp + tn + fp + fn), 6), round((tp + tn) / (tp + tn + fp + fn), 6),
    round((tp + tn) / (tp + tn + fp + fn), 6), CAST(tp + tn + fp + fn AS BIGINT) FROM cells
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6),
    round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM per""",
)
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    lines = M.classification_report(entity(spark, d, "pseudo_scores"))
    return lines.withColumns({c: round_half_away(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "confusion_matrix",
    with_sql("pseudo_scores")
    + """ SELECT CAST(a AS BIGINT) AS label, CAST(b AS BIGINT) AS prediction, count(s.label) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS v(a, b) LEFT JOIN pseudo_scores AS s ON s.label = a AND s.prediction = b
GROUP BY a, b""",
)
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return plain(M.confusion(entity(spark, d, "pseudo_scores")))


@query(
    "roc_auc",
    with_sql("pseudo_scores")
    + """
, per AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM pseudo_scores GROUP BY score)
, cum AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS before FROM per)
SELECT round(CAST(sum(pos * (before + neg / 2)) AS DOUBLE) / CAST(sum(pos) * sum(neg) AS DOUBLE), 9) AS roc_auc FROM cum""",
)
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    found = M.roc_auc(entity(spark, d, "pseudo_scores"), key="id")
    return found.select(round_half_away("roc_auc", 9).alias("roc_auc"))


@query(
    "promotion_gate",
    with_sql("candidate_scores", "champion_scores")
    + """
SELECT n.model, accuracy, n.f1, n.recall_unsatisfied, f1_unsatisfied,
    accuracy >= 0.85 AND n.recall_unsatisfied >= 0.5 AND f1_unsatisfied >= 0.63 AND (o.model IS NULL OR
        (n.f1 >= o.f1 - 0.002::DOUBLE AND n.recall_unsatisfied >= o.recall_unsatisfied - 0.01::DOUBLE)) AS promote,
    CASE WHEN accuracy < 0.85 THEN 'accuracy too low' WHEN n.recall_unsatisfied < 0.5 THEN 'recall of class 0 too low'
        WHEN f1_unsatisfied < 0.63 THEN 'f1 of class 0 too low' WHEN o.model IS NULL THEN 'no champion yet'
        WHEN n.f1 >= o.f1 - 0.002::DOUBLE AND n.recall_unsatisfied >= o.recall_unsatisfied - 0.01::DOUBLE
            THEN 'as good as the champion or better' ELSE 'worse than the champion' END AS reason
FROM candidate_scores AS n LEFT JOIN champion_scores AS o USING (model)""",
)
def promotion_gate(spark: SparkSession, d: str) -> DataFrame:
    return learning.promotion_gate(
        entity(spark, d, "candidate_scores"), entity(spark, d, "champion_scores")
    )


_EVENTS = """
SELECT 'model' || CAST(user_id % 40 AS STRING) AS model, CAST(event_id % 9 AS INT) AS version,
    CASE event_type WHEN 'purchase' THEN 'alias' WHEN 'signup' THEN 'registered' ELSE 'stage' END AS kind,
    CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'champion' ELSE 'other' END
        WHEN 'view' THEN 'Production' WHEN 'click' THEN 'Archived' ELSE 'Staging' END AS value,
    CAST(ts AS STRING) || lpad(CAST(event_id AS STRING), 12, '0') AS at, CAST(user_id AS STRING) AS run_id,
    md5(CAST(event_id AS STRING)) AS fingerprint
FROM events WHERE user_id % 40 <> 7 OR event_type NOT IN ('purchase', 'view')"""


@query(
    "registry_champion",
    f"""
WITH e AS ({_EVENTS.replace("AS STRING", "AS VARCHAR")})
, s AS (SELECT model, version, max(run_id) AS run_id, max(fingerprint) AS fingerprint,
    arg_max(value, "at") FILTER (WHERE kind = 'stage') AS stage FROM e GROUP BY model, version)
, named AS (SELECT model, arg_max(version, "at") AS version FROM e WHERE kind = 'alias' AND value = 'champion' GROUP BY model)
, staged AS (SELECT model, max(version) AS version FROM s WHERE stage = 'Production' GROUP BY model)
, picked AS (SELECT model, coalesce(named.version, staged.version) AS version FROM named FULL JOIN staged USING (model))
SELECT model, CAST(version AS BIGINT) AS version, run_id, fingerprint, stage FROM s JOIN picked USING (model, version)""",
)
def registry_champion(spark: SparkSession, d: str) -> DataFrame:
    """The champion of every model in a long registry."""
    events = spark.sql(_EVENTS.replace("FROM events", "FROM {events}"), events=table(spark, d, "events"))
    return plain(learning.champions(events))


@query(
    "score_validation",
    with_sql("scoring_requests")
    + """
SELECT id, concat_ws('; ', CASE WHEN delivery_delay_days IS NULL THEN 'delivery_delay_days missing or not a number' END,
    CASE WHEN review_comment_length < 0 THEN 'review_comment_length below 0' END,
    CASE WHEN has_comment IS NULL THEN 'has_comment missing or not a flag' END,
    CASE WHEN payment_type_encoded NOT BETWEEN 0 AND 4 THEN 'payment_type_encoded outside 0..4' END) AS reason
FROM scoring_requests""",
)
def score_validation(spark: SparkSession, d: str) -> DataFrame:
    valid, rejected = scoring.validate_requests(entity(spark, d, "scoring_requests"))
    return valid.select("id", F.lit("").alias("reason")).unionByName(rejected.select("id", "reason"))


_VALID = with_sql("scoring_requests") + r"""
, valid AS (SELECT *, regexp_replace(review_comment_message, '^[\s\pZ\x0b\x1c-\x1f\x85]+|[\s\pZ\x0b\x1c-\x1f\x85]+$', '', 'g') AS t
    FROM scoring_requests WHERE delivery_delay_days IS NOT NULL AND review_comment_length >= 0
    AND has_comment IS NOT NULL AND payment_type_encoded BETWEEN 0 AND 4)"""


@query(
    "score_features",
    _VALID
    + """
SELECT id, t AS review_comment_message, delivery_delay_days, length(t) AS review_comment_length,
    CAST(length(t) > 0 AS BIGINT) AS has_comment, CAST(payment_type_encoded AS BIGINT) AS payment_type_encoded,
    CAST(review_comment_length AS BIGINT) AS received_length, has_comment AS received_has_comment
FROM valid""",
)
def score_features(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = scoring.validate_requests(entity(spark, d, "scoring_requests"))
    return plain(scoring.derive_features(valid))


_RULE_STATEMENT = (
    "SELECT *, CASE WHEN delivery_delay_days + review_comment_length < 0 THEN 1.0D ELSE 0.0D END AS prediction "
    "FROM __THIS__"
)


@query(
    "score_with_rule",
    _VALID
    + """
SELECT '2024-03-01' AS at, delivery_delay_days, CAST(review_comment_length AS BIGINT) AS review_comment_length, has_comment,
    CAST(payment_type_encoded AS BIGINT) AS payment_type_encoded, delivery_delay_days + length(t) < 0 AS satisfied,
    CASE WHEN delivery_delay_days + length(t) < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS probability
FROM valid""",
)
def score_with_rule(spark: SparkSession, d: str) -> DataFrame:
    """Score with a model that has no probabilities; the audit rows."""
    rule = SQLTransformer(statement=_RULE_STATEMENT)
    cfg = learning.TrainConfig(use_text=False)
    scored, _ = scoring.score_requests(rule, entity(spark, d, "scoring_requests"), cfg)
    return plain(scoring.audit(scored, "2024-03-01"))


@query(
    "prediction_summary",
    with_sql("pseudo_scores")
    + """
, clamped AS (SELECT id, label, score * 1.2 - 0.1 AS probability, score * 1.2 - 0.1 >= 0.5 AS satisfied,
    least(greatest(score * 1.2 - 0.1, 0), 1) AS c, CASE WHEN label = 1 THEN 'order ' || id ELSE '' END AS t FROM pseudo_scores)
SELECT id, satisfied, round(probability, 6) AS probability, CASE WHEN satisfied THEN 'satisfied' ELSE 'unsatisfied' END AS label,
    round(c, 6) AS satisfied_share, round(1 - c, 6) AS unsatisfied_share,
    round(CASE WHEN satisfied THEN c ELSE 1 - c END, 6) AS confidence,
    CASE WHEN t <> '' THEN left(t, 50) ELSE 'no comment' END AS comment_preview
FROM clamped""",
)
def prediction_summary(spark: SparkSession, d: str) -> DataFrame:
    chance = F.col("score") * F.lit(1.2) - F.lit(0.1)
    scored = entity(spark, d, "pseudo_scores").select(
        "id",
        (chance >= 0.5).alias("satisfied"),
        chance.alias("probability"),
        F.when(F.col("label") == 1, F.concat(F.lit("order "), F.col("id").cast("string")))
        .otherwise("")
        .alias("review_comment_message"),
    )
    shown = scoring.summarise(scored).drop("review_comment_message")
    digits = ("probability", "satisfied_share", "unsatisfied_share", "confidence")
    return shown.withColumns({c: round_half_away(c, 6) for c in digits})


def _small(use_text: bool) -> learning.TrainConfig:
    """The test tables hold few labelled texts of no meaning, so the row
    minimum and the gate are lowered."""
    open_gate = learning.GateConfig(0.0, 0.0, 0.0)
    return learning.TrainConfig(use_text=use_text, min_rows=20, gate=open_gate)


_SCALED = ", ".join(
    f"(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM raw)) - avg(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM raw))) OVER ())"
    f" / coalesce(nullif(stddev_pop(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM raw))) OVER (), 0), 1) AS {c}"
    for c in learning.NUMERIC_FEATURES
)


@query(
    "logistic_optimum",
    with_sql("labelled_reviews")
    + f"""
, raw AS (SELECT CAST(delivery_delay_days AS DOUBLE) AS delivery_delay_days, CAST(review_comment_length AS DOUBLE) AS review_comment_length,
    CAST(coalesce(CAST(has_comment AS INTEGER), 0) AS DOUBLE) AS has_comment, CAST(payment_type_encoded AS DOUBLE) AS payment_type_encoded,
    CAST(satisfied AS DOUBLE) AS y FROM labelled_reviews)
, scaled AS (SELECT {_SCALED}, y, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY y)) AS w FROM raw)
, sides AS (SELECT 'intercept' AS feature, sum(w * y) / sum(w) AS v FROM scaled
    {" ".join(f"UNION ALL SELECT '{c}', sum(w * {c} * y) / sum(w) FROM scaled" for c in learning.NUMERIC_FEATURES)})
SELECT feature, round(v, 4) AS observed, round(v, 4) AS fitted FROM sides""",
)
def logistic_optimum(spark: SparkSession, d: str) -> DataFrame:
    """Fit the numeric model and see that it is the optimum: SQL knows both sides of the condition from the labels."""
    data = durable(learning.training_frame(entity(spark, d, "labelled_reviews")), "labelled")
    names = list(learning.NUMERIC_FEATURES)
    scaled = durable(VectorAssembler(inputCols=names, outputCol="features").transform(L.scale(data, names, True)), "scaled")
    model = learning.fit_logistic(scaled, balanced=True, tol=1e-12)
    sizes = {r.satisfied: r["n"] for r in scaled.groupBy("satisfied").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.when(F.col("satisfied") == 1, sum(sizes.values()) / (2 * sizes[1])).otherwise(sum(sizes.values()) / (2 * sizes[0]))
    pred = model.transform(scaled).withColumn("p", vector_to_array("probability")[1])
    sides = learning.optimality(pred, dict(zip(names, map(float, model.coefficients))), weight=weight)
    return sides.withColumns({c: round_half_away(c, 4) for c in ("observed", "fitted")})


@query("train_logistic")
def train_logistic(spark: SparkSession, d: str) -> DataFrame:
    """Train, register and promote both model kinds, then see them skipped."""
    features = durable(entity(spark, d, "labelled_reviews"), "labelled")
    rows = []
    for use_text in (True, False):
        store = learning.ModelStore(f"{shared_root(spark)}/models-{new_batch_id()}")
        result = learning.train_and_register(spark, features, store, _small(use_text))
        again = learning.train_and_register(spark, features, store, _small(use_text))
        rows += [
            (
                "text" if use_text else "numeric", r["status"], int(r["version"]), r["rows"], r["promoted"],
                r.get("promotion_reason", ""), r["metrics"].get("accuracy"), r["metrics"].get("f1"),
                r["metrics"].get("recall_unsatisfied"), r["metrics"].get("roc_auc"),
            )
            for r in (result, again)
        ]
    return spark.createDataFrame(
        rows,
        "kind string, status string, version int, n_rows bigint, promoted boolean, reason string, "
        "accuracy double, f1 double, recall_unsatisfied double, roc_auc double",
    )


@query("batch_score")
def batch_score(spark: SparkSession, d: str) -> DataFrame:
    """Fit on the labelled texts, then score every request."""
    cfg = _small(True)
    data = learning.training_frame(entity(spark, d, "labelled_reviews"))
    train = durable(learning.prepare(data, cfg), "train-terms")
    model = learning.fit_model(train, cfg)
    scored, _ = scoring.score_requests(model, entity(spark, d, "scoring_requests"), cfg)
    return scored.select("id", "satisfied", "probability")
