"""The word-pair model against its formula."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from tallyroom.llm.language_model import SHARE, _asked, _pair_counts, _shared_pairs, blocks, corpus, score


def formula(training, texts):
    """log10 probabilities by the formula, pairs met once left out."""
    rows = [[*t.lower().split(), None] for t in training]
    words, total = Counter(w for r in rows for w in r), sum(map(len, rows))
    pairs = Counter((v, w) for r in rows for v, w in zip(["<s>", *r], r))
    contexts = Counter(v for r in rows for v in ["<s>", *r[:-1]])
    p = lambda w: (words[w] + 0.5) / (total + 0.5 * (len(words) + 1))
    out = []
    for t in texts:
        r, at = [*t.lower().split(), None], 0.0
        for v, w in zip(["<s>", *r], r):
            if not contexts[v]:
                at += math.log10(p(w))
            else:
                n = pairs[v, w] if pairs[v, w] > 1 else 0
                at += math.log10((1 - SHARE) * p(w) + SHARE * n / contexts[v])
        out.append(at)
    return out


def test_scores_follow_the_formula(spark):
    training = ["the cat sat on the mat", "the cat ran", "a dog sat on the mat", "The dog ran", "", "the cat sat"] * 2
    texts = ["the cat sat on the mat", "zebra cat zebra zebra", "zebra", "", "the", "a zebra sat on the cat"]
    df = spark.createDataFrame([(i, t, i >= len(training)) for i, t in enumerate([*training, *texts])], "doc_id int, text string, held boolean")
    got = {r.doc_id: r.score for r in score(df, F.col("held")).collect()}
    for i, expected in enumerate(formula(training, texts)):
        # probabilities are stored in 256 levels
        assert math.isclose(got[len(training) + i], expected, abs_tol=0.05), texts[i]


def test_without_training_texts_all_is_base(spark):
    df = spark.createDataFrame([(0, "a b"), (1, ""), (2, None)], "doc_id int, text string")
    for r in score(df, F.lit(True)).collect():
        assert math.isclose(r.score, r.base_score) and r.train_tokens == 0 and r.n_known == 0


def test_pairs_met_once_count(spark):
    """After a known word the probabilities of all known words add up to what P(w) adds up to."""
    training = ["a b", "a c", "a b d", "d"]
    words = ["a", "b", "c", "d"]
    df = spark.createDataFrame(
        [(i, t, False) for i, t in enumerate(training)] + [(10 + i, f"a {w}", True) for i, w in enumerate(words)] + [(20, "a", True)],
        "doc_id int, text string, held boolean",
    )
    got = {r.doc_id: r for r in score(df, F.col("held")).collect()}
    tokens, distinct = 12, 5
    count = Counter(" ".join(training).split()) | Counter({None: len(training)})
    p = lambda w: (count[w] + 0.5) / (tokens + 0.5 * (distinct + 1))
    pair, after = Counter(), {"a": 3, "b": 2, "c": 1, "d": 2, "<s>": 4}
    for t in training:
        row = ["<s>", *t.split(), None]
        pair.update(zip(row, row[1:]))
    q = lambda v, w: (1 - SHARE) * p(w) + SHARE * pair[v, w] / after[v]
    for i, w in enumerate(words):
        expected = math.log10(q("<s>", "a")) + math.log10(q("a", w)) + math.log10(q(w, None))
        assert math.isclose(got[10 + i].score, expected, abs_tol=0.01), w


def test_pairs_keep_five_bytes_of_a_word(spark):
    """A pair takes 13 bytes: 40 bits of its word, 32 of its context and the share."""
    texts = spark.createDataFrame([(i, f"w{i % 7} x{i} w{i % 3}") for i in range(50)], "key bigint, text string")
    info, _ = corpus(texts)
    pairs = _shared_pairs(_pair_counts(texts, info), info)
    assert "w" not in pairs.columns
    distinct = {p for r in texts.collect() for p in zip(["<s>", *r.text.split()], [*r.text.split(), None])}
    sizes = {c: pairs.agg(F.sum(F.octet_length(c))).first()[0] for c in ("hi", "lo", "v", "share")}
    assert sizes == {"hi": 4 * len(distinct), "lo": len(distinct), "v": 4 * len(distinct), "share": 4 * len(distinct)}


def test_a_block_asks_for_a_pair_once(spark):
    """No row per text and shard; many small blocks give the same sums as one."""
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(1 + i % 40)) for i in range(300)] + ["x y " * 100, "x y " * 100, "", "unseen " * 3]
    one = spark.createDataFrame([(i, t, i == 303) for i, t in enumerate(texts)], "doc_id bigint, text string, held boolean").coalesce(1)
    many = one.repartition(20, "doc_id")
    listed = many.select(F.col("doc_id").alias("key"), "text")
    made = [b for part in listed.rdd.glom().collect() if part for b in blocks(iter([pd.DataFrame(part, columns=["key", "text"])]))]
    info, _ = corpus(listed)
    asked = _asked(listed, info, [1] * (1 << info.bits)).toPandas()
    assert len(made) > 10 and len(asked) <= len(made) << info.bits
    assert asked.v.map(len).sum() == 4 * sum(len(set(zip(b.before, b.words))) for b in made)
    whole, small = [{r.doc_id: r for r in score(df, F.col("held")).collect()} for df in (one, many)]
    for i, text in enumerate(texts):
        assert small[i].n_tokens == whole[i].n_tokens == len(text.split()) + 1 and small[i].n_known == whole[i].n_known
        assert math.isclose(small[i].score, whole[i].score) and math.isclose(small[i].base_score, whole[i].base_score)
