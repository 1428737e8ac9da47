"""Sources without words, very long tokens, clashing names and ids that repeat."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from conftest import SMALL
from tallyroom.llm import mixing, near_duplicates, toxicity

NAMES = "_id _size _times _copy id size times row _left _key _text_key key h digest _rated component first cycle _at run node a b".split()
PROSE = "the quick brown fox jumps over the lazy dog and then it sleeps all day in the warm sun"


def test_source_without_words(spark):
    rows = [(1, PROSE, "a"), (2, PROSE + " x", "a"), (3, None, "empty"), (4, "", "empty"), (5, " \n", None)]
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    assert [got[i].taken for i in (3, 4, 5)] == [0, 0, 0] and {got[i].target for i in (3, 4, 5)} == {0.0}
    assert got[1].target == 1.5 * got[1].source_size  # all of the budget: what the others leave is shared out
    assert mixing.mix(spark.createDataFrame([r for r in rows if r[0] > 2], "doc_id int, text string, source string")).agg(F.sum("taken")).first()[0] == 0


@pytest.mark.parametrize("token", ["a" + "-" * 1_000_000 + "a", "-" * 1_000_000, "a-" * 500_000, "-" * 1_000_000 + "idiot"])
def test_long_tokens_are_read_once(token):
    model = toxicity.Model(toxicity.Lexicon(["idiot"], []), toxicity.np.array([7.0]), toxicity.np.array([3.0]), toxicity.Model.PRIOR)
    start = time.perf_counter()
    hits = model.hits(token)
    assert time.perf_counter() - start < 2
    assert len(hits) == token.endswith("idiot")


def test_edges_are_stripped():
    assert [toxicity.unmasked(t) for t in ("id*ot", "--i.d.i.o.t!!", "_x_id-iot_", "idiot", "***", "", "a" + "-" * 70 + "a")] == ["idot", "idiot", "xidiot", None, None, None, None]


def test_texts_labelled_both_ways_are_no_evidence(spark):
    docs = spark.createDataFrame([(i, f"{PROSE} {i % 10} {'idiot' if i % 2 else 'friend'}") for i in range(80)], "doc_id int, text string")
    labels = spark.createDataFrame([(i, 1 if i < 40 else i % 2) for i in range(80)], "doc_id int, toxic int")
    fits = [toxicity.fit(docs.repartition(n), labels, F.lit(True)) for n in (1, 5)]
    assert fits[0].lexicon.terms == fits[1].lexicon.terms


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_with_clashing_names(spark, name):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in NAMES})
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, SMALL)
    assert out.columns == odd.columns
    rows = out.collect()
    assert len(rows) > 20 and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in NAMES)
    plain = stage(spark, docs, SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in plain)


def test_rows_that_share_an_id(spark):
    other = " ".join(PROSE.split()[::-1])
    df = spark.createDataFrame([(1, PROSE), (1, other), (1, PROSE), (2, PROSE + " today"), (3, None), (3, None), (None, PROSE)], "doc_id int, text string")
    kept = sorted(map(tuple, near_duplicates.keep_one(df).collect()), key=repr)
    assert kept == sorted([(1, PROSE), (1, other), (3, None), (None, PROSE)], key=repr)


def test_mixing_still_matches_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert oracle.difference(mixing.mix(spark.read.parquet(f"{SMALL}/documents.parquet")), con, mixing.MIX_SQL) is None


def test_neighbours_over_many_shards_and_blocks(spark):
    """Results of seven graphs, asked in several blocks, merge to the nearest of all."""
    import numpy as np

    from tallyroom.llm import neighbours

    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.collect()
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    ids = np.array([r.vec_id for r in rows])
    got = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 5 == 0, 10, shard_rows=80, query_rows=30).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == set(ids[ids % 5 == 0].tolist())
    found = 0
    for q, answers in got.items():
        answers.sort()
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        assert [a[0] for a in answers] == list(range(1, 11))
        assert [(-a[2], a[1]) for a in answers] == sorted((-a[2], a[1]) for a in answers)
        assert np.allclose([score[ids == a[1]][0] for a in answers], [a[2] for a in answers])
        found += sum(a[2] >= np.sort(score)[-10] - 1e-9 for a in answers)
    assert found >= 0.9 * 10 * len(got)
