"""State that only grows: layers, baselines, champions, keyed tables; streams that go on past bad files."""

from __future__ import annotations

import json

import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallyroom.operators import drift as D
from tallyroom.operators import learning as L
from tallyroom.operators import quality as Q
from tallyroom.plans import layers
from tallyroom.plans import learning as P
from tallyroom.sources import events as E
from tallyroom.sources import sinks
from tallyroom.sources import upsert as U
from tallyroom.sources.durable import durable, owned
from tallyroom.streaming.ingest import ingest_stream, quarantine
from tallyroom.streaming.score import score_stream

CHECKS = (Q.not_null("t", "k"), Q.between("t", "v", 0, 10), Q.unique("t", "k"), Q.relationships("t", "k", "parents", "k"))


def rows(spark, values):
    return spark.createDataFrame(values, "k string, v int")


def test_checks_are_counted_while_writing(spark, tmp_path):
    tables = {"t": rows(spark, [("a", 1), ("a", 11), (None, -1), ("c", None)]), "parents": rows(spark, [("a", 0)])}
    written, report = Q.checked_writes(tables, CHECKS, lambda n, df: (df.write.parquet(f"{tmp_path}/{n}"), spark.read.parquet(f"{tmp_path}/{n}"))[1])
    mine = {tuple(r) for r in report.collect()}
    assert mine == {tuple(r) for r in Q.run_checks(tables, CHECKS).select(*report.columns).collect()}
    assert written["t"].count() == 4
    empty = {"t": rows(spark, []), "parents": rows(spark, [])}
    assert all(r.passed for r in Q.checked_writes(empty, CHECKS, lambda n, df: (df.write.parquet(f"{tmp_path}/e{n}"), df)[1])[1].collect())


def test_single_row_checks_need_no_second_scan(spark, tmp_path):
    """The write is the only job that reads the input."""
    passes = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            passes.add(len(pdf))
            yield pdf

    df = rows(spark, [("a", 1), ("b", 20)]).mapInPandas(counted, "k string, v int")
    _, report = Q.checked_writes({"t": df}, CHECKS[:2], lambda n, x: (x.write.parquet(f"{tmp_path}/{n}"), spark.read.parquet(f"{tmp_path}/{n}"))[1])
    assert [r.failing_rows for r in report.orderBy("check_name").collect()] == [1, 0]
    assert passes.value == 2


def test_a_refused_layer_stays_unseen(spark, tmp_path):
    root, parents = f"{tmp_path}/layer", {"parents": rows(spark, [("a", 0), ("b", 0)])}
    assert layers.current_layer(spark, root) == {}
    layers.build_layer(spark, {"t": rows(spark, [("a", 1)])}, CHECKS, root, parents)
    for bad in ([("a", 99)], [("a", 1), ("a", 2)], [("z", 1)]):
        with pytest.raises(Q.QualityError):
            layers.build_layer(spark, {"t": rows(spark, bad)}, CHECKS, root, parents)
        assert [tuple(r) for r in layers.current_layer(spark, root)["t"].collect()] == [("a", 1)]
    layers.build_layer(spark, {"t": rows(spark, [("b", 2)])}, CHECKS, root, parents)
    assert [tuple(r) for r in layers.current_layer(spark, root)["t"].collect()] == [("b", 2)]


def test_newest_event_counts(spark, tmp_path):
    log = f"{tmp_path}/log"
    assert E.newest(E.read_events(spark, log), "x").collect() == []
    for at, value in (("2024-02", "b"), ("2024-03", "c"), ("2024-01", "a"), ("2024-03", "d")):
        E.append_events(spark, log, [("m", None, "x", value, at, None, None), ("n", None, "y", value, at, None, None)])
    assert [tuple(r) for r in E.newest(E.read_events(spark, log), "x").collect()] == [("m", "d")]


FEATURES = "review_id string, review_comment_message string, delivery_delay_days double, review_comment_length int, has_comment boolean, payment_type_encoded int, satisfied int"


def test_a_promotion_moves_the_baseline_in_the_same_change(spark, tmp_path, monkeypatch):
    data = [(str(i), "", float(i % 40 - 20), i % 7, bool(i % 2), i % 4, int(i % 40 < 20)) for i in range(400)]
    features = spark.createDataFrame(data, FEATURES)
    store = P.ModelStore(f"{tmp_path}/models")
    cfg = P.TrainConfig(use_text=False, min_rows=10, max_iter=20, gate=P.GateConfig(0, 0, 0))
    drift = P.drift_store(store, cfg, f"{tmp_path}/drift")
    assert D.current_baseline(spark, drift) is None

    with monkeypatch.context() as broken:  # the profile is written, the promotion is not
        def stop(*_):
            raise RuntimeError("lost")

        broken.setattr(P, "promote", stop)
        with pytest.raises(RuntimeError, match="lost"):
            P.train_and_register(spark, features, store, cfg, drift_root=drift.root)
    assert D.current_baseline(spark, drift) is None and P.champion(P.registry_events(spark, store), cfg.model_name).first() is None

    result = P.train_and_register(spark, features, store, cfg, drift_root=drift.root)
    assert result["promoted"] and D.load_baseline(spark, drift).agg(F.max("row_count")).first()[0] == 400
    changes = P.registry_events(spark, store).where("kind IN ('alias', 'baseline')").select("at").distinct().count()
    assert changes == 1
    assert D.run_drift(spark, features, drift).first().severity == "stable"


def test_keyed_table_takes_deliveries_again(spark, tmp_path):
    schema = "k string, n int, _loaded_at string, _batch_id string"
    table = U.KeyedTable(f"{tmp_path}/keyed", ("k",), buckets=4)
    with pytest.raises(LookupError):
        U.read_keyed(spark, table)
    first = spark.createDataFrame([(f"k{i}", i, "2024-01", "1") for i in range(40)] + [("k1", -1, "2023-01", "0"), (None, 7, "2024-01", "1")], schema)
    assert U.upsert(table, first) == [0, 1, 2, 3]
    before = U.generations(spark, table)
    assert U.upsert(table, first.limit(0)) == []
    one = spark.createDataFrame([("k3", 300, "2024-02", "2", "new")], schema + ", note string")
    (touched,) = U.upsert(table, one)
    after = U.generations(spark, table)
    assert {b for b in after if after[b] != before[b]} == {touched}
    U.upsert(table, first)  # older than k3's row
    got = {r.k: (r.n, r.note) for r in U.read_keyed(spark, table).collect()}
    assert len(got) == 41 and got["k3"] == (300, "new") and got["k1"] == (1, None) and got[None] == (7, None)


def test_a_merge_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    schema = "k string, n int, _loaded_at string, _batch_id string"
    table = U.KeyedTable(f"{tmp_path}/keyed", ("k",), buckets=2)
    U.upsert(table, spark.createDataFrame([("a", 1, "2024-01", "1")], schema))
    with monkeypatch.context() as broken:
        def stop(*_):
            raise RuntimeError("lost")

        broken.setattr(U, "append_events", stop)
        with pytest.raises(RuntimeError):
            U.upsert(table, spark.createDataFrame([("a", 2, "2024-02", "2")], schema))
    assert [r.n for r in U.read_keyed(spark, table).collect()] == [1]


def test_owned_tables_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyroom.sources.durable._configured", lambda _: f"{tmp_path}/shared")
    with owned(spark):
        assert durable(spark.range(3), "inner").count() == 3
        with pytest.raises(RuntimeError), owned(spark):
            durable(spark.range(3), "deeper")
            raise RuntimeError
        assert [p.name[:5] for p in (tmp_path / "shared").iterdir()] == ["inner"]
    assert list((tmp_path / "shared").iterdir()) == []
    data = [(str(i), "", float(i % 40 - 20), i % 7, bool(i % 2), i % 4, int(i % 40 < 20)) for i in range(200)]
    cfg = P.TrainConfig(use_text=False, min_rows=10, max_iter=5, gate=P.GateConfig(0, 0, 0))
    P.train_and_register(spark, spark.createDataFrame(data, FEATURES), P.ModelStore(f"{tmp_path}/models"), cfg)
    assert list((tmp_path / "shared").iterdir()) == []


def test_fingerprint_of_batches(spark):
    df = spark.createDataFrame([(i, str(i % 5), "abc"[i % 3]) for i in range(60)], "k int, _batch_id string, v string")
    columns = ["k", "v"]
    whole = L.fingerprint(df, columns).first()
    known = L.fingerprint_by_batch(df.where("_batch_id < '3'"), columns)
    parts = L.add_new_batches(known, df, columns)
    assert parts.count() == 5 and L.combined_fingerprint(parts).first() == whole
    assert L.combined_fingerprint(L.add_new_batches(known.limit(0), df, columns)).first() == whole
    assert L.combined_fingerprint(known.limit(0)).first().n_rows == 0


HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_a_stream_goes_on_past_bad_files(spark, tmp_path):
    src, dst, state = (tmp_path / n for n in ("src", "dst", "state"))
    src.mkdir()

    def run():
        ingest_stream(spark, "sellers", str(src), str(dst), str(state)).awaitTermination()

    (src / "a.csv").write_text(HEADER + 's1,01,"two\nlines",SP\ns2,02,x\ns3,03,y,RJ,more\ns4,04,z,SP\n')
    (src / "b.csv").write_text("seller_state,extra,seller_city,seller_zip_code_prefix,seller_id\nSP,e,,05,s5\n")
    (src / "c.csv").write_text("seller_id,seller_city\ns6,x\n")
    (src / "d.csv").write_text("")
    run()
    (src / "e.csv").write_text(HEADER + "s7,07,w,SP\n")
    run()
    good = {r.seller_id: (r.seller_zip_code_prefix, r.seller_city, r.seller_state, r.extra, r._source_file) for r in sinks.read_bronze(spark, str(dst)).collect()}
    assert good == {
        "s1": ("01", "two\nlines", "SP", None, "a.csv"), "s4": ("04", "z", "SP", None, "a.csv"),
        "s5": ("05", "", "SP", "e", "b.csv"), "s7": ("07", "w", "SP", None, "e.csv"),
    }
    bad = {(r._source_file, r.text): r.reason for r in sinks.read_bronze(spark, quarantine(str(dst))).collect()}
    assert set(bad) == {("a.csv", "s2,02,x"), ("a.csv", "s3,03,y,RJ,more"), ("c.csv", "seller_id,seller_city")}
    assert bad["c.csv", "seller_id,seller_city"].startswith("file lacks ['seller_state'")


def test_unreadable_requests_keep_their_text(spark, tmp_path):
    good = {"review_comment_message": "x", "delivery_delay_days": -1.0, "review_comment_length": 1, "has_comment": True, "payment_type_encoded": 1}
    lines = [json.dumps(good), json.dumps(good)[:40], json.dumps({**good, "payment_type_encoded": 9}), json.dumps({**good, "delivery_delay_days": "soon"})]
    (tmp_path / "src").mkdir()
    (tmp_path / "src/r.json").write_text("\n".join(lines) + "\n")
    rule = SQLTransformer(statement="SELECT *, CASE WHEN delivery_delay_days < 0 THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__")
    score_stream(spark, rule, str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "state"), cfg=P.TrainConfig(use_text=False)).awaitTermination()
    assert sinks.read_bronze(spark, str(tmp_path / "out/audit")).count() == 1
    refused = {(r.text, r.reason, r._source_file) for r in sinks.read_bronze(spark, str(tmp_path / "out/rejected")).collect()}
    assert refused == {
        (lines[1], "line is no readable request", "r.json"), (lines[3], "line is no readable request", "r.json"),
        (None, "payment_type_encoded outside 0..4", "r.json"),
    }


def test_a_large_bucket_is_merged_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(U, "PART_ROWS", 100)
    kept = U.KeyedTable(str(tmp_path / "keyed"), ("id",), buckets=2)
    first = spark.range(2000).select("id", F.lit("a").alias("v"), F.lit("1").alias("_loaded_at"))
    again = spark.range(1000, 2500).select("id", F.lit("b").alias("v"), F.lit("2").alias("_loaded_at"))
    for delivery in (first.unionByName(first), again, again):
        U.upsert(kept, delivery)
    of = U.generations(spark, kept)
    for bucket, generation in of.items():
        assert len(list((tmp_path / "keyed/data" / f"generation={generation}" / f"_bucket={bucket}").glob("*.parquet"))) > 3
    got = U.read_keyed(spark, kept)
    assert got.columns == ["id", "v", "_loaded_at"]
    assert sorted((r.id, r.v) for r in got.collect()) == [(i, "a" if i < 1000 else "b") for i in range(2500)]
