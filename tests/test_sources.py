"""Readers, sinks, loads and the incremental load."""

from __future__ import annotations

import json
import threading

import pytest

from tallyroom.entry import movement
from tallyroom.operators import quality as Q
from tallyroom.sources import loads, readers, sinks
from tallyroom.sources.durable import durable, shared_root
from tallyroom.sources.loads import LakePaths, load_all, load_products
from tallyroom.sources.registry import ENTITIES
from tallyroom.streaming.ingest import ingest_stream

REVIEWS = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,,"two\nlines, and ""quotes""",2018-01-01,\n'
    "r2,o2,1,  padded ,,2018-01-02,2018-01-03\n"
)


@pytest.fixture
def lake(tmp_path):
    for folder in ("csv", "json", "api"):
        (tmp_path / "data" / folder).mkdir(parents=True)
    (tmp_path / "data/csv/shop_order_reviews_dataset.csv").write_text(REVIEWS, encoding="utf-8")
    (tmp_path / "data/csv/shop_sellers_dataset.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01234,São Paulo,SP\n", encoding="utf-8"
    )
    products = ",".join(ENTITIES["products"].columns) + "\np1,toys,1,2,3,4,5,6,7\n"
    (tmp_path / "data/csv/shop_products_dataset.csv").write_text(products, encoding="utf-8")
    (tmp_path / "data/json/products_sample.json").write_text(
        json.dumps([{"product_id": "a", "brand": "x"}, {"product_id": "b", "unit_cost": "1"}])
    )
    rates = {"BRL": 4.97, "EUR": 0.92}
    (tmp_path / "data/api/exchange_rates_1.json").write_text(
        json.dumps({"base": "USD", "fetched_at": "2024-01-01T00:00:00Z", "rates": rates}, indent=2)
    )
    (tmp_path / "data/api/exchange_rates_2.json").write_text(
        json.dumps({"base_code": "BRL", "time_last_update_utc": "Mon", "rates": {"USD": 1}})
    )
    (tmp_path / "data/api/exchange_rates_3.json").write_text(json.dumps({"base": "EUR", "rates": {"USD": 2.5}}))
    (tmp_path / "data/api/exchange_rates_4.json").write_text(json.dumps({"rates": {"X": 1.5}}))
    (tmp_path / "data/api/exchange_rates_5.json").write_text(json.dumps({"base": "GBP"}))
    (tmp_path / "data/api/other.json").write_text("{}")
    return tmp_path


def test_csv_cells_stay_text_and_blank(spark, lake):
    rows = readers.read_entity(spark, "reviews", f"{lake}/data", batch_id="b1", loaded_at="now").collect()
    first, second = sorted(rows, key=lambda r: r.review_id)
    assert first.review_comment_message == 'two\nlines, and "quotes"'
    assert first.review_comment_title == "" and first.review_answer_timestamp == ""
    assert second.review_comment_title == "  padded "
    assert (first._loaded_at, first._source_file, first._batch_id) == ("now", "shop_order_reviews_dataset.csv", "b1")


def test_csv_without_a_declared_column_is_refused(spark, lake):
    path = lake / "data/csv/short_sellers_dataset.csv"
    path.write_text("seller_id\ns1\n")
    with pytest.raises(ValueError, match="seller_city"):
        readers.read_csv_entity(spark, "sellers", str(path))


def test_unknown_columns_flow_in_and_old_stamps_are_replaced(spark, tmp_path):
    path = tmp_path / "x_sellers_dataset.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state,extra,_batch_id\ns,0,c,s,e,old\n")
    row = readers.read_csv_entity(spark, "sellers", str(path), batch_id="new").first()
    assert (row.extra, row._batch_id) == ("e", "new")


def test_json_array_and_single_record(spark, lake, tmp_path):
    rows = readers.read_entity(spark, "products_json", f"{lake}/data", batch_id="b").collect()
    assert {r.product_id for r in rows} == {"a", "b"}
    (tmp_path / "one.json").write_text(json.dumps({"product_id": "z"}, indent=1))
    assert [r.product_id for r in readers.read_json_records(spark, str(tmp_path / "one.json")).collect()] == ["z"]


def test_rates_shapes(spark, lake):
    rows = readers.read_entity(spark, "exchange_rates", f"{lake}/data", batch_id="b").collect()
    got = {(r.currency_code, r.rate, r.base_currency, r.fetched_at, r._source_file[-6]) for r in rows}
    assert got == {
        ("BRL", 4.97, "USD", "2024-01-01T00:00:00Z", "1"),
        ("EUR", 0.92, "USD", "2024-01-01T00:00:00Z", "1"),
        ("USD", 1.0, "BRL", "Mon", "2"),
        ("USD", 2.5, "EUR", "", "3"),
        ("X", 1.5, "UNKNOWN", "", "4"),
    }


def test_rates_without_files(spark, tmp_path):
    assert readers.read_exchange_rates(spark, f"{tmp_path}/exchange_rates*.json").count() == 0


def test_tables_load_side_by_side(spark, lake, monkeypatch):
    both, order = threading.Barrier(2, timeout=20), []

    def load(spark, name, paths, batch_id):
        if order.count(name) == 0:
            both.wait()  # breaks when one table waits for the end of the other
        order.append(name)

    monkeypatch.setattr(loads, "load_entity", load)
    report = load_all(spark, LakePaths(f"{lake}/data", f"{lake}/bronze"), names=("reviews", "sellers", "reviews")).collect()
    assert [(r.name, r.success, r.n_rows, r.error) for r in report] == [(n, True, -1, "") for n in ("reviews", "sellers", "reviews")]


def test_load_all_isolates_failures_and_appends(spark, lake):
    paths = LakePaths(f"{lake}/data", f"{lake}/bronze")
    names = ("reviews", "orders", "sellers", "exchange_rates", "products_json")
    assert load_all(spark, paths, names=names, dry_run=True).count() == 0
    first = {r.name: r for r in load_all(spark, paths, names=names).collect()}
    assert not first["orders"].success and first["orders"].error
    assert {n: first[n].n_rows for n in names if n != "orders"} == {
        "reviews": 2, "sellers": 1, "exchange_rates": 5, "products_json": 2,
    }
    second = {r.name: r for r in load_all(spark, paths, names=names).collect()}
    assert second["reviews"].n_rows == 4
    bronze = sinks.bronze_views(spark, f"{lake}/bronze", ["reviews"])["reviews"]
    assert bronze.select("_batch_id").distinct().count() == 2
    assert spark.table("bronze_reviews").count() == 4


def test_products_share_a_batch(spark, lake):
    load_products(spark, LakePaths(f"{lake}/data", f"{lake}/bronze"), "b7")
    for name in ("products", "products_json"):
        ids = {r._batch_id for r in sinks.read_bronze(spark, f"{lake}/bronze/raw_{name}").collect()}
        assert ids == {"b7"}


def test_batch_ids_that_look_like_numbers(spark, tmp_path):
    df = spark.createDataFrame([("x", "007")], "v string, _batch_id string")
    sinks.append_bronze(df, f"{tmp_path}/t")
    assert sinks.read_bronze(spark, f"{tmp_path}/t").first()._batch_id == "007"


def test_verify_layer(spark):
    full = spark.createDataFrame([("a", "b", "c", "d")], "v string, _loaded_at string, _source_file string, _batch_id string")
    report = {r.table_name: r for r in Q.verify_layer({"full": full, "bare": full.select("v"), "empty": full.limit(0)}).collect()}
    assert report["full"].ok and not report["bare"].ok and not report["empty"].ok
    assert report["bare"].missing_columns == "_batch_id, _loaded_at, _source_file"
    assert (report["full"].n_columns, report["empty"].n_rows) == (4, 0)


def test_preview_shortens_and_skips_blank(spark):
    df = spark.createDataFrame([("a" * 100,), ("",), (None,)], "t string")
    assert [r.t for r in Q.preview(df, ["t"], text="t").collect()] == ["a" * 80]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "", 'q"\n')], "x string, y string, z string")
    sinks.write_csv(df, f"{tmp_path}/csv")
    back = spark.read.options(**readers.CSV_OPTIONS).csv(f"{tmp_path}/csv").first()
    assert (back.x, back.y or "", back.z) == (" a ", "", 'q"\n')
    sinks.write_json(df, f"{tmp_path}/json")
    sinks.append_json(df, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 2


def test_gzip_exports_read_back(spark, tmp_path):
    columns = ENTITIES["sellers"].columns
    rows = [("s1", " 01 ", 'two\nlines, and "quotes"', ""), ("s2", None, "São Paulo", "SP"), ("", "", "", "")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).repartition(3)
    sinks.write_csv(df, f"{tmp_path}/plain")
    sinks.write_csv(df, f"{tmp_path}/small", gzip=True)
    assert list(tmp_path.glob("plain/*.csv")) and not list(tmp_path.glob("plain/*.gz"))
    assert list(tmp_path.glob("small/*.csv.gz")) and not list(tmp_path.glob("small/*.csv"))
    back = {n: sorted(map(tuple, readers.read_csv_entity(spark, "sellers", f"{tmp_path}/{n}").select(*columns).collect())) for n in ("plain", "small")}
    assert back["small"] == back["plain"] == sorted(tuple(v or "" for v in r) for r in rows)


def _shop(spark, d):
    """Own rows for the tables under ``load_all_report``; texts with line ends, quotes and blanks."""
    keys = spark.range(0, 4000, 1, 2)
    day = "TIMESTAMP '2020-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 700 AS INT))"
    tables = {
        "nation": ("id AS n_nationkey", "concat('N', id) AS n_name"),
        "customer": ("id AS c_custkey", "concat('C#', id) AS c_name", "CAST(id % 5 AS INT) AS c_nationkey", "'HOME' AS c_mktsegment"),
        "supplier": ("id AS s_suppkey", "concat('S#', id) AS s_name", "CAST(id % 5 AS INT) AS s_nationkey"),
        "part": ("id AS p_partkey", "concat('part ', id) AS p_name", "concat('T', id % 9) AS p_type", "CAST(id % 50 AS INT) AS p_size",
                 "CAST(id AS DOUBLE) / 4 AS p_retailprice"),
        "orders": ("id AS o_orderkey", "id % 300 AS o_custkey", "substring('FOP', CAST(id % 3 AS INT) + 1, 1) AS o_orderstatus",
                   f"{day} AS o_orderdate", "concat(id % 5 + 1, '-HIGH') AS o_orderpriority"),
        "lineitem": ("id % 999 AS l_orderkey", "id % 70 AS l_partkey", "id % 40 AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber",
                     "CAST(id % 50 AS DOUBLE) AS l_quantity", "id * 1.25D AS l_extendedprice", "0.05D AS l_discount",
                     "substring('ANR', CAST(id % 3 AS INT) + 1, 1) AS l_returnflag", f"{day} AS l_shipdate"),
        "documents": ("id * 2 AS doc_id", "concat(' text ', id, ', \"quoted\"\\n', repeat('ação ', CAST(id % 40 AS INT))) AS text"),
    }
    for name, columns in tables.items():
        (keys.limit(25) if name == "nation" else keys).selectExpr(*columns).write.parquet(f"{d}/{name}.parquet")


def test_load_all_report_needs_a_fraction_of_the_plain_files(spark, tmp_path, monkeypatch):
    """Deliveries and raw tables hold every row, in less than half of the disk of plain CSV and snappy."""
    d, root = str(tmp_path / "tables"), tmp_path / "lake"
    _shop(spark, d)
    monkeypatch.setattr(movement, "_folder", lambda *_: str(root))
    report = {r.name: r for r in movement.load_all_report(spark, d).collect()}
    size = lambda at: sum(f.stat().st_size for f in at.rglob("part-*"))
    plain = loaded = 0
    for name, file in movement._FILE_NAMES.items():
        raw, columns = movement._files(spark, d, name), ENTITIES[name].columns
        sinks.write_csv(raw, str(tmp_path / "plain" / name))
        bronze = sinks.read_bronze(spark, f"{root}/bronze/raw_{name}")
        bronze.write.option("compression", "snappy").parquet(str(tmp_path / "snappy" / name))
        as_text = lambda df: sorted(tuple(v or "" for v in r) for r in df.select(*columns).collect())  # noqa: B023, E731
        assert as_text(bronze) == as_text(raw), name
        assert report[name].success and report[name].n_rows == raw.count() > 0
        plain += size(tmp_path / "plain" / name)
        loaded += size(root / "data/csv" / file)
    assert loaded < 0.5 * plain
    assert size(root / "bronze") < size(tmp_path / "snappy")
    assert not report["geolocation"].success and not report["products_json"].success


def test_write_tables_refreshes(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    sinks.write_tables({"t": df}, str(tmp_path))
    assert sinks.write_tables({"t": df}, str(tmp_path))["t"].collect() == df.collect()


def test_durable_uses_the_configured_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyroom.sources.durable._configured", lambda _: f"{tmp_path}/")
    assert shared_root(spark) == str(tmp_path)
    assert durable(spark.range(5), "x").count() == 5
    assert list(tmp_path.glob("x-*"))


def test_incremental_files_land_once(spark, tmp_path):
    src, dst, state = (f"{tmp_path}/{n}" for n in ("src", "dst", "state"))
    (tmp_path / "src").mkdir()
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"

    def run():
        ingest_stream(spark, "sellers", src, dst, state).awaitTermination()
        return sinks.read_bronze(spark, dst)

    (tmp_path / "src/a.csv").write_text(header + "s1,01,,SP\n")
    first = run()
    query = json.loads((tmp_path / "state/metadata").read_text())["id"]
    assert [(r.seller_id, r.seller_city, r._source_file, r._batch_id) for r in first.collect()] == [
        ("s1", "", "a.csv", f"stream-{query}-0")
    ]
    (tmp_path / "src/b.csv").write_text(header + 's2,02,"two\nlines",RJ\n')
    assert run().count() == 2
    again = run()
    assert again.count() == 2 and again.select("_batch_id").distinct().count() == 2


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


RATES = '{"base":"USD","fetched_at":"2024-01-01","rates":{"BRL":%s,"EUR":0.9}}'


@pytest.mark.parametrize(
    "rates, success", [(RATES % "4.9", True), (RATES % '"x"', False), (RATES[:40], False)], ids=["good", "unreadable", "cut off"]
)
def test_malformed_rates_fail_their_load(spark, tmp_path, rates, success):
    _write(tmp_path / "data" / ENTITIES["exchange_rates"].folder / "exchange_rates_1.json", rates)
    report = load_all(spark, LakePaths(str(tmp_path / "data"), str(tmp_path / "bronze")), names=("exchange_rates",)).first()
    assert (report.success, report.error == "") == (success, success)
    assert report.n_rows == (2 if success else 0)


@pytest.mark.parametrize("row, success", [("o1,1,boleto,1,9.5", True), ("o1,1,boleto,1,9.5,extra", False)])
def test_surplus_cells_fail_their_load(spark, tmp_path, row, success):
    entity = ENTITIES["payments"]
    _write(tmp_path / "data" / entity.folder / entity.files.replace("*", "x"), ",".join(entity.columns) + "\n" + row + "\n")
    report = load_all(spark, LakePaths(str(tmp_path / "data"), str(tmp_path / "bronze")), names=("payments",)).first()
    assert report.success == success


def test_two_streams_fill_one_target(spark, tmp_path):
    columns = ENTITIES["payments"].columns
    for name in ("a", "b"):
        _write(tmp_path / name / "part.csv", ",".join(columns) + f"\n{name},1,boleto,1,9.5\n")
        for _ in range(2):  # the second run finds nothing new
            ingest_stream(spark, "payments", str(tmp_path / name), str(tmp_path / "out"), str(tmp_path / f"state-{name}")).awaitTermination()
    assert sorted(r.order_id for r in sinks.read_bronze(spark, str(tmp_path / "out")).collect()) == ["a", "b"]


def test_first_lines_sort_no_file(spark, tmp_path):
    """The first lines of large and small files, without a sort of all their lines."""
    from tallyroom.streaming.ingest import _first_lines

    for i in range(5):
        (tmp_path / f"f{i}.csv").write_text("".join([f"h{i % 2}\n", *(f"{j}\n" for j in range(3000, 0, -1))]))
    (tmp_path / "empty.csv").write_text("")
    plans = []
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        paths = sorted(str(p) for p in tmp_path.glob("*.csv"))
        collect = type(spark.range(1)).collect
        type(spark.range(1)).collect = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df)
        try:
            found = _first_lines(spark, paths)
        finally:
            type(spark.range(1)).collect = collect
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {line: len(files) for line, files in found.items()} == {"h0": 3, "h1": 2}
    assert plans and not any("Sort" in plan for plan in plans)
