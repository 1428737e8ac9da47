"""Checks: what fails, what passes, what a report says."""

from __future__ import annotations

import threading

import pytest

from tallyroom.operators import quality as Q
from tallyroom.plans import contract


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", 5.0, 1), (1, "b", 0.0, 2), (2, None, -1.0, 9), (None, "zz", None, None), (1, "a", 7.0, 9)],
        "id int, kind string, amount double, parent_id int",
    )
    return {"child": child, "parent": spark.createDataFrame([(1,), (2,), (None,)], "pid int")}


@pytest.mark.parametrize(
    ("check", "failing"),
    [
        (Q.not_null("child", "id"), 1),
        (Q.unique("child", "id"), 1),
        (Q.accepted_values("child", "kind", ["a", "b"]), 1),
        (Q.relationships("child", "parent_id", "parent", "pid"), 2),
        (Q.between("child", "amount", 0, 5), 2),
        (Q.between("child", "amount", 0, strict=True), 2),
        (Q.between("child", "amount", high=7, strict=True), 1),
        (Q.unique("parent", "pid"), 0),
        (Q.relationships("child", "id", "child", "id"), 0),
    ],
)
def test_each_kind(tables, check, failing):
    row = Q.run_checks(tables, [check]).first()
    assert (row.failing_rows, row.passed) == (failing, failing == 0)


def test_all_in_one_report(tables):
    checks = [Q.not_null("child", "id"), Q.unique("child", "id"), Q.not_null("parent", "pid"), Q.between("child", "amount", 0)]
    report = Q.run_checks(tables, checks)
    assert report.count() == 4
    with pytest.raises(Q.QualityError, match="unique"):
        Q.enforce(report)
    Q.enforce(report.where("passed"))


def test_empty_tables_pass(spark, tables):
    empty = {n: df.limit(0) for n, df in tables.items()}
    checks = [Q.not_null("child", "id"), Q.unique("child", "id"), Q.relationships("child", "parent_id", "parent", "pid")]
    assert all(r.passed for r in Q.run_checks(empty, checks).collect())


def test_orphans_count_null_keys(spark):
    items = spark.createDataFrame([("o1", "p", 1.0), ("gone", "p", 1.0), ("gone", "p", 0.0), (None, "p", 1.0)], "order_id string, product_id string, price double")
    orders = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    reviews = spark.createDataFrame([("r", 6), ("s", 1), ("t", None)], "review_id string, review_score int")
    tables = {"order_items": items, "orders": orders, "reviews": reviews}
    checks = [c for c in contract.SILVER_CHECKS if c.failing is not None]
    got = {r.check_name: r.failing_rows for r in Q.run_checks(tables, checks).collect()}
    assert got == {"items_without_order": 3, "items_without_price": 1, "scores_out_of_range": 1}


def test_checks_on_one_key_share_an_aggregation(spark):
    """Repeated and NULL keys on both sides; the counts of :func:`failing_rows`, one read per table."""
    items = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), ("y",), (None,), (None,)], "order_id string")
    pays = spark.createDataFrame([("b",), (None,), ("y",)], "order_id string")
    orders = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "order_id string")
    tables = {"order_items": items, "payments": pays, "orders": orders}
    checks = [
        Q.unique("orders", "order_id"),
        Q.relationships("order_items", "order_id", "orders", "order_id"),
        Q.relationships("payments", "order_id", "orders", "order_id"),
        *[c for c in contract.SILVER_CHECKS if c.kind == "items_without_order"],
        Q.relationships("orders", "order_id", "orders", "order_id"),
    ]
    report = Q.run_checks(tables, checks)
    assert [r.failing_rows for r in report.collect()] == [1, 3, 1, 5, 0]
    for check, found in zip(checks, [1, 3, 1, 5, 0]):
        rows = Q.failing_rows(check, tables).collect()
        assert (len(rows) if check.kind == "unique" else sum(r.n_rows for r in rows)) == found
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [value") == 1 and "Join" not in plan


def test_key_of_another_type(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([("1",), ("3",), (None,)], "k string")
    report = Q.run_checks({"c": child, "p": parent}, [Q.relationships("c", "k", "p", "k"), Q.unique("p", "k")])
    assert {r.check_name: r.failing_rows for r in report.collect()} == {"relationships": 2, "unique": 0}


def test_tables_are_written_side_by_side(spark):
    both = threading.Barrier(2, timeout=20)

    def write(name, df):
        both.wait()  # breaks when one write waits for the end of the other
        df.collect()
        return df

    tables = {n: spark.createDataFrame([(1,), (None,)], "k int") for n in ("s", "t")}
    written, report = Q.checked_writes(tables, [Q.not_null("s", "k"), Q.not_null("t", "k")], write)
    assert list(written) == ["s", "t"]
    assert [(r.table_name, r.failing_rows) for r in report.collect()] == [("s", 1), ("t", 1)]


def test_contract_size():
    generic = [c for c in (*contract.BRONZE_CHECKS, *contract.SILVER_CHECKS, *contract.GOLD_CHECKS) if c.failing is None]
    assert len(generic) == 59
