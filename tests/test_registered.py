"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as contract
from conftest import SMALL

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SMALL), con, SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_training_promotes_and_then_skips(spark):
    rows = {(r.kind, r.status): r for r in QUERIES["train_logistic"](spark, SMALL).collect()}
    for kind in ("text", "numeric"):
        assert rows[kind, "trained"].promoted
        assert rows[kind, "trained"].version == rows[kind, "skipped"].version == 1


def test_batch_scores_are_probabilities(spark):
    rows = QUERIES["batch_score"](spark, SMALL).collect()
    assert rows and all(0 <= r.probability <= 1 for r in rows)
    assert all(r.satisfied == (r.probability >= 0.5) for r in rows if abs(r.probability - 0.5) > 1e-3)


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
