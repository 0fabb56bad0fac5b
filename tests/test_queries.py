"""Every registered query against its SQL on the smallest tables, and on tables with hot keys."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.skewed import skewed_tables

FOLDER = "/root/testdata/sf0.001"
# The training-data queries have tests of their own beside their package.
QUERIES = {k: v for k, v in entry.queries().items() if not re.match(r"op[0-9]+_|pipeline$", k)}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = differences(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert found is None or (found == "no rows" and name in EMPTY)


# Queries that rightly find nothing in the smallest tables.
EMPTY: set[str] = set()
HOT = [
    "segment_events", "segment_documents", "delta_stands", "collapse_windows", "small_steps", "gap_series_orders",
    "series_state", "running_average", "factor_running", "share_of_total", "opposition_residual_join",
    "resolve_suffix_suppliers", "incumbent", "last_five_form",
]


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    return skewed_tables(FOLDER, str(tmp_path_factory.mktemp("hot")))


@pytest.mark.parametrize("name", HOT)
def test_query_with_hot_keys_in_small_chunks(spark, hot, name, monkeypatch):
    monkeypatch.setattr("matchbook.operators.chunks.PIECES", 7)
    for module in ("chunks", "scan", "series", "stands"):
        target = __import__(f"matchbook.operators.{module}", fromlist=["x"])
        for function in vars(target).values():
            if callable(function) and getattr(function, "__module__", "") == target.__name__:
                limits = tuple(50 if d == 1_000_000 else d for d in function.__defaults__ or ())
                if function.__defaults__:
                    monkeypatch.setattr(function, "__defaults__", limits)
                keywords = {k: 50 if v == 1_000_000 else v for k, v in (function.__kwdefaults__ or {}).items()}
                if keywords:
                    monkeypatch.setattr(function, "__kwdefaults__", keywords)
    assert differences(QUERIES[name](spark, hot), connect(hot), ORACLES[name]) is None
