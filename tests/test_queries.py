"""Every registered query against its SQL twin."""

from __future__ import annotations

import re

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_names_agree():
    assert set(ORACLE) <= set(QUERIES)
    library = {name for name in QUERIES if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert library - set(ORACLE) == {"frontend_json"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, sf_dir, con, name):
    problems = differences(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert [p for p in problems if p != "no rows"] == []


def test_frontend_documents(spark, sf_dir):
    kinds = {(r.event_type, r.type_of_plot) for r in QUERIES["frontend_json"](spark, sf_dir).collect()}
    assert {("latest", "heatmap"), ("latest", "graph"), ("hourly_overview", "heatmap"), ("hour", "graph"), ("month", "graph")} <= kinds


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["mean", "sd", "total", "time", "day", "round_id", "observable_name", "obs_type"]
