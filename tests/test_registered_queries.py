"""Every registered query against its DuckDB oracle on the smallest tables."""

import importlib.util
import os

import pytest

from conftest import SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


entry_mod = _load("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
compare_mod = _load("tm_compare", os.path.join(ROOT, "tools", "compare.py"))
from tidemark.plans.catalog import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return compare_mod.duck(SMALL)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "sum_close" in df.columns


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems, *_ = compare_mod.compare(spark, con, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name],
                                       SMALL)
    assert not problems, problems
