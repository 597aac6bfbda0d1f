"""Every registered query vs its DuckDB oracle on the smallest fixture."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quizmill.plans.oracle import ORACLE
from quizmill.plans.registry import QUERIES
from quizmill.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "overall_pass" in df.columns


def test_structural_rules_all_have_rows_on_both_sides(spark, con):
    """Each named rule counts something, and the same, so that no rule can stand in for another."""
    found = {(r.qtype, r.rule): r.n_violations for r in QUERIES["structural_violations"](spark, SF).collect()}
    wanted = {(q, r): n for q, r, n in con.execute(ORACLE["structural_violations"]).fetchall()}
    assert found == wanted
    assert {r for _, r in found} >= {"required_field_blank", "mcq_not_four_options"}
