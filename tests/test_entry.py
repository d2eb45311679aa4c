"""Driver contract and the DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import os

import pytest

import __spark_entry__ as entry
from casetrail.plans import refresh, registry
from casetrail.operators.quality import QualityGateError
from casetrail.sources.fixtures import RawSources

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
registry.load_all()
KEYS = sorted(registry.QUERIES)          # the optional subpackage has its own tests


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "open_to_start_rate" in df.columns


def test_every_query_has_oracle_or_is_declared_rows_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(KEYS) <= set(entry.queries())
    assert len(KEYS) >= 63


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, sf_small, key):
    df = entry.queries()[key](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        pytest.skip("rows-only")
    rel = duck.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, srows) == _bag(rel.columns, rel.fetchall())


def test_gated_refresh_stops_on_parse_errors(spark, sf_small, scratch):
    raw = RawSources(spark, sf_small)
    with pytest.raises(QualityGateError, match="parse_error"):
        refresh.run_layers(spark, raw, f"{scratch}/gated", fail_on_error=True,
                           error_after_hours=None)
    import os
    assert os.path.isdir(f"{scratch}/gated/stg_events")            # staging was written
    assert not os.path.exists(f"{scratch}/gated/case_durations")     # the gate stopped the next layer
    results = refresh.run_layers(spark, raw, f"{scratch}/all", fail_on_error=False,
                                 store_failures=True, error_after_hours=None)
    assert set(results) == {"source", "staging", "intermediate", "mart"}
    assert spark.read.parquet(f"{scratch}/all/_failures").count() > 0


@pytest.mark.parametrize("missing", ["sentencepiece", "zstandard", "public_tokenizers",
                                     "corpus_pipeline", "casetrail.llm"])
def test_a_missing_optional_module_leaves_the_other_queries(missing):
    import subprocess
    import sys
    code = f"""
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing + "."!r}):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), sum(n.startswith("op") for n in entry.queries()))"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == ["72", "0"]
