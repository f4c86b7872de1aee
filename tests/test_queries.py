"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from chartloom.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(SF):
        path = f"{SF}/{name}"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return c


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else f"{v:.12g}" if isinstance(v, float) else str(v)
    return [columns[i] for i in order], sorted([tuple(value(r[i]) for i in order) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rel = duck.sql(registry.oracle_sql()[name])
    assert plain(df.columns, [tuple(r) for r in df.collect()]) == plain(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_works_without_the_optional_parts(tmp_path):
    """In a copy without the llm folders, with and without the pipeline file."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    copy = tmp_path / "copy"
    shutil.copytree(Path(entry.__file__).parent, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "tests"))
    says = "import __spark_entry__ as e; q = e.queries(); assert 'manifest_summary' in q and set(e.oracle_sql()) <= set(q); assert not [k for k in q if k[:2] == 'op' and k[2:3].isdigit() or k == 'pipeline']"
    for gone in ((), ("corpus_pipeline.py",)):
        for name in gone:
            (copy / name).unlink(missing_ok=True)
        subprocess.run([sys.executable, "-c", says], cwd=copy, check=True, timeout=120)
