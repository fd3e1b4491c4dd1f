"""Registered queries run on the smallest tables, and agree with their SQL."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

CORE = sorted(n for n, f in entry.queries().items() if ".llm." not in f.__module__)
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return c


def plain(x):
    if x is None or x != x:
        return None
    return round(float(x), 5) if isinstance(x, (int, float)) and not isinstance(x, bool) or type(x).__name__ == "Decimal" else str(x)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in ORACLES:
        rel = con.execute(ORACLES[name])
        names = [d[0] for d in rel.description]
        want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)
        assert sorted(names) == cols and rows == want


def test_rest_stands_without_the_text_operators(tmp_path):
    import shutil

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/lodegraph", f"{tmp_path}/lodegraph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p7_ids' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
