"""The driver's entry points, with and without the corpus operators."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"


def test_names_and_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_core_imports_alone(tmp_path):
    """A copy without the corpus operators and their pipeline still has its own queries."""
    import shutil

    shutil.copytree(ROOT / "fathomseq", tmp_path / "fathomseq", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    a, b = map(int, said.stdout.split()[-2:])
    assert a == b > 60


def core_names():
    from fathomseq.queries import QUERIES

    return sorted(QUERIES)


def plain(v):
    return round(float(v), 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", core_names())
def test_query_against_sql(spark, name):
    from fathomseq.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("lineitem", "documents", "labels", "events", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    want = sorted(map(repr, (tuple(map(plain, r)) for r in found.fetchall())))
    assert sorted(map(repr, (tuple(plain(r[c]) for c in names) for r in df.collect()))) == want
