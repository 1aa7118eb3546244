"""The driver contract: every query equals its SQL; the library stands without the training-data operators."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from keyloom.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def normal(rows):
    return sorted(tuple(None if v is None else round(float(v), 5) if isinstance(v, float) and math.isfinite(v) else str(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert normal(got.select(*columns).collect()) == normal(found)


def test_entry(spark):
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())
    flagship = __spark_entry__.entry(spark)
    assert flagship.columns[0] == "entity_id" and flagship.count() > 0


def test_without_training_operators(tmp_path):
    """Where the folders are deleted, the rest imports, and its queries and tests work."""
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "*.json", "*.md")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    env = os.environ | {"PYTHONPATH": str(tmp_path / "repo")}
    code = "import __spark_entry__ as e; n = set(e.queries()); assert 'pipeline' not in n and not [x for x in n if x.startswith('op')] and len(n) > 80 and set(e.oracle_sql()) <= n; import keyloom.streaming.job, bench"
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=tmp_path / "repo", env=env, check=True)
    picked = "test_velocity or auth_geo_drift_hot_key or test_layouts or test_reach"
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "-k", picked, "-p", "no:cacheprovider"], cwd=tmp_path / "repo", env=env, capture_output=True, text=True)
    assert done.returncode == 0 and "4 passed" in done.stdout, done.stdout + done.stderr
