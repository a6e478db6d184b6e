"""Every registered query against its SQL twin on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import suite
from tools.check_sql import TABLES, compare

SF = "/root/testdata/sf0.001"
suite.load_all()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", list(suite.QUERIES))
def test_query(spark, db, name):
    df = suite.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in suite.ORACLES:
        assert rows
        return
    cursor = db.execute(suite.ORACLES[name])
    assert compare(df.columns, rows, [d[0] for d in cursor.description], cursor.fetchall()) is None


@pytest.mark.parametrize("gone", [["pressroom/llm", "corpus_pipeline.py"], ["pressroom/llm"], ["corpus_pipeline.py"]])
def test_entry_without_the_optional_part(tmp_path, gone):
    root = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    ignored = shutil.ignore_patterns(".git", "__pycache__", "tests", *[Path(g).name for g in gone])
    shutil.copytree(root, copy, ignore=ignored)
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    count, pipeline, known = done.stdout.split()
    assert int(count) >= len(suite.QUERIES) and (pipeline, known) == ("False", "True")
