"""Every registered query runs, and equals its SQL where it has one."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 199


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    assert rows
    if name in SQL:
        result = duck.execute(SQL[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert _table(df.columns, rows) == _table(columns, result.fetchall())


def test_the_rest_imports_without_the_optional_folders(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for kept in ("pipeline", "nothing"):
        copy = tmp_path / kept
        ignore = shutil.ignore_patterns(".git", "__pycache__", "llm", *([] if kept == "pipeline" else ["corpus_pipeline.py"]))
        shutil.copytree(root, copy, ignore=ignore)
        code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=False)
        assert done.returncode == 0, done.stderr
        assert done.stdout.strip().endswith("[]")
