"""Every registered query against its SQL counterpart on the smallest tables."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

FOLDER = Path("/root/testdata/sf0.001")
ENTRY = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, str(FOLDER))
    rows = result.collect()
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert _rows(result.columns, rows) == _rows(columns, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_measured_recall(spark):
    rows = QUERIES["approximate_recall"](spark, str(FOLDER)).groupBy("method").avg("recall").collect()
    assert len(rows) == 3 and all(r["avg(recall)"] >= 0.9 for r in rows)
    assert all(r.recall >= 0.9 for r in QUERIES["similarity_recall"](spark, str(FOLDER)).collect())
