"""Every query beside its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexmill.sources.tables import TABLES, table
from verify import _cell

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
CORE = {name: query for registry in entry._all() if registry is not entry._llm for name, query in registry.queries.items()}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, base, name):
    df = CORE[name](spark, SMALL)
    mine = sorted(tuple(map(_cell, r)) for r in df.select(*sorted(df.columns)).collect())
    if name in SQL:
        found = base.execute(SQL[name])
        columns = [c[0] for c in found.description]
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        assert sorted(columns) == sorted(df.columns)
        assert mine == sorted(tuple(_cell(r[i]) for i in order) for r in found.fetchall())


@pytest.mark.parametrize(("name", "source", "key"), [("council_records", "documents", "doc_id"), ("nearest_column", "revue_index", "id")])
def test_ids_beyond_32_bits(spark, tmp_path, name, source, key):
    """Ids shifted beyond an INTEGER change nothing but the ids."""
    far = 5_000_000_000
    table(spark, SMALL, source).withColumn(key, F.col(key) + far).write.parquet(f"{tmp_path}/{source}.parquet")
    mine, shifted = ([r.asDict() for r in CORE[name](spark, d).collect()] for d in (SMALL, str(tmp_path)))
    ids = {"id", "source_page", "decision_number"}
    plain = lambda rows, by: sorted(str({k: int(v) + by if k in ids else v for k, v in r.items()}) for r in rows)
    assert len(mine) > 0 and plain(mine, far) == plain(shifted, 0)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_unknown_table(spark):
    with pytest.raises(ValueError):
        table(spark, SMALL, "x")
