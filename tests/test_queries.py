import duckdb
import pytest

import __spark_entry__ as entry_points

from pairloom.plans.oracles import ORACLES
from pairloom.plans.registry import QUERIES

TABLES = ["documents", "conversations", "pages", "benchmark", "labels"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert len(got) > 0
    rows = [sorted(df[columns].astype(object).where(df[columns].notna(), None).map(str).itertuples(index=False, name=None)) for df in (got, want)]
    assert rows[0] == rows[1]


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["doc_id", "ids"]


@pytest.mark.parametrize("name", ["encode_stream", "pretoken_counts_stream"])
def test_streams_read_a_table_that_is_a_folder(spark, tmp_path, name):
    docs = spark.createDataFrame([(i, f"the {i}th") for i in range(6)], "doc_id long, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/many/documents.parquet")
    docs.toPandas().to_parquet((tmp_path / "documents.parquet"), index=False)
    got, want = (sorted(map(tuple, QUERIES[name](spark, d).collect())) for d in (f"{tmp_path}/many", str(tmp_path)))
    assert got == want != []
