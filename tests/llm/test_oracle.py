"""The text queries against their SQL on DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallybrook.llm.oracle import ORACLE
from tallybrook.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.cases import awkward
from tests.llm.test_quoting import SCHEMA
from tools.check import compare, connect, rows_of


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert compare(spark, connect(DATA), name, DATA) == ""


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


def on_rows(spark, tmp_path, name, table, df):
    df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    cur = con.execute(ORACLE[name])
    got = QUERIES[name](spark, str(tmp_path))
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert rows_of(got.columns, got.collect()) == want


@pytest.mark.parametrize("name", ["op8_curriculum", "op10_quality"])
def test_awkward_rows_equal_sql(spark, tmp_path, name):
    on_rows(spark, tmp_path, name, "documents", awkward(spark))


def test_quotes_equal_sql(spark, tmp_path):
    first = "The first message says a lot.\r\nIt has two lines."
    rows = [
        (1, 0, first),
        (1, 1, "Another opinion that stands by itself."),
        (1, 2, "> The first message says a lot.\n> It has two lines.\nI agree with all of it."),
        (1, 3, "On Monday he wrote:\n> > the FIRST message, says a lot. It has\n>> two lines\n> I agree with all of it.\n\nSo do I."),
        (1, 4, "> It has two lines.\nOnly the second one, I think."),
        (1, 5, "Well:\n> Only the second one, I think.\n\n> Another opinion that\n> stands by itself.\nHm."),
        (2, 9, "> It has two lines.\nElsewhere."),
        (None, 1, "> It has two lines."),
        (1, None, None),
    ]
    table = spark.createDataFrame([(c, t, "user", x, "", "", "") for c, t, x in rows], SCHEMA)
    on_rows(spark, tmp_path, "op3_quotes", "conversations", table.select("conv_id", "turn", "role", "text"))
