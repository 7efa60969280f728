"""The SQL of operators that SQL can express, on edge cases that the given tables do not hold."""

import random

import duckdb
import pytest

from check_oracle import rows_of
from recordloom.llm import queries

NAMES = ["op9_decontamination", "op10_substring_dedup", "op12_periodic_runs"]


def texts():
    rnd = random.Random(11)
    passage = " ".join(rnd.choices("abcdefghij", k=70))
    out = [None, "", " \n ", "a", "- !", "a " * 40, "a b " * 30, "x y z " * 50 + "x y", "Ünï b " * 9]
    out += [passage, passage, "q " + passage.replace(" ", "\t"), passage + " " + passage[20:], passage.upper()]
    for n in (5, 9, 30, 49, 50, 51, 120, 400):
        out += [" ".join(rnd.choices("ab", k=n)), " ".join(rnd.choices("abcdefgh", k=n)), passage[: n * 2] + " " + "c d e " * n]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("oracles"))
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    documents.coalesce(1).write.parquet(f"{path}/documents.parquet")
    body = [t for t in texts() if t and len(t) > 60]
    items = [(i, " ".join(t.split()[2:15])) for i, t in enumerate(body)] + [(90, None), (91, "a"), (92, "- ."), (None, "a")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name", NAMES)
def test_sql_agrees_on_edge_cases(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, folder)
    result = con.execute(queries.ORACLES[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert sorted(got.columns) == sorted(d[0] for d in result.description)
    assert rows_of(got.columns, got.collect()) == want


@pytest.mark.parametrize("name", NAMES)
def test_sql_of_empty_tables_has_no_rows(name):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark(item_id BIGINT, text VARCHAR)")
    assert con.execute(queries.ORACLES[name]).fetchall() == []
