"""Queries that have SQL, against DuckDB on a small table with what the driver's tables lack."""

import pytest

from tidemark.llm.queries import ORACLE_SQL, QUERIES

duckdb = pytest.importorskip("duckdb")


def texts():
    words = [f"w{i % 7}x{i}" for i in range(400)]
    passage, other = " ".join(words[:120]), " ".join(words[200:330])
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "few words"), (5, passage), (6, passage), (7, "before " + passage + " after"), (None, passage)]
    rows += [(8, other + " é\x00 " + passage), (9, other[10:]), (10, "same " * 90), (11, "a" * 450), (12, "a" * 199), (13, "ü" * 150), (14, " ".join(words * 40))]
    return rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("rows", [texts(), []], ids=["texts", "empty"])
def test_same_rows(spark, tmp_path, name, rows):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    got = QUERIES[name](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, found.fetchall()))
