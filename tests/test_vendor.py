"""Vendor pulls against scripted vendors."""

import datetime as dt
import sys

import pytest
from pyspark.sql.types import DateType, DoubleType, StringType, StructType

from tidemark.sources import Lake
from tidemark.sources import vendor as V

SCHEMA = StructType().add("code", StringType()).add("d", DateType()).add("x", DoubleType())


def test_retry_pauses_longer_each_time():
    pauses, calls = [], []

    def call(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("down")
        return x * 2

    assert V.Retry(sleep=pauses.append)(call, 4) == 8 and pauses == [1.5, 3.0]
    with pytest.raises(OSError):
        V.Retry(tries=2, sleep=pauses.append)(lambda: (_ for _ in ()).throw(OSError("down")))


class Answer:
    fields = ["a", "b"]

    def __init__(self, rows, codes):
        self.rows, self.codes, self.error_msg, self.at = rows, codes, "limit", -1

    @property
    def error_code(self):
        return self.codes.pop(0) if len(self.codes) > 1 else self.codes[0]

    def next(self):
        self.at += 1
        return self.at < len(self.rows)

    def get_row_data(self):
        return self.rows[self.at]


def test_cursor():
    assert list(V.cursor_rows(Answer([[1, 2], [3, 4]], ["0"]))) == [{"a": 1, "b": 2}, {"a": 3, "b": 4}]
    with pytest.raises(V.VendorError, match="7: limit"):
        list(V.cursor_rows(Answer([[1, 2]], ["0", "7"])))


def test_pages_end():
    asked = []

    def endless(page):
        asked.append(page)
        return [{"p": page}], 3

    assert [r["p"] for r in V.paged(endless)] == asked == [1, 2, 3]
    assert list(V.paged(lambda p: ([{"p": p}] if p < 2 else [], 9))) == [{"p": 1}]
    assert list(V.paged(lambda p: ([], 0))) == []


def test_pull(spark):
    codes = spark.createDataFrame([("a",), ("b",), ("bad",), ("none",), ("a",), (None,)], "code string")

    def fetch(code):
        if code == "bad":
            raise OSError("down")
        return [] if code == "none" else [{"d": dt.date(2020, 1, i), "x": float(i)} for i in (1, 2)]

    got = V.pull(codes, fetch, SCHEMA, shards=3, retry=V.Retry(tries=2, pause=0.0))
    rows = sorted(map(tuple, got.collect()), key=str)
    assert [r[0] for r in rows if r[3] is None] == ["a", "a", "b", "b"]
    assert [(r[0], r[3]) for r in rows if r[3]] == [("bad", "OSError: down")]
    assert V.pull(codes.limit(0), fetch, SCHEMA).count() == 0


def test_month_ends(spark):
    d = dt.date
    rows = spark.createDataFrame([(1, d(2020, 1, 30)), (2, d(2020, 1, 30)), (1, d(2020, 1, 3)), (1, d(2020, 2, 2)), (3, None)], "s int, t date")
    assert sorted(map(tuple, V.month_end_snapshots(rows, "t").select("s", "t").collect())) == [(1, d(2020, 1, 30)), (1, d(2020, 2, 2)), (2, d(2020, 1, 30))]


def test_shards(spark, tmp_path):
    rows = [(f"s{i % 5}", dt.date(2020, 1, 1 + i // 5), float(i)) for i in range(50)] + [("s1", dt.date(2020, 1, 1), 0.0)]
    audit, files = V.flush_shards(Lake(spark, str(tmp_path)), spark.createDataFrame(rows, SCHEMA), "bars", "code", "d", 3, 10)
    told = audit.collect()
    assert sum(r["rows"] for r in told) == 51 and sum(r["keys"] for r in told) == 5 and sum(r["duplicates"] for r in told) == 1
    assert files.count() >= 6 and files.where("length(sha256) = 64").count() == files.count()


def test_jobs():
    py = sys.executable
    jobs = [V.Job("ok", (py, "-c", "print(1)")), V.Job("spare", (py, "-c", "raise SystemExit(2)"), required=False), V.Job("slow", (py, "-c", "import time; time.sleep(9)"), timeout=0.2), V.Job("after", (py, "-c", ""))]
    done = V.run_jobs(jobs)
    assert [(d["name"], d["code"]) for d in done] == [("ok", 0), ("spare", 2), ("slow", None)]
    assert V.bootstrap_passed(done[:2], {"bars": 3}, ["bars"]) and not V.bootstrap_passed(done, {"bars": 3}, ["bars"])
    assert not V.bootstrap_passed(done[:1], {"bars": 0}, ["bars"])
