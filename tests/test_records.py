"""Quoted line breaks read by many tasks."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.sources import landing
from fundlake.sources.records import BLOCK, physical_lines, read_records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("k", "a", "b")])


def text_of(rows, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerows([("k", "a", "b"), *rows])
    return out.getvalue()


def write(tmp_path, text, name="x.csv"):
    p = tmp_path / name
    p.write_bytes(text.encode())
    return str(p)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def some_rows(n, seed=1):
    rnd = random.Random(seed)
    for i in range(n):
        yield str(i), rnd.choice(["plain", "two\nlines", 'say "hi"', "a,b", "\n", "x\n\n\ny", '"', 'tail"\n']) + "!", \
            rnd.choice(["", "z" * rnd.randrange(50), "m\n" * rnd.randrange(4) + "."])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_read_in_many_splits(spark, tmp_path, small_splits, end):
    rows = list(some_rows(1500))
    path = write(tmp_path, text_of(rows, end))
    lines = physical_lines(spark.read, path)
    assert lines.rdd.getNumPartitions() > 10 and lines.select(BLOCK).distinct().count() > 10
    got = read_records(spark, path, SCHEMA).collect()
    assert sorted((r.k, r.a, r.b or "") for r in got) == sorted((k, a.strip(" "), b) for k, a, b in rows)


def test_several_files_each_with_a_header(spark, tmp_path, small_splits):
    rows = list(some_rows(600))
    for i in range(3):
        write(tmp_path, text_of(rows[i::3]), f"part{i}.csv")
    write(tmp_path, text_of([]), "empty.csv")
    got = landing.read_landing(spark, str(tmp_path), SCHEMA, multi_line=True).collect()
    assert sorted(r.k for r in got) == sorted(r[0] for r in rows)


def test_ragged_records_keep_their_text(spark, tmp_path):
    path = write(tmp_path, 'k,a,b\n1,"x\ny"\n2,"p\nq",r,extra\n\n3,"u",v\n')
    got = {r.k: r for r in landing.read_landing(spark, path, SCHEMA, keep_raw_line=True, multi_line=True).collect()}
    assert (got["1"].a, got["1"].b, got["1"]._raw_line) == ("x\ny", None, '1,"x\ny"')
    assert got["2"]._raw_line == '2,"p\nq",r,extra' and got["3"]._raw_line is None and len(got) == 3


def test_unbalanced_quotes_are_refused(spark, tmp_path):
    path = write(tmp_path, 'k,a,b\n1,"open,x\n2,y,z\n')
    with pytest.raises(Exception, match="unbalanced quotes"):
        read_records(spark, path, SCHEMA).collect()


def test_plan_shuffles_by_split_and_record_only(spark, tmp_path):
    path = write(tmp_path, text_of(some_rows(10)))
    plan = read_records(spark, path, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Python" not in plan


field = st.text(alphabet='ab",\n ', max_size=8).filter(lambda t: t == t.strip())


@settings(max_examples=15, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from("pqr"), field, field), max_size=30))
def test_any_fields_come_back(spark, tmp_path_factory, rows):
    d = tmp_path_factory.mktemp("csv")
    with open(d / "x.csv", "w", newline="") as f:
        csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows([("k", "a", "b"), *rows])
    got = read_records(spark, str(d / "x.csv"), SCHEMA).collect()
    assert sorted((r.k, r.a or "", r.b or "") for r in got) == sorted(rows)
