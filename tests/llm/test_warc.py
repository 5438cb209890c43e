import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundlake.llm import warc


def sha(b):
    return hashlib.sha256(b).hexdigest()


def pages(spark, rows, ddl="page_id long, url string, html string"):
    clash = ("id", "payload", "digest", "first_id", "n", "path", "refers_to")
    return spark.createDataFrame(rows, ddl).select("*", *[F.lit(1).alias(c) for c in clash])


LONG = "é" * 60 + "<html>"


def test_round_trip_revisits_and_odd_rows(spark):
    rows = [(5, "http://a/", LONG), (3, "http://b/ü?x=1%20", LONG), (9, None, LONG), (None, "u", LONG), (1, "u", "short"),
            (2, "u", "short"), (4, "u", None), (6, "u", ""), (3, "again", LONG), (7, "u", "x" * 300_000), (8, "u", "x" * 300_000),
            (None, "u", "y" * 200), (None, "u", "y" * 200), (10, "u", "z" * 99), (11, "u", "z" * 99), (12, "u", "z" * 100), (13, "u", "z" * 100)]
    manifest = warc.write_archives(pages(spark, rows))
    got = warc.read_archives(manifest, payload=True)
    assert sorted(got.columns) == sorted("path offset type id url refers_to payload_bytes payload_digest problem payload".split())
    kind = "long"
    found = got.select(warc.page_id(F.col("id"), kind).alias("pid"), "type", warc.page_id(F.col("refers_to"), kind).alias("ref"),
                       "payload_bytes", "payload_digest", "payload", "problem").collect()
    want = []
    for pid, _, html in rows:
        data = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        ref = min(ids) if len(data) >= 100 and ids and pid != min(ids) else None
        want.append((pid, "response" if ref is None else "revisit", ref, len(data), sha(data), data if ref is None else b"", None))
    have = [(r.pid, r.type, r.ref, r.payload_bytes, r.payload_digest, bytes(r.payload), r.problem) for r in found]
    assert sorted(map(str, have)) == sorted(map(str, want))
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)


def test_text_ids_and_empty_table(spark):
    df = pages(spark, [("a:b/é 1", "u", LONG), ("b", "u", LONG)], "page_id string, url string, html string")
    got = warc.read_archives(warc.write_archives(df)).select(
        warc.page_id(F.col("id"), "string"), "type", warc.page_id(F.col("refers_to"), "string")).collect()
    assert sorted(map(tuple, got), key=str) == [("a:b/é 1", "response", None), ("b", "revisit", "a:b/é 1")]
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_one_member_per_record_and_rolled_files(spark):
    df = pages(spark, [(i, "u", f"{i} " * 200) for i in range(40)]).coalesce(1)
    manifest = warc.write_archives(df, roll_bytes=2_000).collect()
    assert len(manifest) > 3
    for m in manifest:
        data = warc.open_file(m.path).read()
        assert data.count(warc.MAGIC) >= m.records
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == m.records and len(data) == m.bytes


def archive(n=3):
    parts = [warc.member(warc.record_bytes(str(i), "u", b"payload %d " % i * 50, sha(b"payload %d " % i * 50))) for i in range(n)]
    return parts


def test_damage_is_told_and_reading_goes_on():
    good = archive()
    bad = bytearray(good[1])
    bad[len(bad) // 2] ^= 0xFF
    got = list(warc.records(io.BytesIO(good[0] + bytes(bad) + good[2])))
    assert [r["problem"] is None for r in got][:1] == [True] and got[-1]["problem"] is None
    assert any(r["problem"] for r in got) and [warc.id_of(r.get("id")) for r in got if not r["problem"]] == ["0", "2"]
    cut = list(warc.records(io.BytesIO(good[0] + good[1][:-30])))
    assert cut[0]["problem"] is None and "truncated" in cut[-1]["problem"]
    forged = warc.member(warc.record_bytes("7", "u", b"other" * 30, sha(b"payload")))
    assert [r["problem"] for r in warc.records(io.BytesIO(forged + good[0]))] == ["payload digest differs", None]
    short = warc.member(gzip.decompress(good[0])[:-4])
    assert [r["problem"] for r in warc.records(io.BytesIO(short + good[2]))] == ["record not ended by two line breaks", None]
    block = gzip.decompress(good[0]).replace(b"payload 0 payload", b"payload 9 payload")
    assert [r["problem"] for r in warc.records(io.BytesIO(warc.member(block)))] == ["block digest differs"]
    assert list(warc.records(io.BytesIO(b""))) == []
    assert all(r["problem"] for r in warc.records(io.BytesIO(b"no archive at all" * 20)))


class Dribble(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(n, 7) if n > 0 else n)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=400), max_size=6))
def test_records_survive_any_stream(payloads):
    data = b"".join(warc.member(warc.record_bytes(str(i), None, p, sha(p))) for i, p in enumerate(payloads))
    for stream in (io.BytesIO(data), Dribble(data)):
        got = list(warc.records(stream, keep=True))
        assert [(warc.id_of(r["id"]), r["payload"], r["payload_digest"], r["payload_bytes"], r["problem"]) for r in got] == [
            (str(i), p, sha(p), len(p), None) for i, p in enumerate(payloads)]


def test_query_fails_on_a_damaged_archive(spark, monkeypatch):
    monkeypatch.setattr(warc, "record_bytes", lambda *a: b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")
    with pytest.raises(Exception, match="block shorter|two line breaks"):
        warc.op12_warc(spark, "/root/testdata/sf0.001").collect()
