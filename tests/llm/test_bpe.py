import hashlib
import random

import pyarrow as pa

from pyspark.sql import functions as F

from fundlake.llm import bpe, common
from tests.llm.helpers import SF, documents, sf


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def reference(text):
    t = bpe._tokenizer(bpe.default_path())
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_whole_table_equals_library(spark):
    got = {r.doc_id: r for r in bpe.op8_bpe(spark, SF).collect()}
    docs = sf(spark, "documents").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids, text = reference(r.text)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(text))


def test_odd_rows_round_trip(spark):
    df = documents(spark)
    coded = bpe.encode(df, block_rows=2)
    want = sorted(((r.doc_id, reference(r.text)[0]) for r in df.collect()), key=str)
    assert sorted(((r.id, r.ids) for r in coded.collect()), key=str) == want
    texts = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=str)
    assert sorted(((r.id, r.text) for r in bpe.decode(coded).collect()), key=str) == texts
    assert bpe.encode(df.limit(0)).count() == 0


def test_split_equals_library_on_random_text():
    parts = ["'", "'s", "'ll", "'re", "'d", " ", "  ", "\n", "\t", "a", "Zé", "9", "²", "#", "!!", " ", "　",
             "\x85", "​", "\x1c", "\U0001f600", "漢", "́", "<|endoftext|>", "<|endof", "text|>", "_", "ve",
             "\r\n", "\xa0", "᠎", "ǅ", "Ⅷ", "\x00"]
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(4000)]
    words, first = bpe.split_words(pa.array(texts))
    words = words.to_pylist()
    for i, t in enumerate(texts):
        own = words[first[i]:first[i + 1]]
        assert "".join(own) == t
        assert [k for w in own for k in reference(w)[0]] == reference(t)[0]


def test_sliced_arrays_and_nulls():
    arr = pa.array(["skip me", None, "it's  two", "", "x"])[1:4]
    words, first = bpe.split_words(bpe._plain(arr))
    assert [words.to_pylist()[a:z] for a, z in zip(first, first[1:])] == [[], ["it", "'s", " ", " two"], []]


def test_invalid_bytes_decode_to_replacement(spark):
    t = bpe._tokenizer(bpe.default_path())
    half = t.encode("é", add_special_tokens=False).ids + [t.encode("漢", add_special_tokens=False).ids[0]]
    df = spark.createDataFrame([(1, half), (2, None)], "id long, ids array<int>")
    got = {r.id: r.text for r in bpe.decode(df).collect()}
    assert got[2] == "" and got[1].startswith("é") and "�" in got[1]


def test_chunks_grow_with_the_blocks_and_repeats_are_spread(spark):
    plain = "the quick brown fox and its 12 friends, all of them"
    df = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit(plain).alias("text")).union(
        spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), F.col("id")).alias("text")))
    df = common.written(df, "bpe-test")
    got = bpe.encode(df, block_rows=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    n = {}
    for rows in (100, 200):
        blocks = -(-6000 // rows)
        dealt = df.select("text", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block"),
                          F.col("doc_id").alias("id")).repartition(blocks, "block")
        n[rows] = bpe.block_words(dealt, 8).count()
        sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
        assert max(sizes) < 2 * rows                            # one row for two thirds of the table makes no large block
    assert n[100] <= 2 * n[200] and "Python" not in plan.split("FlatMapCoGroupsInArrow")[0]
    ids = reference(plain)[0]
    rows = got.collect()
    assert len(rows) == 6000 and sum(r.ids == ids for r in rows) == 4000
    assert all(r.ids == ids or r.ids == reference(f"word{r.id}")[0] for r in rows)


def test_several_word_tables(spark, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_BLOCKS", 3)
    df = sf(spark, "documents")
    got = {r.id: r.ids for r in bpe.encode(df, block_rows=20).collect()}
    assert got == {r.doc_id: reference(r.text)[0] for r in df.collect()}
