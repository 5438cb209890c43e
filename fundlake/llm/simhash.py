"""SimHash near-duplicates through pivot distance tables.

Fingerprints are 64-bit majorities over the XXH64 values of word shingles.
Two fingerprints link when at most ``max_bits`` bits differ.  The search uses
distances to reference fingerprints:

* *Axis references* resolve the five bit blocks.  For the origin and the axis
  reference of bit i, ``d(x, axis_i) - d(x, origin)`` is +1 or -1 by bit i, so
  the coordinates of a block's references, packed, are the block's bits.  At
  most three differing bits leave two of the five blocks untouched, so every
  linked pair has equal coordinates for all references of some pair of blocks:
  those coordinates are an equality key, ten keys for a fingerprint.
* *Scattered references* (``N_REFS`` fixed pseudo-random fingerprints) give
  every fingerprint a table of Hamming distances, computed before any pair is
  looked at.  By the triangle inequality a linked pair's tables differ by at
  most ``max_bits`` in every coordinate; pairs with a larger maximum
  difference are discarded, the survivors are verified on the bits.

Equal fingerprints are one node.  Inside a key's bucket each task walks the
links and returns a spanning forest (at most n - 1 links), never all pairs.  A
bucket over ``CHUNK`` fingerprints is dealt into chunks by hash and compared
chunk pair by chunk pair, so no task holds more than two chunks.

Defined cases: null text counts as empty; a text without words has fingerprint
zero; fewer words than the shingle length give one shingle of all words.  Null
ids are linked like others but never name a component; a component of null ids
only has a null id.  Repeated rows return one row each.  Very long texts are
fingerprinted whole; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import fresh, slices, small_batches, table, written
from fundlake.llm.graph import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
N_REFS = 32
CHUNK = 8192
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


def references(n: int = N_REFS) -> np.ndarray:
    """The scattered references, from a fixed seed."""
    return np.random.default_rng(20260101).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + \
        np.random.default_rng(20260102).integers(0, 2, n, dtype=np.uint64)


def shingle_hashes(text: str | None, n: int = SHINGLE_WORDS) -> list[int]:
    from xxhash import xxh64_intdigest
    # bytes.lower() changes A-Z only; bytes.split() splits at \x20, \x09-\x0D.
    words = (text or "").encode().lower().split()
    if not words:
        return []
    if len(words) < n:
        return [xxh64_intdigest(b" ".join(words), SEED)]
    return list(map(xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(n)))), repeat(SEED)))


def majority(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprint of each list: the bits set in over half of its hashes."""
    out = np.zeros(len(hashes), np.uint64)
    full = [i for i, h in enumerate(hashes) if h]
    if not full:
        return out
    flat = np.concatenate([np.array(hashes[i], np.uint64) for i in full])
    sizes = np.array([len(hashes[i]) for i in full])
    ends = np.cumsum(sizes)
    for i, end, size in zip(full, ends, sizes):
        n_set = np.zeros(64, np.int64)
        for a in range(end - size, end, 1 << 16):
            b = min(a + (1 << 16), end)
            n_set += np.unpackbits(flat[a:b].astype(">u8").view(np.uint8).reshape(-1, 64 // 8),
                                   axis=1).sum(axis=0, dtype=np.int32)
        out[i] = np.packbits(2 * n_set > size).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in slices(batches):
            fp = majority([shingle_hashes(t, shingle_words) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"id {kind}, fp long")


def block_keys(fp: Column) -> Column:
    """The ten keys: packed axis coordinates of every two blocks."""
    masks = [((1 << n) - 1) << s for s, n in BLOCKS]
    keys = []
    for i in range(len(masks)):
        for j in range(i + 1, len(masks)):
            m = masks[i] | masks[j]
            m -= (1 << 64) if m >= 1 << 63 else 0
            keys.append(F.struct(F.lit(len(keys)).alias("k"), fp.bitwiseAND(F.lit(m)).alias("key")))
    return F.array(*keys)


def spanning_links(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``fp``: two arrays of positions.

    Walks from node to node; each node meets only the nodes not reached yet,
    so a dense group costs little more than its size.
    """
    coords = np.bitwise_count(fp[:, None] ^ references()[None, :]).astype(np.int8)
    rest = np.arange(len(fp))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    while len(rest) > 1:
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            u = stack.pop()
            near = np.abs(coords[rest] - coords[u]).max(axis=1) <= max_bits
            near[near] = np.bitwise_count(fp[rest[near]] ^ fp[u]) <= max_bits
            if near.any():
                hit = rest[near]
                left.append(np.full(len(hit), u))
                right.append(hit)
                stack.extend(hit)
                rest = rest[~near]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def runs_of(batches, keys: list[str]):
    """Consecutive rows with equal ``keys`` from a sorted stream, as Arrow
    tables; runs of one row are left out."""
    import pyarrow as pa
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t]).combine_chunks()
        cols = [t.column(k).to_numpy() for k in keys]
        new = np.zeros(t.num_rows, bool)
        new[0:1] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        for a, z in zip(starts[:-1], starts[1:]):
            if z - a > 1:
                yield t.slice(a, z - a)
        held = t.slice(starts[-1]) if len(starts) else None
    if held is not None and held.num_rows > 1:
        yield held


def links(nodes: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """(u, v) links between distinct fingerprints, enough to span every
    component of the graph of pairs within ``max_bits`` bits."""
    if max_bits > 3:
        raise ValueError("five blocks prove links of at most three bits")
    keyed = nodes.select("fp", F.explode(block_keys(F.col("fp"))).alias("e")).select("fp", "e.*")
    sizes = written(keyed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-sizes")
    dealt = keyed.join(sizes, ["k", "key"]).withColumn(
        "parts", F.ceil(F.col("n") / chunk).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("mine")))
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(other)).select(
        "k", "key", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp")

    def run(batches):
        import pyarrow as pa
        for group in runs_of(batches, ["k", "key", "a", "b"]):
            fp = group.column("fp").to_numpy()
            u, v = spanning_links(fp.view(np.uint64), max_bits)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(fp[u]), pa.array(fp[v])], ["u", "v"])

    by = ["k", "key", "a", "b"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "u long, v long")


def rooted(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``nodes`` with the root of each fingerprint's component."""
    roots = components(links(nodes, max_bits)).select(F.col("node").alias("fp"), "root")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component): one row per input row; ``component`` is the
    smallest id reachable over links, the row's own included."""
    fps = written(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fp")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    # Written, so that joins on a large component's root or a frequent fingerprint can be split.
    found = written(rooted(nodes, max_bits), "simhash-rooted")
    lows = written(found.groupBy("root").agg(F.min("low").alias("component")), "simhash-lows")
    named = written(found.select("fp", "root").join(lows, "root").select("fp", "component"), "simhash-named")
    return fps.join(named, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, all columns kept.

    Of a component's rows that with the smallest id stays, and of those the one
    with the smallest text hash: rows are told apart by id and text, so an
    id that repeats in several components stays in each of them.  Rows with a
    null id are deduplicated among themselves: one stays for each component.
    """
    row, = fresh(docs, "row_key")
    keyed = docs.withColumn(row, F.struct(F.col(id_col).alias("id"),
                                          F.xxhash64(F.col(text_col).cast("string")).alias("h")))
    fps = written(fingerprints(keyed, row, text_col, shingle_words), "simhash-fp")
    named = F.col("id.id").isNotNull()
    nodes = written(fps.groupBy("fp").agg(F.min(F.when(named, F.col("id"))).alias("low"),
                                          F.min(F.when(~named, F.col("id"))).alias("bare")), "simhash-nodes")
    best = rooted(nodes, max_bits).groupBy("root").agg(F.min("low").alias("low"), F.min("bare").alias("bare"))
    kept = best.select(F.explode(F.array("low", "bare")).alias("kept_key")).where("kept_key is not null")
    # One key for both, so that texts are shuffled once; structs are equal where their null ids are.
    return keyed.join(kept, keyed[row] == kept["kept_key"], "left_semi").dropDuplicates([row]).select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


QUERIES = {"op2_simhash": op2_simhash}
ORACLES: dict[str, str] = {}
