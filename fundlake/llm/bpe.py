"""Byte-level BPE encoding and decoding over a distinct-word table.

1. Texts are split into words (pre-tokens) inside Spark tasks, by vector
   operations on code points; the words of a text are a partition of it.
2. Rows are dealt into blocks of bounded rows and bytes by their number, so rows
   that repeat are spread.  Each block sends its distinct words, in ``PARTS`` chunks
   by word hash, to the tasks of the word table.  ``GROUP_BLOCKS`` blocks share a
   word table, in which every distinct word is encoded once; the chunks grow in
   proportion to the blocks, whatever the corpus size.
3. The ids return to the blocks and are joined back by word position.

Only distinct words travel, never word occurrences, and nothing is broadcast:
the word table may grow with the corpus.  A frequent word is one entry of each
block, so it makes no hot key.  Decoding joins ids with the vocabulary's
id-to-piece table (bounded by the vocabulary) and concatenates the pieces.

Defined cases: a null or empty text has no ids and decodes to the empty text;
null ids and repeated rows are encoded row by row; a special token's string in
a text becomes that token, as the library does by default; a very long text is
encoded whole and fills its block; an empty table gives no rows.  Only the id and
text columns are read, so other columns can't clash.  Rows must come in the
same order when they are read again, as those of a written table do; a block
whose words differ is an error.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import give_back, per_worker, slices, small_batches, table

BLOCK_ROWS = 5120
BLOCK_BYTES = 20_000_000     # of text; on average, as rows are dealt by hash
GROUP_BLOCKS = 512           # blocks that share a word table
PARTS = 32                   # tasks of a word table, and chunks of a block's words
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
# The splitter's contractions and white space.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SPECIAL = "<|endoftext|>"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _class_table() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    out[list(WHITE)] = SPACE
    return out


def _tokenizer(path: str):
    def load():
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return t
    return per_worker(("tokenizer", path), load)


def split_words(texts):
    """Arrow string array without nulls -> (words, first word of each text).

    The words are views of the texts' own buffer; ``first`` has one entry more
    than there are texts.
    """
    import pyarrow as pa
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, texts.offset * 4).astype(np.int64)
    data = texts.buffers()[2]
    if n == 0 or offsets[-1] == offsets[0]:
        return pa.array([], pa.string()), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0])
    text = raw.tobytes().decode()
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(cp) == len(raw):
        byte_of = None
        bounds = offsets - offsets[0]
    else:
        byte_of = np.flatnonzero((raw & 0xC0) != 0x80)
        bounds = np.searchsorted(byte_of, offsets - offsets[0])
    size = len(cp)
    edge = np.zeros(size + 1, bool)          # a text, or a special token, begins here
    edge[bounds] = True
    inside = []
    for m in re.finditer(re.escape(SPECIAL), text):
        a, z = m.span()
        if not edge[a + 1:z].any():
            inside.append((a, z))
    for a, z in inside:
        edge[a] = edge[z] = True

    kind = per_worker("character classes", _class_table)[cp]
    blank = cp == 32
    start = np.empty(size, bool)
    start[0] = True
    prev_kind, this = kind[:-1], kind[1:]
    both_space = (this == SPACE) & (prev_kind == SPACE)
    start[1:] = ((this != prev_kind) & ~(blank[:-1] & (this != SPACE)))
    last = np.zeros(size, bool)              # followed by a non-space in the same text
    last[:-1] = (kind[1:] != SPACE) & ~edge[1:size]
    start[1:] |= both_space & last[1:]
    start |= edge[:size]
    for i in np.flatnonzero((cp == 39) & start):
        # start rules out an apostrophe behind an attached blank
        for c in CONTRACTIONS:
            z = i + len(c)
            if text.startswith(c, i) and not edge[i + 1:z].any():
                start[i + 1:z] = False
                if z < size:
                    start[z] = True
                break
    for a, z in inside:
        start[a + 1:z] = False
    at = np.flatnonzero(start)
    first = np.searchsorted(at, bounds)
    ends = np.append(at, size)
    where = ends if byte_of is None else np.append(byte_of, len(raw))[ends]
    words = pa.StringArray.from_buffers(
        len(at), pa.py_buffer((where + offsets[0]).astype(np.int32)), data)
    return words, first


def _distinct(pieces, parts: int):
    """Sorted distinct words of some string arrays, their part by hash, and for each
    array the words' indexes by position and the first word of each text."""
    import pyarrow as pa
    import pyarrow.compute as pc
    coded, first = [], []
    for texts in pieces:
        words, at = split_words(_plain(texts))
        coded.append(words.dictionary_encode())
        first.append(at)
    coded = pa.chunked_array(coded, pa.dictionary(pa.int32(), pa.string())).unify_dictionaries().chunks
    own = (coded[0].dictionary if coded else pa.array([], pa.string())).cast(pa.binary())
    order = pc.sort_indices(own).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    listed = own.take(pa.array(order)).to_pylist()
    part = np.fromiter(map(crc32, listed), np.int64, len(listed)) % parts
    return listed, part, [(rank[c.indices.to_numpy()], at) for c, at in zip(coded, first)]


def _pack(words: list[bytes]) -> bytes:
    import zstandard
    sizes = np.fromiter(map(len, words), np.uint32, len(words))
    return len(words).to_bytes(4, "little") + zstandard.compress(sizes.tobytes() + b"".join(words), 6)


def _unpack(packed: bytes) -> list[bytes]:
    import zstandard
    n = int.from_bytes(packed[:4], "little")
    raw = zstandard.decompress(packed[4:])
    ends = (4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n))).tolist()
    return [raw[a:z] for a, z in zip([4 * n, *ends], ends)]


def _plain(texts):
    """A string array, nulls as empty texts."""
    import pyarrow as pa
    import pyarrow.compute as pc
    return pc.fill_null(texts.cast(pa.string()), "")


def _by_part(part: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(part, its words in order) of every part that has words."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    return [(int(p), order[edges[p]:edges[p + 1]]) for p in np.flatnonzero(np.diff(edges))]


def block_words(docs: DataFrame, parts: int) -> DataFrame:
    """(slot, block, words): each block's distinct words by hash part, of the word
    table of its group; rows of a block arrive together, sorted by block."""
    def run(batches):
        import pyarrow as pa
        held, block = [], None

        def flush():
            listed, part, _ = _distinct((x.column(1) for x in slices(held)), parts)
            for p, own in _by_part(part, parts):
                yield pa.RecordBatch.from_pydict(
                    {"slot": pa.array([block // GROUP_BLOCKS * parts + p], pa.int64()),
                     "block": pa.array([block], pa.int64()),
                     "words": pa.array([_pack([listed[i] for i in own])], pa.binary())})

        for b in batches:
            ids = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1), len(ids)]
            for a, z in zip(cuts, cuts[1:]):
                if z > a:
                    if held and ids[a] != block:
                        yield from flush()
                        held = []
                    block = int(ids[a])
                    held.append(b.slice(a, z - a))
        if held:
            yield from flush()
        give_back()

    # The id is not used here; with it the shuffled rows are those that the
    # join reads, and Spark shuffles the texts once for both.
    return docs.sortWithinPartitions("block").select("block", "text", "id") \
        .mapInArrow(run, "slot long, block long, words binary")


def word_table(chunks: DataFrame, path: str, parts: int, groups: int) -> DataFrame:
    """(block, part, ids): the ids of each chunk's words, in the words' order.

    All chunks of a group's part meet in one task, which encodes each distinct
    word of them once.
    """
    def run(batches):
        import pyarrow as pa
        import zstandard
        known: dict[bytes, list[int]] = {}
        part = None
        for b in batches:
            for p, block, packed in zip(*(c.to_pylist() for c in b.columns)):
                if p != part:
                    known, part = {}, p            # p: group and part
                words = _unpack(packed)
                new = [w for w in words if w not in known]
                if new:
                    coded = _tokenizer(path).encode_batch([w.decode() for w in new], add_special_tokens=False)
                    known.update(zip(new, (c.ids for c in coded)))
                ids = [known[w] for w in words]
                sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
                flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
                raw = zstandard.compress(sizes.tobytes() + flat.view(np.uint8).reshape(-1, 4).T.tobytes(), 6)
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int64()), "part": pa.array([p % parts], pa.int32()),
                     "n": pa.array([len(words)], pa.int32()), "ids": pa.array([raw], pa.binary())})

    return chunks.repartition(groups * parts, "slot").sortWithinPartitions("slot").select("slot", "block", "words") \
        .mapInArrow(run, "block long, part int, n int, ids binary")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           path: str | None = None, block_rows: int = BLOCK_ROWS, finish=None,
           columns: str = "ids array<int>") -> DataFrame:
    """(id, ids): the ids of every row's whole text.

    ``finish(ids, path)`` turns some rows' ids (an Arrow list array) into other
    ``columns`` where they are made, for callers that need only figures of
    them.
    """
    path = path or default_path()
    spark = small_batches(docs).sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(text_col).cast("string")
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()
    blocks = max(shuffled, -(-rows // block_rows), -(-size // BLOCK_BYTES))
    parts, groups = PARTS, -(-blocks // GROUP_BLOCKS)
    by = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    dealt = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        by.alias("block")).repartition(blocks, "block")
    coded = word_table(block_words(dealt, parts), path, parts, groups)

    def join_back(left, right):
        import pyarrow as pa
        import zstandard
        pieces = list(slices(left.to_batches()))
        listed, part, places = _distinct((x.column("text") for x in pieces), parts)
        sizes = np.zeros(len(listed), np.int64)
        owned, flats = dict(_by_part(part, parts)), {}
        for p, n, raw in zip(right.column("part").to_pylist(), right.column("n").to_pylist(),
                             right.column("ids").to_pylist()):
            own = owned.get(p, ())
            if len(own) != n:
                raise ValueError("a block's words changed between two reads of its rows")
            raw = zstandard.decompress(raw)
            sizes[own] = np.frombuffer(raw, np.uint32, n)
            total = int(sizes[own].sum())
            flats[p] = np.frombuffer(raw, np.uint8, 4 * total, 4 * n).reshape(4, total).T.copy().view(np.uint32)[:, 0]
        del listed, part
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.zeros(starts[-1], np.int32)
        if flats.keys() != owned.keys():
            raise ValueError("a block's words did not all come back")
        for p, ids in flats.items():
            own = owned[p]
            n = sizes[own]
            flat[np.repeat(starts[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(ids))] = ids
        per_word = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))
        del flats, owned
        made = []
        places.reverse()                     # a piece's words go once its ids are there
        for x in pieces:
            index, first = places.pop()
            ends = np.concatenate([[0], np.cumsum(sizes[index])])[first]
            out = per_word.take(pa.array(index)).flatten() if len(index) else pa.array([], pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), out)
            made.append([x.column("id"), *([ids] if finish is None else finish(ids, path))])
        give_back()
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(m, names) for m in made])

    names = ["id", *(c.split()[0] for c in columns.split(", "))]
    return dealt.groupBy("block").cogroup(coded.groupBy("block")) \
        .applyInArrow(join_back, f"id {kind}, {columns}")


def pieces(path: str) -> tuple[bytes, ...]:
    """Id -> the piece's bytes (byte-level alphabet undone)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    t = _tokenizer(path)
    out = []
    for i in range(t.get_vocab_size()):
        piece = t.id_to_token(i) or ""
        known = all(c in byte for c in piece)
        out.append(bytes(byte[c] for c in piece) if known else piece.encode())
    return tuple(out)


def _piece_array(path: str):
    import pyarrow as pa
    return per_worker(("pieces", path), lambda: pa.array(pieces(path), pa.large_binary()))


def _decimal_array(path: str):
    import pyarrow as pa
    return per_worker(("decimals", path), lambda: pa.array(
        [b"%d," % i for i in range(_tokenizer(path).get_vocab_size())], pa.large_binary()))


def joined_rows(ids, table) -> list[bytes]:
    """Arrow list array of ids -> each row's entries of ``table``, joined."""
    joined = table.take(ids.flatten())
    at = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8) if len(joined) \
        else np.zeros(1, np.int64)
    data = memoryview(joined.buffers()[2]) if len(joined) else memoryview(b"")
    sizes = np.diff(np.asarray(ids.offsets.to_numpy()))
    ends = at[np.concatenate([[0], np.cumsum(sizes)])]
    return [bytes(data[a:z]) for a, z in zip(ends, ends[1:])]


def decode(encoded: DataFrame, id_col: str = "id", ids_col: str = "ids",
           path: str | None = None) -> DataFrame:
    """(id, text) from (id, ids); bytes that are no UTF-8 become U+FFFD."""
    path = path or default_path()
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for a in range(0, b.num_rows, 512):
                x = b.slice(a, 512)
                ids = x.column(1)
                texts = [t.decode("utf-8", "replace") for t in joined_rows(ids, _piece_array(path))]
                yield pa.RecordBatch.from_arrays([x.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
                          .alias("ids")).mapInArrow(run, f"id {kind}, text string")


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digests(ids, path: str):
    """The ``DIGESTS`` columns of some rows' ids; the text is decoded from them."""
    import pyarrow as pa
    sha = hashlib.sha256
    told = [t.decode("utf-8", "replace").encode() for t in joined_rows(ids, _piece_array(path))]
    return (pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64)),
            pa.array([sha(d[:-1]).hexdigest() for d in joined_rows(ids, _decimal_array(path))], pa.string()),
            pa.array([sha(t).hexdigest() for t in told], pa.string()))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode(docs, finish=digests, columns=DIGESTS).withColumnRenamed("id", "doc_id")


QUERIES = {"op8_bpe": op8_bpe}
ORACLES: dict[str, str] = {}
