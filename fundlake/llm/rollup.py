"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are kept as sums of signed
batches.  A change is an insert (+new), a delete (-old) or a revision (-old
and +new, which may also move a document to another group).  ``commit`` adds
one batch's changes up by group and writes them under a name of their own; a
ledger entry that names this folder, moved into place after it, makes the batch
count.  A batch id in the ledger is not applied again, what a broken-off writer
left is never read, and as an entry names one folder, one of two writers of the
same batch counts.

``totals`` sums the ledger's batches: one scan of the folders, joined with the
ledger's names, however many batches there are.  ``compact`` replaces them by
one folder and one list of ids, in two writes.  Sums are partial before the
shuffle, so a source with a third of all rows is one small row of each task.

Defined cases: null source, language or version is a group of its own; a null
count is 0 tokens (the document still counts); repeated change rows count as
often as they come; groups that fall to no documents and no tokens are left
out; without a batch there are no totals.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import table, written
from fundlake.session import shared_dir

KEYS = ("source", "lang", "version")
SIDE = "struct<source:string,lang:string,version:string,tokens:bigint>"
STORED = "batch string, source string, lang string, version string, n_docs long, n_tokens long"
LEDGER = "batch string, folder string"


def side(source, lang, version, tokens):
    """One side (old or new) of a change."""
    return F.struct(source.alias("source"), lang.alias("lang"), version.alias("version"),
                    tokens.cast("long").alias("tokens"))


def signed(changes: DataFrame) -> DataFrame:
    """(old, new) changes -> signed rows (source, lang, version, n_docs,
    n_tokens); old is null for an insert, new for a delete."""
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("s")),
                   F.struct(F.lit(1).alias("sign"), F.col("new").alias("s")))
    return (changes.select(F.explode(F.filter(both, lambda x: x["s"].isNotNull())).alias("x"))
            .select(*[F.col(f"x.s.{k}").alias(k) for k in KEYS], F.col("x.sign").cast("long").alias("n_docs"),
                    (F.col("x.sign") * F.coalesce(F.col("x.s.tokens"), F.lit(0))).cast("long").alias("n_tokens")))


def _added(rows: DataFrame) -> DataFrame:
    return (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs != 0 or n_tokens != 0"))


class Rollup:
    """A rollup kept under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def ledger(self) -> DataFrame:
        """(batch, folder) of the committed batches.  ``ledger`` holds a file
        for each batch, ``compacted`` the entries taken over by ``compact``."""
        out = self.spark.createDataFrame([], LEDGER)
        for part in ("ledger", "compacted"):
            fs, p = self._fs(f"{self.path}/{part}")
            if fs.exists(p):
                lines = self.spark.read.schema(LEDGER).option("sep", "\t").csv(p.toString())
                out = out.unionByName(lines.select(F.unhex("batch").cast("string").alias("batch"), "folder"))
        return out

    def batches(self) -> list[str]:
        """The ids of the committed batches."""
        return sorted(r.batch for r in self.ledger().select("batch").collect())

    def _has(self, batch: str) -> bool:
        fs, p = self._fs(f"{self.path}/ledger/{_entry(batch)}")
        if fs.exists(p):
            return True
        fs, p = self._fs(f"{self.path}/compacted")
        return fs.exists(p) and not self.ledger().where(F.col("batch") == batch).isEmpty()

    def _enter(self, batch: str, folder: str) -> None:
        """The ledger entry, written aside and moved: no reader sees half of it."""
        fs, aside = self._fs(f"{self.path}/ledger/.{folder}")
        out = fs.create(aside, True)
        out.write(f"{batch.encode().hex()}\t{folder}\n".encode())
        out.close()
        if not fs.rename(aside, self._fs(f"{self.path}/ledger/{_entry(batch)}")[1]):
            fs.delete(aside, False)                # another writer's entry stands

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of (old, new) changes; False if it already counts."""
        if self._has(batch):
            return False
        folder = f"b{uuid.uuid4().hex}"
        _added(signed(changes)).write.parquet(f"{self.path}/batches/folder={folder}")
        self._enter(batch, folder)
        return True

    def rows(self) -> DataFrame:
        """The committed batches' rows, in one scan."""
        fs, p = self._fs(f"{self.path}/batches")
        if not fs.exists(p):
            return self.spark.createDataFrame([], STORED)
        data = self.spark.read.schema(f"{STORED.partition(', ')[2]}, folder string").parquet(p.toString())
        return data.join(self.ledger(), "folder").select("batch", *data.drop("folder").columns)

    def totals(self) -> DataFrame:
        return _added(self.rows())

    def compact(self, path: str) -> Rollup:
        """A rollup under a new ``path`` with one folder of rows, given to the
        first batch, and the same ids; the old folder is left to its owner."""
        new = Rollup(self.spark, path)
        first = self.ledger().agg(F.min("batch")).first()[0]
        if first is not None:
            folder = f"b{uuid.uuid4().hex}"
            self.totals().write.parquet(f"{new.path}/batches/folder={folder}")
            entries = self.ledger().select(F.hex(F.encode("batch", "utf-8")).alias("batch"),
                                           F.when(F.col("batch") == first, folder).alias("folder"))
            entries.write.mode("overwrite").option("sep", "\t").csv(f"{new.path}/compacted")
        return new


def _entry(batch: str) -> str:
    return hashlib.sha256(batch.encode()).hexdigest()


# Two countings of a text: words, and runs of letters, single digits and signs.
WORDS = r"[^\x20\x09-\x0D]+"
PIECES = r"[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]"


def counted(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "source", "lang", F.regexp_count(text, F.lit(WORDS)).alias("words"),
                       F.regexp_count(text, F.lit(PIECES)).alias("pieces"))


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: every document is inserted with its
    words; all but the English ones are recounted by another tokenizer; those
    labelled as junk are deleted.  The second batch is committed twice."""
    docs = written(counted(table(spark, sf_dir, "documents")), "rollup-counts")
    none = F.lit(None).cast(SIDE)
    words = side(F.col("source"), F.col("lang"), F.lit("words-1"), F.col("words"))
    pieces = side(F.col("source"), F.col("lang"), F.lit("pieces-2"), F.col("pieces"))
    recounted = F.coalesce(F.col("lang") != "en", F.lit(True))
    junk = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct()
    rollup = Rollup(spark, shared_dir(spark, "rollup"))
    rollup.commit("load", docs.select(none.alias("old"), words.alias("new")))
    recount = docs.where(recounted).select(words.alias("old"), pieces.alias("new"))
    rollup.commit("recount", recount)
    rollup.commit("recount", recount)
    rollup.commit("junk", docs.join(junk, "doc_id", "left_semi").select(
        F.when(recounted, pieces).otherwise(words).alias("old"), none.alias("new")))
    return rollup.totals()


_ORACLE = r"""
WITH d AS (
  SELECT source, lang, doc_id, coalesce(lang <> 'en', true) AS again,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]')) AS pieces
  FROM documents)
SELECT source, lang, CASE WHEN again THEN 'pieces-2' ELSE 'words-1' END AS version,
       count(*) AS n_docs, CAST(sum(CASE WHEN again THEN pieces ELSE words END) AS BIGINT) AS n_tokens
FROM d WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)
GROUP BY ALL
"""

QUERIES = {"op7_token_rollup": op7_token_rollup}
ORACLES = {"op7_token_rollup": _ORACLE}
