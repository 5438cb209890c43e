"""Small tables for the operators' edge cases."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def documents(spark, rows=None):
    """Odd documents: null and empty texts, a very long one, repeated rows,
    null ids, and columns that clash with the operators' own names."""
    rnd = random.Random(4)
    words = "the of and to in is that ing tion er".split()
    long_text = " ".join(rnd.choice(words) for _ in range(30_000))
    plain = " ".join(rnd.choice(words) for _ in range(120))
    rows = rows if rows is not None else [
        (1, plain), (1, plain), (2, None), (3, ""), (4, " \n\t "), (5, long_text), (None, plain), (None, None),
        (6, "aé\U0001f600 <|endoftext|> it's"), (7, "one two"), (8, "x" * 50_000),
        (9, "line\nline\nother\nline")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ("id", "fp", "block", "score", "stats", "component", "kept", "copies", "copy", "base", "n_words", "spans",
             "p", "rate", "ids", "h", "y")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
                     F.length("text").cast("long").alias("n_chars"), *[F.lit(7).alias(c) for c in clash])


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def sf(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
