"""Usage logs stored by day, with what the reports need summed once.

``rows/day=…`` holds the log itself, ``daily/day=…`` the credits per warehouse and
the newest time of each day, ``names/day=…`` which query used which table.  A
report over a window of days reads the sums of its whole days and the rows of its
first, cut day; a search for a table is an equality on a sorted column.

Writing is by whole days, in dynamic overwrite mode: days that come again replace
themselves, others stay as they are, so a repeated run changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "day"
# What stands before a table's name in a statement.
TABLE_WORDS = r"\b(?:from|join|into|update|table)\s+([\w.$`\"]+)"


def _write_days(df: DataFrame, path: str) -> None:
    # Rows of a day go to as many tasks as its size needs, not to all and not to one.
    (df.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(DAY).parquet(path))


def _read_days(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    fields = [f for f in schema.fields if f.name != DAY]
    return spark.read.schema(T.StructType([*fields, T.StructField(DAY, T.DateType())])).parquet(path)


def day_of(time: Column) -> Column:
    return F.to_date(time)


class MeteringStore:
    """Metering rows (warehouse_name, start_time, credits_used, …) by day."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, metering: DataFrame) -> "MeteringStore":
        """Store whole days (given again, they replace themselves)."""
        self.schema = metering.schema
        rows = metering.withColumn(DAY, day_of(F.col("start_time")))
        _write_days(rows, f"{self.root}/rows")
        days = rows.select(DAY).distinct()
        daily = (self.rows().join(days, DAY, "left_semi").groupBy(DAY, "warehouse_name")
                 .agg(F.sum("credits_used").alias("credits"), F.max("start_time").alias("newest")))
        self.daily_schema = daily.schema
        _write_days(daily, f"{self.root}/daily")
        return self

    def rows(self) -> DataFrame:
        return _read_days(self.spark, self.schema, f"{self.root}/rows")

    def daily(self) -> DataFrame:
        return _read_days(self.spark, self.daily_schema, f"{self.root}/daily")

    def newest(self) -> Column:
        """The newest logged time, from the daily rows."""
        return self.daily().agg(F.max("newest")).scalar()

    def window(self, now: Column, days: int) -> DataFrame:
        """(day, warehouse_name, credits) of the rows from ``days`` before
        ``now`` on: whole days from their sums, the first day from its rows."""
        since = now - F.make_dt_interval(F.lit(days))
        whole = self.daily().where(F.col(DAY) > day_of(since)).select(DAY, "warehouse_name", "credits")
        cut = (self.rows().where((F.col(DAY) == day_of(since)) & (F.col("start_time") >= since))
               .groupBy(DAY, "warehouse_name").agg(F.sum("credits_used").alias("credits")))
        return whole.unionByName(cut)

    def credits_by_warehouse(self, now: Column, days: int = 7, usd_per_credit: float = 1.0) -> DataFrame:
        out = self.window(now, days).groupBy("warehouse_name").agg(F.sum("credits").alias("_c"))
        return (out.select("warehouse_name", F.round("_c", 3).alias("credits_used"),
                           F.round(F.col("_c") * F.lit(usd_per_credit), 2).alias("approx_usd"))
                .orderBy(F.col("credits_used").desc_nulls_first()))

    def daily_credits(self, now: Column, days: int = 14) -> DataFrame:
        kind = self.schema["start_time"].dataType
        return (self.window(now, days).groupBy(F.col(DAY).cast(kind).alias("day"))
                .agg(F.round(F.sum("credits"), 3).alias("credits")).orderBy("day"))


def tables_in(text: Column) -> Column:
    """The tables a statement names after FROM, JOIN, INTO, UPDATE or TABLE: lower
    case, without namespace or quoting, each once."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TABLE_WORDS), F.lit(1))
    return F.array_distinct(F.transform(found, lambda t: F.element_at(
        F.split(F.regexp_replace(t, "[`\"]", ""), r"\."), -1)))


class HistoryStore:
    """Query history by day, with an inverted list of table names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, history: DataFrame) -> "HistoryStore":
        self.schema = history.schema
        rows = history.withColumn(DAY, day_of(F.col("start_time")))
        _write_days(rows, f"{self.root}/rows")
        names = (self.rows().join(rows.select(DAY).distinct(), DAY, "left_semi")
                 .select(F.explode(tables_in(F.col("query_text"))).alias("table_name"), "query_id", "start_time", DAY))
        self.names_schema = names.schema
        # Sorted by name inside each file, so that row groups without the name are skipped.
        (names.hint("rebalance", DAY).sortWithinPartitions(DAY, "table_name").write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{self.root}/names"))
        return self

    def rows(self) -> DataFrame:
        return _read_days(self.spark, self.schema, f"{self.root}/rows")

    def names(self) -> DataFrame:
        return _read_days(self.spark, self.names_schema, f"{self.root}/names")

    def between(self, start: Column, end: Column) -> DataFrame:
        """Rows from ``start`` to ``end``; other days' folders are not opened."""
        return self.rows().where(F.col(DAY).between(day_of(start), day_of(end))
                                 & F.col("start_time").between(start, end)).drop(DAY)

    def audit(self, table: str, n: int = 20) -> DataFrame:
        """Who last used ``table``, newest first.  Only the list's rows of that name
        are ordered; the texts of the ``n`` found are then looked up in their days."""
        plain = table.replace("`", "").replace('"', "").rpartition(".")[2].lower()
        newest = [F.col("start_time").desc_nulls_first(), F.col("query_id").asc()]
        found = self.names().where(F.col("table_name") == plain).orderBy(*newest).limit(n).select(
            "query_id", F.col(DAY).alias("_day"))
        rows = self.rows()
        hit = (rows["query_id"] == found["query_id"]) & rows[DAY].eqNullSafe(found["_day"])
        return rows.join(F.broadcast(found), hit, "left_semi").select(          # n rows
            "query_id", "query_text", "user_name", "role_name", "start_time").orderBy(*newest)
