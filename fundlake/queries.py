"""Registered queries over the driver's tables: one per pipeline stage or
operator.  Each is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.functions import initcap_words
from fundlake.functions import parse_any_date as _parse_any_date
from fundlake.functions import try_number as _try_number
from fundlake.operators import governance as _gov
from fundlake.operators import quota as _quota
from fundlake.plans import dashboard, pipeline, profiling, reports
from fundlake.plans import silver as _silver
from fundlake.plans import star as _star
from fundlake.plans import usage as _usage
from fundlake.session import shared_dir
from fundlake.sources import landing as _landing
from fundlake.sources import snapshots as _snap
from fundlake.sources import testdata as _td
from fundlake.sources.ledger import Ledger
from fundlake.sources.logstore import HistoryStore, MeteringStore

REGISTRY: dict = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def parity(df: DataFrame) -> DataFrame:
    """Decimals -> DOUBLE, small integers -> BIGINT (presentation only)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _w(spark, sf_dir) -> "pipeline.Written":
    """RAW/SILVER/STAR written once per session for ``sf_dir``."""
    return pipeline.written(spark, sf_dir)


def _layers(spark, sf_dir):
    return _w(spark, sf_dir).layers()


@register("funding_equity")
def funding_equity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity(reports.funding_equity(_layers(spark, sf_dir).tables()))


@register("disbursement_lag_all")
def disbursement_lag_all(spark, sf_dir):
    return parity(reports.disbursement_lag(_layers(spark, sf_dir).tables(), valid_only=False))


@register("disbursement_lag_valid")
def disbursement_lag_valid(spark, sf_dir):
    return parity(reports.disbursement_lag(_layers(spark, sf_dir).tables(), valid_only=True))


@register("program_efficiency")
def program_efficiency(spark, sf_dir):
    return parity(reports.program_efficiency(_layers(spark, sf_dir).tables()))


# ------------------------------------------------------------ cleansing ----


@register("null_tokens")
def null_tokens(spark, sf_dir):
    return _landing.null_tokens(_td.raw_enrollments(spark, sf_dir))


@register("parse_any_date")
def parse_any_date(spark, sf_dir):
    raw = _w(spark, sf_dir).raw["applications"]
    return raw.select("application_id", F.col("submission_date").alias("submission_text"),
                      _parse_any_date("submission_date").alias("submission_date"))


@register("try_number")
def try_number(spark, sf_dir):
    raw = _w(spark, sf_dir).raw["applications"]
    return parity(raw.select("application_id", F.col("amount_requested").alias("amount_text"),
                             _try_number("amount_requested").alias("amount_requested")))


@register("initcap_status")
def initcap_status(spark, sf_dir):
    raw = _w(spark, sf_dir).raw["applications"]
    return raw.select("application_id", F.col("status").alias("status_text"),
                      initcap_words("status").alias("status"))


@register("money_text")
def money_text(spark, sf_dir):
    return parity(_w(spark, sf_dir).silver_stage("funding_decisions"))


@register("normalise_id")
def normalise_id(spark, sf_dir):
    return parity(_w(spark, sf_dir).silver_stage("enrollments"))


@register("flag_missing")
def flag_missing(spark, sf_dir):
    enr = _w(spark, sf_dir).silver_stage("enrollments")
    return (enr.groupBy("headcount_missing_flag",
                        F.col("headcount").isNull().alias("headcount_is_null"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("dedupe_first")
def dedupe_first(spark, sf_dir):
    return _silver.deduped_applications(_w(spark, sf_dir).raw["applications"])


@register("conform_name")
def conform_name(spark, sf_dir):
    return parity(_w(spark, sf_dir).silver_stage("applications"))


@register("flag_orphans")
def flag_orphans(spark, sf_dir):
    return parity(_w(spark, sf_dir).silver_stage("disbursements"))


@register("quality_report")
def quality_report(spark, sf_dir):
    lay = _layers(spark, sf_dir)
    return parity(_silver.quality_report(lay.raw, lay.silver))


@register("load_counts")
def load_counts(spark, sf_dir):
    return _landing.count_rows_by_table(_w(spark, sf_dir).raw)


@register("name_variants")
def name_variants(spark, sf_dir):
    raw = _w(spark, sf_dir).raw["applications"]
    return profiling.name_variants(raw, "%nation_1%")


@register("headcount_nulls")
def headcount_nulls(spark, sf_dir):
    return profiling.null_count(_w(spark, sf_dir).raw["enrollments"], "headcount")


def _checked_sample(df: DataFrame, column: str, n: int) -> DataFrame:
    """A LIMIT sample of a column (any ``n`` rows, no order), reported as its
    row count and how many of its values are in the extract."""
    found = df.select(F.col(column).alias("_v")).distinct().withColumn("_in", F.lit(1))
    s = profiling.sample(df, column, n)
    return s.join(found, F.col(column).eqNullSafe(F.col("_v")), "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_in").alias("n_members"))


@register("date_samples")
def date_samples(spark, sf_dir):
    """A peek at ten raw submission dates."""
    return _checked_sample(_w(spark, sf_dir).raw["applications"], "submission_date", 10)


@register("amount_samples")
def amount_samples(spark, sf_dir):
    """A peek at five raw approved amounts (money text)."""
    return _checked_sample(_w(spark, sf_dir).raw["funding_decisions"], "approved_amount", 5)


# ----------------------------------------------------------------- star ----
def _star_table(name):
    def run(spark, sf_dir):
        return parity(_w(spark, sf_dir).star_stage(name))
    run.__name__ = name
    return run


for _name in ("dim_institution", "dim_program", "dim_date", "fact_applications",
              "fact_disbursements", "fact_enrollments"):
    register(_name)(_star_table(_name))


@register("application_keys")
def application_keys(spark, sf_dir):
    """Dense keys 1..n over every application id with the scalable
    (range-sliced) surrogate-key form: no task holds more than one slice."""
    from fundlake.operators.keys import surrogate_key
    ids = _w(spark, sf_dir).silver["applications"].select("application_id")
    n = spark.sparkContext.defaultParallelism
    return surrogate_key(ids, "application_id", "application_key", ranged_partitions=n)


@register("wide_keys")
def wide_keys(spark, sf_dir):
    """The range-sliced form over a frame wider than its key."""
    from fundlake.operators.keys import surrogate_key
    wide = _w(spark, sf_dir).silver["applications"].select(
        "institution_id", "application_id", "fiscal_year", "status")
    return surrogate_key(wide, "application_id", "application_key",
                         ranged_partitions=spark.sparkContext.defaultParallelism)


@register("star_counts")
def star_counts(spark, sf_dir):
    return _star.star_counts(_layers(spark, sf_dir).star)


# ------------------------------------------------------------ dashboard ----
def _views(spark, sf_dir):
    return reports.views(_layers(spark, sf_dir).tables())


@register("kpi_headline")
def kpi_headline(spark, sf_dir):
    v = _views(spark, sf_dir)
    return dashboard.headline(spark, v["v_funding_equity"], v["v_disbursement_lag"],
                              v["v_program_efficiency"])


PICKED_YEARS = ("1994", "1996")


@register("kpi_picked_years")
def kpi_picked_years(spark, sf_dir):
    """The headline figures for two picked fiscal years."""
    v = _views(spark, sf_dir)
    return dashboard.headline(spark, v["v_funding_equity"], v["v_disbursement_lag"],
                              v["v_program_efficiency"], years=PICKED_YEARS)


@register("kpi_years_from_rollup")
def kpi_years_from_rollup(spark, sf_dir):
    """The same figures from a row per fiscal year, written once for any pick."""
    v = _views(spark, sf_dir)
    years = dashboard.year_rollup(v["v_funding_equity"], v["v_disbursement_lag"], shared_dir(spark, "year-rollup"))
    return dashboard.headline_of_years(spark, years, v["v_program_efficiency"], PICKED_YEARS)


@register("fiscal_years")
def fiscal_years(spark, sf_dir):
    return dashboard.fiscal_years(_views(spark, sf_dir)["v_funding_equity"])


@register("top15_equity")
def top15_equity(spark, sf_dir):
    return parity(dashboard.top_equity(_views(spark, sf_dir)["v_funding_equity"]))


@register("top15_lag")
def top15_lag(spark, sf_dir):
    return parity(dashboard.top_lag(_views(spark, sf_dir)["v_disbursement_lag"]))


@register("program_table")
def program_table(spark, sf_dir):
    return parity(dashboard.program_table(_views(spark, sf_dir)["v_program_efficiency"]))


# ----------------------------------------------------------- governance ----
def _secured(spark, sf_dir, role):
    lay = _layers(spark, sf_dir)
    reg = pipeline.registry_for(spark, lay)
    return reg.secured_tables(lay.tables(), role), reg, lay


@register("row_policy_restricted")
def row_policy_restricted(spark, sf_dir):
    t, _, _ = _secured(spark, sf_dir, pipeline.RESTRICTED_ROLE)
    return parity(t["fact_applications"])


@register("row_policy_privileged")
def row_policy_privileged(spark, sf_dir):
    lay = _layers(spark, sf_dir)
    reg = pipeline.registry_for(spark, lay)
    roles = ("ANALYST", "AUDITOR", pipeline.RESTRICTED_ROLE, "UNKNOWN_ROLE")
    return _gov.rows_visible(reg, "fact_applications", lay.star["fact_applications"], roles)


@register("mask_small_cells")
def mask_small_cells(spark, sf_dir):
    t, _, _ = _secured(spark, sf_dir, pipeline.RESTRICTED_ROLE)
    return parity(t["fact_enrollments"])


@register("equity_as_restricted")
def equity_as_restricted(spark, sf_dir):
    t, _, _ = _secured(spark, sf_dir, pipeline.RESTRICTED_ROLE)
    return parity(reports.funding_equity(t))


@register("facts_by_name_restricted")
def facts_by_name_restricted(spark, sf_dir):
    """SQL over the facts by name, as the restricted role."""
    _w(spark, sf_dir).register(role=pipeline.RESTRICTED_ROLE)
    return spark.sql("""SELECT i.institution_id, p.program_code, count(*) AS n, count(e.headcount) AS n_shown
                        FROM secured_fact_enrollments e
                        JOIN secured_dim_institution i ON i.institution_key = e.institution_key
                        LEFT JOIN secured_dim_program p ON p.program_key = e.program_key
                        GROUP BY i.institution_id, p.program_code""")


@register("view_by_name")
def view_by_name(spark, sf_dir):
    """A report view read by its name."""
    _w(spark, sf_dir).register()
    return parity(spark.sql("SELECT * FROM v_program_efficiency"))


@register("tables_by_name")
def tables_by_name(spark, sf_dir):
    """Every layer's tables in their namespaces, read by name."""
    w = _w(spark, sf_dir)
    w.register()
    named = {}
    for layer in ("raw", "silver", "star"):
        for r in spark.sql(f"SHOW TABLES IN {layer}").where("NOT isTemporary").collect():
            if r.tableName in getattr(w, layer):
                named[f"{layer}.{r.tableName}"] = spark.table(f"{layer}.{r.tableName}")
    return _landing.count_rows_by_table(named)


@register("entitlement_inserts")
def entitlement_inserts(spark, sf_dir):
    """Roles are entitled by inserting rows into a table; the row policy
    follows the table."""
    lay = _layers(spark, sf_dir)
    path = shared_dir(spark, "entitlements")
    name = "entitlements_" + path[-12:]
    _landing.create_layers(spark)
    _landing.load(pipeline.entitlements(spark), f"star.{name}", path=path)
    _landing.insert_rows(spark, f"star.{name}", [("REGION_NORTH", "INST-003"), ("REGION_NORTH", "INST-004")],
                         pipeline.ENTITLEMENT_SCHEMA)
    reg = pipeline.registry_for(spark, lay, ent=spark.table(f"star.{name}"))
    return _gov.rows_visible(reg, "fact_disbursements", lay.star["fact_disbursements"],
                             ("ANALYST", pipeline.RESTRICTED_ROLE, "REGION_NORTH"))


@register("policy_detach")
def policy_detach(spark, sf_dir):
    """What the restricted role sees before and after policies come off."""
    lay = _layers(spark, sf_dir)
    fact = lay.star["fact_enrollments"]

    def seen(step, reg):
        return reg.secure("fact_enrollments", fact, pipeline.RESTRICTED_ROLE).agg(
            F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"), F.count("headcount").alias("n_shown"))

    out = seen("both", pipeline.registry_for(spark, lay))
    out = out.unionByName(seen("mask", pipeline.registry_for(spark, lay).detach("fact_enrollments", _gov.RowPolicy)))
    return out.unionByName(seen("none", pipeline.registry_for(spark, lay).detach("FACT_ENROLLMENTS")))


@register("session_role_views")
def session_role_views(spark, sf_dir):
    """One set of views for all roles; only SET VAR lies between the answers."""
    pipeline.session_views(_w(spark, sf_dir))
    parts = []
    for role in (None, "ANALYST", pipeline.RESTRICTED_ROLE, "UNKNOWN_ROLE"):
        spark.sql("SET VAR fundlake_role = CAST(:role AS STRING)", args={"role": role})
        for t in ("fact_applications", "fact_enrollments"):
            shown = "headcount" if t == "fact_enrollments" else "amount_requested"
            parts.append(spark.sql(f"""SELECT fundlake_role AS role_name, '{t}' AS tbl, count(*) AS n, count({shown}) AS n_shown
                                       FROM session_{t}"""))
    spark.sql("SET VAR fundlake_role = DEFAULT")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("audit_search")
def audit_search(spark, sf_dir):
    return _gov.audit(_td.query_history(spark, sf_dir), "%FACT_PURCHASES%", 20)


# ---------------------------------------------------------------- usage ----
USD_PER_CREDIT = 3.0
BUDGET_LIMIT = 50.0


@register("credits_by_warehouse")
def credits_by_warehouse(spark, sf_dir):
    return parity(_usage.credits_by_warehouse(_td.metering_history(spark, sf_dir),
                                              _td.clock(spark, sf_dir), 7, USD_PER_CREDIT))


@register("daily_credits")
def daily_credits(spark, sf_dir):
    return parity(_usage.daily_credits(_td.metering_history(spark, sf_dir),
                                       _td.clock(spark, sf_dir), 14))


def _metering_store(spark, sf_dir) -> MeteringStore:
    return MeteringStore(spark, shared_dir(spark, "metering-store")).write(_td.metering_history(spark, sf_dir))


def _history_store(spark, sf_dir) -> HistoryStore:
    return HistoryStore(spark, shared_dir(spark, "history-store")).write(_td.query_history(spark, sf_dir))


@register("credits_from_store")
def credits_from_store(spark, sf_dir):
    """Credits per warehouse from the log store: daily sums and one cut day."""
    store = _metering_store(spark, sf_dir)
    return parity(store.credits_by_warehouse(store.newest(), 7, USD_PER_CREDIT))


@register("daily_from_store")
def daily_from_store(spark, sf_dir):
    store = _metering_store(spark, sf_dir)
    return parity(store.daily_credits(store.newest(), 14))


@register("slowest_from_store")
def slowest_from_store(spark, sf_dir):
    """The slowest queries of the last day, from the folders of two days."""
    store, now = _history_store(spark, sf_dir), _td.clock(spark, sf_dir)
    return _usage.slowest_queries(store.between(now - F.make_dt_interval(F.lit(0), F.lit(24)), now), now)


@register("audit_by_table")
def audit_by_table(spark, sf_dir):
    """Who used a table, by the store's list of table names."""
    return _history_store(spark, sf_dir).audit("STAR.FACT_PURCHASES", 20)


@register("slowest_queries")
def slowest_queries(spark, sf_dir):
    return _usage.slowest_queries(_td.query_history(spark, sf_dir), _td.clock(spark, sf_dir))


@register("storage_by_schema")
def storage_by_schema(spark, sf_dir):
    return _usage.storage_by_schema(_td.storage_metrics(spark, sf_dir))


@register("layer_storage")
def layer_storage(spark, sf_dir):
    """The written layers' storage from file sizes.  Sizes depend on the codec, so
    the row tells how many tables' files hold what their rows need at least (a
    byte for a hundred rows, and a Parquet footer), and whether all do."""
    w = _w(spark, sf_dir)
    layers = ("raw", "silver", "star")
    sizes = _usage.storage_from_files(spark, {f"{layer}.{t}": f"{w.root}/{layer}/{t}" for layer in layers
                                              for t in getattr(w, layer)})
    sizes = sizes.groupBy(F.col("table_schema").alias("tbl")).agg(F.sum("active_bytes").alias("bytes"))
    rows = _landing.count_rows_by_table({f"{layer}.{t}": df for layer in layers for t, df in getattr(w, layer).items()})
    held = F.coalesce(F.col("bytes") >= F.greatest(F.lit(12), F.col("row_count") / 100), F.lit(False))
    return rows.join(sizes, "tbl", "left").groupBy(F.split_part("tbl", F.lit("."), F.lit(1)).alias("table_schema")).agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("row_count").alias("n_rows"),
        F.count_if(held).alias("n_sized"), F.bool_and(held).alias("measured"))


@register("quota_status")
def quota_status(spark, sf_dir):
    return parity(_quota.quota_walk(_td.metering_history(spark, sf_dir),
                                    _quota.monitors_frame(spark), _quota.triggers_frame(spark)))


@register("budget_status")
def budget_status(spark, sf_dir):
    return parity(_quota.budget_status(_td.metering_history(spark, sf_dir), BUDGET_LIMIT))


# -------------------------------------------------------------- landing ----
@register("landing_roundtrip")
def landing_roundtrip(spark, sf_dir):
    """Write the decisions extract as gzip CSV (quoted money with commas,
    header), then land it back through the tolerant reader."""
    path = shared_dir(spark, "landing-decisions")
    raw = _td.raw_funding_decisions(spark, sf_dir)
    _landing.write_landing_csv(raw, path)
    return _landing.read_landing(spark, path, _landing.LANDING_SCHEMAS["funding_decisions"])


@register("append_load")
def append_load(spark, sf_dir):
    """The decisions extract arrives in two parts that add up in one table; the
    load of the first is run twice and takes its files once."""
    inbox = shared_dir(spark, "append-inbox")
    raw = _td.raw_funding_decisions(spark, sf_dir)
    deferred = F.coalesce(F.lower("decision") == "deferred", F.lit(False))
    ledger = Ledger(spark, shared_dir(spark, "append-load"), _landing.LANDING_SCHEMAS["funding_decisions"], "decision_id")
    for i, (part, times) in enumerate(((raw.where(deferred), 2), (raw.where(~deferred), 1))):
        _landing.write_landing_csv(part, f"{inbox}/part{i}")
        for _ in range(times):
            ledger.load(f"{inbox}/part*", glob="*.csv.gz")
    return ledger.rows().drop("ragged")


@register("load_report")
def load_report(spark, sf_dir):
    """Rows loaded, ragged and rejected in each drop of the ragged enrollment
    extract, from the ledger's account of its files."""
    inbox = shared_dir(spark, "report-inbox")
    ledger = Ledger(spark, shared_dir(spark, "report-load"), _landing.LANDING_SCHEMAS["enrollments"], "enrollment_id")
    lines = _ragged_enrollment_lines(spark, sf_dir, keep_line_key=True)
    for i in range(2):
        lines.where(F.col("_k") % 2 == i).select("value").write.text(f"{inbox}/drop{i}")
        ledger.load(f"{inbox}/drop*", header=False, glob="part-*")
    drop = F.regexp_extract("path", "/(drop[0-9]+)/", 1).alias("drop")
    return ledger.entries().groupBy(drop).agg(*[F.sum(c).alias(c) for c in ("loaded", "ragged", "rejected")])


@register("padded_fields")
def padded_fields(spark, sf_dir):
    """Blanks around every field of a line are trimmed at load."""
    path = shared_dir(spark, "landing-padded")
    e = _td.raw_enrollments(spark, sf_dir)
    padded = F.concat_ws(" , ", *[F.concat(F.lit("  "), F.coalesce(F.col(c), F.lit("NULL"))) for c in e.columns])
    e.select(F.concat(padded, F.lit("   ")).alias("value")).write.text(path)
    return _landing.read_landing(spark, path, _landing.LANDING_SCHEMAS["enrollments"], header=False)


@register("quoted_line_breaks")
def quoted_line_breaks(spark, sf_dir):
    """Names over two lines, quoted: still one record each."""
    path = shared_dir(spark, "landing-line-breaks")
    raw = _td.raw_applications(spark, sf_dir)
    broken = raw.withColumn("institution_name", F.concat("institution_name", F.lit("\nMain, Campus")))
    _landing.write_landing_csv(broken, path, compression="none")
    return _landing.read_landing(spark, path, _landing.LANDING_SCHEMAS["applications"], multi_line=True)


@register("incremental_line_breaks")
def incremental_line_breaks(spark, sf_dir):
    """Two drops of names over two lines through the incremental path: every
    record lands once."""
    from fundlake.streaming.incremental import land_new_files
    inbox, table, ckpt = (shared_dir(spark, f"breaks-{n}") for n in ("inbox", "landed", "ckpt"))
    raw = _td.raw_applications(spark, sf_dir)
    broken = raw.withColumn("institution_name", F.concat("institution_name", F.lit("\nMain, Campus")))
    late = F.coalesce(F.col("status").isin("Pending", "pending"), F.lit(False))
    schema = _landing.LANDING_SCHEMAS["applications"]
    for i, part in enumerate((broken.where(late), broken.where(~late))):
        _landing.write_landing_csv(part, f"{inbox}/drop{i}", compression="none")
        land_new_files(spark, f"{inbox}/drop*", schema, table, ckpt, multi_line=True)
    return spark.read.parquet(table).drop("batch")


@register("sql_functions")
def sql_functions(spark, sf_dir):
    """The parsers as SQL functions."""
    from fundlake.functions.sql import register_sql_functions
    register_sql_functions(spark)
    _w(spark, sf_dir).raw["funding_decisions"].createOrReplaceTempView("landed_decisions")
    return parity(spark.sql("""SELECT decision_id, parse_any_date(decision_date) AS decision_date,
                                      money_to_number(approved_amount) AS approved_amount
                               FROM landed_decisions"""))


def _ragged_enrollment_lines(spark, sf_dir, keep_line_key: bool = False) -> DataFrame:
    """Enrollment extract as text lines: every 23rd line lost its last
    field, every 19th has an extra one, every 37th has no id."""
    e = _td.raw_enrollments(spark, sf_dir, keep_line_key=True)
    k = F.col("_k")
    first4 = F.concat_ws(",", F.when(k % 37 == 0, F.lit("")).otherwise(F.col("enrollment_id")),
                         *[F.coalesce(F.col(c), F.lit("")) for c in
                           ("institution_id", "program_code", "fiscal_year")])
    head = F.coalesce(F.col("headcount"), F.lit(""))
    line = (F.when(k % 23 == 0, first4)
            .when(k % 19 == 0, F.concat_ws(",", first4, head, F.lit("extra")))
            .otherwise(F.concat_ws(",", first4, head)))
    return e.select(line.alias("value"), *(["_k"] if keep_line_key else []))


@register("split_rejects")
def split_rejects(spark, sf_dir):
    path = shared_dir(spark, "landing-enrollments")
    _ragged_enrollment_lines(spark, sf_dir).write.mode("overwrite").text(path)
    landed = _landing.read_landing(spark, path, _landing.LANDING_SCHEMAS["enrollments"],
                                   keep_raw_line=True, header=False)
    good, _rejects = _landing.split_rejects(landed, "enrollment_id")
    return _landing.with_ragged_flag(good)


@register("landing_rejects")
def landing_rejects(spark, sf_dir):
    """The rows the ragged enrollment extract could not key (no id): they
    are accounted for, not silently lost."""
    path = shared_dir(spark, "landing-enrollments-rejects")
    _ragged_enrollment_lines(spark, sf_dir).write.mode("overwrite").text(path)
    landed = _landing.read_landing(spark, path, _landing.LANDING_SCHEMAS["enrollments"],
                                   keep_raw_line=True, header=False)
    _good, rejects = _landing.split_rejects(landed, "enrollment_id")
    return _landing.with_ragged_flag(rejects)


@register("file_listing")
def file_listing(spark, sf_dir):
    """The staged files of an extract, beside the rows they hold (names and
    sizes depend on the writer and the codec)."""
    path = shared_dir(spark, "landing-listing")
    raw = _td.raw_funding_decisions(spark, sf_dir)
    _landing.write_landing_csv(raw.repartition(3), path)
    files = _landing.list_files(spark, path, glob="*.csv.gz").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("file_size") > 0).alias("n_with_bytes"))
    rows = _landing.read_landing(spark, path, _landing.LANDING_SCHEMAS["funding_decisions"]).agg(
        F.count(F.lit(1))).scalar()
    return files.withColumn("n_rows", rows)


@register("incremental_landing")
def incremental_landing(spark, sf_dir):
    """The decisions extract arrives as two drops (odd then even order
    keys); two incremental runs - plus a third with nothing new - land
    every row exactly once."""
    from fundlake.streaming.incremental import land_new_files
    inbox = shared_dir(spark, "inbox-decisions")
    table = shared_dir(spark, "landed-decisions")
    ckpt = shared_dir(spark, "ckpt-decisions")
    raw = _td.raw_funding_decisions(spark, sf_dir)
    half = F.substring_index(F.col("decision_id"), "-", -1).cast("bigint") % 2
    schema = _landing.LANDING_SCHEMAS["funding_decisions"]
    for part in (1, 0):
        _landing.write_landing_csv(raw.where(half == part), f"{inbox}/drop{part}")
        land_new_files(spark, f"{inbox}/drop*", schema, table, ckpt)
    land_new_files(spark, f"{inbox}/drop*", schema, table, ckpt)
    return spark.read.parquet(table)


@register("incremental_ragged")
def incremental_ragged(spark, sf_dir):
    """Ragged lines and lines without an id through the incremental path: the
    same good rows and rejects as the batch reader, flagged by where they went."""
    from fundlake.streaming.incremental import land_new_files
    inbox, good, bad, ckpt = (shared_dir(spark, f"ragged-{n}") for n in ("inbox", "good", "rejects", "ckpt"))
    _ragged_enrollment_lines(spark, sf_dir).write.text(inbox)
    schema = _landing.LANDING_SCHEMAS["enrollments"]
    for _ in range(2):               # the second run finds nothing new
        land_new_files(spark, inbox, schema, good, ckpt, key="enrollment_id", rejects_path=bad, header=False)
    parts = [spark.read.parquet(p).drop("batch").withColumn("rejected", F.lit(r)) for p, r in ((good, False), (bad, True))]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------ snapshots ----
SNAP_T1, SNAP_T2, SNAP_READ = "2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 00:30:00"


@register("as_of_snapshot")
def as_of_snapshot(spark, sf_dir):
    """Two refreshes of fact_applications an hour apart (the second one
    after every pending application was approved); reading half-way
    returns the first."""
    fa = _layers(spark, sf_dir).star["fact_applications"]
    path = shared_dir(spark, "snap-fact-applications")
    _snap.write_snapshot(fa, path, SNAP_T1)
    _snap.write_snapshot(fa, path, SNAP_T1)          # a retried refresh counts once
    later = fa.withColumn("status", F.when(F.col("status") == "Pending", F.lit("Approved"))
                          .otherwise(F.col("status")))
    _snap.write_snapshot(later, path, SNAP_T2)
    return parity(_snap.as_of(spark, path, SNAP_READ))
