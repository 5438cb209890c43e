"""Tables, views and SQL functions for SQL users: layer namespaces,
create-or-replace tables, appends, literal inserts, views by name, SQL
functions and per-role secured views."""

import datetime as dt
from decimal import Decimal

import pytest

from fundlake.functions.sql import register_sql_functions
from fundlake.operators import governance as gov
from fundlake.sources.landing import create_layers, insert_rows, load, save


def test_layers_tables_and_inserts(spark):
    create_layers(spark)
    assert {"raw", "silver", "star"} <= {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()}
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    save(df, "silver.t_demo")
    save(df.union(df), "silver.t_demo")            # create-or-replace
    assert spark.table("silver.t_demo").count() == 2
    load(df, "raw.t_append")
    load(df, "raw.t_append")                        # append
    assert spark.table("raw.t_append").count() == 2
    save(spark.createDataFrame([], "role_name string, institution_id string"), "star.role_map")
    insert_rows(spark, "star.role_map", [("INSTITUTION_USER", "INST-002")],
                "role_name string, institution_id string")
    assert [tuple(r) for r in spark.table("star.role_map").collect()] == [
        ("INSTITUTION_USER", "INST-002")]


def test_sql_functions_match_column_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("""SELECT parse_any_date('03/04/2023') a, parse_any_date('01/15/2023') b,
                            parse_any_date('soon') c, try_number('123.5') d,
                            money_to_number('$1,250,000') e""").first()
    assert tuple(r) == (dt.date(2023, 4, 3), dt.date(2023, 1, 15), None, Decimal(124),
                        Decimal(1250000))


def test_secured_views_for_sql(spark):
    dim = spark.createDataFrame([(1, "INST-001"), (2, "INST-002")],
                                "institution_key long, institution_id string")
    fact = spark.createDataFrame([("e1", 1, 5.0), ("e2", 2, 9.0), ("e3", 2, 30.0)],
                                 "enrollment_id string, institution_key long, headcount double")
    ent = spark.createDataFrame([("INSTITUTION_USER", "INST-002")],
                                "role_name string, institution_id string")
    reg = gov.standard_registry(ent, dim)
    gov.register_secured_views(spark, reg, {"fact_enrollments": fact}, "INSTITUTION_USER",
                               prefix="sec_")
    rows = spark.sql("SELECT enrollment_id, headcount FROM sec_fact_enrollments "
                     "ORDER BY enrollment_id").collect()
    assert [tuple(r) for r in rows] == [("e2", None), ("e3", 30.0)]


def test_cluster_conf_sizes_partitions():
    from fundlake.session import cluster_conf
    c = cluster_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(10 * 2**20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_written_layers_as_sql_tables(spark, tmp_path):
    """SQL users query star.* / silver.* by name and see what the frames hold."""
    from pyspark.sql import functions as F

    from fundlake.plans import pipeline
    w = pipeline.written(spark, "/root/testdata/sf0.001")
    names = w.register(spark)
    assert "star.fact_applications" in names and "v_funding_equity" in names
    by_stream = spark.sql("""SELECT funding_stream, status, count(*) AS n, max(submission_date) AS newest
                             FROM star.dim_funding_type NATURAL JOIN star.fact_applications GROUP BY ALL""")
    want = (w.star["fact_applications"].join(w.star["dim_funding_type"], "funding_type_key")
            .groupBy("funding_stream", "status").agg(F.count("*"), F.max("submission_date")))
    assert sorted(map(tuple, by_stream.collect())) == sorted(map(tuple, want.collect()))
    assert spark.sql("SELECT count(*) FROM silver.applications").first()[0] == \
        w.silver["applications"].count()


def test_a_role_meets_governed_objects_only(spark):
    from fundlake.plans import pipeline
    w = pipeline.written(spark, "/root/testdata/sf0.001")
    w.register(spark)
    names = w.register(spark, role="INSTITUTION_USER")
    assert all(n.startswith(("secured_", "v_")) for n in names)
    assert not any(spark.catalog.tableExists(f"{layer}.{n}") for layer in ("raw", "silver", "star")
                   for n in getattr(w, layer))
    seen = spark.sql("SELECT count(*) FROM secured_fact_applications").first()[0]
    assert 0 < seen < w.star["fact_applications"].count()
    assert spark.sql("SELECT count(*) FROM secured_fact_enrollments WHERE headcount < 10").first()[0] == 0


@pytest.mark.parametrize("name", ["FACT_APPLICATIONS", "star.fact_applications", "`star`.`Fact_Applications`"])
def test_every_spelling_meets_the_policy(spark, name):
    from fundlake.plans import pipeline
    w = pipeline.written(spark, "/root/testdata/sf0.001")
    reg = pipeline.registry_for(spark, w.layers())
    fact = w.star["fact_applications"]
    assert reg.secure(name, fact, "NOBODY").count() == 0
    for unknown in ("fact_aplications", "silver.applications", ""):
        with pytest.raises(PermissionError):
            reg.secure(unknown, fact, "ANALYST")


def test_register_leaves_foreign_tables_alone(spark):
    from fundlake.plans import pipeline
    w = pipeline.written(spark, "/root/testdata/sf0.001")
    w.register(spark, role="INSTITUTION_USER")
    load(spark.createDataFrame([(1,)], "x int"), "raw.applications")
    with pytest.raises(ValueError, match="raw.applications"):
        w.register(spark)
    assert spark.table("raw.applications").count() == 1
    spark.sql("DROP TABLE raw.applications")
    w.register(spark)
    assert spark.table("raw.applications").count() == w.raw["applications"].count()


def test_shared_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    from fundlake.session import shared_base
    bare = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://x:7077", getCheckpointDir=lambda: None),
                           conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_base(bare)


def test_clear_shared_removes_what_the_session_made(spark, tmp_path):
    import os

    from fundlake import session
    kept = session._MADE.pop(spark.sparkContext.applicationId, [])
    path = session.shared_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.clear_shared(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
    session._MADE[spark.sparkContext.applicationId] = kept
