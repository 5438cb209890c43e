"""Run the pipeline over a landing folder and print the reports.

    python -m fundlake --landing /data/extracts [--out /shared/layers]
                       [--role ANALYST] [--rows 20]

The landing folder holds one sub-folder (or file) per extract:
institutions, applications, enrollments, funding_decisions, disbursements.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="fundlake")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--out")
    ap.add_argument("--role", default="ANALYST")
    ap.add_argument("--entitlements", help="CSV of role_name,institution_id (header)")
    ap.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)

    from fundlake.plans import pipeline, reports, silver

    spark = SparkSession.builder.appName("fundlake").getOrCreate()
    w = pipeline.from_landing_folder(spark, args.landing, args.out)
    layers = w.layers()
    ent = (spark.read.option("header", True).csv(args.entitlements) if args.entitlements
           else pipeline.entitlements(spark))
    tables = pipeline.registry_for(spark, layers, ent, dim_rows=None).secured_tables(layers.tables(), args.role)
    silver.quality_report(layers.raw, layers.silver).orderBy("ordinal").show(truncate=False)
    for name, df in reports.views(tables).items():
        print(f"== {name} (as {args.role})")
        df.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
