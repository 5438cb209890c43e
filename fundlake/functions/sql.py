"""The cleansing functions as SQL functions, for users who write SQL.

They are SQL-bodied temporary functions (no Python at run time): Catalyst
inlines the body into the calling query like any built-in expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from fundlake.functions.dates import parse_any_date_sql


def register_sql_functions(spark: SparkSession) -> None:
    """parse_any_date(d) -> DATE, try_number(s) -> DECIMAL(38,0),
    money_to_number(s) -> DECIMAL(38,0)."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION parse_any_date(d STRING) "
              f"RETURNS DATE RETURN {parse_any_date_sql('d')}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION try_number(s STRING) "
              "RETURNS DECIMAL(38,0) RETURN try_cast(s AS DECIMAL(38,0))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION money_to_number(s STRING) "
              "RETURNS DECIMAL(38,0) RETURN try_cast(translate(s, '$,', '') AS DECIMAL(38,0))")
