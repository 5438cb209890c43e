"""Row-level security, small-cell masking and a policy registry.

Policies are plain DataFrame rewrites applied *below* every report: a
restricted role's scan becomes a broadcast left-semi join against its
entitled keys, and a masked column becomes a CASE projection.  Catalyst
then pushes the report's own filters and aggregates on top.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.operators.lookup import bounded

# Roles that see every row and every cell.
PRIVILEGED_ROLES = ("ADMIN", "ENGINEER", "ANALYST", "AUDITOR")
# Cells below this count are suppressed for other roles.
SMALL_CELL_THRESHOLD = 10


@dataclass
class RowPolicy:
    """Privileged roles see all rows; any other role sees rows whose
    ``key`` maps (through ``dim``) to an institution it is entitled to.
    Rows with a NULL key are hidden from restricted roles; a role with no
    entitlement sees nothing."""

    key: str
    entitlements: DataFrame          # (role_name, institution_id)
    dim: DataFrame                   # (institution_key, institution_id)
    privileged: tuple = PRIVILEGED_ROLES
    dim_key: str = "institution_key"
    natural_key: str = "institution_id"
    dim_rows: int | None = None      # proven bound on dim rows (broadcast)
    dim_name: str = "dim_institution"    # the dimension's table, for session views

    def allowed_keys(self, role: str) -> DataFrame:
        ent = (self.entitlements.where(F.col("role_name") == F.lit(role))
               .select(F.col(self.natural_key).alias("_nat")))
        d = self.dim.select(F.col(self.dim_key).alias("_allowed"),
                            F.col(self.natural_key).alias("_nat"))
        return d.join(ent, "_nat", "left_semi").select("_allowed").distinct()

    def apply(self, df: DataFrame, role: str) -> DataFrame:
        if role in self.privileged:
            return df
        allowed = bounded(self.allowed_keys(role), self.dim_rows)
        return df.join(allowed, df[self.key] == F.col("_allowed"), "left_semi")


@dataclass
class MaskPolicy:
    """Values below ``threshold`` become NULL for non-privileged roles."""

    column: str
    threshold: int = SMALL_CELL_THRESHOLD
    privileged: tuple = PRIVILEGED_ROLES

    def apply(self, df: DataFrame, role: str) -> DataFrame:
        if role in self.privileged:
            return df
        c = F.col(self.column)
        masked = F.when(c < self.threshold, F.lit(None)).otherwise(c).cast(
            df.schema[self.column].dataType)
        return df.withColumn(self.column, masked)


# The role of an SQL session, set with SET VAR; no role at first.
ROLE_VARIABLE = "fundlake_role"


def _listed(names) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


def session_views(spark, registry: "Registry", sources: dict, entitlements: DataFrame, prefix: str = "session_") -> list[str]:
    """One set of temp views for all roles: they read the session's variable
    ``fundlake_role`` when a query is planned, so

        SET VAR fundlake_role = 'ANALYST'

    alone changes what the session sees.  Without a role nothing governed is
    visible.  ``sources``: table name -> (SQL of its relation, schema), whole
    relations that are not in the catalog.  The role is a constant of the plan: a
    privileged one leaves a plain scan, any other a left semi join on its keys.
    Policies attached to ``registry`` later need the views made anew.
    """
    role = f"system.session.{ROLE_VARIABLE}"
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT CAST(NULL AS STRING)")
    entitled = f"{prefix}entitlements"
    entitlements.createOrReplaceTempView(entitled)
    names = []
    for table, (relation, schema) in sources.items():
        tests, shown = [], {f.name: f"CAST(t.`{f.name}` AS {f.dataType.simpleString()})" for f in schema.fields}
        for p in registry.policies[registry._known(table)]:
            if isinstance(p, RowPolicy):
                dim = sources[p.dim_name][0]
                tests.append(f"""({role} IN ({_listed(p.privileged)}) OR EXISTS (
                    SELECT 1 FROM {entitled} e JOIN {dim} d ON d.`{p.natural_key}` = e.`{p.natural_key}`
                    WHERE e.role_name = {role} AND d.`{p.dim_key}` = t.`{p.key}`))""")
            else:
                c = shown[p.column]
                shown[p.column] = (f"CASE WHEN {role} IN ({_listed(p.privileged)}) THEN {c} "
                                   f"WHEN {c} < {p.threshold} THEN NULL ELSE {c} END")
        columns = ", ".join(f"{c} AS `{n}`" for n, c in shown.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{table} AS SELECT {columns} FROM {relation} t"
                  + (" WHERE " + " AND ".join(tests) if tests else ""))
        names.append(f"{prefix}{table}")
    return names


def plain_name(table: str) -> str:
    """A table's name without quoting, namespace or letter case, so that every
    spelling of a table meets the same policies."""
    return table.replace("`", "").strip().rpartition(".")[2].lower()


@dataclass
class Registry:
    """Table name -> attached policies.  Kept apart from the tables, so a
    full rebuild of a table never drops its policies.

    Closed by default: a table that was neither given a policy nor opened by
    name is refused, whoever asks.
    """

    policies: dict = field(default_factory=dict)

    def attach(self, table: str, policy) -> "Registry":
        self.policies.setdefault(plain_name(table), []).append(policy)
        return self

    def open(self, *tables: str) -> "Registry":
        """Name tables that anyone may read whole."""
        for t in tables:
            self.policies.setdefault(plain_name(t), [])
        return self

    def detach(self, table: str, policy_type=None) -> "Registry":
        """Take policies off; the table stays known (and open without any).  A
        name that is not known is refused, as a misspelt one would be opened."""
        name = self._known(table)
        self.policies[name] = [] if policy_type is None else [
            p for p in self.policies[name] if not isinstance(p, policy_type)]
        return self

    def _known(self, table: str) -> str:
        name = plain_name(table)
        if name not in self.policies:
            raise PermissionError(f"no policy is known for table {table!r}; attach one or open it by name")
        return name

    def secure(self, table: str, df: DataFrame, role: str) -> DataFrame:
        for p in self.policies[self._known(table)]:
            df = p.apply(df, role)
        return df

    def secured_tables(self, tables: dict, role: str) -> dict:
        """The same table mapping as seen by ``role``."""
        return {name: self.secure(name, df, role) for name, df in tables.items()}


def standard_registry(entitlements: DataFrame, dim_institution: DataFrame,
                      dim_rows: int | None = None) -> Registry:
    """Row policy on the three facts, small-cell mask on enrolment
    headcount."""
    rp = RowPolicy("institution_key", entitlements, dim_institution, dim_rows=dim_rows)
    reg = Registry()
    for t in ("fact_applications", "fact_disbursements", "fact_enrollments"):
        reg.attach(t, rp)
    reg.attach("fact_enrollments", MaskPolicy("headcount"))
    return reg.open("dim_institution", "dim_program", "dim_date", "dim_funding_type")


def rows_visible(registry: Registry, table: str, df: DataFrame, roles) -> DataFrame:
    """Row count of ``table`` as each role sees it (one row per role)."""
    parts = [registry.secure(table, df, r).agg(F.count(F.lit(1)).alias("rows_visible"))
             .select(F.lit(r).alias("role_name"), "rows_visible") for r in roles]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit(history: DataFrame, pattern: str, n: int = 20) -> DataFrame:
    """Who ran queries whose text matches ``pattern`` (case-insensitive
    LIKE), newest first."""
    hits = history.where(F.col("query_text").ilike(pattern))
    return (hits.select("query_id", "query_text", "user_name", "role_name", "start_time")
            .orderBy(F.col("start_time").desc_nulls_first(), F.col("query_id").asc())
            .limit(n))


def register_secured_views(spark, registry: Registry, tables: dict, role: str,
                           prefix: str = "") -> list[str]:
    """Temp views of every table as ``role`` sees it, for SQL users: the
    policies sit below whatever SQL is written on top."""
    names = []
    for name, df in registry.secured_tables(tables, role).items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
