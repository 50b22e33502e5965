"""Row filters and column masks.

Open-source Spark has no ``SET ROW FILTER`` / ``SET MASK`` and no
``is_member()``; policies are therefore data (policy and membership tables)
and a secured *view* is built from them. Policies are part of the view's plan,
as a semi join and a scalar subquery, and so is the viewer
(``current_user()`` unless one is named): they are evaluated when the view is
read, so a policy that is revoked later takes effect. Deny is the default: a
viewer matched by no policy sees no rows and masked values.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import semi_by_values


def viewer(user: str | None = None) -> Column:
    """The named viewer, else the session user at the time the plan runs."""
    return F.current_user() if user is None else F.lit(user)


def groups_of(membership: DataFrame, user: str | None = None) -> DataFrame:
    """Groups of one user: the open-source stand-in for ``is_member``."""
    return membership.filter(F.col("user") == viewer(user)).select("group")


def _allowed_by_group(policy: DataFrame, membership: DataFrame, user: str | None) -> DataFrame:
    return policy.join(groups_of(membership, user), "group", "left_semi").select("value")


def _allowed_by_user(policy: DataFrame, user: str | None) -> DataFrame:
    return policy.filter(F.col("user") == viewer(user)).select("value")


def rls_group(df: DataFrame, column: str, policy: DataFrame, membership: DataFrame,
              user: str | None = None) -> DataFrame:
    """Rows whose ``column`` value a group of the viewer may see.

    ``policy``: ``group, value``; ``membership``: ``user, group``.
    """
    return semi_by_values(df, column, _allowed_by_group(policy, membership, user), "value")


def rls_user(df: DataFrame, column: str, policy: DataFrame, user: str | None = None) -> DataFrame:
    """Rows whose ``column`` value the viewer may see (R2); ``policy``: ``user, value``."""
    return semi_by_values(df, column, _allowed_by_user(policy, user), "value")


def _masked(df: DataFrame, columns: Sequence[str], visible: Column) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.when(visible, F.col(f"`{c}`")).otherwise(F.lit(None).cast(types[c])) for c in columns})


def is_member(membership: DataFrame, groups: Iterable[str], user: str | None = None) -> Column:
    """Whether the viewer belongs to any of ``groups``: a scalar subquery of the plan."""
    m = membership.filter((F.col("user") == viewer(user)) & F.col("group").isin(list(groups)))
    return m.agg((F.count(F.lit(1)) > 0).alias("member")).scalar()


def mask_group(df: DataFrame, columns: Sequence[str], allowed_groups: Iterable[str], membership: DataFrame,
               user: str | None = None) -> DataFrame:
    """Null the columns unless the viewer is in an allowed group."""
    return _masked(df, columns, is_member(membership, allowed_groups, user))


def mask_user(df: DataFrame, columns: Sequence[str], allowed_users: Iterable[str],
              user: str | None = None) -> DataFrame:
    """Null the columns unless the viewer is an allowed user."""
    return _masked(df, columns, viewer(user).isin(list(allowed_users)))


def secured_view(df: DataFrame, name: str, *, row_column: str | None = None, group_policy: DataFrame | None = None,
                 user_policy: DataFrame | None = None, membership: DataFrame | None = None,
                 masks: dict[str, Iterable[str]] | None = None, user: str | None = None) -> DataFrame:
    """Bind row and column policies to a table as a temporary view.

    Rows are visible when a group policy *or* a user policy allows them (no
    policy given: all rows); ``masks`` maps column -> allowed groups. A group
    policy or mask without a membership table allows nobody.
    """
    spark = df.sparkSession
    out = df
    if row_column is not None and (group_policy is not None or user_policy is not None):
        parts = []
        if group_policy is not None and membership is not None:
            parts.append(_allowed_by_group(group_policy, membership, user))
        if user_policy is not None:
            parts.append(_allowed_by_user(user_policy, user))
        out = (semi_by_values(out, row_column, reduce(lambda a, b: a.unionByName(b), parts), "value") if parts
               else out.filter(F.lit(False)))
    for col_name, groups in (masks or {}).items():
        out = _masked(out, [col_name], F.lit(False) if membership is None else is_member(membership, groups, user))
    out.createOrReplaceTempView(name)
    return spark.table(name)


def _sql_str(v: str) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def register_row_filter_function(spark: SparkSession, name: str, policy_rows: Sequence[tuple[str, str]],
                                 value_type: str = "STRING") -> None:
    """SQL function ``name(value, viewer) -> boolean`` from (user, value) policy rows.

    A SQL-bodied temporary function: the analyzer inlines its CASE, so it
    runs as an ordinary expression (no Python). The policy is written into the
    function body: for short lists; :func:`rls_user` takes a policy table.
    """
    whens = " ".join(f"WHEN viewer = {_sql_str(u)} AND v = {_sql_str(val)} THEN TRUE" for u, val in policy_rows)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v {value_type}, viewer STRING) RETURNS BOOLEAN "
              f"RETURN {f'CASE {whens} ELSE FALSE END' if whens else 'FALSE'}")


def register_mask_function(spark: SparkSession, name: str, allowed_users: Sequence[str],
                           value_type: str = "DOUBLE") -> None:
    """SQL function ``name(value, viewer)`` returning the value for allowed viewers, else null."""
    users = ", ".join(_sql_str(u) for u in allowed_users) or "NULL"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v {value_type}, viewer STRING) RETURNS {value_type} "
              f"RETURN CASE WHEN viewer IN ({users}) THEN v ELSE NULL END")


def policy_frame(spark: SparkSession, rows: Sequence[tuple[str, str]], who: str = "group") -> DataFrame:
    """Policy table from config rows: ``(group|user, value)``."""
    return spark.createDataFrame(list(rows), f"`{who}` string, value string")


def membership_frame(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    """Membership table ``(user, group)``."""
    return spark.createDataFrame(list(rows), "user string, `group` string")
