"""JDBC sources (S1, S2, S4) and the connection registry.

Connection details come from the caller (options or environment variables of
the caller's choosing); nothing here embeds a host or a password. Drivers are
external jars that must be on the classpath; they are named, not shipped.

Reads are parallel when a numeric/date ``partition_column`` is given: Spark
issues ``num_partitions`` range queries instead of one single-connection scan,
and pushes filters and the column list into each query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SourceKind:
    """URL template and driver class of one database kind."""

    driver: str
    url: str
    port: int | None = None


# URL templates, driver classes and default ports per kind.
SOURCE_KINDS = {
    "mysql": SourceKind("com.mysql.cj.jdbc.Driver", "jdbc:mysql://{host}:{port}/{database}", 3306),
    "sqlserver": SourceKind("com.microsoft.sqlserver.jdbc.SQLServerDriver",
                            "jdbc:sqlserver://{host}:{port};databaseName={database}", 1433),
    "postgres": SourceKind("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}", 5432),
    "snowflake": SourceKind("net.snowflake.client.jdbc.SnowflakeDriver",
                            "jdbc:snowflake://{account}.snowflakecomputing.com"),
    "derby": SourceKind("org.apache.derby.iapi.jdbc.AutoloadedDriver", "jdbc:derby:{database}"),
}


class ConfigError(ValueError):
    """A rule or connection names a kind or a URL part that is not configured."""


def jdbc_url(kind: str, **parts) -> str:
    """Fill the URL template of ``kind`` (S2). Missing parts raise."""
    if kind not in SOURCE_KINDS:
        raise ConfigError(f"no connection kind {kind!r}; known: {sorted(SOURCE_KINDS)}")
    k = SOURCE_KINDS[kind]
    values = dict(parts)
    if k.port is not None:
        values.setdefault("port", k.port)
    try:
        return k.url.format(**values)
    except KeyError as e:
        raise ConfigError(f"{kind} URL needs {e.args[0]!r}") from None


def jdbc_options(kind: str, table: str | None = None, query: str | None = None, *, user: str | None = None,
                 password: str | None = None, partition_column: str | None = None, lower_bound=None,
                 upper_bound=None, num_partitions: int | None = None, fetch_size: int | None = 10_000,
                 url: str | None = None, **parts) -> dict[str, str]:
    """Option map for ``spark.read.format("jdbc")``."""
    if (table is None) == (query is None):
        raise ConfigError("give exactly one of table or query")
    opts = {"url": url or jdbc_url(kind, **parts), "driver": SOURCE_KINDS[kind].driver}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ConfigError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return opts


def quoted_table(schema: str, table: str) -> str:
    """``"schema"."table"`` with embedded quotes doubled."""
    def q(s: str) -> str:
        return '"' + s.replace('"', '""') + '"'
    return f"{q(schema)}.{q(table)}"


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Lazy JDBC relation; select/filter afterwards are pushed into the query."""
    return spark.read.format("jdbc").options(**options).load()
