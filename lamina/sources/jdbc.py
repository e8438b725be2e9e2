"""Relational sources through Spark's JDBC reader (SQL Server, PostgreSQL).

The driver jars are deployment matters and are not part of this package.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    driver: str
    user: str | None = None
    password: str | None = None

    def options(self) -> dict[str, str]:
        out = {"url": self.url, "driver": self.driver}
        if self.user is not None:
            out["user"] = self.user
        if self.password is not None:
            out["password"] = self.password
        return out


def sql_server_target(dsn: str) -> JdbcTarget:
    """Target from an ODBC style text (``Server=tcp:host,1433;Database=db;Uid=..;Pwd=..;``)."""
    parts = {}
    for item in dsn.split(";"):
        if "=" in item:
            key, value = item.split("=", 1)
            parts[key.strip().lower()] = value.strip()
    server = parts.get("server", parts.get("data source", ""))
    if not server:
        raise ValueError("connection text names no server")
    host, _, port = server.removeprefix("tcp:").partition(",")
    url = f"jdbc:sqlserver://{host}:{port or '1433'}"
    database = parts.get("database", parts.get("initial catalog"))
    if database:
        url += f";databaseName={database}"
    if parts.get("encrypt", "").lower() in ("yes", "true", "mandatory", "strict"):
        url += ";encrypt=true"
    return JdbcTarget(
        url,
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        parts.get("uid", parts.get("user id")),
        parts.get("pwd", parts.get("password")),
    )


def postgres_target(conn_str: str) -> JdbcTarget:
    """Target from a URI (``postgres://user:pw@host:5432/db``) or ``key=value`` pairs."""
    driver = "org.postgresql.Driver"
    if "://" in conn_str:
        parts = urlsplit(conn_str)
        query = "&".join(f"{k}={v}" for k, v in parse_qsl(parts.query))
        url = f"jdbc:postgresql://{parts.hostname}:{parts.port or 5432}/{parts.path.lstrip('/')}"
        return JdbcTarget(
            f"{url}?{query}" if query else url,
            driver,
            unquote(parts.username) if parts.username else None,
            unquote(parts.password) if parts.password else None,
        )
    pairs = dict(item.split("=", 1) for item in conn_str.split() if "=" in item)
    url = f"jdbc:postgresql://{pairs.get('host', 'localhost')}:{pairs.get('port', '5432')}"
    return JdbcTarget(f"{url}/{pairs.get('dbname', '')}", driver, pairs.get("user"), pairs.get("password"))


def read_options(
    target: JdbcTarget,
    query: str,
    split_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options for a query; with a split column it is read over several connections."""
    options = {**target.options(), "fetchsize": str(FETCH_SIZE)}
    if split_column is None:
        return {**options, "query": query}
    if lower is None or upper is None or not partitions:
        raise ValueError("a split read needs lower, upper and partitions")
    # Spark allows partitioned reads of a table expression only, not of the query option.
    return {
        **options,
        "dbtable": f"({query}) src",
        "partitionColumn": split_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_query(
    spark: SparkSession,
    target: JdbcTarget,
    query: str,
    split_column: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Result of ``query``; later filters on it (such as a watermark) are pushed to the server.

    For a split read the bounds come from one MIN/MAX query on the server; rows outside them
    would still be read, by the first and last partition.
    """
    lower = upper = None
    if split_column is not None:
        bounds = f"SELECT MIN({split_column}) AS lo, MAX({split_column}) AS hi FROM ({query}) src"
        row = spark.read.format("jdbc").options(**read_options(target, bounds)).load().first()
        lower, upper = row[0], row[1]
        if lower is None:
            split_column = None
    options = read_options(target, query, split_column, lower, upper, partitions)
    return spark.read.format("jdbc").options(**options).load()
