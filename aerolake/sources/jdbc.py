"""Optional relational sink through Spark's JDBC data source.

Connection settings come from the caller (e.g. a secrets manager); nothing is
read from process environment files. MySQL is the default dialect and
PostgreSQL the alternative; a database name given as ``db/schema`` keeps only
the database part. Writes are batched inserts issued by the executors, one
transaction per partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

DRIVERS = {
    "mysql": ("com.mysql.cj.jdbc.Driver", "jdbc:mysql://{host}:{port}/{database}", 3306),
    "postgresql": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}", 5432),
}
DEFAULT_BATCH_SIZE = 50_000


@dataclass
class JdbcTarget:
    host: str
    database: str
    user: str
    password: str
    port: int | None = None
    dialect: str = "mysql"

    def normalised_dialect(self) -> str:
        d = (self.dialect or "mysql").lower()
        return "postgresql" if d in ("postgres", "postgresql") else "mysql"

    def create_schema_sql(self, schema: str) -> str:
        """S15 on the database side: ``CREATE SCHEMA IF NOT EXISTS`` with the dialect's quoting
        (double quotes for PostgreSQL, backticks for MySQL); run it with the database's client."""
        if not schema or any(ch in schema for ch in '`"'):
            raise ValueError(f"bad schema name: {schema!r}")
        quoted = f'"{schema}"' if self.normalised_dialect() == "postgresql" else f"`{schema}`"
        return f"CREATE SCHEMA IF NOT EXISTS {quoted}"

    def options(self, table: str, schema: str | None = None,
                batch_size: int = DEFAULT_BATCH_SIZE) -> dict[str, str]:
        if not self.password:
            raise ValueError("a password is required for the JDBC target")
        dialect = self.normalised_dialect()
        driver, url, default_port = DRIVERS[dialect]
        database = self.database.split("/")[0] if self.database else self.database
        qualified = f"{schema}.{table}" if schema else table
        return {
            "url": url.format(host=self.host, port=self.port or default_port, database=database),
            "driver": driver,
            "user": self.user,
            "password": self.password,
            "dbtable": qualified,
            "batchsize": str(int(batch_size)),
        }


def append_to_jdbc(df: DataFrame, target: JdbcTarget, table: str, schema: str | None = None,
                   batch_size: int = DEFAULT_BATCH_SIZE, max_connections: int | None = None) -> None:
    """Append ``df`` to ``schema.table``.

    ``max_connections`` is passed as the JDBC source's ``numPartitions``, the
    number of concurrent connections the database can take; each task streams
    its rows in ``batch_size`` inserts, one transaction per partition.
    """
    opts = target.options(table, schema, batch_size)
    if max_connections:
        opts["numPartitions"] = str(int(max_connections))
    df.write.format("jdbc").options(**opts).mode("append").save()


def read_jdbc_count(spark, target: JdbcTarget, table: str, schema: str | None = None) -> int:
    """S16 for the JDBC target: ``SELECT count(*)`` pushed down to the database."""
    opts = target.options(table, schema)
    opts["query"] = f"SELECT count(*) AS n FROM {opts.pop('dbtable')}"
    return spark.read.format("jdbc").options(**opts).load().first()[0]
