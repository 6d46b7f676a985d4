"""Database connector (S8): read and write tables over JDBC.

Connection details are passed in by the caller (URL, user, password or a
credentials provider configured on the cluster); nothing is hard-coded.
Reads can be split over a numeric column so that executors fetch ranges in
parallel instead of one task pulling the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    batch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of the built-in `jdbc` source/sink."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size), "batchsize": str(batch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query  # type: ignore[assignment]
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned reads need lower_bound, upper_bound, num_partitions")
        if query is not None:
            raise ValueError("partitioned reads need table=, not query=")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def write_jdbc(df: DataFrame, mode: str = "append", **kwargs) -> None:
    """Append (the loader's `if_exists='append'`) or overwrite a table."""
    df.write.format("jdbc").options(**jdbc_options(**kwargs)).mode(mode).save()
