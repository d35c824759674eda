"""JDBC sources (warehouse and analytics databases), read in parallel.

``pd.read_sql`` pulls a whole query through one connection into one
process; here a table is read by ``numPartitions`` range queries over a
numeric column, only the selected columns are fetched, and filters are
pushed into the database. Credentials come from the caller's options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, columns: list[str] | None = None,
               partition_column: str | None = None, bounds: tuple[int, int] | None = None,
               num_partitions: int = 64, fetch_size: int = 10000, **options) -> DataFrame:
    """Read ``table`` (or a ``(SELECT ...) t`` subquery) over JDBC.

    With ``partition_column`` and ``bounds`` the read is split into
    ``num_partitions`` parallel range queries; pass bounds from the caller's
    own metadata rather than a driver-side ``MIN/MAX`` scan.
    """
    if (partition_column is None) != (bounds is None):
        raise ValueError("partition_column and bounds go together: one without the other would read in one task")
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetch_size)))
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
                  .option("numPartitions", str(num_partitions)))
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load()
    return df.select(*columns) if columns else df


def analytics_users(spark: SparkSession, url: str, bounds: tuple[int, int], **options) -> DataFrame:
    """The seven user columns the analytics link needs (SRC-5), read in ranges of ``id`` between ``bounds``."""
    return read_table(spark, url, "rdm.users",
                      ["id", "first_name", "last_name", "email", "created_at", "updated_at", "active"],
                      partition_column="id", bounds=bounds, **options)


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10000,
                num_partitions: int | None = None, **options) -> None:
    """Batched JDBC write (``fast_executemany`` counterpart); parallelism is
    capped by ``num_partitions`` so the database is not flooded."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).mode(mode))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
