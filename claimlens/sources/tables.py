"""Driver parquet tables.  Selecting columns here lets the scan prune them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlens.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None, spread_by: str | None = None) -> DataFrame:
    """A table; ``spread_by`` deals a table of fewer file splits than cores to all of them by that column.

    A small table is often one row group, which one task would tokenise alone.  With as many splits as cores nothing moves.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, spread_by) if spread_by and df.rdd.getNumPartitions() < cores else df
