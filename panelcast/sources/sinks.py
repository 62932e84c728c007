"""Writers for result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """Parquet folder; rows are grouped by the partition columns before the write so that
    each partition folder gets few files. AQE may split a large partition over tasks."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """Write each named table under ``root`` and return the paths."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        write_table(df, paths[name], mode=mode)
    return paths
