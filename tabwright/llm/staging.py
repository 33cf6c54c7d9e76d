"""Tables written to the shared folder and read back: they cut lineage and pin what a step gave."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabwright.functions.state import scratch_path


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """The rows of ``df``, computed once and stored as Parquet where all executors can read them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(columns: list[str], wanted: list[str]) -> list[str]:
    """The wanted names, with underscores in front as long as the table has columns of that name."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out
