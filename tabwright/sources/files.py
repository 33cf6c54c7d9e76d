"""CSV and Parquet sources and sinks, and the overview of a loaded table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabwright.functions.types import replace_columns
from tabwright.sources.csv_records import read_records

# Texts a CSV uses for a missing value.
MISSING_TOKENS = (
    "", "NA", "N/A", "n/a", "<NA>", "#N/A", "#NA", "NaN", "nan", "-NaN", "-nan",
    "NULL", "null", "None", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN", "#N/A N/A",
)


def load_data(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """Read a CSV with a header. Missing-value tokens become NULL; a missing path is an error.

    Every column is read as text and cleaned of missing-value tokens first. Without a schema the types are then found by
    one aggregate over all rows (whole numbers, numbers, booleans, else text), so a column of numbers and ``NULL`` is a
    column of numbers. Quoted line breaks are kept, and large files are split all the same (``csv_records``), at the price of
    one more scan; ``multi_line=False`` saves it for files without quoted line breaks. Naming the schema saves another.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("multiLine", multi_line).option("escape", '"')
    if multi_line:
        columns = _reading(reader, path).columns  # from the first record
        if schema is not None:
            wanted = schema if isinstance(schema, T.StructType) else _parse(spark, schema)
            if [c.lower() for c in columns] != [f.name.lower() for f in wanted]:
                raise ValueError(f"the file has the columns {columns}, the schema {wanted.names}")
        read = read_records(spark, path, columns)
    if schema is None:
        clean = normalise_missing(read if multi_line else _reading(reader, path))
        return clean.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in _found_types(clean).items()])
    wanted = schema if isinstance(schema, T.StructType) else _parse(spark, schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    clean = normalise_missing(read.toDF(*wanted.names) if multi_line else _reading(reader.schema(text), path))
    return clean.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def _found_types(text: DataFrame) -> dict[str, str]:
    """The narrowest type that takes all values of each text column; text for a column without values."""
    kinds = ("bigint", "double", "boolean")
    checks = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(k).isNull()).alias(f"{i}_{k}")
              for i, c in enumerate(text.columns) for k in kinds]
    row = text.agg(*checks, *[F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(text.columns)]).first()
    return {c: next((k for k in kinds if row[f"{i}_n"] and not row[f"{i}_{k}"]), "string") for i, c in enumerate(text.columns)}


def _parse(spark: SparkSession, ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _reading(reader, path: str) -> DataFrame:
    try:
        return reader.csv(path)
    except AnalysisException as failure:
        if "PATH_NOT_FOUND" in str(failure):
            raise FileNotFoundError(f"data file not found: {path}") from failure
        raise


def normalise_missing(df: DataFrame) -> DataFrame:
    """Missing-value texts and NaN both become NULL."""
    new = {}
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            new[field.name] = F.when(~column.isin(*MISSING_TOKENS), column)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            new[field.name] = F.when(~F.isnan(column), column)
    return replace_columns(df, new) if new else df


def load_processed_data(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a curated table: Parquet by default, CSV when the path says so."""
    if path.rstrip("/").endswith(".csv"):
        return load_data(spark, path, schema)
    try:
        return spark.read.parquet(path)
    except AnalysisException as failure:
        if "PATH_NOT_FOUND" in str(failure):
            raise FileNotFoundError(f"processed data not found: {path}") from failure
        raise


def save_processed_data(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write a curated table as a directory of files, one per task; no single-file merge."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path.rstrip("/").endswith(".csv"):
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)
    return path


def dataset_overview(df: DataFrame) -> DataFrame:
    """Per column: type, rows in the table and non-null count, from one aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns],
    )
    records = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("_rows").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
            F.col(f"`{f.name}`").alias("non_null"),
        )
        for i, f in enumerate(df.schema)
    ])
    return counted.select(F.inline(records))
