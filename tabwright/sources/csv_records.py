"""CSV records of large files with quoted line breaks, read in as many tasks as the files have splits.

A line break ends a record only outside quotes, which a task that starts in the middle of a file cannot see. So one scan counts
the quotes of every split; their running parity tells for each split whether it starts inside quotes. The second scan cuts
records at true ends. What a split leaves open at its end, and what it finds before its first true start, are fragments,
at most two a split, which are put together afterwards.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

# tasks get the code of this module with them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT = ["file", "start"]
PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("record", pa.string())])
WHOLE, HEAD, TAIL = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files, in order within a split, and the split they come from."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _inside_at_start(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """For each split, whether it starts inside quotes. One short row per split comes to the driver."""
    quotes = F.sum(F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'))))
    rows = lines.groupBy(*SPLIT).agg((quotes % 2).cast("int").alias("odd")).toArrow().to_pylist()
    found, inside, file = {}, False, None
    for row in sorted(rows, key=lambda r: (r["file"], r["start"])):
        inside = inside if row["file"] == file else False
        file = row["file"]
        found[file, row["start"]] = inside
        inside ^= bool(row["odd"])
    return found


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array, bool]]:
    """(split, some of its lines, whether they are its last ones) in the order of the file."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0), batch.column(1)
        changed = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        cuts = [0, *(1 + np.flatnonzero(changed)).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            key = file[low].as_py(), start[low].as_py()
            if held:
                yield held[0], held[1], held[0] != key
            held = key, batch.column(2).slice(low, high - low)
    if held:
        yield held[0], held[1], True


def _cut(inside: dict[tuple[str, int], bool], header: list[str] | None):
    """Records and fragments of the splits of one task."""

    def rows(split, kind: int, records: list[str] | pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(records, pa.string())], schema=PIECES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, open_, kind, first = None, [], WHOLE, False
        for own, lines, last in _splits(batches):
            if own != split:
                split, open_, first = own, [], own[1] == 0
                within = inside[own]
                kind = HEAD if within else WHOLE
            odd = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_numpy(zero_copy_only=False).astype(bool)
            after = np.logical_xor.accumulate(np.concatenate(([within], odd)))[1:]  # inside quotes at the end of each line
            ends = np.flatnonzero(~after)
            if not len(ends):
                open_ += lines.to_pylist()
            else:
                starts = np.concatenate(([0], ends[:-1] + 1))
                several = np.flatnonzero(ends > starts)
                records = lines.take(pa.array(ends))
                if len(several) or open_:
                    records = records.to_pylist()
                    for k in several.tolist():
                        records[k] = "\n".join(lines[int(starts[k]):int(ends[k]) + 1].to_pylist())
                    if open_:
                        records[0] = "\n".join([*open_, records[0]])
                if kind == HEAD:
                    yield rows(split, HEAD, [records[0] if isinstance(records, list) else records[0].as_py()])
                    records = records[1:]
                    kind = WHOLE
                elif first:
                    top = records[0] if isinstance(records, list) else records[0].as_py()
                    names = next(csv.reader([top.lstrip("﻿").rstrip("\r")]), [])
                    if header is not None and names != header:
                        raise ValueError(f"{split[0]} has the columns {names} instead of {header}")
                    records = records[1:]
                first = False
                yield rows(split, WHOLE, records)
                open_ = lines[int(ends[-1]) + 1:].to_pylist()
            within = bool(after[-1])
            if last and open_:
                yield rows(split, HEAD if kind == HEAD else TAIL, ["\n".join(open_)])

    return work


def read_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns of CSV files with a header, as text. Empty records are left out.

    Quotes are doubled inside quotes. A quote in the middle of an unquoted value is not told apart from one that opens a
    quoted value; such files need ``multi_line=False``.
    """
    lines = _lines(spark, path)
    header = columns if len(set(c.lower() for c in columns)) == len(columns) else None
    pieces = lines.mapInArrow(_cut(_inside_at_start(lines), header), "file string, start long, kind int, record string")
    whole = pieces.where(F.col("kind") == WHOLE).select("record")
    # a record that goes over the end of a split is a tail and the heads behind it
    order = Window.partitionBy("file").orderBy("start", "kind")
    fragments = pieces.where(F.col("kind") != WHOLE).withColumn("number", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    joined = fragments.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"))
    joined = joined.select(F.array_join("parts.record", "\n").alias("record"))
    record = F.regexp_replace("record", "\r$", "")
    text = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(columns))])
    options = {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = whole.unionByName(joined).select(record.alias("record")).where("record <> ''")
    parsed = parsed.select(F.from_csv("record", text.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("r"))
    return parsed.select(*[F.col(f"r._{i}").alias(c) for i, c in enumerate(columns)])
