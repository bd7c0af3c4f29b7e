"""Rows of CSV files with line breaks inside quotes, read by many tasks per file.

A line ends a row if the quotes up to its end are even in number (a doubled quote inside
quotes counts as two).  Spark deals a file into ranges of lines.  One pass counts the quotes of
each range; sums over the ranges before tell which ranges begin inside quotes.  A second pass
cuts every range into rows by itself.  A row that runs over the end of a range is left in
pieces, at most two a range, which are put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagegrid import settings

_PIECES = "file string, block long, kind int, value string"
#: Kinds of pieces, in the order they have within a range: the end of a row that began before,
#: a whole row, the beginning of a row that ends later, the same of a header row.
_END, _ROW, _BEGIN, _HEADER = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where the range begins), seq (order of lines in a task), value."""
    # a carriage return before the line feed, or alone in quotes, stays in the value
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value",
    )


def _open_ranges(lines: DataFrame) -> DataFrame:
    """(file, block, open): the ranges that begin inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = counted.withColumn("open", F.sum("quotes").over(before) % 2 == 1)
    return odd.where("open").select("file", "block", "open")


def _cut(batches: Iterable[pa.RecordBatch], header: bool) -> Iterator[pa.RecordBatch]:
    """Lines of ranges, in order, to rows and pieces of rows, without header rows."""
    here: tuple[str, int] | None = None
    held: list[str] = []  # lines of a row that is not complete yet
    kind, odd = _ROW, False  # what a row that ends now is, and whether a quote is open
    head = False  # whether the next row is the header

    def made(values: pa.Array, kinds: np.ndarray) -> pa.RecordBatch:
        n = len(values)
        return pa.record_batch({
            "file": pa.array([here[0]] * n, pa.string()), "block": pa.array([here[1]] * n, pa.int64()),
            "kind": pa.array(kinds, pa.int32()), "value": values.cast(pa.string()),
        })

    def left_over() -> Iterator[pa.RecordBatch]:
        if held:
            # a range that lies inside quotes as a whole neither begins nor ends the row
            name = _END if kind == _END else _HEADER if head else _BEGIN
            yield made(pa.array(["\n".join(held)], pa.string()), np.array([name]))

    for batch in batches:
        files, blocks = batch.column("file"), batch.column("block").to_numpy()
        changes = np.flatnonzero(np.diff(blocks)) + 1
        if files[0].as_py() != files[len(files) - 1].as_py():
            names = files.dictionary_encode().indices.to_numpy()
            changes = np.union1d(changes, np.flatnonzero(np.diff(names)) + 1)
        edges = [0, *changes.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            now = (files[a].as_py(), int(blocks[a]))
            if now != here:
                if here is not None:
                    yield from left_over()
                here, held = now, []
                odd = bool(batch.column("open")[a].as_py())
                kind = _END if odd else _ROW
                head = header and here[1] == 0
            values = batch.column("value").slice(a, b - a)
            after = (odd + np.cumsum(pc.count_substring(values, '"').to_numpy())) % 2
            ends = np.flatnonzero(after == 0)
            if len(ends) == b - a and not held and kind == _ROW:
                values, head = values.slice(int(head)), False
                if len(values):
                    yield made(values, np.full(len(values), _ROW))
            else:
                lines, out, kinds, start = values.to_pylist(), [], [], 0
                for end in ends.tolist():
                    if not head:
                        out.append("\n".join([*held, *lines[start : end + 1]]))
                        kinds.append(kind)
                    held, kind, start, head = [], _ROW, end + 1, False
                held = held + lines[start:]
                if out:
                    yield made(pa.array(out, pa.string()), np.array(kinds))
            odd = bool(after[-1])
    if here is not None:
        yield from left_over()


def csv_rows(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``value``: the text of every row of the CSV files at ``path``, without header rows and
    empty rows.

    Files are read twice, by as many tasks as their size asks for.  A row may run over any
    number of lines and ranges; a quote that is never closed makes the rest of its file one row.
    """
    lines = _lines(spark, path)
    opened = settings.written(_open_ranges(lines), "csv-open")
    small = settings.small_side(opened)
    tagged = lines.join(small, ["file", "block"], "left")
    if small is opened:  # too many to send to all tasks: the join deals the lines anew
        tagged = tagged.repartition("file", "block").sortWithinPartitions("file", "block", "seq")
    pieces = tagged.select("file", "block", "open", "value").mapInArrow(lambda batches: _cut(batches, header), _PIECES)
    whole = pieces.where(F.col("kind") == _ROW).select("value")

    begins = F.col("kind").isin(_BEGIN, _HEADER).cast("int")
    parts = pieces.where(F.col("kind") != _ROW)
    parts = parts.withColumn("row", F.sum(begins).over(Window.partitionBy("file").orderBy("block", "kind")))
    ordered = F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("parts")
    joined = parts.groupBy("file", "row").agg(ordered).where(F.col("parts")[0]["kind"] != _HEADER)
    rows = whole.unionByName(joined.select(F.array_join("parts.value", "\n").alias("value")))
    return rows.select(F.regexp_replace("value", r"\r$", "").alias("value")).where(F.trim("value") != "")
