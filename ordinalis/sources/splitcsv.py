"""Records of large CSV files whose quoted cells hold line breaks, read by many tasks.

A line break ends a record unless an odd number of quotes comes before it in the file (a quote
inside a cell is doubled, so it counts twice). Files are scanned twice in their ordinary
splits. The first scan counts the quotes of each split; their running sum tells whether a split
starts inside a quoted cell, a bit per split. In the second, each task joins the lines of a
record, and leaves what crosses the edges of its split, two pieces at most, to be joined by file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_PIECES = "file string, split long, header boolean, part string, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line) in the order of the files: only line feeds end a line."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                        F.col("value").alias("line"))


def inside_quotes(lines: DataFrame) -> dict[str, np.ndarray]:
    """Per file the splits that start inside a quoted cell; eight bytes for each of them.

    A file whose quotes don't pair is refused.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split")
    parity = counts.select("file", "split", (F.sum("odd").over(before.rowsBetween(Window.unboundedPreceding, -1)) % 2).alias("inside"),
                           (F.sum("odd").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) % 2).alias("open"))
    found: dict[str, list[int]] = {}
    for row in parity.where("inside = 1 or open = 1").collect():
        if row["open"]:
            raise ValueError(f"{row['file']}: the quotes don't pair")
        found.setdefault(row["file"], []).append(row["split"])
    return {file: np.array(sorted(splits)) for file, splits in found.items()}


def _pieces(inside: dict[str, np.ndarray]):
    """Joins lines to records, a batch at a time: part is null for whole records, else head, middle or tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, open_lines, odd, seen, started = None, [], 0, False, True

        def out(records: list | pa.Array, header: list[bool], part: str | None) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array([place[0]] * n, pa.string()), pa.array([place[1]] * n, pa.int64()), pa.array(header, pa.bool_()),
                 pa.array([part] * n, pa.string()), pa.array(records, pa.string()) if isinstance(records, list) else records],
                names=["file", "split", "header", "part", "record"])

        def closed() -> Iterator[pa.RecordBatch]:
            """What is left open at the end of a split goes on in the next."""
            if open_lines:
                yield out(["\n".join(open_lines)], [place[1] == 0 and not seen], "head" if started else "middle")

        for batch in batches:
            files, splits, lines = batch.columns
            edges = [0, *(np.flatnonzero(np.diff(splits.to_numpy()) | (pc.not_equal(files[1:], files[:-1]).to_numpy(False)
                                                                        if len(files) > 1 else False)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                here = (files[a].as_py(), splits[a].as_py())
                if here != place:
                    yield from closed()
                    place, open_lines, seen = here, [], False
                    odd = int(here[1] in inside.get(here[0], ()))
                    started = not odd  # whether the open record began in this split
                some = lines.slice(a, b - a)
                parity = (odd + np.cumsum(pc.count_substring(some, '"').to_numpy())) % 2
                odd = int(parity[-1])
                ends = np.flatnonzero(parity == 0) + 1
                if not len(ends):
                    open_lines += some.to_pylist()
                    continue
                first = "\n".join([*open_lines, *some.slice(0, ends[0]).to_pylist()])
                if started:
                    yield out([first], [here[1] == 0 and not seen], None)
                    seen = True
                else:
                    yield out([first], [False], "tail")
                    started = True
                if len(ends) > 1:
                    offsets = pa.array((ends - ends[0]).astype(np.int32))
                    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, some.slice(ends[0], ends[-1] - ends[0])), "\n")
                    yield out(joined, [here[1] == 0 and not seen, *[False] * (len(joined) - 1)], None)
                    seen = True
                open_lines = some.slice(ends[-1]).to_pylist()
        if place:
            yield from closed()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, header): every record of the files with its line breaks, the first of a file marked.

    Records end with a line feed, or a carriage return and a line feed; empty ones are left out. Line
    breaks inside cells stay as they are, in files of either kind. Both
    scans must see the same splits; if they don't, the pieces don't fit and the job fails.
    """
    lines = _lines(spark, path)
    pieces = lines.mapInArrow(_pieces(inside_quotes(lines)), _PIECES)
    parts = F.sort_array(F.collect_list(F.struct("split", "part", "record")))
    in_file = Window.partitionBy("file").orderBy("split", F.when(F.col("part") == "tail", 0).otherwise(1))
    crossing = (pieces.where(F.col("part").isNotNull())
                .withColumn("n", F.sum((F.col("part") == "head").cast("int")).over(in_file))
                .groupBy("file", "n").agg(parts.alias("parts"), F.bool_or("header").alias("first")))
    kinds = F.array_join(F.col("parts.part"), " ")
    fits = kinds.rlike("^head( middle)* tail$")
    whole = F.when(fits, F.array_join(F.col("parts.record"), "\n")).otherwise(
        F.raise_error(F.concat(F.lit("the splits changed between two scans of "), F.col("file"))).cast("string"))
    # a header that crosses an edge is the whole of its file's first split
    both = (pieces.where(F.col("part").isNull()).select("record", "header")
            .unionByName(crossing.select(whole.alias("record"), F.col("first").alias("header"))))
    return both.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(F.length("record") > 0)


def cells(rows: DataFrame, header: list[str]) -> DataFrame:
    """One string column per name of ``header``; a first record with other names fails the job."""
    schema = ", ".join(f"`{name}` string" for name in header)
    cell = F.from_csv("record", schema, {"escape": '"', "multiLine": "true"})
    names = F.array(*[F.lit(name) for name in header])
    parsed = rows.withColumn("_c", cell)
    found = F.array(*[F.col("_c")[name] for name in header])
    wrong = F.raise_error(F.concat(F.lit("another header: "), F.col("record"))).cast("boolean")
    keep = F.when(~F.col("header"), True).when(found == names, False).otherwise(wrong)
    return parsed.where(keep).select(*[F.col("_c")[name].alias(name) for name in header])
