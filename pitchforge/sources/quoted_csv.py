"""CSV files whose quoted values hold newlines, read in splits.

``multiLine`` reads a file in one task.  Here the lines of a file are read in byte
ranges like any text, and whether a range starts inside quotes follows from the
quotes before it: the parity of each range's quotes, composed by prefix.  Within a
range the same parity, line by line, tells where records start.  A record that
leaves its range comes in fragments, which are joined; all others stay where they are.

Values hold quotes only as ``write_csv`` writes them: around the value, doubled
inside.  Records end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchforge.session import cut_lineage
from pitchforge.sources.files import read_csv_strings

#: Pieces of records: complete, the head of one that goes on in the next range, or what follows a head.
WHOLE, HEAD, MORE = 0, 1, 2
PIECES = "file string, start long, kind int, header boolean, text string"
#: Ranges (a path and two numbers each) that are broadcast; beyond that, lines are shuffled to their range.
MAX_RANGES = 100_000


def ranges_of_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in order (``n``) with their file, the first byte of their range and the number of their quotes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
                        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
                        F.monotonically_increasing_id().alias("n"))


def open_ranges(lines: DataFrame) -> DataFrame:
    """(file, start, open): a row for each range; open is 1 if it starts inside quotes."""
    parity = lines.groupBy("file", "start").agg(F.sum("quotes").alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select("file", "start", F.pmod(F.coalesce(F.sum("n").over(before), F.lit(0)), F.lit(2)).cast("int").alias("open"))


def with_open(lines: DataFrame, state: DataFrame, max_ranges: int = MAX_RANGES) -> DataFrame:
    """Lines, still in order within their range, with the state in which it starts."""
    if state.count() <= max_ranges:
        known = lines.join(F.broadcast(state), ["file", "start"], "left")
    else:
        known = lines.join(state.hint("merge"), ["file", "start"], "left").repartition("file", "start") \
            .sortWithinPartitions("file", "start", "n")
    changed = F.raise_error(F.lit("the ranges of the files have changed since their quotes were counted"))
    return known.withColumn("open", F.coalesce("open", changed.cast("int"))).drop("n")


def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of consecutive lines of ranges, and fragments at the ranges' borders.

    The first record of a file's first range that isn't blank is its header.
    """
    columns = ["file", "start", "kind", "header", "text"]
    where, inside = None, 0    # range; in quotes
    held, begun = [], True     # lines of the record that is open, and whether it started in this range
    heading = False            # the file's header is still to come

    def row(kind):
        nonlocal heading
        text = "\n".join(held)
        header = heading and text.strip("\r") != ""
        heading = heading and not header
        return (*where, kind, header, text)

    def rest():
        return [row(HEAD if begun else MORE)] if held else []

    for pdf in batches:
        if not len(pdf):
            continue
        out, at = [], pd.MultiIndex.from_arrays([pdf["file"], pdf["start"]])
        key = pd.factorize(at)[0]
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(pdf)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):  # a batch may hold several ranges
            part, here = pdf.iloc[lo:hi], (at[lo][0], int(at[lo][1]))
            if here != where:
                out += rest()
                where, inside, held = here, int(part["open"].iloc[0]), []
                begun, heading = not inside, here[1] == 0
            after = (inside + np.cumsum(part["quotes"].to_numpy())) % 2
            inside = int(after[-1])
            for text, still in zip(part["value"], after, strict=True):
                held.append(text)
                if not still:
                    out.append(row(WHOLE if begun else MORE))
                    held, begun = [], True
        yield pd.DataFrame(out, columns=columns)
    yield pd.DataFrame(rest(), columns=columns)


def joined(parts: DataFrame) -> DataFrame:
    """Fragments joined to records; a fragment belongs to the last head at or before it in its file.

    A range gives two fragments at most.
    """
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == HEAD)
    owner = F.max(F.when(F.col("kind") == HEAD, F.col("start"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    grouped = parts.filter(F.col("kind") != WHOLE).withColumn("owner", owner).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("start", "text"))).alias("all"), F.bool_or("header").alias("header"))
    return grouped.select("header", F.array_join(F.transform("all", lambda x: x["text"]), "\n").alias("text"))


def read_csv_quoted(spark: SparkSession, path: str, max_ranges: int = MAX_RANGES) -> DataFrame:
    """Header row, every column a string; the rows of ``read_csv_strings`` with ``multi_line``.

    A file is read by as many tasks as it has ranges of ``spark.sql.files.maxPartitionBytes``.
    Its lines are scanned twice (for parities, then for records), and the records are written
    once to the shared folder.  A range that the second scan cuts elsewhere than the first
    (executors came in between) is an error, never a wrong row.  Blank lines are no records;
    columns are those of the header that Spark finds, and a short record has nulls at its end.
    Newlines within values stay as the file has them (``multi_line`` gives line feeds for
    the carriage returns of a file whose records end with them).
    """
    names = read_csv_strings(spark, path).columns
    lines = ranges_of_lines(spark, path)
    known = with_open(lines, cut_lineage(open_ranges(lines), "csv-ranges"), max_ranges)
    made = cut_lineage(known.mapInPandas(pieces, PIECES), "csv-records")
    records = made.filter(F.col("kind") == WHOLE).select("header", "text").unionByName(joined(made))
    text = F.regexp_replace("text", r"\r\z", "")
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    parsed = F.from_csv(text, schema, {"escape": '"', "multiLine": "true"})
    return records.filter(~F.col("header") & (text != "")).select(parsed.alias("r")).select("r.*")


__all__ = ["read_csv_quoted", "ranges_of_lines", "open_ranges", "with_open", "pieces", "joined", "MAX_RANGES"]
