"""Benchmark decontamination (operator 9), in DataFrame functions only.

A benchmark item of n words is looked for in every window of n words of a text
(in the whole text, if that is shorter).  Words are runs of letters and digits
in lower case; shingles are five words (all words, for a shorter item).

1. Seeds: shingles that a text shares with any item of n words.  A window with
   weighted similarity t to an item shares at least t / (1 + t) of both sides'
   shingles, so windows with fewer seeds can't match; and of those that can, the
   best one starts at a seed or at the last place.  No match is lost here.
2. SimHash of each such window and of each item.  Within ``radius`` bits two
   fingerprints agree in one of radius + 1 blocks, so an equi-join on (n, block)
   finds all pairs within the radius.
3. Exact weighted similarity (shared over all shingles, with multiplicity) of
   those pairs, ``similarity`` or more.

An item and its copy with some words changed differ in a number of bits that
depends on the hashes: at similarity 0.8 about 10 of 64 with a deviation of 3,
so the radius of 19 is meant to hold all of them; what lies beyond is not found.

Null and empty texts match nothing, as do items without words or with a null
text; repeated rows and items each get rows of their own; null ids stay null;
empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, narrow, small_side, with_row_id

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 19


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once in each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order; empty if there are fewer words."""
    return F.when(F.size(words) >= width, F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))).otherwise(F.array().cast("array<bigint>"))


def simhash(shingles: str) -> Column:
    """64-bit SimHash of an array column; a bit is set if more than half of the hashes have it."""
    return F.expr(f"""aggregate(sequence(0, 63), 0L, (bits, b) -> bits | if(
        2 * aggregate({shingles}, 0, (n, h) -> n + cast(shiftrightunsigned(h, b) & 1L as int)) > size({shingles}),
        shiftleft(1L, b), 0L))""")


def blocks(fp: Column, radius: int) -> Column:
    """Array of (number, content) of the radius + 1 blocks of a fingerprint."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(i).alias("at"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))])


def items_table(benchmark: DataFrame, radius: int, item_col: str, text_col: str) -> DataFrame:
    """Rows (item_id, n, k, shingles, fp) of items with words: n words, shingles of k."""
    src = narrow(benchmark, item_id=item_col, text=text_col).select("item_id", word_hashes(F.col("text")).alias("words"))
    src = src.where(F.size("words") > 0).withColumns({"n": F.size("words"), "k": F.least(F.size("words"), F.lit(SHINGLE))})
    pick = F.coalesce(*[F.when(F.col("k") == k, shingle_hashes(F.col("words"), k)) for k in range(1, SHINGLE + 1)])
    src = src.select("item_id", "n", "k", pick.alias("shingles"))
    return src.withColumn("fp", simhash("shingles"))


def candidate_windows(texts: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """Rows (rid, windows array<struct<n, k, start>>) of texts that may hold an item."""
    seeds = materialize(items.select("n", "k", F.explode("shingles").alias("h")).distinct(), "seeds")
    widths = [r["k"] for r in items.select("k").distinct().orderBy("k").collect()]  # at most SHINGLE values
    hits = None
    for k in widths or [SHINGLE]:
        at = texts.select("rid", word_hashes(F.col("text")).alias("words")).select(
            "rid", F.size("words").alias("size"), F.posexplode(shingle_hashes(F.col("words"), k)).alias("pos", "h"))
        at = at.join(small_side(seeds.where(F.col("k") == k)), "h").select("rid", "size", "n", "k", "pos")
        hits = at if hits is None else hits.unionByName(at)
    # a document's seeds for one length: as many as it has words at most
    hits = hits.groupBy("rid", "size", "n", "k").agg(F.sort_array(F.collect_set("pos")).alias("ps"))
    whole = F.least("n", "size") - F.col("k") + 1  # shingles of a window
    share = similarity / (1 + similarity)
    need = F.greatest(F.lit(1), F.ceil(share * (F.col("n") - F.col("k") + 1 + whole) - 1e-9).cast("int"))
    hits = hits.withColumns({"need": need, "last": F.greatest(F.col("size") - F.col("n"), F.lit(0)), "whole": whole})
    hits = hits.where(F.size("ps") >= F.col("need"))
    starts = F.expr("""array_distinct(concat(
        transform(filter(sequence(0, size(ps) - need), i -> ps[i] <= last and ps[i + need - 1] - ps[i] < whole), i -> ps[i]),
        if(ps[size(ps) - need] >= last, array(last), array())))""")
    found = hits.select("rid", F.explode(F.transform(starts, lambda s: F.struct("n", "k", s.alias("start")))).alias("w"))
    return materialize(found.groupBy("rid").agg(F.collect_list("w").alias("windows")), "candidate-windows")


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """Rows (rid, doc_id, item_id, n_words, similarity): each item found in each text, at its best window.

    ``docs`` has to be a table scan, as its rows are numbered in two plans.
    """
    texts = with_row_id(narrow(docs, doc_id=id_col, text=text_col))
    items = materialize(items_table(benchmark, radius, item_col, item_text_col), "items")
    found = candidate_windows(texts, items, similarity)
    held = texts.join(small_side(found, 50_000), "rid").select(
        "rid", "doc_id", "windows", word_hashes(F.col("text")).alias("words"))
    shingles = held.select("rid", "doc_id", "windows", F.array(*[
        shingle_hashes(F.col("words"), k) for k in range(1, SHINGLE + 1)]).alias("by_width"))
    cut = F.transform("windows", lambda w: F.struct(
        w["n"].alias("n"), F.slice(F.get("by_width", w["k"] - 1), w["start"] + 1, w["n"] - w["k"] + 1).alias("seen")))
    window = shingles.select("rid", "doc_id", F.explode(cut).alias("w")).select("rid", "doc_id", "w.n", "w.seen")
    window = window.withColumn("fp", simhash("seen")).distinct()
    near = window.withColumn("block", F.explode(blocks(F.col("fp"), radius)))
    near = near.join(items.select("item_id", "n", "shingles", F.col("fp").alias("item_fp"),
                                  F.explode(blocks(F.col("fp"), radius)).alias("block")), ["n", "block"])
    # a pair meets in each block that agrees; the first one, whose bits differ nowhere, stands for it
    apart = blocks(F.col("fp").bitwiseXOR(F.col("item_fp")), radius)
    first = F.element_at(F.filter(apart, lambda x: x["bits"] == 0), 1)["at"]
    near = near.where((F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius) & (F.col("block.at") == first))
    # without repeats on either side the common shingles are a set
    shared = F.expr("""if(size(array_distinct(seen)) = size(seen) and size(array_distinct(shingles)) = size(shingles),
        size(array_intersect(seen, shingles)),
        aggregate(array_distinct(shingles), 0, (n, x) -> n + least(
            size(filter(seen, y -> y = x)), size(filter(shingles, y -> y = x)))))""")
    exact = near.select("rid", "doc_id", "item_id", "n", "seen", "shingles", shared.alias("both")).select(
        "rid", "doc_id", "item_id", F.col("n").cast("long").alias("n_words"),
        (F.col("both") / (F.size("seen") + F.size("shingles") - F.col("both"))).alias("similarity"))
    exact = exact.where(F.col("similarity") >= similarity)
    return exact.groupBy("rid", "doc_id", "item_id", "n_words").agg(F.max("similarity").alias("similarity"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
               **columns: str) -> DataFrame:
    """``docs`` without the rows that hold an item of the benchmark."""
    rid = fresh(docs, "row_number_of_scan")
    gone = leaks(docs, benchmark, similarity, radius, **columns).select(F.col("rid").alias(rid)).distinct()
    gone = small_side(materialize(gone, "leaking-rows"))
    return with_row_id(docs, rid).join(gone, rid, "left_anti").drop(rid)
