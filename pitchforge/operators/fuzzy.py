"""Lossless fuzzy best-match join on token-sort similarity.

For every left name, find the right name with the highest token-sort ratio
(200*LCS/(a+b) over token-sorted strings), accept it when the score reaches
``threshold``; ties go to the right name seen first (smallest order value).

Plan, all DataFrame operations:

1. Both sides are reduced to *distinct token-sorted strings* (the right side
   keeps the first row per sorted form: same sorted form => same score for
   every left name, so only the earliest can win).
2. Exact pass: equal sorted strings score 100 and cannot be beaten.
3. Candidate pass (pass-join segment filter, Li et al., VLDB 2011), for each
   pair of lengths (a, b) on its own.  A score >= t allows an indel distance of
   d = floor((100-t)/100*(a+b)).  Of d + 1 even segments of the right string at
   least one survives intact in the left string; of the at most d edits,
   (d + a - b)/2 are extra characters of the left and (d - a + b)/2 missing ones,
   which bounds its shift to either side.  The equi-join on (a, b, segment
   number, text) yields only pairs that share a placed segment: a necessary
   condition, never a cap.
4. A second necessary condition: the common characters, with multiplicity,
   bound the LCS from above.  It is a set intersection of (character, number)
   pairs in the JVM and leaves few pairs for the Arrow UDF.
5. Distinct candidate pairs are verified by that UDF (bit-parallel LCS), kept
   when 200*LCS >= t*(a+b) (integer test), and the best per left string is chosen
   by (score desc, right order asc).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchforge.functions.text import lcs_udf, token_sort_key
from pitchforge.operators.dedupe import first_per_key
from pitchforge.operators.joins import shuffled

#: Below this a string may have fewer characters than segments.
LEAST_THRESHOLD = 70


def _feasible(n: Column, t: int) -> Column:
    """Lengths a partner of a string of length n can have: t*(a+b) <= 200*min(a,b)."""
    lo = F.greatest(F.lit(1), F.ceil(n * F.lit(t) / F.lit(200 - t)).cast("int"))
    hi = F.floor(n * F.lit(200 - t) / F.lit(t)).cast("int")
    return F.when(lo <= hi, F.sequence(lo, hi))


def _distance(a: Column, b: Column, t: int) -> Column:
    """Largest indel distance of strings of lengths a and b with a score of t."""
    return F.floor((a + b) * F.lit(100 - t) / F.lit(100)).cast("int")


def _segment(b: Column, k: Column, i: Column) -> tuple[Column, Column]:
    """Start (0-based) and length of segment i when b chars are cut into k parts;
    the last (b mod k) segments are one character longer."""
    base = F.floor(b / k).cast("int")
    rem = (b % k).cast("int")
    long_from = k - rem
    seg_len = base + F.when(i >= long_from, F.lit(1)).otherwise(F.lit(0))
    start = i * base + F.greatest(F.lit(0), i - long_from)
    return start, seg_len


def right_segments(right_sorted: DataFrame, t: int, within: Sequence[str] = ()) -> DataFrame:
    """(rs, a, b, seg_i, seg_text, *within): the segments of each string, for each partner length a."""
    df = right_sorted.select("rs", *within, F.length("rs").alias("b"))
    df = df.select("rs", *within, "b", F.explode(_feasible(F.col("b"), t)).alias("a"))
    df = df.withColumn("k", _distance(F.col("a"), F.col("b"), t) + 1)
    df = df.select("rs", *within, "a", "b", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("seg_i"))
    start, ln = _segment(F.col("b"), F.col("k"), F.col("seg_i"))
    return df.select("rs", "a", "b", "seg_i", F.substring(F.col("rs"), start + 1, ln).alias("seg_text"), *within)


def left_probes(left_sorted: DataFrame, t: int, within: Sequence[str] = ()) -> DataFrame:
    """(ls, a, b, seg_i, seg_text, *within): substrings of ls that can be a surviving segment
    of a right string of length b, within the shift that the two lengths allow."""
    df = left_sorted.select("ls", *within, F.length("ls").alias("a"))
    df = df.select("ls", *within, "a", F.explode(_feasible(F.col("a"), t)).alias("b"))
    df = df.withColumn("d", _distance(F.col("a"), F.col("b"), t)).withColumn("k", F.col("d") + 1)
    df = df.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("seg_i"))
    start, ln = _segment(F.col("b"), F.col("k"), F.col("seg_i"))
    extra = F.floor((F.col("d") + F.col("a") - F.col("b")) / 2)
    missing = F.floor((F.col("d") - F.col("a") + F.col("b")) / 2)
    df = df.select("ls", *within, "a", "b", "seg_i", ln.cast("int").alias("ln"),
                   F.greatest(F.lit(0), start - missing).cast("int").alias("lo"),
                   F.least(F.col("a") - ln, start + extra).cast("int").alias("hi"))
    df = df.filter(F.col("lo") <= F.col("hi")).withColumn("q", F.explode(F.sequence(F.col("lo"), F.col("hi"))))
    return df.select("ls", "a", "b", "seg_i", F.substring(F.col("ls"), F.col("q") + 1, F.col("ln")).alias("seg_text"),
                     *within).distinct()


def numbered_characters(text: Column) -> Column:
    """The characters of a text, the n-th 'e' as 'e' with n: their common ones count with multiplicity."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.transform(chars, lambda c, i: F.concat(c, (i - F.array_position(chars, c)).cast("string")))


def candidate_pairs(left_sorted: DataFrame, right_sorted: DataFrame, t: int, within: Sequence[str] = (),
                    segs: DataFrame | None = None) -> DataFrame:
    """Distinct (ls, rs, *within) that pass both necessary conditions and agree in the columns ``within``.

    ``segs``: stored segments of the right side; of names that are not in ``right_sorted`` none comes back.
    """
    segs = right_segments(right_sorted, t, within) if segs is None else segs
    pairs = left_probes(left_sorted, t, within).join(shuffled(segs), ["a", "b", "seg_i", "seg_text", *within])
    pairs = pairs.select("ls", "rs", "a", "b", *within).distinct()
    lefts, rights = (df.select(c).distinct() if within else df for df, c in ((left_sorted, "ls"), (right_sorted, "rs")))
    pairs = pairs.join(shuffled(lefts.select("ls", numbered_characters(F.col("ls")).alias("lc"))), "ls")
    pairs = pairs.join(shuffled(rights.select("rs", numbered_characters(F.col("rs")).alias("rc"))), "rs")
    common = F.size(F.array_intersect("lc", "rc"))
    return pairs.filter(common * F.lit(200) >= F.lit(t) * (F.col("a") + F.col("b"))).select("ls", "rs", *within)


def similar_pairs(left_sorted: DataFrame, right_sorted: DataFrame, t: int, within: Sequence[str] = (),
                  segs: DataFrame | None = None) -> DataFrame:
    """(ls, rs, *within, score) of every pair of distinct sorted strings with a score of ``t`` or more that
    agrees in the columns ``within``."""
    if t < LEAST_THRESHOLD:
        raise ValueError(f"the segment filter is lossless from a threshold of {LEAST_THRESHOLD} on")
    total = F.length("ls") + F.length("rs")
    return (candidate_pairs(left_sorted, right_sorted, t, within, segs)
            .withColumn("__lcs", lcs_udf(F.col("ls"), F.col("rs")))
            .filter(F.col("__lcs") * F.lit(200) >= F.lit(t) * total)
            .select("ls", "rs", *within, (F.lit(200.0) * F.col("__lcs") / total).alias("score")))


def fuzzy_best_match(left: DataFrame, left_name: str, right: DataFrame, right_name: str,
                     right_order: str, right_cols: list[str], threshold: int = 85, index=None) -> DataFrame:
    """Best right match per distinct left name.

    ``index``: a ``SegmentIndex`` of the same threshold, to which new right names are added first.

    Returns one row per distinct non-empty ``left_name`` value that has a
    match: (``left_name``, score, *right_cols) where right_cols come from the
    winning right row (first row, by ``right_order``, of the winning sorted
    form).
    """
    t = int(threshold)
    if t < LEAST_THRESHOLD:
        raise ValueError(f"the segment filter is lossless from a threshold of {LEAST_THRESHOLD} on")
    lnames = (left.select(F.col(left_name).alias("lname"))
                  .filter(F.col("lname").isNotNull() & (F.col("lname") != "")).distinct()
                  .withColumn("ls", token_sort_key("lname")))
    rrows = (right.filter(F.col(right_name).isNotNull())
                  .withColumn("rs", token_sort_key(right_name)))
    rfirst = first_per_key(rrows, ["rs"], [F.col(right_order).asc()]).select(
        "rs", F.col(right_order).alias("__rorder"), *right_cols)

    ls_distinct = lnames.select("ls").distinct()
    exact = ls_distinct.join(shuffled(rfirst.select("rs").withColumnRenamed("rs", "ls")), "ls", "left_semi")
    exact_pairs = exact.select("ls", F.col("ls").alias("rs"), F.lit(100.0).alias("score"))

    todo = ls_distinct.join(shuffled(exact), "ls", "left_anti")
    segs = None
    if index is not None:
        if index.threshold != t:
            raise ValueError(f"the index is for a threshold of {index.threshold}")
        index.update(rfirst)
        segs = index.segments()
    scored = similar_pairs(todo, rfirst.select("rs"), t, segs=segs)
    pairs = exact_pairs.unionByName(scored).join(shuffled(rfirst), "rs")
    best = first_per_key(pairs, ["ls"], [F.col("score").desc(), F.col("__rorder").asc()])
    return (lnames.join(shuffled(best), "ls").select(F.col("lname").alias(left_name), "score",
                                           *right_cols))


__all__ = ["fuzzy_best_match", "similar_pairs", "candidate_pairs", "left_probes", "right_segments"]
