"""SimHash near-duplicates with BK-trees (operator 8).

Fingerprint: ASCII letters lower-cased, words between ASCII white space,
shingles of ``shingle`` words (repeats included; the whole sequence if there are
fewer words; 0 for none); bit b is set if more than half of the XXH64 hashes
have it.  Fingerprints link at ``radius`` or fewer differing bits.

Whole texts stay where they were read; from there on only 8-byte fingerprints
move, and equal ones meet once.  The set of distinct fingerprints is dealt to
shards by multi-index blocks: two values within radius r agree in one of r + 1
blocks, and what is left agrees in one of r + 1 smaller blocks.  Each shard is
a BK-tree: children are keyed by their integer distance to the parent, and a
search follows only edges within the radius.  A shard's tree can't be broadcast
to all executors without a bound on its size, so the searching values are dealt
to the tree instead.  A shard reports a spanning star of each linked group, not
its pairs; connected components then join the stars of all shards.

Null and empty texts have fingerprint 0 and link like others; repeated rows
share a component; null ids take no part in the smallest id (a component with
no other has null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, narrow, with_row_id

BITS = 64
#: Distinct fingerprints of one shard beyond which its rows are dealt once more.
SHARD_VALUES = 100_000
#: A tree node with so few values is a leaf, compared as one array.
LEAF = 64


# ---- fingerprints ---------------------------------------------------------

def fingerprint(text: str | None, shingle: int) -> int:
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - width + 1].tolist()
    hashed, ends = xxhash.xxh64_intdigest, ends[width - 1:].tolist()
    h = np.array([hashed(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(h), 4096):
        bits = np.unpackbits(h[lo:lo + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (rid, doc_id, fp): ``fp`` is the 64-bit fingerprint as a signed long."""
    src = with_row_id(narrow(docs, doc_id=id_col, text=text_col))

    @F.pandas_udf("long")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return src.select("rid", "doc_id", compute("text").alias("fp"))


# ---- shards ---------------------------------------------------------------

def block(value, width: int, at: int, size: int):
    """Bits [at, at + size) of a ``width``-bit column."""
    return F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << size) - 1))


def without(value, width: int, at: int, size: int):
    """The other bits, closed up to ``width - size`` bits."""
    low = value.bitwiseAND(F.lit((1 << at) - 1))
    if at + size >= width:
        return low
    high = F.shiftrightunsigned(value, at + size).bitwiseAND(F.lit((1 << (width - at - size)) - 1))
    return F.shiftleft(high, at).bitwiseOR(low)


def spans(width: int, parts: int) -> list[tuple[int, int]]:
    """``parts`` blocks (at, size) that make up ``width`` bits."""
    edges = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def shard_keys(fp, radius: int, levels: int):
    """Array of structs (key, ...): the shards of a value, ``levels`` of blocks deep.

    Equal keys mean the same choice of blocks with the same contents.
    """
    out = [(F.lit(0).cast("long"), fp, BITS)]
    for _ in range(levels):
        out = [(F.xxhash64(key, F.lit(i), block(rest, width, at, size)), without(rest, width, at, size), width - size)
               for key, rest, width in out for i, (at, size) in enumerate(spans(width, radius + 1))]
    return F.array(*[key for key, _, _ in out])


# ---- BK-trees -------------------------------------------------------------

def distances(a, b):
    return np.bitwise_count(a ^ b).astype(np.int16)


class Groups:
    """Disjoint sets over positions; ``label`` is kept flat."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            apart = np.flatnonzero(la != lb)
            if not len(apart):
                return
            x, y = la[apart[0]], lb[apart[0]]
            self.label[self.label == max(x, y)] = min(x, y)
            a, b = a[apart], b[apart]


def bk_groups(values: np.ndarray, radius: int) -> np.ndarray:
    """For each of distinct ``values``: position of the first value of its linked group.

    All values search the tree together, so a node is visited once with those
    searches whose edges lead to it.
    """
    groups = Groups(len(values))
    todo = [(np.arange(len(values)), np.arange(len(values)))]  # (values below a node, searches that reach it)
    while todo:
        below, search = todo.pop()
        if len(below) <= LEAF:
            near = distances(values[search][:, None], values[below][None, :]) <= radius
            first = near.argmax(axis=1)
            hit = near.any(axis=1)
            groups.join(search[hit], below[first[hit]])
            both = near[near.sum(axis=1) > 1].astype(np.float32)
            if len(both):  # values that one search meets belong together
                i, j = np.nonzero(np.triu(both.T @ both, 1))
                groups.join(below[i], below[j])
            continue
        parent, below = below[0], below[1:]
        d = distances(values[search], values[parent])
        hit = search[d <= radius]
        groups.join(hit, np.full(len(hit), parent))
        edge = distances(values[below], values[parent])
        for e in np.unique(edge):
            go = search[np.abs(d - e) <= radius]
            if len(go):
                todo.append((below[edge == e], go))
    return groups.label


def shard_links(keyed: DataFrame, radius: int) -> DataFrame:
    """Rows (a, b) of fingerprints that belong together, from rows (key, fp) of shards."""

    def links(batches):
        def flush(pdf):
            key, fp = pdf["key"].to_numpy(), pdf["fp"].to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            a, b = [], []
            for i in np.flatnonzero(np.diff(edges) > 1):
                group = fp[edges[i]:edges[i + 1]]
                label = bk_groups(group.view(np.uint64), radius)
                moved = np.flatnonzero(label != np.arange(len(group)))
                a.append(group[moved])
                b.append(group[label[moved]])
            if a and sum(map(len, a)):
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

        held = None  # the last key's rows may go on in the next batch
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = pdf["key"].to_numpy() != pdf["key"].iloc[-1]
            if last.any():
                yield from flush(pdf[last])
            held = pdf[~last]
        if held is not None and len(held):
            yield from flush(held)

    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(links, "a long, b long").distinct()


def fingerprint_links(distinct: DataFrame, radius: int, shard_values: int = SHARD_VALUES) -> DataFrame:
    """Links between rows (fp) of a written table of distinct values."""
    keyed = distinct.select("fp", F.explode(shard_keys(F.col("fp"), radius, 2)).alias("key"))
    large = materialize(keyed.groupBy("key").count().where(F.col("count") > shard_values).select("key"), "large-shards")
    if large.isEmpty():
        return shard_links(keyed, radius)
    # Beyond the bound a shard is dealt by one more level of blocks; no value is left out.
    rest = keyed.join(large, "key", "left_anti")
    deeper = keyed.join(large, "key", "left_semi").select("fp", F.explode(F.transform(
        shard_keys(F.col("fp"), radius, 3), lambda k: F.xxhash64(k, F.col("key")))).alias("key"))
    return shard_links(rest.unionByName(deeper.select("key", "fp")), radius)


# ---- components -----------------------------------------------------------

def components(links: DataFrame, name: str = "star") -> DataFrame:
    """Rows (node, root): the smallest node reachable, for each node with a link.

    Alternates two steps that point neighbours at the smallest one, those above
    a node and those below, until nothing changes; each round is written to the
    shared folder, and its number grows with the logarithm of a group's size.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges, before = materialize(links.where("a != b").select("a", "b"), name), None
    while True:
        near = both(edges)
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        edges = materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = now


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Rows (rid, doc_id, fp, root, component_id): the component's smallest fingerprint and doc_id."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    root = components(fingerprint_links(distinct, radius))
    linked = distinct.join(root, distinct["fp"] == root["node"], "left").select(
        distinct["fp"], "least", F.coalesce("root", distinct["fp"]).alias("root"))
    linked = materialize(linked, "linked-fingerprints")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    known = linked.join(least, "root").select("fp", "root", "component_id")
    return rows.join(known, "fp").select("rid", "doc_id", "fp", "root", "component_id")


def fingerprint_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null last), of equal ones the first row.

    ``docs`` has to be a table scan, as its rows are numbered in two plans.
    """
    groups = near_duplicates(docs, shingle, radius, id_col, text_col)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first"))
    rid = fresh(docs, "row_number_of_scan")
    kept = materialize(first.select(F.col("first.rid").alias(rid)), "kept-rows")
    # most rows stay, so their numbers grow with the table: a merge join at every size
    return with_row_id(docs, rid).join(kept.hint("merge"), rid, "left_semi").drop(rid)
