"""Exact top-k inner products by MaxScore (operator 4).

A vector's components are the weights of its terms.  In a shard, each term has
two posting lists, of the vectors with a positive and with a negative weight,
ordered by size of weight; the list whose sign is the query's can only add to a
score, and adds at most ``|query weight| * largest weight``.

For a query, terms are ordered by these bounds.  Terms whose bounds together
stay below the score of the k-th best so far are non-essential: a vector found
in no other list can't get in.  The essential lists are traversed for
candidates and their partial scores; the others are probed only for candidates
whose partial score plus the bounds that are left still competes.  What the
opposite lists take off is counted with each term, so bounds stay bounds.

Blocks of queries meet shards of vectors of a fixed size, and the shards'
results merge by rank.

Vectors that are null, or hold a null or non-finite component, take no part;
missing components of shorter vectors weigh 0;
components of any size are compared exactly; a null id is no query and comes
last among ties; repeated rows are vectors and queries of their own, and a query
leaves out its own row alone; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, narrow, with_row_id

#: Vectors of a shard and queries of a block.
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
#: Heads of the strongest posting lists that give a query its first threshold.
HEADS, HEAD_ROWS = 8, 8
#: Essential terms that are traversed between two checks of the threshold.
STEP = 8


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """Rows (rid, id, v array<double>): floor(scale * component), of the vectors that take part."""
    src = with_row_id(narrow(df, id=id_col, v=vector_col)).withColumn("v", F.col("v").cast("array<double>"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    src = src.where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    # a long holds less than a double: from 2^52 on a double is a whole number as it is
    whole = lambda x: F.when(F.abs(x) < F.lit(2.0 ** 52), F.floor(x).cast("double")).otherwise(x)
    return src.withColumn("v", F.transform("v", lambda x: whole(x * F.lit(float(scale)))))


class Shard:
    """Posting lists of a block of vectors (rows ``rids``) in the order of ties."""

    def __init__(self, rids: np.ndarray, x: np.ndarray):
        self.rids, self.x = rids, x
        self.columns = np.ascontiguousarray(x.T)
        self.lists = {}
        for d, c in enumerate(self.columns):
            for sign in (1, -1):
                at = np.flatnonzero(c * sign > 0)
                at = at[np.argsort(-sign * c[at], kind="stable")]
                self.lists[d, sign] = at, int(sign * c[at[0]]) if len(at) else 0

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.x[at] @ q

    def top(self, rid: int, q: np.ndarray, k: int):
        """(place, score) of the k best vectors other than row ``rid``, the query's own."""
        own = self.rids == rid
        signs = np.sign(q).astype(int)
        terms = [d for d in np.flatnonzero(q) if self.lists[d, signs[d]][1]]
        bound = {d: abs(q[d]) * self.lists[d, signs[d]][1] for d in terms}
        terms.sort(key=lambda d: -bound[d])
        floor = self.threshold(q, signs, terms, own, k)
        # non-essential terms are a tail of the order by bound
        left = np.concatenate([np.cumsum([bound[d] for d in terms][::-1])[::-1], [0]]) if terms else np.zeros(1)
        essential = int(np.searchsorted(-left, -floor, side="right")) if floor is not None else len(terms)
        found = np.zeros(len(self.rids), bool)
        if floor is None or floor <= 0:
            found[:] = True  # vectors in no list of the query's signs compete too
        for d in terms[:essential]:
            found[self.lists[d, signs[d]][0]] = True
        found &= ~own
        at = np.flatnonzero(found)
        part = np.zeros(len(at), self.x.dtype)
        silent = [d for d in np.flatnonzero(q) if d not in bound]  # only the opposite list is there: they take off
        for d in silent:
            part += q[d] * self.columns[d][at]
        for lo in range(0, len(terms), STEP):
            step = terms[lo:lo + STEP]
            for d in step:
                part += q[d] * self.columns[d][at]
            if floor is not None:
                live = part + left[lo + len(step)] >= floor
                if not live.all():
                    at, part = at[live], part[live]
        if len(at) > k:
            least = np.partition(part, len(part) - k)[len(part) - k]
            live = part >= least
            at, part = at[live], part[live]
        best = np.lexsort((at, -part))[:k]
        return at[best], part[best]

    def threshold(self, q, signs, terms, own, k):
        """Score of the k-th best of some likely vectors; None if there are fewer."""
        heads = [self.lists[d, signs[d]][0][:HEAD_ROWS] for d in terms[:HEADS]]
        at = np.unique(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
        at = at[~own[at]]
        if len(at) < k:
            return None
        s = self.scores(q, at)
        return np.partition(s, len(s) - k)[len(s) - k]


def matrix(vectors, width: int) -> np.ndarray:
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = v
    return x


def exact_type(x: np.ndarray, q: np.ndarray):
    """float64 (fast products) where all sums are exact integers in it, else int64."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    return np.float64 if most < 2 ** 52 else np.int64


def moderate(x: np.ndarray) -> np.ndarray:
    """Vectors so small that sums of products of any two of them, and their bounds, are exact in a long."""
    return np.abs(x).max(axis=1, initial=0) < (2.0 ** 62 / max(1, x.shape[1])) ** 0.5


def unbounded(x: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python's integers."""
    most = np.finfo(np.float64).max
    return np.frompyfunc(int, 1, 1)(np.clip(x, -most, most) if x.dtype.kind == "f" else x).astype(object)


def rounded(score: int) -> float:
    """A double that keeps the order of scores which no long holds."""
    return float(max(-2 ** 1023, min(2 ** 1023, score)))


class Block:
    """The vectors of a shard: a ``Shard`` of the moderate ones, and those beyond, which are compared one by one."""

    def __init__(self, rids: np.ndarray, x: np.ndarray, q: np.ndarray):
        small = moderate(x)
        self.rids, self.whole, self.small, self.beyond = rids, x, np.flatnonzero(small), np.flatnonzero(~small)
        self.kind = exact_type(x[self.small], q[moderate(q)])
        self.shard = Shard(rids[self.small], x[self.small].astype(self.kind))
        self.large = unbounded(x[self.beyond])
        self.every = None

    def top(self, rid: int, q: np.ndarray, k: int):
        """(place, score, size) of the k best vectors other than row ``rid``.

        Scores that a long can't hold are its least or largest; ``size`` keeps their order.
        """
        if moderate(q[None])[0]:
            at, score = self.shard.top(rid, q.astype(self.kind), k)
            at, score = self.small[at], score.astype(np.int64)
            if not len(self.beyond):
                return at, score, score.astype(np.float64)
            at, score = np.concatenate([at, self.beyond]), np.concatenate([unbounded(score), self.large @ unbounded(q)])
        else:
            if self.every is None:
                self.every = unbounded(self.whole)
            at, score = np.arange(len(self.whole)), self.every @ unbounded(q)
        best = sorted((-s, a) for a, s in zip(at, score, strict=True) if self.rids[a] != rid)[:k]
        return (np.array([a for _, a in best], np.int64), np.array([max(-2 ** 63, min(2 ** 63 - 1, -s)) for s, _ in best], np.int64),
                np.array([rounded(-s) for s, _ in best], np.float64))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (query_id, rank, id, score) from a written table (rid long, id long, v array<double>).

    Each query of ``is_query`` meets all vectors: shards and blocks are joined
    by number, and each pair of them is one bounded group.
    """
    counts = vectors.agg(F.count("*"), F.count(F.when(is_query & F.col("id").isNotNull(), 1))).first()
    shards, blocks = max(1, -(-counts[0] // shard_rows)), max(1, -(-counts[1] // block_rows))
    numbered = vectors.withColumn("no_id", F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(0)))
    # both sides' keys have one type: a cogroup compares hashes, and equal numbers of two types have different ones
    deal = lambda n, salt: F.pmod(F.xxhash64("rid", F.lit(salt)), F.lit(n)).cast("int")
    data = numbered.withColumn("shard", deal(shards, 1)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # names of their own: both sides of a cogroup come from one table
    asked = numbered.where(is_query & ~F.col("no_id")).select(
        F.col("rid").alias("query"), F.col("id").alias("query_id"), F.col("v").alias("q"), deal(blocks, 2).alias("block"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left = left.sort_values(["no_id", "id", "rid"], kind="stable")
            width = max(int(left["v"].map(len).max()), int(right["q"].map(len).max()))
            x, q = matrix(left["v"], width), matrix(right["q"], width)
            shard = Block(left["rid"].to_numpy(), x, q)
            no_id, ids = left["no_id"].to_numpy(), left["id"].to_numpy()
            for query, query_id, row in zip(right["query"], right["query_id"], q, strict=True):
                at, score, size = shard.top(query, row, k)
                out.append(pd.DataFrame({"query": query, "query_id": query_id, "no_id": no_id[at], "id": ids[at],
                                         "rid": shard.rids[at], "score": score, "size": size}))
        if not out:
            return pd.DataFrame({c: [] for c in ("query", "query_id", "no_id", "id", "rid", "score", "size")})
        return pd.concat(out, ignore_index=True)

    each = data.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        search, "query long, query_id long, no_id boolean, id long, rid long, score long, size double")
    order = Window.partitionBy("query").orderBy(F.desc("size"), F.desc("score"), "no_id", "id", "rid")
    best = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.when(~F.col("no_id"), F.col("id")).alias("id"), "score")


def search(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 256) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of a table of vectors; ``is_query`` takes the id column."""
    vectors = materialize(integer_vectors(df, id_col, vector_col, scale), "vectors")
    return top_k(vectors, is_query(F.col("id")), k).withColumnRenamed("id", "vec_id")
