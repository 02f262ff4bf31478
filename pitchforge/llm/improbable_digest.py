"""Document fingerprints of improbable features (operator 13).

1. Rarity: every window of 32 bytes of every text has an entropy class (0 to
   1000, its share of the most that 32 bytes can have).  One pass counts the classes over
   all texts, and the rarer a class, the lower its rank.
2. Features: in each stretch of 32 neighbouring windows the one of least rank (of
   equal ones the first) wins; windows that win 8 stretches or more are a text's
   features.  Windows of little entropy are no features, as they are alike in unrelated texts.
3. Digest: the distinct features in order of their places set 5 bits each in a Bloom
   filter of 2048 bits; after 128 features the next filter of the chain begins.
4. Likeness of two digests: for each filter of the one with fewer features, the best overlap with any of the
   other's, weighted by features.  An overlap is the number of common bits, where what chance
   may well give counts as 0 and the geometric mean of both filters' bits as 1.

A text that has no feature otherwise (fewer than 32 bytes, or nothing but windows of little
entropy) is one feature as a whole, so that it is like its copies and unlike others.
Null and empty texts have the digest '', which is like itself alone.  Equal texts
have equal digests.  Null ids come last in the order of documents, equal ids in
the order of the scan; repeated rows each get their own result; an only document
is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

import binascii
import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, with_row_id

#: Bytes of a window; windows of a stretch; stretches that a feature wins at least.
WINDOW, STRETCH, POPULAR = 32, 32, 8
#: Classes below this are no features.
LEAST_CLASS = 300
#: Bits of a Bloom filter, bits of a feature, features of a filter.
BITS, HASHES, FEATURES = 2048, 5, 128
CLASSES = 1001
#: Common bits up to this many spreads over the mean of unrelated filters count as chance.
SPREADS = 2.0
#: Bytes of text in a task that meets neighbours, and tasks at most (a task streams, so larger ones take no more memory).
TASK_BYTES, TASKS = 16 << 20, 16384
#: Rows for each task from which the borders of the tasks are chosen.
SAMPLE = 50

# c log2 c in units of 2**-32, whole numbers so that sums have no order
_C = np.arange(WINDOW + 1)
_UNIT = 1 << 32
_CLOGC = np.round(_C * np.log2(np.maximum(_C, 1)) * _UNIT).astype(np.int64)
# steps of the sum when one of c equal bytes leaves, and when one comes to c others
_LEAVES = np.concatenate([[0], _CLOGC[:-1] - _CLOGC[1:]])
_ENTERS = np.concatenate([_CLOGC[1:] - _CLOGC[:-1], [0]])
_MOST = WINDOW * int(round(np.log2(WINDOW) * _UNIT))
_WINDOW, _SHIFTS = np.arange(WINDOW), np.arange(0, 11 * HASHES, 11, dtype=np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def entropy_classes(x: np.ndarray) -> np.ndarray:
    """The class of the window from each byte on, for all that are whole.

    From one window to the next a byte leaves and one enters; what this does to
    the entropy follows from how often each is in the window, which the places
    of equal bytes in order tell.
    """
    n = len(x)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    kind = np.int32 if n < 1 << 22 else np.int64  # 256 * (n + WINDOW) has to fit
    order = np.argsort(x, kind="stable").astype(kind)
    key = x[order].astype(kind) * kind(n + WINDOW) + order
    index = np.arange(n, dtype=kind)
    reach = np.searchsorted(key, key + kind(WINDOW))  # first equal byte beyond the window that starts here
    ahead, behind = np.empty(n, kind), np.empty(n, kind)
    ahead[order] = reach - index
    behind[order] = index - np.cumsum(np.bincount(reach, minlength=n + 1))[:n]
    out, into = ahead[:n - WINDOW], behind[WINDOW:]
    # a byte that enters as an equal one leaves finds itself behind: both steps cancel
    step = _LEAVES[out] + _ENTERS[into]
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = _CLOGC[np.bincount(x[:WINDOW])].sum()
    np.cumsum(step, out=total[1:])
    total[1:] += total[0]
    return ((_MOST - total) // (_MOST // 1000)).astype(np.int32)


def ranks(counts: np.ndarray) -> np.ndarray:
    """Ranks of the classes, the rarest 0; classes that are no features get the highest."""
    rank = np.empty(CLASSES, np.int32)
    rank[np.argsort(counts, kind="stable")] = np.arange(CLASSES)
    rank[:LEAST_CLASS] = CLASSES
    return rank


def stretches(key: np.ndarray, width: int) -> np.ndarray:
    """Least value of each stretch of ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        key = np.minimum(key[:-step], key[step:])
        done += step
    return key


def features(r: np.ndarray) -> np.ndarray:
    """Places of the features of a text, ascending, given the ranks of its windows."""
    if not len(r):
        return r
    width, n = min(STRETCH, len(r)), len(r)
    kind = np.int32 if n < 1 << 21 else np.int64  # CLASSES * n has to fit
    best = stretches(r.astype(kind) * kind(n) + np.arange(n, dtype=kind), width)
    wins = np.bincount(best[best < CLASSES * n] % n, minlength=n)
    # a text with few stretches has the windows that win most of them
    return np.flatnonzero(wins >= max(1, min(POPULAR, int(wins.max()))))


def feature_bits(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The bits (rows of HASHES) of the distinct windows at these places, in order."""
    eights = x[places[:, None] + _WINDOW].view("<u8")
    h = np.full(len(places), 42, np.uint64)
    for word, mix in zip(eights.T, _MIX, strict=True):
        h = (h ^ word) * mix
        h ^= h >> np.uint64(29)
    return bits_of(h[np.sort(np.unique(h, return_index=True)[1])])


def bits_of(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes: 11 bits each of five places."""
    h = h * _MIX[1]
    h ^= h >> np.uint64(32)
    return ((h[:, None] >> _SHIFTS) & np.uint64(BITS - 1)).astype(np.int64)


class Digest:
    """A chain of Bloom filters: features and bits (as packed bytes) of each."""

    def __init__(self, counts: np.ndarray, filters: np.ndarray):
        self.counts, self.filters = counts, filters

    @classmethod
    def of(cls, text: str | None, rank: np.ndarray) -> Digest:
        raw = (text or "").encode()
        return cls.of_classes(raw, entropy_classes(np.frombuffer(raw, np.uint8)), rank)

    @classmethod
    def of_classes(cls, raw: bytes, classes: np.ndarray, rank: np.ndarray) -> Digest:
        """The digest of bytes whose entropy classes are known."""
        if not raw:
            return cls(np.zeros(0, np.int64), np.zeros((0, BITS // 8), np.uint8))
        places = features(rank[classes])
        if len(places):
            bits = feature_bits(np.frombuffer(raw, np.uint8), places)
        else:
            bits = bits_of(np.frombuffer(hashlib.sha256(raw).digest()[:8], "<u8"))
        number = np.arange(len(bits)) // FEATURES
        on = np.zeros((int(number[-1]) + 1, BITS), bool)
        on[number[:, None], bits] = True
        return cls(np.bincount(number), np.packbits(on, axis=1))

    def __str__(self) -> str:
        """Features and base64 bits of each filter."""
        return ",".join(f"{c}:{binascii.b2a_base64(f.tobytes(), newline=False).decode()}"
                        for c, f in zip(self.counts.tolist(), self.filters, strict=True))

    @classmethod
    def parse(cls, s: str) -> Digest:
        parts = [p.split(":") for p in s.split(",")] if s else []
        raw = [np.frombuffer(binascii.a2b_base64(f), np.uint8) for _, f in parts]
        return cls(np.array([int(c) for c, _ in parts], np.int64), np.array(raw, np.uint8).reshape(-1, BITS // 8))


def overlaps(a: Digest, b: Digest) -> np.ndarray:
    """The best normalised overlap of each filter of ``a`` with one of ``b``."""
    words_a, words_b = a.filters.view("<u8"), b.filters.view("<u8")
    size_a, size_b = (np.bitwise_count(w).sum(axis=1, dtype=float) for w in (words_a, words_b))
    best = np.zeros(len(words_a))
    for at in range(len(words_a)):
        for lo in range(0, len(words_b), 4096):
            common = np.bitwise_count(words_a[at] & words_b[lo:lo + 4096]).sum(axis=1, dtype=float)
            product = size_a[at] * size_b[lo:lo + 4096]
            chance = product / BITS
            chance += SPREADS * np.sqrt(chance)
            room = np.sqrt(product) - chance
            best[at] = max(best[at], np.where(room > 0, (common - chance) / np.maximum(room, 1e-9), 0).max())
    return best


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1, the same from both sides; 1 for equal digests."""
    if len(a.filters) == len(b.filters) and (a.filters == b.filters).all():
        return 1.0
    if not len(a.filters) or not len(b.filters):
        return 0.0
    size = int(a.counts.sum()) - int(b.counts.sum())
    sides = [(a, b)] if size < 0 else [(b, a)] if size > 0 else [(a, b), (b, a)]
    scores = [float((overlaps(p, q) * p.counts).sum() / p.counts.sum()) for p, q in sides]
    return min(1.0, sum(scores) / len(scores))


# --- on tables ---

def class_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Windows of each entropy class over all texts (a row for each class and task is summed)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CLASSES, np.int64)
        for pdf in batches:
            for t in pdf["text"]:
                if t:
                    total += np.bincount(entropy_classes(np.frombuffer(t.encode(), np.uint8)), minlength=CLASSES)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"class": seen, "windows": total[seen]})

    rows = narrow(docs, text=text_col).mapInPandas(count, "class int, windows long")
    out = np.zeros(CLASSES, np.int64)
    for r in rows.groupBy("class").agg(F.sum("windows").alias("windows")).collect():
        out[r["class"]] = r["windows"]
    return out


def fingerprints(docs: DataFrame, counts: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint) of all documents, given the ``class_counts`` of a corpus."""
    rank = ranks(counts)

    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([str(Digest.of(t, rank)) for t in texts], dtype=object)

    return narrow(docs, doc_id=id_col, text=text_col).select("doc_id", digest("text").alias("fingerprint"))


def like(a: str, b: str):
    """Column: likeness of two columns of fingerprints."""

    @F.pandas_udf("double")
    def compare(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else likeness(Digest.parse(x), Digest.parse(y))
                          for x, y in zip(left, right, strict=True)], dtype=float)

    return compare(F.col(a), F.col(b))


def borders(rows: DataFrame, tasks: int) -> list[tuple]:
    """(no id, id, rid) of the first row of each task, ascending; the very first row begins the first one.

    Chosen from a sample of a bounded number of rows by a hash; each border is a
    row of the table, so no task is empty and the first row of each is known.
    """
    keys = rows.select(F.struct("no_id", "doc_id", "rid").alias("key"), "rid")
    first = keys.agg(F.count("*").alias("n"), F.min("key").alias("first")).first()
    if not first["n"]:
        return []
    share = int(min(1.0, SAMPLE * tasks / first["n"]) * (1 << 30))
    picked = keys.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) < share).collect()
    order = sorted({tuple(r["key"]) for r in picked})
    return sorted({tuple(first["first"]), *(order[len(order) * t // tasks] for t in range(1, tasks) if order)})


def with_next(docs: DataFrame, once: Callable[[str | None], Any], work: Callable[[Any, Any], tuple], schema: str,
              total_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``work(own, next one's)`` (of ``schema``) of what ``once`` makes of each text; the last one's next is the first.

    Documents are dealt once, into ranges of (id, row number), and streamed in
    that order.  A range also gets the first document of the one after it.
    """
    spark = docs.sparkSession
    rows, kind = with_row_id(narrow(docs, doc_id=id_col, text=text_col)), docs.schema[id_col].dataType
    # pandas would make doubles of a column of whole numbers with nulls
    rows = rows.withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast(kind)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(TASKS, -(-total_bytes // TASK_BYTES)))
    starts = borders(rows, tasks)
    n, names = len(starts), ["no_id", "doc_id", *[c.split()[0] for c in schema.split(",")]]

    @F.pandas_udf("array<int>")
    def ranges(no_ids: pd.Series, ids: pd.Series, rids: pd.Series) -> pd.Series:
        out = []
        for key in zip(no_ids.tolist(), ids.tolist(), rids.tolist(), strict=True):
            at = bisect_right(starts, key) - 1
            out.append([at, (at - 1) % n] if starts[at] == key else [at])
        return pd.Series(out, dtype=object)

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for pdf in batches:
            out = []
            for no_id, i, text, extra, at in zip(pdf["no_id"], pdf["doc_id"], pdf["text"], pdf["extra"], pdf["range"], strict=True):
                made = once(text)
                if waiting and waiting[0] == at:
                    out.append((*waiting[1:3], *work(waiting[3], made)))
                waiting = None if extra else (at, no_id, i, made)
            if out:
                yield pd.DataFrame(out, columns=names)

    dealt = rows.select("*", F.posexplode(ranges("no_id", "doc_id", "rid")).alias("extra", "range"))
    dealt = dealt.repartitionById(max(1, n), F.col("range")).sortWithinPartitions("range", "extra", "no_id", "doc_id", "rid")
    found = dealt.select("no_id", "doc_id", "text", "extra", "range").mapInPandas(
        stream, f"no_id boolean, doc_id {kind.simpleString()}, {schema}")
    return found.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def spliced(left: bytes, left_classes: np.ndarray, right: bytes, right_classes: np.ndarray) -> np.ndarray:
    """Entropy classes of left + right, given those of texts that begin with either."""
    a, b = max(0, len(left) - WINDOW + 1), max(0, len(right) - WINDOW + 1)
    seam = np.frombuffer(left[a:] + right[:WINDOW - 1], np.uint8)
    return np.concatenate([left_classes[:a], entropy_classes(seam), right_classes[:b]])


def edit_trial(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of every text and its edited text, and how like the text's is to the edited one's and the next one's.

    The edited text has its last half (in code points, rounded down) replaced by
    as many first ones of the next document.  Rows (doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    """
    counts = class_counts(docs, text_col)
    rank = ranks(counts)

    def once(text: str | None) -> tuple:
        raw = (text or "").encode()
        classes = entropy_classes(np.frombuffer(raw, np.uint8))
        return text or "", classes, Digest.of_classes(raw, classes, rank)

    def work(own: tuple, following: tuple) -> tuple:
        text, classes, digest = own
        half = len(text) // 2
        left, right = text[:len(text) - half].encode(), following[0][:half].encode()
        changed = Digest.of_classes(left + right, spliced(left, classes, right, following[1]), rank)
        return (len(text), hashlib.sha256(left + right).hexdigest(), str(digest), str(changed),
                likeness(digest, changed), likeness(digest, following[2]))

    return with_next(docs, once, work, "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                     "near_edited double, near_next double", int(counts.sum()), id_col, text_col)


__all__ = ["edit_trial", "fingerprints", "class_counts", "like", "Digest", "likeness", "with_next"]
