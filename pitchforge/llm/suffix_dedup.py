"""Removal of long repeated byte strings with suffix arrays (operator 6).

Every byte that lies in a ``length``-byte string which also starts anywhere
else, in the same or another document, is marked; matches never cross
documents, and strings are judged on the input.

The strings are dealt to shards by content.  A string's key is the least hash
of its ``GRAM``-byte grams, so equal strings have equal keys, and neighbours
mostly share one: a run of starts with one key, with the bytes up to the end of
its last string, is a *segment*.

1. Keys are counted; a key that stands on one segment, which has the least gram
   once, can't match and is dropped.  If all segments of a key have the
   same bytes, all their strings repeat.
2. Of the other keys, one copy of each distinct segment goes to the key's
   shard.  There, batches of segments get suffix arrays (sorted starts, ranked by
   prefix doubling up to ``length`` bytes).  A new batch is merge-scanned against
   the levels that exist, for strings in both, and levels of equal size merge.
   Levels last as long as their key.
3. A key with more occurrences (a line that many texts have) is dealt finer:
   beyond ``LARGE_SEGMENTS`` its segments are cut once more by the least hash of
   longer grams, beyond ``HOT_SEGMENTS`` its strings go one by one, each by a
   128-bit hash of the whole string.  So no key's segments have to fit in a task.

Marks return to the segments' documents.  Null and empty texts have nothing to
remove; repeated rows are documents of their own, so a long repeated text goes
wholly; null ids stay null; an empty table gives no rows.  The table is read
more than once, so it has to be a scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, narrow, prepare, with_row_id

LENGTH, GRAM = 200, 32
#: Bytes of segments in one suffix array, and of texts hashed at once.
BATCH_BYTES = 1 << 20
CHUNK_BYTES = 1 << 18
#: Occurrences of one key beyond which its segments are cut by longer grams, and beyond which its strings go one by one.
LARGE_SEGMENTS, HOT_SEGMENTS = 500, 50_000
LONG_GRAM = 128


# ---- segments -------------------------------------------------------------

def gram_hashes(b: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of each run of ``gram`` bytes (a power of two), by doubling."""
    seed = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seed ^= seed >> np.uint64(29)
    h, m = (seed * np.uint64(0xBF58476D1CE4E5B9))[b], 1
    while m < gram:
        right = h[m:]
        h = h[:-m] * np.uint64(0x9E3779B97F4A7C15) + ((right >> np.uint64(31)) | (right << np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        m *= 2
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m = 1
    while 2 * m <= width:
        h, m = np.minimum(h[:-m], h[m:]), 2 * m
    return np.minimum(h[:m - width], h[width - m:]) if m < width else h


def segments_of(bodies: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(document, start, number of strings, key, digest of the bytes, may repeat within itself) of some texts."""
    import xxhash

    raw = b"".join(bodies)
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    if len(raw) < length:
        return [*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2, np.zeros(0, bool)]
    begin, grams = np.cumsum(sizes) - sizes, length - gram + 1
    hashes = gram_hashes(np.frombuffer(raw, np.uint8), gram)
    key = sliding_min(hashes, grams)
    owner = np.repeat(np.arange(len(bodies)), sizes)[:len(key)]
    inside = np.arange(len(key)) + length <= (begin + sizes)[owner]  # strings never cross documents
    change = np.ones(len(key) + 1, bool)
    change[1:-1] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    edge = np.flatnonzero(change)
    # ``inside`` holds for the first starts of a document, so it cuts a run at its end at most
    count = np.add.reduceat(inside, edge[:-1]) if len(key) else np.zeros(0, np.int64)
    at, count = edge[:-1][count > 0], count[count > 0].astype(np.int64)
    digest = np.array([xxhash.xxh3_64_intdigest(raw[a:a + c + length - 1]) for a, c in zip(at.tolist(), count.tolist(), strict=True)],
                      dtype=np.uint64)
    # places of least grams: hashes that equal the largest minimum of the strings around them
    around = ~sliding_min(~np.pad(key, grams - 1), grams)
    least = np.flatnonzero(hashes == around)
    low, high = np.searchsorted(least, at), np.searchsorted(least, at + count + grams - 1)
    each = np.repeat(np.arange(len(at)), high - low)
    place = least[np.arange(len(each)) - np.repeat(np.cumsum(high - low) - high, high - low)]
    own = np.bincount(each, hashes[place] == key[at][each], len(at)) > 1
    return owner[at], at - begin[owner[at]], count, key[at], digest, own


def segments(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows (rid, start, strings, key, digest, own) of all texts (rid, text)."""

    def cut(batches):
        for pdf in batches:
            bodies, rids, size = [], [], 0
            for i, (rid, text) in enumerate(zip(pdf.rid, pdf.text, strict=True)):
                bodies.append(text.encode())
                rids.append(rid)
                size += len(bodies[-1])
                if size >= CHUNK_BYTES or i == len(pdf) - 1:
                    doc, start, count, key, digest, own = segments_of(bodies, length, gram)
                    yield pd.DataFrame({"rid": np.array(rids, dtype=np.int64)[doc], "start": start, "strings": count,
                                        "key": key.view(np.int64), "digest": digest.view(np.int64), "own": own})
                    bodies, rids, size = [], [], 0

    return texts.select("rid", "text").mapInPandas(cut, "rid long, start int, strings int, key long, digest long, own boolean")


# ---- suffix arrays --------------------------------------------------------

def ranked(values: np.ndarray) -> np.ndarray:
    """Rank of each value among the distinct ones."""
    order = np.argsort(values)
    rank = np.empty(len(values), np.uint64)
    srt = values[order]
    rank[order] = np.cumsum(np.concatenate([[0], srt[1:] != srt[:-1]]).astype(np.uint64))
    return rank


def words(text: np.ndarray) -> np.ndarray:
    """View of the 8 bytes at each position as one big-endian number; ``text`` has 8 spare bytes."""
    return np.lib.stride_tricks.as_strided(text.view(np.uint8), (len(text) - 7, 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)


def sort_strings(text: np.ndarray, starts: np.ndarray, length: int = LENGTH):
    """(order, equal): starts sorted by their strings, and whether each equals the one before it.

    Prefix doubling: ranks by 8 bytes, then 16, 32, ... of two halves, until
    two overlapping prefixes make up the length.
    """
    depth, rank = 8, ranked(words(text))
    shift = np.uint64(32)
    while depth * 2 < length:
        joined = rank << shift
        joined[:-depth] |= rank[depth:]
        rank, depth = ranked(joined), 2 * depth
    last = (rank[starts] << shift) | rank[starts + length - depth]
    order = np.argsort(last, kind="stable")
    srt = last[order]
    return order, np.concatenate([[False], srt[1:] == srt[:-1]])


class Level:
    """A suffix array: starts in the order of their strings, and the number of each."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, number: np.ndarray):
        self.text, self.starts, self.number = text, starts, number

    def compare(self, at: np.ndarray, other: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """-1, 0 or 1 for own strings ``at`` against strings of another text."""
        out, open_ = np.zeros(len(at), np.int8), np.arange(len(at))
        for k in [*range(0, length - 8, 8), length - 8]:
            if not len(open_):
                break
            a, b = word_at(self.text, self.starts[at[open_]] + k), word_at(other, starts[open_] + k)
            out[open_] = np.where(a < b, -1, np.where(a > b, 1, 0))
            open_ = open_[a == b]
        return out

    def search(self, text: np.ndarray, starts: np.ndarray, length: int):
        """(place of the first string not below, whether it is equal) for each start."""
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.starts), np.int64)
        while (todo := np.flatnonzero(lo < hi)).size:
            mid = (lo[todo] + hi[todo]) // 2
            less = self.compare(mid, text, starts[todo], length) < 0
            lo[todo[less]], hi[todo[~less]] = mid[less] + 1, mid[~less]
        equal, there = np.zeros(len(starts), bool), np.flatnonzero(lo < len(self.starts))
        equal[there] = self.compare(lo[there], text, starts[there], length) == 0
        return lo, equal

    def merged(self, other: Level, length: int) -> Level:
        place, _ = self.search(other.text, other.starts, length)
        return Level(np.concatenate([self.text, other.text]),
                     np.insert(self.starts, place, other.starts + len(self.text)),
                     np.insert(self.number, place, other.number))


def word_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    every = np.lib.stride_tricks.as_strided(text, (len(text) - 7, 8), (1, 1))
    return every[at].view(">u8").ravel().astype(np.uint64)


class IndexFamily:
    """Suffix arrays of batches, in levels that merge geometrically; marks repeated strings."""

    def __init__(self, length: int = LENGTH):
        self.length, self.levels, self.seen, self.marks, self.size = length, [], [], [], 0

    def add(self, keys, digests, bases, bodies: list[bytes], twice) -> None:
        """A batch of segments, or parts of them from string ``base`` on; ``twice``: it occurs more than once."""
        sizes = np.array([len(b) for b in bodies], dtype=np.int64)
        count = sizes - self.length + 1
        begin, first = np.cumsum(sizes) - sizes, np.cumsum(count) - count
        n = int(count.sum())
        starts = np.arange(n) + np.repeat(begin - first, count)
        text = np.frombuffer(b"".join(bodies) + b"\0" * 8, np.uint8)
        order, equal = sort_strings(text, starts, self.length)
        starts, number = starts[order], order + self.size
        self.marks += [number[equal], number[:-1][equal[1:]], np.repeat(np.asarray(twice, bool), count).nonzero()[0] + self.size]
        if self.levels:
            once = np.flatnonzero(~equal)
            for level in self.levels:
                place, found = level.search(text, starts[once], self.length)
                # equal strings within one array are marked already, so the first stands for all
                self.marks += [level.number[place[found]], number[once[found]]]
        self.levels.append(Level(text, starts, number))
        while len(self.levels) > 1 and len(self.levels[-2].starts) < 2 * len(self.levels[-1].starts):
            late = self.levels.pop()
            self.levels[-1] = self.levels[-1].merged(late, self.length)
        self.seen.append((np.asarray(keys), np.asarray(digests), np.asarray(bases), count))
        self.size += n

    def repeated(self) -> pd.DataFrame:
        """Rows (key, digest, low, high): runs of marked strings in each segment."""
        flag = np.zeros(self.size + 1, bool)
        flag[np.concatenate(self.marks)] = True
        keys, digests, bases, count = (np.concatenate(x) for x in zip(*self.seen, strict=True))
        owner = np.repeat(np.arange(len(count)), count)
        first = np.cumsum(count) - count
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        on = flag[:-1]
        low = np.flatnonzero(on & (new | ~np.concatenate([[False], on[:-1]])))
        high = np.flatnonzero(on & (np.concatenate([new[1:], [True]]) | ~flag[1:])) + 1
        o = owner[low]
        begin = bases[o] - first[o]
        return pd.DataFrame({"key": keys[o], "digest": digests[o], "low": low + begin, "high": high + begin})


def match_segments(bodies: DataFrame, length: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Repeated runs of rows (shard, key, digest, base, twice, body), shard by shard."""

    def add(family, pdf):
        family.add(pdf["key"].to_numpy(), pdf["digest"].to_numpy(), pdf["base"].to_numpy(), pdf["body"].tolist(),
                   pdf["twice"].to_numpy())

    def match(batches):
        held, size, family, family_key = [], 0, None, None

        def take(at_end):
            nonlocal held, size, family, family_key
            rows = pd.concat(held, ignore_index=True)
            key = rows["shard"].to_numpy()
            if family is not None:  # the levels of a large shard go on
                own = key == family_key
                if own.any():
                    add(family, rows[own])
                rows, key = rows[~own], key[~own]
                if len(rows) or at_end:
                    yield family.repeated()
                    family = None
            going_on = key == key[-1] if len(key) and not at_end else np.zeros(len(key), bool)
            done = rows[~going_on]
            if len(done):
                whole = IndexFamily(length)
                add(whole, done)
                yield whole.repeated()
            held, size = [], 0
            if going_on.any():
                rest = rows[going_on]
                if len(done):
                    held, size = [rest], int(rest["body"].map(len).sum())
                else:
                    family, family_key = IndexFamily(length), int(key[-1])
                    add(family, rest)

        for pdf in batches:
            if len(pdf):
                held.append(pdf)
                size += int(pdf["body"].map(len).sum())
                if size >= batch_bytes:
                    yield from take(False)
        if held:
            yield from take(True)
        elif family is not None:
            yield family.repeated()

    sorted_ = bodies.repartition("shard").sortWithinPartitions("shard", "key", "digest", "base")
    return sorted_.mapInPandas(match, "key long, digest long, low int, high int")


# ---- the whole ------------------------------------------------------------

def long_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_segments: int = HOT_SEGMENTS,
                 large_segments: int = LARGE_SEGMENTS, batch_bytes: int = BATCH_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (rid, doc_id, text, low, high): arrays of the repeated strings' first starts and ends of starts."""
    texts = with_row_id(narrow(docs, doc_id=id_col, text=text_col)).select(
        "rid", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    cut = segments(texts, length, gram)
    keys = cut.groupBy("key").agg(F.count("*").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"),
                                  F.max("own").alias("own"))
    keys = keys.where((F.col("n") > 1) | F.col("own"))
    keys = materialize(keys.select("key", ((F.col("n") > 1) & (F.col("lo") == F.col("hi"))).alias("same"),
                                   (F.col("n") > hot_segments).alias("hot"), (F.col("n") > large_segments).alias("large")), "repeated-keys")
    found = materialize(cut.join(keys, "key").select("rid", "start", "strings", "key", "digest", "same", "hot", "large"), "segments")

    # one copy of each distinct segment, with the bytes of the document that has it first
    first = found.where(~F.col("same")).groupBy("key", "digest").agg(
        F.min(F.struct("rid", "start", "strings", "hot", "large")).alias("at"), (F.count("*") > 1).alias("twice"))
    wanted = first.groupBy("at.rid").agg(F.collect_list(F.struct(
        "key", "digest", "twice", "at.start", "at.strings", "at.hot", "at.large")).alias("w"))
    columns = ("key", "digest", "twice", "start", "strings", "hot", "large")
    wanted = wanted.select("rid", *[F.col(f"w.{c}").alias(c) for c in columns])
    # dealt once by row; both joins use this exchange
    dealt = texts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "rid")

    def bodies(batches):
        for pdf in batches:
            out, large = [], []
            for text, *lists in zip(pdf.text, *[pdf[c] for c in columns], strict=True):
                raw = text.encode()
                for k, d, t, s, n, h, more in zip(*lists, strict=True):
                    part = (int(k), k, d, 0, t, raw[s:s + n + length - 1], h)
                    (large if more and not h else out).append(part)
            at, start, count, finer, _, _ = segments_of([p[5] for p in large], length,
                                                         1 << min(LONG_GRAM, length).bit_length() - 1)
            for i, s, n, f in zip(at.tolist(), start.tolist(), count.tolist(), finer.view(np.int64).tolist(), strict=True):
                _, k, d, _, t, raw, h = large[i]
                out.append((k ^ f, k, d, s, t, raw[s:s + n + length - 1], h))
            yield pd.DataFrame(out, columns=["shard", "key", "digest", "base", "twice", "body", "hot"])

    body = dealt.join(wanted, "rid").mapInPandas(
        bodies, "shard long, key long, digest long, base int, twice boolean, body binary, hot boolean")
    if keys.where("hot and not same").isEmpty():
        runs = match_segments(body.drop("hot"), length, batch_bytes)
    else:
        body = materialize(body, "segment-bodies")
        runs = match_segments(body.where(~F.col("hot")).drop("hot"), length, batch_bytes).unionByName(
            match_strings(body.where(F.col("hot")), length))
    marked = found.where(~F.col("same")).join(runs, ["key", "digest"]).select(
        "rid", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
    marked = marked.unionByName(found.where("same").select("rid", F.col("start").alias("low"), (F.col("start") + F.col("strings")).alias("high")))
    marked = marked.groupBy("rid").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
    return dealt.join(marked, "rid", "left").select("rid", "doc_id", "text", "low", "high")


def match_strings(bodies: DataFrame, length: int) -> DataFrame:
    """The runs of hot keys' segments, from 128-bit hashes of their single strings."""

    def strings(batches):
        import xxhash
        for pdf in batches:
            for key, digest, twice, body in zip(pdf.key, pdf.digest, pdf.twice, pdf.body, strict=True):
                h = [xxhash.xxh3_128_digest(body[i:i + length]) for i in range(len(body) - length + 1)]
                yield pd.DataFrame({"key": key, "digest": digest, "low": np.arange(len(h)), "n": 1 + int(twice), "h": h})

    each = materialize(bodies.mapInPandas(strings, "key long, digest long, low int, n long, h binary"), "hot-strings")
    again = each.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    return each.join(again, "h").select("key", "digest", "low", (F.col("low") + 1).alias("high"))


def removed_runs(low, high, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs [a, b) covered by the strings that start in any [low, high)."""
    if low is None or not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(low, kind="stable")
    a, b = np.asarray(low)[order].astype(np.int64), np.asarray(high)[order].astype(np.int64) + length - 1
    reach = np.maximum.accumulate(b)
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    return a[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(a) - 1]])]


def without_repeats(raw: bytes, low, high, length: int = LENGTH) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, runs removed)."""
    a, b = removed_runs(low, high, length)
    edges = [0, *np.column_stack([a, b]).ravel().tolist(), len(raw)]
    return b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)), int((b - a).sum()), len(a)


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, kept binary, n_bytes, n_removed, n_spans) of all documents."""
    length = options.get("length", LENGTH)
    found = long_repeats(docs, **options)

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def remove(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lows, highs in batches:
            out = [without_repeats(t.encode(), a, b, length) for t, a, b in zip(texts, lows, highs, strict=True)]
            yield pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])

    found = found.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), remove("text", "low", "high").alias("r"))
    return found.select("doc_id", "r.kept", "n_bytes", "r.n_removed", "r.n_spans")


__all__ = ["remove_repeats", "long_repeats"]
