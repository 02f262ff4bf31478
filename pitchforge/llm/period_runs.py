"""Periodic runs of words by a dictionary of basic factors (operator 11).

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) of at least ``max(least, exponent * q)`` words that no neighbouring
word extends.

The dictionary gives the factors of each power-of-two length L of a text names,
equal names for equal factors; the name at length 2L comes from the names of the
two halves.  Successor occurrences of a name that lie at most 2L apart and follow
each other at the same distance p are an arithmetic progression, which proposes
the period p at its first member.  A run with period q shows its progression at
the least L of at least q: a factor that long recurs within the run at distance
q and no sooner, and at least three times, as 2q + L < 4q.  So factors that occur
less than three times need no name at any longer length, which leaves few names
in plain prose.  Proposals are extended word by word to both sides, and
of the periods that propose the same stretch the smallest stays, which is its
smallest period by the theorem of Fine and Wilf.

The texts of an Arrow batch share one dictionary; words of different texts have
different names, so that no factor crosses from text to text.  Work is n log^2 n
for n words, and no row is shuffled.

Words are maximal stretches without space and the characters U+0009 to U+000D.
Null and empty texts have no words and no runs; a null id stays null (and is not
tiled); repeated rows each get their own result; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow

#: A run has at least so many words, and so many times its period.
LEAST, EXPONENT = 6, 4
#: Words compared in the first step of an extension; later steps double.
STEP = 32


def word_numbers(words: list[bytes], base: int) -> list[int]:
    """Numbers from ``base`` on, equal for equal words of one text."""
    known: dict[bytes, int] = {}
    return [known.setdefault(w, base + len(known)) for w in words]


def proposals(word: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """(period, place) of the progressions of all factor lengths, by period, then place.

    ``word`` has the names of the factors of length 1, ``end`` the end of each
    place's text.
    """
    n, length = len(word), 1
    place, name = np.arange(n), word
    named = np.full(n + 1, -1, np.int64)
    periods, places = [], []
    while len(place):
        often = np.bincount(name)[name] >= 3
        place, name = place[often], name[often]
        if not len(place):
            break
        order = np.argsort(name, kind="stable")  # places ascend within a name
        at, same = place[order], np.diff(name[order]) == 0
        gap = np.where(same, np.diff(at), 0)
        steady = np.flatnonzero((gap[1:] == gap[:-1]) & (gap[1:] > 0) & (gap[1:] <= 2 * length))
        # the first member of each progression stands for the others
        first = steady[(np.diff(steady, prepend=-2) > 1) | (gap[steady - 1] != gap[steady])]
        periods.append(gap[first])
        places.append(at[first])
        # names of twice the length, where both halves have one and the text goes on
        named[:] = -1
        named[place] = name
        right = named[np.minimum(place + length, n)]
        whole = (right >= 0) & (place + 2 * length <= end[place])
        pair = name[whole] * (int(name.max()) + 1) + right[whole]
        place, name = place[whole], np.unique(pair, return_inverse=True)[1]
        length *= 2
    p, i = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (periods, places))
    order = np.lexsort((i, p))
    p, i = p[order], i[order]
    # of neighbouring places with one period the first finds the run of all
    new = (np.diff(p, prepend=-1) != 0) | (np.diff(i, prepend=-2) > 1)
    return list(zip(p[new].tolist(), i[new].tolist(), strict=True))


def agreement(word: np.ndarray, a: int, b: int, back: bool) -> int:
    """How many words from places a < b on (or before them) agree; steps double."""
    done, step = 0, STEP
    while True:
        if back:
            m = min(step, a - done)
            differ = (word[a - done - m:a - done] != word[b - done - m:b - done])[::-1]
        else:
            m = min(step, len(word) - b - done)
            differ = word[a + done:a + done + m] != word[b + done:b + done + m]
        k = int(differ.argmax()) if m else 0
        if m and differ[k]:
            return done + k
        done += m
        if m < step:
            return done
        step *= 2


def find(word: np.ndarray, end: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    smallest: dict[tuple[int, int], int] = {}
    period, reached = 0, 0
    for p, i in proposals(word, end):
        if p == period and i + p < reached:
            continue  # inside the stretch of the proposal before
        left = agreement(word, i, i + p, back=True)
        right = agreement(word, i, i + p, back=False)
        period, reached = p, i + p + right
        if left + right + p >= max(least, exponent * p):
            smallest.setdefault((i - left, reached), p)  # periods ascend
    return sorted((s, e - s, p) for (s, e), p in smallest.items())


def runs_of(texts: list[list[bytes]], least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text (a list of words), by one dictionary of all of them."""
    names, size, base = [], [len(t) for t in texts], 0
    for t in texts:
        names.append(word_numbers(t, base))
        base += len(t)
    word = np.fromiter((w for t in names for w in t), np.int64, base)
    start = np.cumsum([0, *size])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = find(word, np.repeat(start[1:], size), least, exponent)
    of = np.searchsorted(start, [s for s, _, _ in found], side="right") - 1
    for (s, m, p), t in zip(found, of.tolist(), strict=True):
        out[t].append((s - int(start[t]), m, p))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words, without those that a run holds after its first period, joined by spaces."""
    if runs:
        gone = np.zeros(len(words), bool)
        for s, m, p in runs:
            gone[s + p:s + m] = True
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return b" ".join(words).decode()


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
              exponent: int = EXPONENT) -> DataFrame:
    """A row for each document: (doc_id, n_words, runs array<struct<start, length, period>>, collapsed).

    ``exponent`` is at least 4, as a progression needs three occurrences.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods may show no progression")

    @F.pandas_udf("struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            # split() of bytes parts at exactly the six separators
            words = [(t or "").encode().split() for t in texts]
            found = runs_of(words, least, exponent)
            yield pd.DataFrame({
                "n_words": [len(w) for w in words],
                "runs": [[{"start": s, "length": m, "period": p} for s, m, p in r] for r in found],
                "collapsed": [collapse(w, r) for w, r in zip(words, found, strict=True)]})

    return narrow(docs, doc_id=id_col, text=text_col).withColumn("f", search("text")).select(
        "doc_id", "f.n_words", "f.runs", "f.collapsed")


def tile_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with texts made periodic from some word on in a tenth of the documents, by a checksum of the id.

    With h the CRC-32 of the decimal id, g = h // 10 and n > 0 words: if h % 10 is
    0, word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    Such texts hold their words joined by single spaces; others stay as they are.
    """

    @F.pandas_udf("string")
    def tiled(ids: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for i, t in zip(ids, texts, strict=True):
            h = zlib.crc32(i.encode()) if isinstance(i, str) else 1
            words = t.encode().split() if t and h % 10 == 0 else []
            if words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                t = b" ".join(words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]).decode()
            out.append(t)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, tiled(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")))


def run_digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_runs``: counts, the longest run, hashes of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines: Column = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumn("best", longest)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


__all__ = ["find_runs", "tile_words", "run_digest", "runs_of"]
