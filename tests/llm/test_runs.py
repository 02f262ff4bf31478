"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib

import pytest

from pitchforge.llm import period_runs, registry

from .conftest import SF, same


def every_period(w, least=6, exponent=4):
    n, out = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q) and j > i:
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, m, q) for (s, m), q in out.items())


def tiled(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def digest(doc_id, text):
    w = tiled(doc_id, text)
    runs = every_period(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_small_alphabets():
    rng = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            w = [rng.choice([b"a", b"b", b"c"][:rng.randint(1, 3)]) for _ in range(rng.randint(0, 50))]
            if rng.random() < 0.5 and w:
                a = rng.randrange(len(w))
                p = 1 + (len(w) - a) // rng.randint(2, 9)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))] * rng.randint(1, 2)
            texts.append(w)
        assert period_runs.runs_of(texts) == [every_period(w) for w in texts]
    assert period_runs.runs_of([]) == [] and period_runs.runs_of([[], [b"x"]]) == [[], []]


def test_long_texts_take_no_square_of_time():
    n = 300_000
    assert period_runs.runs_of([[b"a"] * n])[0] == [(0, n, 1)]
    words = [b"%d" % (i % 70_000) for i in range(n)]
    assert period_runs.runs_of([words])[0] == [(0, n, 70_000)]
    # the first and last words of texts in one batch don't meet
    assert period_runs.runs_of([[b"a"] * 5, [b"a"] * 5]) == [[], []]


def rows(df):
    return [tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                 "collapsed_sha256")) for r in df.collect()]


def test_query_on_the_table(spark, docs):
    got = rows(registry.op11_period_runs(spark, SF))
    same(got, [digest(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sum(r[1] > 0 for r in got) > 3


def test_odd_rows(odd_docs, odd_rows):
    found = period_runs.find_runs(period_runs.tile_words(odd_docs))
    same(rows(period_runs.run_digest(found)), [digest(*r) for r in odd_rows])


def test_separators_and_results(spark):
    t = "x y a\x0bb\x0ca\rb\na\tb  a b"
    df = spark.createDataFrame([(1, t, 5), (None, None, 6), (2, "", 7), (2, "é " * 7, 8)], "doc_id long, text string, runs int")
    got = {(r["doc_id"], r["n_words"]): ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in period_runs.find_runs(df).collect()}
    assert got == {(1, 9): ([(1, 8, 2)], "x y a b"), (None, 0): ([], ""), (2, 0): ([], ""), (2, 7): ([(0, 7, 1)], "é")}
    with pytest.raises(ValueError):
        period_runs.find_runs(df, exponent=3)


def test_no_rows(no_docs):
    assert period_runs.run_digest(period_runs.find_runs(period_runs.tile_words(no_docs))).collect() == []
