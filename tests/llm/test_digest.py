"""Improbable-feature digests against plain loops."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from pitchforge.llm import improbable_digest as d
from pitchforge.llm import registry

from .conftest import SF, prose, same


def classes(raw):
    """Entropy classes of all windows, counted one by one."""
    out = []
    for i in range(len(raw) - d.WINDOW + 1):
        h = sum(c / d.WINDOW * math.log2(d.WINDOW / c) for c in Counter(raw[i:i + d.WINDOW]).values())
        out.append(1000 * h / math.log2(d.WINDOW))
    return out


def places(raw, rank):
    r = [int(rank[c]) for c in d.entropy_classes(np.frombuffer(raw, np.uint8))]
    width, wins = min(d.STRETCH, len(r)), Counter()
    for i in range(len(r) - width + 1 if r else 0):
        j = min(range(i, i + width), key=lambda j: (r[j], j))
        if r[j] < d.CLASSES:
            wins[j] += 1
    return sorted(j for j, n in wins.items() if n >= max(1, min(d.POPULAR, max(wins.values()))))


TEXTS = ["", "a", "short", "x" * 500, "ab" * 300, "ü é ñ " * 30, prose(random.Random(1), 40), prose(random.Random(2), 400),
         "".join(random.Random(3).choices("0123456789abcdef", k=900)), "z" * 100 + prose(random.Random(4), 20)]


def test_entropy_and_features():
    counts = np.random.default_rng(1).integers(0, 50, d.CLASSES)
    rank = d.ranks(counts)
    for t in TEXTS:
        raw = t.encode()
        got = d.entropy_classes(np.frombuffer(raw, np.uint8))
        want = classes(raw)
        assert len(got) == len(want) and all(abs(g - w) <= 1 and g == math.floor(w + 1e-6) or abs(w - round(w)) < 1e-6
                                             for g, w in zip(got, want, strict=True))
        if raw:
            assert d.features(rank[got]).tolist() == places(raw, rank)


def test_classes_across_a_seam():
    texts = [t.encode() for t in TEXTS]
    of = lambda raw: d.entropy_classes(np.frombuffer(raw, np.uint8))
    for a in texts:
        for b in texts:
            for m, n in ((0, 0), (5, 9), (31, 31), (32, 40), (200, 3), (90, 200)):
                assert d.spliced(a[:m], of(a), b[:n], of(b)).tolist() == of(a[:m] + b[:n]).tolist()


def test_rare_classes_come_first():
    counts = np.zeros(d.CLASSES, np.int64)
    counts[700], counts[650], counts[600] = 5, 3, 3
    rank = d.ranks(counts)
    assert rank[600] < rank[650] < rank[700] and (rank[:d.LEAST_CLASS] == d.CLASSES).all()


def test_digests_and_likeness():
    rank = d.ranks(np.random.default_rng(1).integers(0, 50, d.CLASSES))
    digests = [d.Digest.of(t, rank) for t in TEXTS]
    for t, a in zip(TEXTS, digests, strict=True):
        assert str(d.Digest.parse(str(a))) == str(a) == str(d.Digest.of(t, rank)) and d.likeness(a, a) == 1
        assert (str(a) == "") == (t == "")
        for b in digests:
            assert d.likeness(a, b) == d.likeness(b, a) and 0 <= d.likeness(a, b) <= 1
            if a is not b:
                assert d.likeness(a, b) < 0.3
    assert str(d.Digest.of(None, rank)) == ""
    long = prose(random.Random(9), 30_000)
    chain = d.Digest.of(long, rank)
    assert len(chain.filters) > 20 and set(chain.counts[:-1]) == {d.FEATURES}
    assert d.likeness(chain, d.Digest.of(long[:len(long) // 2], rank)) > 0.9
    assert 0.35 < d.likeness(chain, d.Digest.of(long[:len(long) // 2] + prose(random.Random(10), 15_000), rank)) < 0.65
    # each filter has exactly the bits of its features
    x = np.frombuffer(long.encode(), np.uint8)
    bits = d.feature_bits(x, d.features(rank[d.entropy_classes(x)]))
    for n, f in enumerate(chain.filters):
        assert set(np.flatnonzero(np.unpackbits(f))) == set(bits[n * d.FEATURES:(n + 1) * d.FEATURES].ravel())


def test_class_counts_cover_all_texts(docs, no_docs):
    want = np.zeros(d.CLASSES, np.int64)
    for r in docs.collect():
        if r["text"]:
            want += np.bincount(d.entropy_classes(np.frombuffer(r["text"].encode(), np.uint8)), minlength=d.CLASSES)
    assert (d.class_counts(docs) == want).all() and d.class_counts(no_docs).sum() == 0


def plain(rows, counts):
    """The trial's rows, of (doc_id, text) in the order of the scan."""
    rank = d.ranks(counts)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for (i, t), (_, u) in zip(order, [*order[1:], *order[:1]], strict=True):
        t, u = t or "", u or ""
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        a, b, c = (d.Digest.of(x, rank) for x in (t, e, u))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), str(a), str(b), d.likeness(a, b), d.likeness(a, c)))
    return out


def test_query_on_the_table(spark, docs):
    got = registry.op13_improbable_digest(spark, SF).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    same(got, plain(rows, d.class_counts(docs)))
    long = [r for r in got if r["n_chars"] >= 256]
    assert len(long) > 100 and all(r["near_edited"] > r["near_next"] for r in long)


def test_odd_rows(odd_docs, odd_rows):
    same(d.edit_trial(odd_docs).collect(), plain(odd_rows, d.class_counts(odd_docs)))


def test_many_ranges(spark, tmp_path):
    """More tasks than rows in most, equal ids, and an only document that is its own next."""
    rng = random.Random(4)
    rows = [(rng.choice([7, 7, 7, i, None]), prose(rng, rng.randint(0, 12))) for i in range(400)]
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(path)
    df = spark.read.parquet(path)
    order = [(r["doc_id"], r["text"]) for r in df.collect()]
    work = lambda a, b: (len(a), f"{a}|{b}")
    got = d.with_next(df, str, work, "n long, both string", 400 * d.TASK_BYTES).collect()
    ordered = sorted(order, key=lambda r: (r[0] is None, r[0] or 0))
    same(got, [(i, len(t), f"{t}|{u}") for (i, t), (_, u) in zip(ordered, [*ordered[1:], *ordered[:1]], strict=True)])
    one = spark.createDataFrame([("k", "only")], "id string, body string")
    assert [tuple(r) for r in d.with_next(one, str, work, "n long, both string", 0, "id", "body").collect()] == [("k", 4, "only|only")]


def test_no_rows(no_docs):
    got = d.edit_trial(no_docs)
    assert got.collect() == [] and got.columns[0] == "doc_id"


def test_general_interface(spark, odd_docs):
    counts = d.class_counts(odd_docs)
    got = d.fingerprints(odd_docs, counts)
    by_text = {}
    for a, b in zip(odd_docs.collect(), got.collect(), strict=True):
        assert by_text.setdefault(a["text"] or "", b["fingerprint"]) == b["fingerprint"] and a["doc_id"] == b["doc_id"]
    pairs = got.withColumnRenamed("fingerprint", "other").where("doc_id = 8").crossJoin(got.where("doc_id = 9"))
    assert all(r["s"] == pytest.approx(1, abs=0.1) for r in pairs.select(d.like("other", "fingerprint").alias("s")).collect())
