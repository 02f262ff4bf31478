"""Operators that find pairs, spans and repeats, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from pitchforge.llm import decontam, maxscore, registry, secrets_scan, simhash_bk, suffix_dedup

from . import brute
from .conftest import SF, prose, same


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# ---- 1 --------------------------------------------------------------------

def test_secret_spans(spark, docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        want = [(d, ",".join(brute.base_spans(t))) for d, t in rows(df, "doc_id", "text")]
        found = secrets_scan.find_secrets(df)
        base = F.array_join(F.transform(F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex")),
                                        lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
        same(rows(found.select("doc_id", base.alias("b")), "doc_id", "b"), want)
    assert secrets_scan.span_digest(secrets_scan.find_secrets(no_docs)).count() == 0


def test_weak_parts_need_a_complement():
    f = secrets_scan.Finder()
    kinds = lambda t: [k for _, _, k in f.spans(t)[1]]
    assert kinds("see https://example.net/a and mail") == []
    assert kinds("user = bob, see https://example.net") == []  # no secret
    assert kinds("Qx7+kP2/vR9zLm4Wt8 alone") == []
    assert kinds("https://db.example.net Qx7+kP2/vR9zLm4Wt8") == ["endpoint", "secret"]
    assert kinds('password = "hunter22" at 10.0.0.1:5432') == ["assign", "endpoint"]
    assert kinds('password = "hunter22"' + " x" * 300 + " 10.0.0.1") == ["assign"]  # out of reach
    assert kinds('password = "hunter22"\n \n10.0.0.1') == ["assign"]  # another block
    many = "user=abc " * 300 + "token=abcdef1"
    assert kinds(many).count("identifier") == 29


def test_overlapped_weak_parts_vouch():
    f = secrets_scan.Finder()
    text = "https://db.example.com/login?token=abcdef123456 then Qx7+kP2/vR9zLm4Wt8"
    assert [(text[s:e], k) for s, e, k in f.spans(text)[1]] == [("token=abcdef123456", "assign"), ("Qx7+kP2/vR9zLm4Wt8", "secret")]
    assert [k for _, _, k in f.spans("https://db.example.com/login?token=abcdef123456 alone")[1]] == ["assign"]


def test_linking_equals_all_pairs():
    rng, finder = random.Random(1), secrets_scan.Finder()
    apart = lambda p, q: p[1] <= q[0] or q[1] <= p[0]
    for n in range(200):
        blanks = sorted(rng.sample(range(3000), 4))
        parts = [(s := rng.randrange(3000), s + rng.randint(1, 60), rng.choice(secrets_scan.KINDS)) for _ in range(rng.randint(0, 12 + n // 4))]
        block = lambda p: sum(b <= p[0] for b in blanks)
        role = lambda p: secrets_scan.ROLES[p[2]]
        near = lambda p, q: max(p[0], q[0]) - min(p[1], q[1]) <= secrets_scan.REACH
        base, weak = [p for p in parts if p[2] in secrets_scan.BASE], []
        for p in sorted((p for p in parts if p[2] not in secrets_scan.BASE), key=lambda p: (p[0] - p[1], p[0], secrets_scan.KINDS.index(p[2]))):
            if all(apart(p, q) for q in weak):
                weak.append(p)
        want = [p for p in weak if all(apart(p, q) for q in base) and any(
            apart(p, q) and (role(p) == "secret") != (role(q) == "secret") and block(p) == block(q) and near(p, q) for q in base + weak)]
        got = finder.apart(secrets_scan.linked(base + secrets_scan.containers([p for p in parts if p not in base]), blanks), base)
        assert sorted(got) == sorted(want)


def test_a_part_is_no_complement_of_itself():
    spans = lambda t: [(k, t[s:e]) for s, e, k in secrets_scan.Finder().spans(t)[1]]
    assert spans("See https://docs.example.com/Guide-2024/Intro_Part1 for details.") == []
    assert spans("https://a.example.org/Path-12/Xy_Z9/ab and https://b.example.org/2024/Some_Title-With1Digits too") == []
    assert spans("https://db.example.net/main key part Zz9+/xYw8Vu7Ts6R then") == [
        ("endpoint", "https://db.example.net/main"), ("secret", "Zz9+/xYw8Vu7Ts6R")]
    assert spans("https://db.example.com/login?token=abcdef123456 then Zz9+/xYw8Vu7Ts6R") == [
        ("assign", "token=abcdef123456"), ("secret", "Zz9+/xYw8Vu7Ts6R")]


def test_redaction(spark, odd_docs, no_docs):
    got = dict(rows(secrets_scan.redact(odd_docs).where("doc_id in (1, 2, 11, 12)"), "doc_id", "text"))
    assert got[1] == "" and got[2] is None
    assert "hunter2" not in got[11] and "example" not in got[11] and got[11].startswith("<redacted>")
    assert got[12] == "<redacted> <redacted> <redacted>' deadbeef"
    assert secrets_scan.redact(odd_docs).columns == odd_docs.columns and secrets_scan.redact(no_docs).count() == 0


# ---- 4 --------------------------------------------------------------------

def test_top_k(spark, tmp_path):
    rng = random.Random(2)
    vec = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(230)]
    vec += [(50, [0.5] * 12), (300, None), (350, [0.1, None]), (400, [float("nan")] * 12), (450, [float("inf")] * 12),
            (500, []), (550, [0.0] * 12), (None, [0.4] * 12), (600, [0.3] * 5), (7, vec[7][1]), (8, vec[7][1])]
    vec += [(650 + i, [round(rng.random()) / 2 for _ in range(12)]) for i in range(120)]  # many ties
    spark.createDataFrame([(i, v, 1) for i, v in vec], "vec_id long, embedding array<float>, score int").write.parquet(f"{tmp_path}/v")
    table = spark.read.parquet(f"{tmp_path}/v")
    exact = rows(table, "vec_id", "embedding")  # as floats
    found = maxscore.integer_vectors(table, "vec_id", "embedding").transform(lambda d: _written(d, tmp_path))
    want = brute.top_k(exact)
    for shard, block in ((8192, 2048), (37, 3)):
        got = maxscore.top_k(found, F.col("id") % 50 == 0, 5, shard, block)
        same(rows(got, "query_id", "rank", "id", "score"), want)
    assert maxscore.search(table.where("false"), lambda i: i % 50 == 0).count() == 0
    two = maxscore.search(table.where("vec_id in (100, 101)"), lambda i: i % 50 == 0)
    assert two.count() == 1


def test_top_k_in_many_partitions(spark):
    """Both sides of the cogroup meet wherever their keys are dealt."""
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        got = rows(registry.op4_maxscore(spark, SF), "query_id", "rank", "vec_id", "score")
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    want = brute.top_k(rows(e, "vec_id", "embedding"))
    assert want
    same(got, want)


def test_top_k_of_large_components(spark, tmp_path):
    """Bounds, products and components beyond a long: scores that fit are exact."""
    rng = random.Random(4)
    vec = [(i, [rng.choice([-1, 1]) * 2e6 * rng.random() for _ in range(12)]) for i in range(160)]
    vec += [(200 + i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(101)]
    vec += [(400, [1e30] + [0.0] * 11), (401, [-1e30] + [0.5] * 11), (403, [0.0] * 11 + [2.0 ** 60])]
    spark.createDataFrame(vec, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/v")
    table = spark.read.parquet(f"{tmp_path}/v")
    fits = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    want = [(q, r, i, fits(s)) for q, r, i, s in brute.top_k(rows(table, "vec_id", "embedding"))]
    same(rows(maxscore.search(table, lambda i: i % 50 == 0), "query_id", "rank", "vec_id", "score"), want)


def _written(df, tmp_path):
    df.write.parquet(f"{tmp_path}/written")
    return df.sparkSession.read.parquet(f"{tmp_path}/written")


def test_top_k_table(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    same(rows(registry.op4_maxscore(spark, SF), "query_id", "rank", "vec_id", "score"), brute.top_k(rows(e, "vec_id", "embedding")))


# ---- 6 --------------------------------------------------------------------

@pytest.mark.parametrize("which,options", [("docs", {}), ("odd_docs", {}), ("docs", {"large_segments": 1})])
def test_repeats(request, which, options):
    df = request.getfixturevalue(which)
    got = rows(suffix_dedup.remove_repeats(df, **options).withColumn("sha", F.sha2("kept", 256)), "doc_id", "n_bytes", "n_removed", "n_spans", "sha")
    table = rows(df, "doc_id", "text")
    same(got, [(d, *r) for (d, _), r in zip(table, brute.repeats([t for _, t in table]))])


def test_repeats_in_small_batches_and_hot_keys(odd_docs, no_docs):
    whole = suffix_dedup.remove_repeats(odd_docs)
    for options in ({"batch_bytes": 400}, {"large_segments": 1}, {"large_segments": 1, "batch_bytes": 400}, {"hot_segments": 1}):
        same(rows(suffix_dedup.remove_repeats(odd_docs, **options), *whole.columns), rows(whole, *whole.columns))
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_index_family_equals_counts():
    rng = random.Random(4)
    base = prose(rng, 200).encode()
    bodies = []
    for _ in range(60):
        a = rng.randrange(len(base) - 300)
        body = bytearray(base[a:a + rng.randint(200, 300)])
        if rng.random() < 0.7:
            body[rng.randrange(len(body))] = 35
        bodies.append(bytes(body))
    bodies = list(dict.fromkeys(bodies))
    family, levels = suffix_dedup.IndexFamily(), 0
    for lo in range(0, len(bodies), 5):
        levels, part = max(levels, len(family.levels)), bodies[lo:lo + 5]
        family.add([7] * len(part), list(range(lo, lo + len(part))), [0] * len(part), part, [i % 13 == 0 for i in range(lo, lo + len(part))])
    assert 1 < levels < 8
    seen = {}
    for i, b in enumerate(bodies):
        for j in range(len(b) - 199):
            seen.setdefault(b[j:j + 200], []).append((i, j))
    want = {p for places in seen.values() if len(places) > 1 for p in places}
    want |= {(i, j) for i, b in enumerate(bodies) if i % 13 == 0 for j in range(len(b) - 199)}
    got = {(r.digest, j) for r in family.repeated().itertuples() for j in range(r.low, r.high)}
    assert got == want


# ---- 8 --------------------------------------------------------------------

@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_simhash(request, which):
    df = request.getfixturevalue(which)
    got = simhash_bk.near_duplicates(df).select("doc_id", simhash_bk.fingerprint_hex(F.col("fp")).alias("f"), "component_id")
    same(rows(got, "doc_id", "f", "component_id"), brute.components(rows(df, "doc_id", "text")))


def test_links_of_shards_and_deeper_shards(spark, tmp_path):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {b for b in base}
    for b in base[:20]:
        for _ in range(30):
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                b ^= 1 << bit
            fps.add(b)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    spark.createDataFrame([(x,) for x in fps], "fp long").write.parquet(f"{tmp_path}/fp")
    table = spark.read.parquet(f"{tmp_path}/fp")
    import numpy as np
    a = np.array(fps, dtype=np.int64).view(np.uint64)
    label = simhash_bk.bk_groups(a, 3)
    want = {int(a.view(np.int64)[i]): int(a.view(np.int64)[label == label[i]].min()) for i in range(len(a)) if a.view(np.int64)[i] != a.view(np.int64)[label == label[i]].min()}
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 3
    assert all(len(set(label[near[i]])) == 1 for i in range(len(a)))  # linked values share a group
    for limit in (100_000, 3):
        root = simhash_bk.components(simhash_bk.fingerprint_links(table, 3, limit))
        assert dict(rows(root, "node", "root")) == want


def test_one_row_of_each_component_stays(odd_docs, no_docs):
    kept = simhash_bk.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and simhash_bk.keep_one(no_docs).count() == 0
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for _, _, c in brute.components(rows(odd_docs, "doc_id", "text")) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want)


# ---- 9 --------------------------------------------------------------------

def test_leaks(spark, docs, odd_docs, no_docs, tmp_path):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute.leaks(rows(docs, "doc_id", "text"), rows(bench, "item_id", "text"))
    got = decontam.leaks(docs, bench)
    same(rows(got, "doc_id", "item_id", "n_words", "similarity"), want)
    assert want
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([1, 2, 4, 5, 6, 12, 30, 60, 200])] + [(90, None), (91, ""), (None, prose(rng, 20))]
    items += [(92, items[6][1])]
    texts = []
    for i, (_, t) in enumerate(items):
        for changed in (0, 1, 2, 3):
            w = (t or "").split()
            for at in rng.sample(range(len(w)), min(changed, len(w))):
                w[at] = "zzz"
            texts.append((1000 * i + changed, prose(rng, rng.randint(0, 40)) + " " + " ".join(w).upper() + "!\n" + prose(rng, rng.randint(0, 40))))
            texts.append((1000 * i + 10 + changed, " ".join(w[changed:])))
    texts += [(None, items[5][1]), (5, None), (6, ""), texts[3], texts[3]]
    spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, item_id int").write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/i")
    d, b = spark.read.parquet(f"{tmp_path}/d"), spark.read.parquet(f"{tmp_path}/i")
    want = brute.leaks(texts, items)
    same(rows(decontam.leaks(d, b), "doc_id", "item_id", "n_words", "similarity"), want)
    kept = decontam.drop_leaks(d, b)
    assert kept.columns == d.columns
    gone = {t for t, *_ in want}
    same(rows(kept, "doc_id", "text"), [t for t in texts if t[0] not in gone])
    assert decontam.leaks(no_docs, bench).count() == 0 and decontam.leaks(odd_docs, b.where("false")).count() == 0
