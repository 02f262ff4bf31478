"""Trained operators: held-out accuracy, odd rows, and their parts against plain versions."""

import math
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchforge.llm import lang_cnn, license_scan, quality_bayes, registry
from pitchforge.llm.common import table

SF = "/root/testdata/sf0.01"


# ---- 2 --------------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality_bayes.train(docs, labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1").select("doc_id", F.col("quality").alias("label"))
    found = quality_bayes.classify(docs, model).join(held, "doc_id").collect()
    good, bad = [r["keep"] for r in found if r["label"] == 1], [r["keep"] for r in found if r["label"] == 0]
    assert len(found) > 150 and sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def components(rows):
    """Variance components of (host, path, p) by sums over groups in Python; and the groups."""
    hosts = {}
    for h, t, p in rows:
        hosts.setdefault(h, {}).setdefault(t, []).append(p)
    n, mean = len(rows), sum(r[2] for r in rows) / len(rows)
    sites = [x for ps in hosts.values() for x in ps.values()]
    within = sum((p - sum(x) / len(x)) ** 2 for x in sites for p in x) / sum(len(x) - 1 for x in sites)
    size = {h: sum(map(len, ps.values())) for h, ps in hosts.items()}
    rate = {h: sum(map(sum, ps.values())) / size[h] for h, ps in hosts.items()}
    same = {h: sum(len(x) ** 2 for x in ps.values()) / size[h] for h, ps in hosts.items()}
    ssp = sum(len(x) * (sum(x) / len(x) - rate[h]) ** 2 for h, ps in hosts.items() for x in ps.values())
    room = n - sum(same.values())
    between = max(0, (ssp - (len(sites) - len(hosts)) * within) / room) if room > 1e-9 else 0
    ssh = sum(size[h] * (rate[h] - mean) ** 2 for h in hosts)
    above = ssh - (len(hosts) - 1) * within - (sum(same.values()) - sum(len(x) ** 2 for x in sites) / n) * between
    room = n - sum(m * m for m in size.values()) / n
    return within, between, max(0, above / room) if room > 1e-9 else 0, hosts, mean


def test_whole_query_equals_plain_loops(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    model = quality_bayes.train(docs, table(spark, SF, "labels"))
    monkeypatch.setattr(quality_bayes, "train", lambda *a, **k: model)
    got = {r["doc_id"]: r for r in registry.op2_quality(spark, SF).collect()}
    src = docs.collect()
    x = np.array([quality_bayes.shape(r["text"]) for r in src])
    p = np.where(x[:, 0] > 0, model.predict(x), quality_bayes.LEAST)
    rows = [(r["source"] or "", r["lang"] or "", float(v)) for r, v in zip(src, p, strict=True)]
    within, between, above, hosts, mean = components(rows)
    clip = lambda v, lo, hi: min(hi, max(lo, v))
    k_path = clip(within / between, 0.01, 1e4) if between else 1e4
    for r, (h, t, v) in zip(src, rows, strict=True):
        site, host = hosts[h][t], [y for ys in hosts[h].values() for y in ys]
        k = clip((within + between * sum(len(y) ** 2 for y in hosts[h].values()) / len(host)) / above, 0.01, 1e4) if above else 1e4
        host_rate = clip((sum(host) - v + k * mean) / (len(host) - 1 + k), 1e-6, 1 - 1e-6)
        path_rate = clip((sum(site) - v + k_path * host_rate) / (len(site) - 1 + k_path), 1e-6, 1 - 1e-6)
        logit = sum(s * math.log(y / (1 - y)) for s, y in ((1, v), (-1, model.prior), (1, path_rate)))
        g = got[r["doc_id"]]
        assert [g["evidence"], g["host_rate"], g["path_rate"], g["quality"]] == pytest.approx(
            [v, host_rate, path_rate, 1 / (1 + math.exp(-logit))], rel=1e-6, abs=1e-9)
        assert g["keep"] == (g["quality"] >= 0.5)


@pytest.mark.parametrize("low,high", [(0.0, 1.0), (0.2, 0.8)])
@pytest.mark.parametrize("size", [2, 3, 5, 20])
def test_known_strength_is_recovered(spark, size, low, high):
    """Rates of sites from a Beta prior worth 3 documents: hard and soft evidence give the same strength."""
    rng, n = np.random.default_rng(size), 60_000 // size + 8000
    rate = rng.beta(3 * 0.6, 3 * 0.4, n)
    hits = rng.binomial(size, rate)
    one, two = low + (high - low) * 1.0, low
    s, q = hits * one + (size - hits) * two, hits * one ** 2 + (size - hits) * two ** 2
    # sites as hosts of one path, and as paths of one host
    for hosts in (True, False):
        rows = [(size, float(a), float(b)) for a, b in zip(s, q, strict=True)]
        df = spark.createDataFrame(rows, "n long, s double, q double")
        total = (n * size, float(s.sum()), float(n * size * size), n)
        df = df.withColumns(dict(zip(("host_n", "host_s", "host_nn", "host_paths"), (
            (F.col("n"), F.col("s"), F.col("n") * F.col("n"), F.lit(1)) if hosts else map(F.lit, total)), strict=True)))
        within, between, above = quality_bayes.variances(df, float(s.sum() / n / size))
        assert quality_bayes.prior_docs(within, above if hosts else between) == pytest.approx(3, rel=0.1)


def test_single_documents_and_empty_sites(spark, tmp_path):
    rows = [(f"h{i}", "p", 0.2 + 0.6 * (i % 2)) for i in range(50)]
    spark.createDataFrame(rows, "host string, path string, p double").write.parquet(f"{tmp_path}/s")
    sites, mean, k = quality_bayes.posteriors(spark.read.parquet(f"{tmp_path}/s"))
    assert mean == pytest.approx(0.5) and k == 1e4 and {r["k_host"] for r in sites.collect()} == {1e4}


def test_sparse_sites_shrink(spark, tmp_path):
    text = {True: "Plain words make a sentence that reads well enough here.", False: "BAD!! BAD!! BAD!! NOISE!! NOISE!!"}
    rows = [(i, text[i % 10 != 0], "big", "a") for i in range(300)] + [(1000, text[True], "tiny", "b"), (1001, text[True], "bad", "c")]
    rows += [(2000 + i, text[False], "bad", "c") for i in range(40)]
    spark.createDataFrame(rows, "doc_id int, text string, source string, lang string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    model = quality_bayes.train(docs, docs.select("doc_id", F.when(F.col("text").contains("!!"), 0).otherwise(1).alias("quality")))
    got = {r["doc_id"]: r for r in quality_bayes.classify(docs, model).collect()}
    assert len(got) == len(rows)
    assert got[1000]["path_rate"] > 0.5 > got[1001]["path_rate"]  # own text left out: global prior against a bad host
    assert got[1]["path_rate"] > got[1000]["path_rate"] > got[1001]["path_rate"]
    assert got[1001]["quality"] < got[1000]["quality"]


def test_quality_of_odd_rows(odd_docs, no_docs):
    labels = odd_docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    model = quality_bayes.train(odd_docs, labels)
    got = quality_bayes.classify(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["quality"] <= 1 and not math.isnan(r["quality"]) for r in got)
    assert {r["evidence"] for r in got if r["doc_id"] in (1, 2, 3)} == {quality_bayes.LEAST}
    assert quality_bayes.train(odd_docs, labels.withColumn("quality", F.lit(1))) is None
    assert {r["evidence"] for r in quality_bayes.classify(odd_docs, None).collect()} == {0.5, quality_bayes.LEAST}
    assert quality_bayes.classify(no_docs, model).count() == 0 and quality_bayes.train(odd_docs, labels.where("false")) is None


# ---- 3 --------------------------------------------------------------------

def test_licences_of_the_table(spark):
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: r for r in registry.op3_license_scan(spark, SF).collect()}
    lines = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Licensed under the Apache License, Version 2.0": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    seen = 0
    for r in docs.collect():
        want = sorted({f for line, f in lines.items() if line in (r["text"] or "")})
        assert got[r["doc_id"]]["licences"] == ",".join(want), r["text"][:200]
        seen += bool(want)
    assert seen > 10 and len(got) == docs.count()


@pytest.fixture(scope="module")
def licences():
    return license_scan.LicenceModel(["Some plain prose about the use of software and its names.", "The rest of the work."] * 200)


def confirmed(model, text):
    return sorted({f["family"] for f in model.scan(text) if f["confirmed"]})


def test_each_notice_has_its_own_family(licences):
    for family, notices in license_scan.NOTICES.items():
        for notice in notices:
            for text in ("\n".join(notice), " ".join(notice), "\n\n".join(notice).upper(), "\n".join(f"{i}. {p}" for i, p in enumerate(notice))):
                assert confirmed(licences, text) == [family], text


def test_paragraphs_alone(licences):
    """A paragraph tells its family unless another family has it too."""
    for family, texts in license_scan.TEMPLATES.items():
        for t in texts:
            own = license_scan.shingles(license_scan.words_of(t))
            shared = any(own <= licences.shingles[f] for f in license_scan.NOTICES if f != family)
            found = licences.scan("Intro.\n" + t.upper() + "\nEnd.")
            assert [(f["confirmed"], f["line"]) for f in found] == [(not shared, 1)], t
            assert shared or found[0]["family"] == family


def test_near_families_are_not_confirmed(licences):
    gpl = "\n".join(license_scan.NOTICES["GPL-3.0"][1])
    assert confirmed(licences, gpl.replace("version 3", "version 7")) == []
    assert confirmed(licences, gpl.replace("General Public", "Strange Public")) == []
    assert confirmed(licences, license_scan.NOTICES["CC-BY-4.0"][2][0].replace("Attribution", "Attribution-Sampling").replace("/by/", "/by-x/")) == []
    bsd = license_scan.NOTICES["BSD-3-Clause"][0]
    assert confirmed(licences, "\n".join(bsd[:3])) == [] and confirmed(licences, "\n".join([*bsd[:3], bsd[4]])) == ["BSD-2-Clause"]
    both = "\n".join(license_scan.NOTICES["GPL-2.0"][1]) + "\nprose\nprose\nprose\n" + "\n".join(license_scan.NOTICES["AGPL-3.0"][1])
    assert confirmed(licences, both) == ["AGPL-3.0", "GPL-2.0"]


def test_no_licence(licences):
    half = licences.scan("Redistribution and use in source and binary forms depends on many other things that nobody wrote down here")
    assert not any(f["confirmed"] for f in half)
    assert confirmed(licences, "You may use the software under the terms we agreed, the license is with the copy") == []
    assert licences.scan(None) == licences.scan("") == licences.scan("\n \n") == []
    assert confirmed(licences, "word " * 300 + license_scan.TEMPLATES["MIT"][0] + " more" * 300) == ["MIT"]


def test_the_classifier_proposes(licences, monkeypatch):
    text = license_scan.TEMPLATES["MIT"][2]
    chances = np.zeros(len(licences.families))
    chances[0] = 1.0
    monkeypatch.setattr(licences, "chances", lambda words: chances)
    assert licences.scan(text) == []


def test_long_lines_take_linear_time(licences):
    rng, words = np.random.default_rng(1), license_scan.words_of(" ".join(license_scan.NOTICES["GPL-3.0"][1]))
    took = []
    for n in (10_000, 40_000):
        line = [w if x < 0.8 else "zz" for w, x in zip((words * n)[:n], rng.random(n), strict=True)]
        start = time.perf_counter()
        licences.scan(" ".join(line))
        took.append(time.perf_counter() - start)
    assert took[1] < 10 * took[0]


def test_the_query_equals_a_scan_of_every_row(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    model = license_scan.train(docs)
    monkeypatch.setattr(license_scan, "train", lambda *a, **k: model)
    got = {r["doc_id"]: tuple(r[c] for c in ("licences", "n_confirmed", "n_unconfirmed")) for r in registry.op3_license_scan(spark, SF).collect()}
    for r in docs.collect():
        found = model.scan(r["text"])
        sure = [f for f in found if f["confirmed"]]
        assert got[r["doc_id"]] == (",".join(sorted({f["family"] for f in sure})), len(sure), len(found) - len(sure))
        # plain comparison of every family's short notices, word by word
        words = " " + " ".join(license_scan.words_of(r["text"] or "")) + " "
        plain = {f for f, ns in license_scan.NOTICES.items() for n in ns if len(n) == 1 and f" {' '.join(license_scan.words_of(n[0]))} " in words}
        assert plain <= {f["family"] for f in sure}


def test_licence_paragraphs_as_published(licences):
    model = licences
    mit = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
           'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
           'modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the '
           'Software is furnished to do so, subject to the following conditions:')
    apache = ('Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
              '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
              'language governing permissions and limitations under the License.')
    first = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
             'License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 ')
    binary = ('2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following '
              'disclaimer in the documentation and/or other materials provided with the distribution.')
    hope = ('This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty '
            'of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.')
    for text, family in ((mit, "MIT"), (apache, "Apache-2.0"), (first + apache, "Apache-2.0"), ):
        assert [(f["family"], f["confirmed"]) for f in model.scan(text)] == [(family, True)], text
    for text in (binary, hope):  # paragraphs of two families each
        assert [f["confirmed"] for f in model.scan(text)] == [False], text


def test_licence_notices_within_a_line(licences):
    model = licences

    def sure(text):
        return confirmed(model, text)

    assert sure("Copyright 2024 Example Labs. Released under the MIT License.") == ["MIT"]
    assert sure("Copyright 2020 Foo Inc. Licensed under the Apache License, Version 2.0.") == ["Apache-2.0"]
    assert sure("This project is licensed under the MIT License; see the LICENSE file for details.") == ["MIT"]
    assert sure("Code: released under the MIT License. Text: licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0", "MIT"]
    prose = "in the rest of the work there is a copy of this paper for any use of the names that we found".split()
    for family, texts in license_scan.TEMPLATES.items():
        for t in texts:
            for n in (5, 20, 40, 80, 300):
                around = [prose[i % len(prose)] for i in range(n)]
                own = license_scan.shingles(license_scan.words_of(t))
                shared = any(own <= model.shingles[f] for f in license_scan.NOTICES if f != family)
                assert sure(" ".join(around[:n // 2]) + " . " + t + " " + " ".join(around[n // 2:])) == ([] if shared else [family]), (n, t)
    assert sure(" ".join(prose * 20)) == []
    part = "We wrote that redistribution and use in source and binary forms depends on other things, as is, without warranties of any kind. "
    assert sure(part) == sure(part * 8) == []


def test_stretches_equal_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(200):
        marks = list(rng.random(int(rng.integers(1, 40))) < 0.8)
        sums = np.concatenate([[0], np.cumsum([0.2 if m else -0.8 for m in marks])])
        got = license_scan.stretches(marks)
        best = max(sums[j] - sums[i] for i in range(len(sums)) for j in range(i, len(sums)))
        assert max((sums[hi] - sums[lo] for lo, hi in got), default=0) == pytest.approx(best)
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:], strict=False))
        assert all(sum(marks[lo:hi]) / (hi - lo) >= 0.8 for lo, hi in got) and all(any(lo <= i < hi for lo, hi in got) for i, m in enumerate(marks) if m)


def test_licences_of_odd_rows(odd_docs, no_docs):
    model = license_scan.train(odd_docs)
    got = license_scan.summary(license_scan.find_licences(odd_docs, model)).collect()
    assert len(got) == odd_docs.count() and all(r["licences"] == "" for r in got)
    assert license_scan.find_licences(no_docs, license_scan.train(no_docs)).count() == 0


# ---- 10 -------------------------------------------------------------------

def test_language_on_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    got = registry.op10_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and docs[r["doc_id"]]["lang"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert len(held) > 150 and right / len(held) > 0.95


def test_language_of_odd_rows(odd_docs, no_docs):
    model = lang_cnn.train(odd_docs, sample_docs=20)
    got = {}
    for r in lang_cnn.identify(odd_docs, model).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    for i in (1, 2, 3, 10):
        assert got[i] == [("und", 0.0)]
    assert got[9][0] == got[9][1] and got[4] == got[5] and got[4][0][0] in model.labels
    assert lang_cnn.train(no_docs) is None
    assert {r["lang_pred"] for r in lang_cnn.identify(odd_docs, None).collect()} == {"und"}
    assert lang_cnn.identify(no_docs, model).count() == 0
    assert lang_cnn.keep_identified(odd_docs, model).columns == odd_docs.columns


def test_every_label_is_learned(spark, tmp_path):
    rows = [(i, f"word {chr(97 + i % 26)} text", f"l{i % 300}") for i in range(900)]
    spark.createDataFrame(rows, "doc_id int, text string, lang string").write.parquet(f"{tmp_path}/d")
    assert len(lang_cnn.train(spark.read.parquet(f"{tmp_path}/d"), sample_docs=3).labels) == 300


def test_copies_do_not_displace_a_label(spark, tmp_path):
    rows = [(1, "the same words again", "en")] * 500 + [(i, f"mots {i} de plus", "fr") for i in range(2, 12)]
    spark.createDataFrame(rows, "doc_id int, text string, lang string").write.parquet(f"{tmp_path}/d")
    assert lang_cnn.train(spark.read.parquet(f"{tmp_path}/d"), sample_docs=3).labels == ["en", "fr"]


def test_least_score_is_calibrated(spark):
    docs = table(spark, SF, "documents")
    learn = docs.where(~lang_cnn.held_out(F.col("doc_id")))
    model = lang_cnn.train(learn, aside=0.125)
    assert lang_cnn.train(learn).least == 1 / len(model.labels) < model.least < 0.95
    rng = np.random.default_rng(3)
    real = [r["text"] for r in docs.where(lang_cnn.held_out(F.col("doc_id"))).collect() if lang_cnn.has_letter(r["text"])]
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789+/="), 800)) for _ in range(200)]
    passed = [np.mean([s >= model.least for s in lang_cnn.identify_texts([t for t in x if len(t) >= lang_cnn.ENOUGH], model)[1]]) for x in (real, noise)]
    assert passed[0] > 0.99 and passed[1] < 0.95, passed
    rows = spark.createDataFrame([(1, noise[0]), (2, real[0]), (3, "Re."), (4, None)], "doc_id int, text string")
    kept = {r["doc_id"] for r in lang_cnn.keep_identified(rows, model, least=0.999999).collect()}
    assert 3 in kept and 1 not in kept and 4 not in kept


def test_neighbours_do_not_change_a_score():
    rng, net = np.random.default_rng(5), lang_cnn.ByteCNN(list("abcde"))
    texts = ["".join(rng.choice(list("abc de"), int(n))) + "x" for n in rng.integers(1, 3000, 40)]
    alone = [lang_cnn.identify_texts([t], net) for t in texts]
    together = lang_cnn.identify_texts(texts, net)
    assert [a[1][0] for a in alone] == together[1] and [a[0][0] for a in alone] == together[0]


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = lang_cnn.ByteCNN(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(1, 90, (5, 40)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        h, _ = net.pooled(x)
        p = lang_cnn.softmax(np.maximum(h, 0) @ net.p["out"] + net.p["out_bias"])
        return -np.log(p[np.arange(5), y]).mean()

    g = net.gradients(x, y)
    for k, a in net.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in a.shape)
            if k == "embed":
                at = (int(x[0, 3]), at[1])
            old = a[at]
            a[at] = old + 1e-6
            up = loss()
            a[at] = old - 1e-6
            down = loss()
            a[at] = old
            assert g[k][at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_windows_cover_whole_texts():
    texts = ["", "Ab  c\n", "é" * 700, "x" * lang_cnn.WINDOW]
    x, owner, size = lang_cnn.windows(texts)
    for i, t in enumerate(texts):
        assert x[owner == i].reshape(-1)[:len(lang_cnn.text_bytes(t))].tobytes() == lang_cnn.text_bytes(t).tobytes()
        assert size[owner == i].sum() == max(1, len(lang_cnn.text_bytes(t)))
