"""The pipeline, each stage on what the one before it kept, against the operators' plain versions."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from pitchforge.llm import lang_cnn
from pitchforge.llm.common import materialize

from . import brute
from .conftest import SF, same


def ids(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def run_stages(spark, docs):
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], SF), f"test-{name}"))
    return kept


def check(spark, docs, kept):
    start, known, single, clean, masked, packed = kept
    for df in kept[1:5]:
        assert df.columns == docs.columns
    known_ids = ids(known)
    assert all(lang_cnn.has_letter(t) for _, t in known_ids) and set(known_ids) <= set(ids(start))
    if known_ids:
        # one of each component, which has the component's smallest id
        want = {c for _, _, c in brute.components(known_ids)}
        assert sorted((i for i, _ in ids(single)), key=str) == sorted(want, key=str)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {d for d, *_ in brute.leaks(ids(single), bench)}
    same(ids(clean), [x for x in ids(single) if x[0] not in gone])
    before = dict(ids(clean))
    assert {i for i, _ in ids(masked)} == set(before)
    for i, t in ids(masked):
        assert not brute.base_spans(t.replace("<redacted>", "\n")) and (t == before[i]) == ("<redacted>" not in t)
        if t == before[i]:
            assert not brute.base_spans(t)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    same([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed.collect()],
         [(i, *p) for i, t in ids(masked) for p in brute.pieces(t, tok)])
    return gone


def test_stages_on_the_table(spark, docs):
    kept = run_stages(spark, docs)
    assert check(spark, docs, kept)
    counts = [df.count() for df in kept[:5]]
    assert counts == sorted(counts, reverse=True) and counts[4] > 0.8 * counts[0]
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == kept[5].columns and got.count() == kept[5].count()


def test_stages_on_odd_rows(spark, odd_docs):
    check(spark, odd_docs, run_stages(spark, odd_docs))


def test_stages_on_no_rows(spark, no_docs):
    assert [df.count() for df in run_stages(spark, no_docs)] == [0] * 6


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
