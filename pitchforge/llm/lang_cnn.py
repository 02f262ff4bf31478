"""Language identification by a byte convolutional network (operator 10).

Lower-cased text is cut into windows of ``WINDOW`` UTF-8 bytes, all of it and
without overlap.  Bytes are embedded, filters of several widths run over a
window, each is max-pooled, and a softmax layer gives the languages.  The
network is trained in numpy on a bounded sample of labelled texts; a
document's score for a language is the mean over its windows, weighted by their
bytes.

Null texts and texts without a letter are ``und`` with score 0; so are all texts
if there is nothing to learn from.  Repeated rows get equal results; a null id
stays null; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, narrow, small_side

UNKNOWN = "und"
WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 16, 8
#: Bound on the training sample: documents of each language, and windows of each document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 1500, 2
#: Bound on the labelled rows of all languages together, and the documents that each has in any case.
SAMPLE_ALL, LEAST_DOCS = 384_000, 20
#: Windows that one step of a prediction holds, and characters of the texts (one at least) whose windows are cut at once.
STEP, GROUP_CHARS = 64, 1 << 18
#: Share of windows in a learned language that may miss the least score, and bytes below which a text is not judged by it.
LOST, ENOUGH = 0.005, 64
PAD = 0  # no byte of text after cleaning


# ---- network --------------------------------------------------------------

class ByteCNN:
    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.least = 1 / len(labels)  # every text reaches this score
        p = {"embed": rng.normal(0, 0.5, (256, EMBEDDING))}
        for w in WIDTHS:
            p[f"filter{w}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
            p[f"bias{w}"] = np.zeros(FILTERS)
        p["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels)))
        p["out_bias"] = np.zeros(len(labels))
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def pooled(self, x: np.ndarray):
        """Max of each filter over each window, and where it is: (n, all filters) twice."""
        n, length = x.shape
        e = np.ascontiguousarray(self.p["embed"][x].reshape(n, length * EMBEDDING))
        best, where = [], []
        for w in WIDTHS:
            places = length - w + 1
            patches = np.lib.stride_tricks.as_strided(
                e, (n, places, w * EMBEDDING), (e.strides[0], EMBEDDING * e.itemsize, e.itemsize))
            # a product for each window: in one over all of them, other windows beside it would change its rounding
            a = np.matmul(np.ascontiguousarray(patches), self.p[f"filter{w}"])
            best.append(a.max(axis=1) + self.p[f"bias{w}"])
            where.append(a)
        return np.concatenate(best, axis=1), where

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = []
        for lo in range(0, len(x), STEP):
            h, _ = self.pooled(x[lo:lo + STEP])
            evidence = np.einsum("nf,fl->nl", np.maximum(h, 0), self.p["out"], optimize=False)
            out.append(softmax(evidence + self.p["out_bias"]))
        return np.concatenate(out) if out else np.zeros((0, len(self.labels)), np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, g = len(x), {k: np.zeros_like(v) for k, v in self.p.items()}
        h, maps = self.pooled(x)
        hidden = np.maximum(h, 0)
        d = softmax(hidden @ self.p["out"] + self.p["out_bias"])
        d[np.arange(n), y] -= 1
        d /= n
        g["out"], g["out_bias"] = hidden.T @ d, d.sum(axis=0)
        dh = (d @ self.p["out"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            at = maps[i].argmax(axis=1)  # only the place of the maximum learns
            dw = dh[:, i * FILTERS:(i + 1) * FILTERS]
            g[f"bias{w}"] = dw.sum(axis=0)
            seen = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(w)]  # bytes under each maximum
            patch = self.p["embed"][seen].reshape(n, FILTERS, w * EMBEDDING)
            g[f"filter{w}"] = np.einsum("nfk,nf->kf", patch, dw)
            back = (dw[:, :, None] * self.p[f"filter{w}"].T[None]).reshape(-1, EMBEDDING)
            np.add.at(g["embed"], seen.reshape(-1), back)
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 4e-3,
            seed: int = 11) -> ByteCNN:
        rng, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), batch):
                pick, step = order[lo:lo + batch], step + 1
                for k, g in self.gradients(x[pick], y[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def softmax(a: np.ndarray) -> np.ndarray:
    a = np.exp(a - a.max(axis=1, keepdims=True))
    return a / a.sum(axis=1, keepdims=True)


# ---- windows --------------------------------------------------------------

def text_bytes(text: str) -> np.ndarray:
    """Lower-cased UTF-8 bytes; white space of any length and zero bytes become one space."""
    return np.frombuffer(" ".join(text.lower().replace("\0", " ").split()).encode("utf-8", "replace"), np.uint8)


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: (n, WINDOW) bytes, the text of each, its number of bytes."""
    rows, owner, size = [], [], []
    for i, t in enumerate(texts):
        b = text_bytes(t)
        n = max(1, -(-len(b) // WINDOW))
        row = np.zeros(n * WINDOW, np.uint8)
        row[:len(b)] = b
        rows.append(row.reshape(n, WINDOW))
        owner += [i] * n
        size += [WINDOW] * (n - 1) + [max(1, len(b) - WINDOW * (n - 1))]
    x = np.concatenate(rows) if rows else np.zeros((0, WINDOW), np.uint8)
    return x, np.array(owner, dtype=np.int64), np.array(size, dtype=np.float32)


def cut_windows(text: str, per_text: int, rng: np.random.Generator) -> list[bytes]:
    """Random windows of a text, of random lengths, so that short texts are known too."""
    b = text_bytes(text)
    cut = []
    for _ in range(per_text if len(b) > WINDOW else 1):
        at = int(rng.integers(0, max(1, len(b) - WINDOW + 1)))
        cut.append(b[at:at + (WINDOW if rng.random() < 0.6 else int(rng.integers(12, WINDOW)))].tobytes())
    return cut


def padded(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(WINDOW, b"\0") for p in parts), np.uint8).reshape(len(parts), WINDOW)


# ---- Spark ----------------------------------------------------------------

def held_out(doc_id):
    """True for the documents that no training may see: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 7, aside: float = 0.0) -> ByteCNN | None:
    """Fit a network on rows (doc_id, text, lang) with text and lang.

    Every language is learned. About ``sample_docs`` documents of each (fewer, down to LEAST_DOCS, if all
    would pass SAMPLE_ALL) are chosen by a hash of the row; all rows are counted, none is read in order.
    Windows are cut where the texts are, so the driver gets SAMPLE_WINDOWS times WINDOW bytes of each.
    A share ``aside`` of the sample sets the model's least score (``calibrated``) instead.
    """
    usable = labelled.where("text is not null and lang is not null").withColumn("pick", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)))
    counts = small_side(materialize(usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("pick").alias("low")), "languages"))
    languages = counts.count()
    if not languages:
        return None
    each = min(sample_docs, max(LEAST_DOCS, SAMPLE_ALL // languages))
    share = F.floor(F.least(F.lit(1.0), F.lit(each) / F.col("n")) * (1 << 30))

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series, picks: pd.Series) -> pd.Series:
        return pd.Series([cut_windows(t, SAMPLE_WINDOWS, np.random.default_rng([seed, int(p)])) if has_letter(t) else []
                          for t, p in zip(texts, picks, strict=True)], dtype=object)

    chosen = (F.col("pick") < share) | (F.col("pick") == F.col("low"))  # a label of copies alone has one pick
    picked = usable.join(counts, "lang").where(chosen).select("lang", "pick", cut("text", "pick").alias("parts"))
    # repeated rows share a pick and count once; the bound is each language's own
    rows = picked.where(F.size("parts") > 0).groupBy("lang", "pick").agg(F.min("parts").alias("parts"))
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("pick"))).where(F.col("r") <= 2 * each)
    pdf = rows.select("lang", "pick", "parts").toPandas().sort_values(["lang", "pick"], kind="stable").reset_index(drop=True)
    if not len(pdf):
        return None
    labels = sorted(pdf.lang.unique())
    tried = pdf.groupby("lang").cumcount() >= (pdf.groupby("lang").lang.transform("size") * (1 - aside)).clip(lower=1)
    learned = pdf[~tried]
    owner = np.repeat(learned.lang.map({k: i for i, k in enumerate(labels)}).to_numpy(), learned.parts.map(len))
    model = ByteCNN(labels, seed).fit(padded([p for parts in learned.parts for p in parts]), owner)
    if tried.any():
        model.least = calibrated(model, [bytes(p) for parts in pdf[tried].parts for p in parts], seed)
    return model


def calibrated(model: ByteCNN, parts: list[bytes], seed: int = 7) -> float:
    """The least score of a text in a learned language.

    It is the score that all but a share LOST of windows put aside reach, or, if that is lower, the one that
    nearly no noise reaches: windows of the same lengths, of bytes drawn evenly from those that occur.
    Never under the score of no evidence, one in the number of languages.
    """
    long = [p for p in parts if len(p) >= ENOUGH]
    if not long:
        return 1 / len(model.labels)
    rng, seen = np.random.default_rng(seed), np.unique(np.frombuffer(b"".join(long), np.uint8))
    noise = [rng.choice(seen, len(p)).astype(np.uint8).tobytes() for p in long]
    real, other = (model.predict(padded(x)).max(axis=1) for x in (long, noise))
    return float(max(1 / len(model.labels), min(np.quantile(real, LOST, method="lower"), np.quantile(other, 1 - LOST))))


_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def identify(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score), one for each document."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = identify_texts(texts.tolist(), model)
            yield pd.DataFrame({"lang_pred": pd.Series(lang, dtype=object), "score": np.array(score, dtype=float)})

    found = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", predict("text").alias("p"))
    return found.select("doc_id", "p.lang_pred", "p.score")


def identify_texts(texts: list[str | None], model: ByteCNN | None) -> tuple[list[str], list[float]]:
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if model and has_letter(t)]
    while known:  # a few texts at a time bound the windows in memory
        chars = np.cumsum([len(texts[i]) for i in known[:32]])
        n = max(1, int((chars <= GROUP_CHARS).sum()))
        group, known = known[:n], known[n:]
        x, owner, size = windows([texts[i] for i in group])
        p = model.predict(x) * size[:, None]
        total = np.zeros((len(group), p.shape[1]))
        np.add.at(total, owner, p)
        total /= total.sum(axis=1, keepdims=True)
        for i, row in zip(group, total, strict=True):
            lang[i], score[i] = model.labels[int(row.argmax())], float(min(1.0, row.max()))
    return lang, score


def keep_identified(docs: DataFrame, model: ByteCNN | None, least: float | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` without those of no language (``und``) and, of texts of ENOUGH bytes or more, those of no
    language with a score of ``least`` or more (without it, the model's own)."""
    bound = least if least is not None else model.least if model else 0.0

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        lang, score = identify_texts(texts.tolist(), model)
        return pd.Series([k != UNKNOWN and (s >= bound or len(text_bytes(t)) < ENOUGH)
                          for t, k, s in zip(texts, lang, score, strict=True)], dtype=bool)

    return docs.where(kept(F.col(f"`{text_col}`")))
