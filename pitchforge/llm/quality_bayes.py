"""Document quality by hierarchical empirical Bayes (operator 2).

1. Evidence: a logistic regression on the shape of a text (case, punctuation,
   symbols, repeated words, ...), trained on a bounded sample of labelled
   documents, gives each document a probability p of good quality.
2. Sites: grouped sums of p and its square for each path of each host, and from
   them for each host and for all.  A host's rate is shrunk toward the global mean, a path's
   toward its host's, each by a prior of as many documents as the variance within
   sites is larger than that between them.  Both variances are measured, by the
   moments of the nested groups (documents in paths in hosts), so neither hard nor
   soft evidence nor small sites bias them.  Sites with few documents stay close to their prior.
3. Posterior: the odds of p, with the training sample's prior odds replaced by
   those of the document's path, its own p left out.

Hosts and paths that are null count as one named ''.  Null texts and texts
without words have the least p.  Without labels of both kinds p is 1/2 for
all others.  Repeated rows get equal p; a null id stays null; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, narrow

#: Bound on the labelled documents that reach the driver.
SAMPLE_DOCS = 8000
#: Probabilities stay this far from 0 and 1.
LEAST = 1e-6

FEATURES = ("log_words", "word_length", "upper", "digit", "mark", "symbol", "pipe", "line",
            "repeated", "distinct", "short_line", "exclaim")


def shape(text: str | None) -> list[float]:
    """The features of a text; all 0 without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, raw = len(words), np.frombuffer(text.encode(), np.uint8)
    count = np.bincount(raw, minlength=128)
    size, lines = len(raw), text.split("\n")
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    return [np.log1p(n), sum(map(len, words)) / n, count[65:91].sum() / size, count[48:58].sum() / size,
            (count[44] + count[46] + count[59] + count[58] + count[63]) / size,
            (count[35:39].sum() + count[42] + count[64] + count[94:97].sum()) / size, count[124] / n,
            len(lines) / n, repeated, len(set(words)) / n ** 0.8, sum(len(x) < 12 for x in lines) / len(lines), count[33] / n]


class Logistic:
    """Logistic regression on standardised features, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        a = self.design(x)
        self.w, self.prior = np.zeros(a.shape[1]), float(np.clip(y.mean(), LEAST, 1 - LEAST))
        penalty = np.eye(a.shape[1]) * ridge
        penalty[0, 0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a @ self.w, -30, 30)))
            hessian = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + penalty
            move = np.linalg.solve(hessian, a.T @ (y - p) - penalty @ self.w)
            self.w += move / max(1.0, np.abs(move).max() / 2)
        self.w = self.w.astype(float)

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.ones(len(z)), z, z * z])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.clip(1 / (1 + np.exp(-np.clip(self.design(x) @ self.w, -30, 30))), LEAST, 1 - LEAST)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Logistic | None:
    """Fit on about ``sample_docs`` labelled documents; None without both labels.

    Labels are chosen by a hash of the id before any text is touched; at most
    twice the bound are broadcast to the documents, and as many feature rows
    reach the driver.  Rows with a null id, text or label teach nothing.
    """
    usable = narrow(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label is not null")
    share = int(min(1.0, sample_docs / max(1, usable.count())) * (1 << 30))
    picked = usable.withColumn("pick", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))).where(F.col("pick") < share)
    picked = F.broadcast(materialize(picked.limit(2 * sample_docs), "picked-labels"))

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([shape(t) for t in texts], dtype=object)

    rows = narrow(docs, doc_id=id_col, text=text_col).where("text is not null").join(picked, "doc_id")
    pdf = rows.select("pick", "label", features("text").alias("x")).limit(2 * sample_docs).toPandas()
    pdf = pdf.sort_values(["pick", "label"], kind="stable")
    if pdf.label.nunique() < 2:
        return None
    return Logistic(np.array(pdf.x.tolist()), (pdf.label.to_numpy() > 0).astype(float))


def evidence(docs: DataFrame, model: Logistic | None, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """Rows (doc_id, host, path, p) of all documents."""
    src = narrow(docs, doc_id=id_col, text=text_col, host=host_col, path=path_col)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([shape(t) for t in texts]).reshape(-1, len(FEATURES))
            p = model.predict(x) if model else np.full(len(x), 0.5)
            yield pd.Series(np.where(x[:, 0] > 0, p, LEAST))

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("host", "path")]
    return src.select("doc_id", *named, probability("text").alias("p"))


#: Least and largest prior of a site, in documents.
PRIOR_DOCS = (0.01, 1e4)


def prior_docs(within: float, between: float) -> float:
    """Documents that a prior is worth: the variance within sites over that between them."""
    least, most = PRIOR_DOCS
    return float(np.clip(within / between, least, most)) if between > 0 else most


def variances(sites: DataFrame, mean: float) -> tuple[float, float, float]:
    """(within paths, between paths of a host, between hosts): variance components of nested groups.

    ``sites`` has a row for each path: n, s, q (sum of squares) and its host's
    host_n, host_s and host_nn (sum of squared n).  Each sum of squares is set equal to its expectation;
    components below 0 count as 0.  One row comes back.
    """
    share = F.col("n") / F.col("host_n")  # a host's own terms, dealt over its paths
    rate, host_rate = F.col("s") / F.col("n"), F.col("host_s") / F.col("host_n")
    r = sites.agg(
        F.sum(F.col("q") - F.col("s") * rate).alias("inside"), F.sum(F.col("n") - 1).alias("free"),
        F.sum(F.col("n") * F.pow(rate - host_rate, 2)).alias("paths"), F.count("*").alias("n_paths"),
        F.sum(F.col("n") * F.pow(host_rate - mean, 2)).alias("hosts"), F.sum(1 / F.col("host_paths")).alias("n_hosts"),
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(share * F.col("n")).alias("nn_host"), F.sum(share * F.col("host_n") * F.col("host_n")).alias("host_nn")).first()
    if not r["n"] or not r["free"]:
        return 0.0, 0.0, 0.0
    within = max(0.0, r["inside"] / r["free"])
    room = r["n"] - r["nn_host"]
    between = max(0.0, (r["paths"] - (r["n_paths"] - r["n_hosts"]) * within) / room) if room > 1e-9 else 0.0
    room = r["n"] - r["host_nn"] / r["n"]
    above = r["hosts"] - (r["n_hosts"] - 1) * within - (r["nn_host"] - r["nn"] / r["n"]) * between
    return within, between, max(0.0, above / room) if room > 1e-9 else 0.0


def posteriors(scored: DataFrame) -> tuple[DataFrame, float, float]:
    """(rows (host, path, n, s, host_n, host_s, k_host), global mean, prior documents of a path).

    Sums of a group combine before they are shuffled, so a host with a third
    of all documents is no larger than others from there on.  ``k_host``: prior documents of the
    host; a host of few paths counts for less, as its documents share their paths' deviations.
    """
    paths = materialize(scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")), "paths")
    hosts = materialize(paths.groupBy("host").agg(
        F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum(F.col("n") * F.col("n")).alias("host_nn"),
        F.count("*").alias("host_paths")), "hosts")
    n, s = hosts.agg(F.sum("host_n"), F.sum("host_s")).first()
    mean = float(np.clip(s / n, LEAST, 1 - LEAST)) if n else 0.5
    both = paths.join(hosts, "host")
    within, between, above = variances(both, mean)
    least, most = (F.lit(x) for x in PRIOR_DOCS)
    noise = F.lit(within) + F.lit(between) * F.col("host_nn") / F.col("host_n")
    k_host = F.greatest(least, F.least(most, noise / F.lit(above))) if above > 0 else most
    return both.withColumn("k_host", k_host), mean, prior_docs(within, between)


def odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify(docs: DataFrame, model: Logistic | None, threshold: float = 0.5, **columns: str) -> DataFrame:
    """Rows (doc_id, evidence, host_rate, path_rate, quality, keep) of all documents."""
    scored = materialize(evidence(docs, model, **columns), "evidence")
    sites, mean, k_path = posteriors(scored)
    rows = scored.join(sites, ["host", "path"])
    host = (F.col("host_s") - F.col("p") + F.col("k_host") * mean) / (F.col("host_n") - 1 + F.col("k_host"))
    path = (F.col("s") - F.col("p") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    within = lambda c: F.greatest(F.lit(LEAST), F.least(F.lit(1 - LEAST), c))
    rows = rows.withColumn("host_rate", within(host)).withColumn("path_rate", within(path))
    prior = float(np.log((model.prior if model else 0.5) / (1 - (model.prior if model else 0.5))))
    logit = odds(F.col("p")) - prior + odds(F.col("path_rate"))
    rows = rows.withColumn("quality", 1 / (1 + F.exp(-logit)))
    return rows.select("doc_id", F.col("p").alias("evidence"), "host_rate", "path_rate", "quality",
                       (F.col("quality") >= threshold).alias("keep"))
