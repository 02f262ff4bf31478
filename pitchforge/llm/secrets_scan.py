"""Multipart credential linking (operator 1).

A credential has up to three parts: an access identifier, a secret and an
endpoint.  Each text is searched for parts in two grades.

* Base spans are certain and always reported: ``assign`` (a key word with a
  value), ``access`` (an AKIA identifier) and ``hex`` (a long hex run).
* Weak candidates are common in clean text: ``identifier`` (``user = ...``),
  ``secret`` (a mixed token of high entropy) and ``endpoint`` (a URL or an
  address).  One is reported only if a complementary part co-occurs: a secret
  for an identifier or endpoint, and one of those for a secret.  Complementary
  parts are different characters: of weak candidates that overlap, only the longest
  counts (the mixed path of a URL is no secret beside that URL), and one that
  overlaps a base span counts as a complement of others but is not reported itself.

Co-occurrence is an interval join within scopes.  A part's scope is its own
span widened by ``REACH`` code points on each side, cut at the blank lines that
bound its block; parts join if scope and span overlap.  Scopes never leave a
document, so the join is a sweep over the sorted spans of a row, and no row is
shuffled.

Null and empty texts have no spans; a null id stays null; repeated rows each
get their own result; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow

#: Code points on each side of a part in which its complement may lie.
REACH = 256

# Kinds in the order in which ties are listed, and the role of each.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret",
         "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}
BASE = KINDS[:3]
# Patterns of the base spans.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Weak candidates.
IDENTIFIER = r"""\b(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}"""
SECRET = r"[A-Za-z0-9+/_-]{16,}={0,2}"
ENDPOINT = r"""\b[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>|]+|\b\d{1,3}(?:\.\d{1,3}){3}(?::\d{1,5})?\b"""
WORDS = ("passw", "secret", "token", "key")  # each ASSIGN key word has one of these


def entropy(token: str) -> float:
    """Bits per character."""
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


class Finder:
    """Parts of a text as (start, end, kind), patterns compiled once in each task."""

    def __init__(self):
        self.assign = re.compile(ASSIGN, re.I | re.A).finditer
        self.access, self.hex = re.compile(ACCESS).finditer, re.compile(HEX).finditer
        self.identifier = re.compile(IDENTIFIER, re.I | re.A).finditer
        self.secret, self.endpoint = re.compile(SECRET).finditer, re.compile(ENDPOINT, re.A).finditer
        self.digit, self.blank = re.compile("[0-9]").search, re.compile(r"\n[^\S\n]*\n").finditer

    def base(self, text: str) -> list[tuple[int, int, str]]:
        # lower() only finds out whether a key word can be there at all
        low, out = text.lower(), []
        if any(w in low for w in WORDS):
            out += [(m.start(), m.end(), "assign") for m in self.assign(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            out += [(m.start(), m.end(), "access") for m in self.access(text)]
        return out + [(m.start(), m.end(), "hex") for m in self.hex(text)]

    def weak(self, text: str) -> list[tuple[int, int, str]]:
        out = []
        if "=" in text or ":" in text:
            out += [(m.start(), m.end(), "identifier") for m in self.identifier(text)]
        if self.digit(text):
            out += [(m.start(), m.end(), "secret") for m in self.secret(text) if strong_token(m[0])]
            out += [(m.start(), m.end(), "endpoint") for m in self.endpoint(text)]
        elif "://" in text:
            out += [(m.start(), m.end(), "endpoint") for m in self.endpoint(text)]
        return out

    def apart(self, weak: list[tuple[int, int, str]], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """The weak parts that overlap no base span."""
        covered = sorted((s, e) for s, e, _ in base)
        starts = [s for s, _ in covered]
        ends = [0]  # running maximum of the ends
        for _, e in covered:
            ends.append(max(ends[-1], e))

        def free(s, e):  # no base span overlaps it
            before = bisect_right(starts, s)
            return ends[before] <= s and (before == len(starts) or starts[before] >= e)

        return [(s, e, k) for s, e, k in weak if free(s, e)]

    def spans(self, text: str | None) -> tuple[list, list]:
        """(base spans, all spans), both by start, then kind."""
        if not text:
            return [], []
        base = self.base(text)
        weak = self.weak(text)
        order = lambda p: (p[0], KINDS.index(p[2]), p[1])
        if weak:
            weak = self.apart(linked(base + containers(weak), [m.start() for m in self.blank(text)]), base)
        return sorted(base, key=order), sorted(base + weak, key=order)


def strong_token(token: str) -> bool:
    """A mixed token of high entropy: digits, letters of both cases or signs, 3.5 bits a character."""
    kinds = (any(c.isdigit() for c in token), any(c.islower() for c in token),
             any(c.isupper() for c in token), any(c in "+/_-=" for c in token))
    return kinds[0] and sum(kinds) >= 3 and entropy(token) >= 3.5


def containers(weak: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The weak parts without those that overlap a longer one that stays; of equally long ones the first stays."""
    kept: list[tuple[int, int, str]] = []
    for p in sorted(weak, key=lambda p: (p[0] - p[1], p[0], KINDS.index(p[2]))):
        at = bisect_right(kept, p)
        if (at == 0 or kept[at - 1][1] <= p[0]) and (at == len(kept) or kept[at][0] >= p[1]):
            kept.insert(at, p)
    return kept


def linked(parts: list[tuple[int, int, str]], blanks: list[int], reach: int = REACH) -> list[tuple[int, int, str]]:
    """Weak parts that overlap the scope of a complementary part (no weak part overlaps another one).

    Two sweeps in order of start, each linear: the furthest end of each role
    so far in the block, and the nearest start of each role from there on.
    """
    rows = sorted((bisect_right(blanks, s), s, e, k) for s, e, k in parts)
    near: set[tuple[int, int, str]] = set()
    for forward in (True, False):
        block, edge = None, {}
        for b, s, e, k in rows if forward else reversed(rows):
            if b != block:
                block, edge = b, {}
            role = ROLES[k]
            wanted = ("identifier", "endpoint") if role == "secret" else ("secret",)
            if any(w in edge and (s - edge[w] <= reach if forward else edge[w] - e <= reach) for w in wanted):
                near.add((s, e, k))
            edge[role] = max(edge.get(role, e), e) if forward else min(edge.get(role, s), s)
    return [p for p in parts if p[2] not in BASE and p in near]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: (doc_id, spans array<struct<kind, start, end>>)."""
    @F.pandas_udf("array<struct<kind: string, start: int, end: int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder()
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for s, e, k in finder.spans(t)[1]] for t in texts], dtype=object)

    return narrow(docs, doc_id=id_col, text=text_col).select("doc_id", find("text").alias("spans"))


def span_digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_secrets``: counts, a hash of base spans, all spans."""
    text = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: ~x["kind"].isin(*BASE))).cast("long").alias("n_linked"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "<redacted>") -> DataFrame:
    """``docs`` with every reported span (overlapping ones merged) replaced by ``mask``.

    Only the text column changes; null texts stay null.
    """

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        finder, out = Finder(), []
        for t in texts:
            at, kept = 0, []
            for s, e, _ in finder.spans(t)[1]:
                if s >= at:
                    kept += [t[at:s], mask]
                at = max(at, e)
            out.append("".join(kept) + t[at:] if kept else t)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, cleaned(F.col(f"`{text_col}`")))


__all__ = ["find_secrets", "span_digest", "redact"]
