"""Plain versions of the corpus operators, for comparison on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def base_spans(text):
    t, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def top_k(rows, k=5):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(ok):
        if q is not None and q % 50 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i is None, i) for m, (i, b) in enumerate(ok) if m != n]
            out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    raws = [(t or "").encode() for t in texts]
    count = Counter()
    for r in raws:
        count.update(r[i:i + length] for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((gone[1:] < gone[:-1]).sum()) if len(r) else 0
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=3):
    """doc_id -> smallest doc_id reachable, for each row (doc_id, text)."""
    fps = np.array([fingerprint(t) for _, t in rows], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            root[find(int(j))] = find(i)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)] += [d] if d is not None else []
    return [(d, f"{int(fp):016x}", min(least[find(i)], default=None)) for i, ((d, _), fp) in enumerate(zip(rows, fps))]


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def leaks(docs, items, threshold=0.8, width=5):
    """(doc_id, item_id, n_words, best similarity) over all windows of all texts."""
    out = []
    for d, text in docs:
        w = words(text)
        for item, item_text in items:
            v = words(item_text)
            k = min(width, len(v))
            if not v or len(w) < k:
                continue
            a = Counter(tuple(v[i:i + k]) for i in range(len(v) - k + 1))
            sh = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
            if sum(s in a for s in sh) < threshold / 2 * sum(a.values()):
                continue
            best, m = 0, min(len(v), len(w)) - k + 1
            for s in range(max(1, len(w) - len(v) + 1)):
                b = Counter(sh[s:s + m])
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= threshold:
                out.append((d, item, len(v), best))
    return out


def pieces(text, tokenizer, end_id=0, sequence=2048):
    """(piece, start, length, crc) of a document."""
    ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id], dtype="<u4")
    first = len(ids) % sequence or sequence
    cuts = [0, *range(first, len(ids) + 1, sequence)]
    return [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
