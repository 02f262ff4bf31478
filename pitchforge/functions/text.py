"""Text functions: normalisation (H1), name rules (H2/H3), token-sort similarity (H4).

``normalize_text`` stays in the JVM: tables are built at import time *by rule* (Unicode
NFKD of every letter and compatibility form of a script's blocks, then the fixed
transliterations of what is left), as one ``translate`` for letters that
become one and a replacement for each that becomes several; combining marks go, so
decomposed input folds like precomposed.  Accented Latin values pass through the
Latin table alone, and those with Greek, Cyrillic or Hangul characters (whose
syllables are decomposed by their code points) or ligatures through all.  Han and
other scripts, for which no rule gives a reading, pass through unchanged.

``token_sort_ratio`` is an Arrow UDF over *pairs*; callers feed it distinct
candidate pairs only (see ``operators.fuzzy``).
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Arrow UDFs below are shipped to executors by value, so Python workers
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---------------------------------------------------------------------------
# Transliterations that NFKD does not produce (letters without a
# canonical decomposition).  Lower and upper case, in natural order.
FIXED_TRANSLITERATIONS = {
    "ß": "ss", "ẞ": "SS",
    "æ": "ae", "Æ": "AE",
    "œ": "oe", "Œ": "OE",
    "þ": "th", "Þ": "TH",
    "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D",
    "ð": "d", "Ð": "D",
    "ł": "l", "Ł": "L",
    "ı": "i",
    "ħ": "h", "Ħ": "H",
    "ŧ": "t", "Ŧ": "T",
    "ŋ": "ng", "Ŋ": "NG",
    "ĸ": "k",
    "ŀ": "l", "Ŀ": "L",
    "ə": "@", "Ə": "@",
    "\u2018": "'", "\u2019": "'", "\u201a": ",", "\u201b": "'", "ʼ": "'", "´": "'",
    "\u201c": '"', "\u201d": '"', "\u201e": ",,", "«": "<<", "»": ">>",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "--",
    "\u2026": "...", "\u00a0": " ",
}
# ---------------------------------------------------------------------------


# Greek and Cyrillic letters without accents, lower case, in natural order.
GREEK = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
         "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o"}
CYRILLIC = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l",
            "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
            "ш": "sh", "щ": "shch", "ъ": '"', "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "ё": "io", "ђ": "dj", "ѓ": "gj",
            "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh", "ќ": "kj", "ў": "u", "џ": "dzh", "ґ": "g"}
# Romanised initial, medial and final letters of Hangul syllables, in the order of their code points.
HANGUL = (("g", "gg", "n", "d", "dd", "r", "m", "b", "bb", "s", "ss", "", "j", "jj", "c", "k", "t", "p", "h"),
          ("a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa", "wae", "oe", "yo", "u", "weo", "we", "wi", "yu", "eu", "yi", "i"),
          ("", "g", "gg", "gs", "n", "nj", "nh", "d", "l", "lg", "lm", "lb", "ls", "lt", "lp", "lh", "m", "b", "bs", "s", "ss", "ng",
           "j", "c", "k", "t", "p", "h"))
# ---------------------------------------------------------------------------


def _folded(ch: str, letters: dict[str, str]) -> str:
    """What a character becomes: its own entry, or that of each part of its decomposition without marks."""
    def entry(c: str) -> str:
        return letters.get(c) or letters.get(c.lower(), c).upper() if c.lower() in letters else c
    if ch.lower() in letters:
        return entry(ch)
    parts = [c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)]
    return "".join(entry(c) for c in parts)


def _tables(blocks: list[range], letters: dict[str, str]) -> tuple[str, str, dict[str, str]]:
    """(characters, the one that each becomes, those that become several) of blocks, where the result is ASCII."""
    src, dst, several = [], [], {}
    for cp in [c for b in blocks for c in b]:
        ch = chr(cp)
        out = _folded(ch, letters) if unicodedata.category(ch)[0] in "LNPS" else ch
        if out.isascii() and out and out != ch and not ch.isascii():
            if len(out) == 1:
                src.append(ch)
                dst.append(out)
            else:
                several[ch] = out
    return "".join(src), "".join(dst), several


# Latin letters, ligatures and full-width forms; letters of these blocks with entries of their own come from FIXED_TRANSLITERATIONS.
ACCENT_FROM, ACCENT_TO, _DIGRAPHS = _tables([range(0x00C0, 0x0250), range(0x1E00, 0x1F00), range(0xFB00, 0xFB07), range(0xFF01, 0xFF5F)],
                                            {k: v for k, v in FIXED_TRANSLITERATIONS.items() if k.isalpha()})
_SINGLE_FIXED = {k: v for k, v in FIXED_TRANSLITERATIONS.items() if len(v) == 1 and k not in ACCENT_FROM}
_MULTI_FIXED = {k: v for k, v in FIXED_TRANSLITERATIONS.items() if len(v) > 1}
_DIGRAPHS = {k: v for k, v in _DIGRAPHS.items() if k not in FIXED_TRANSLITERATIONS}
_GREEK = _tables([range(0x0370, 0x0400), range(0x1F00, 0x2000)], GREEK)
_CYRILLIC = _tables([range(0x0400, 0x0500)], CYRILLIC)


def _characters(col: Column, several: dict[str, str]) -> Column:
    """Letters that become several ones, and Hangul syllables, one character after the other."""
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])

    def one(ch: Column) -> Column:
        i = F.ascii(ch) - 0xAC00  # the code point of the first character
        part = lambda letters, at: F.get(F.array(*map(F.lit, letters)), at.cast("int"))
        return F.when(ch.between("\uac00", "\ud7a3"), F.concat(
            part(HANGUL[0], F.floor(i / 588)), part(HANGUL[1], F.floor(i % 588 / 28)), part(HANGUL[2], i % 28))).otherwise(
            F.coalesce(F.try_element_at(table, ch), ch))
    return F.array_join(F.transform(F.split(col, ""), one), "")


#: Characters of the tables beside accented letters; values with one of them are rarer.
_OTHERS = f"[{''.join(_DIGRAPHS)}\u0370-\u03ff\u1f00-\u1fff\u0400-\u04ff\uac00-\ud7a3]"


def strip_accents(col: Column) -> Column:
    """JVM-side transliteration of Latin, Greek, Cyrillic and Hangul letters (no Python on executors)."""
    latin = F.translate(col, ACCENT_FROM + "".join(_SINGLE_FIXED), ACCENT_TO + "".join(_SINGLE_FIXED.values()))
    for k, v in _MULTI_FIXED.items():
        latin = F.replace(latin, F.lit(k), F.lit(v))
    others = F.translate(latin, _GREEK[0] + _CYRILLIC[0], _GREEK[1] + _CYRILLIC[1])
    others = _characters(others, _DIGRAPHS | _GREEK[2] | _CYRILLIC[2])
    # the range is checked first, as most values have nothing beyond it and many classes are slow to match
    beyond = col.rlike("[^\\x00-\u0131]") & col.rlike(_OTHERS)
    out = F.regexp_replace(F.when(beyond, others).otherwise(latin), r"\p{M}+", "")
    # most values are plain ASCII and need none of this
    return F.when(col.rlike(r"[^\x00-\x7F]"), out).otherwise(col)


def normalize_text(col: Column | str) -> Column:
    """H1: null/blank -> ''; transliterate accents; lower case; strip whitespace."""
    c = F.col(col) if isinstance(col, str) else col
    cleaned = F.regexp_replace(F.lower(strip_accents(c)), r"^\s+|\s+$", "")
    return F.when(c.isNull(), F.lit("")).otherwise(cleaned)


def _py_normalize(s):
    if s is None:
        return ""
    s = str(s)
    if not s.strip():
        return ""
    s = "".join(FIXED_TRANSLITERATIONS.get(ch, ch) for ch in s)
    s = unicodedata.normalize("NFKD", s)
    s = "".join(ch for ch in s if not unicodedata.combining(ch))
    return s.lower().strip()


@F.pandas_udf(T.StringType())
def normalize_text_udf(s: pd.Series) -> pd.Series:
    """H1 general path for any script (Arrow batches, full NFKD)."""
    return s.map(_py_normalize)


# ---------------------------------------------------------------------------
# H2 / H3: column-name rules (applied at plan time to schema names, or on data)
_CAMEL = re.compile(r"(?<!^)(?=[A-Z])")


def camel_to_snake(name: str) -> str:
    return _CAMEL.sub("_", name).lower()


# ---------------------------------------------------------------------------
# H4: token-sort similarity
def token_sort_key(col: Column | str) -> Column:
    """Tokens split on whitespace, sorted by code point, joined by one space."""
    c = F.col(col) if isinstance(col, str) else col
    trimmed = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.lit("")).otherwise(
        F.array_join(F.array_sort(F.split(trimmed, r"\s+")), " "))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence length, bit-parallel (one pass over ``b``)."""
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def indel_ratio(a: str, b: str) -> float:
    """Normalised indel similarity in 0..100 of two already-processed strings."""
    total = len(a) + len(b)
    if total == 0:
        return 100.0
    return 200.0 * lcs_length(a, b) / total


def token_sort_ratio_py(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


@F.pandas_udf(T.LongType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """LCS length per pair, Arrow-batched."""
    return pd.Series([lcs_length(x or "", y or "") for x, y in zip(a, b)], dtype="int64")


def token_sort_ratio(left_sorted: Column, right_sorted: Column) -> Column:
    """H4 on token-sorted inputs: 200*LCS/(len a + len b), 100 when both empty."""
    total = F.length(left_sorted) + F.length(right_sorted)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.lit(200.0) * lcs_udf(left_sorted, right_sorted) / total)


__all__ = ["normalize_text", "normalize_text_udf", "strip_accents", "camel_to_snake",
           "token_sort_key", "lcs_length", "indel_ratio",
           "token_sort_ratio", "token_sort_ratio_py", "lcs_udf", "FIXED_TRANSLITERATIONS"]
