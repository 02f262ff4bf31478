"""Scalar Column builders: formats (H5-H18), dates (H20-H24), math.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` only,
so it is evaluated inside whole-stage codegen.  ANSI mode is on in Spark 4, so
anything that can fail per row uses the ``try_*`` forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- strings
def short_name(col) -> Column:
    """H5: first three characters, upper case."""
    return F.upper(F.substring(_col(col).cast("string"), 1, 3))


def signed_number(col) -> Column:
    """H10: '+n' for positive, 'n' otherwise (integer part)."""
    n = _col(col).cast("bigint")
    return F.when(n > 0, F.concat(F.lit("+"), n.cast("string"))).otherwise(n.cast("string"))


def goals_label(goals, penalties) -> Column:
    """H11: 'g (p pen)' when p > 0 else 'g'; nulls count as 0."""
    g = F.coalesce(_col(goals).cast("bigint"), F.lit(0))
    p = F.coalesce(_col(penalties).cast("bigint"), F.lit(0))
    return F.when(p > 0, F.format_string("%d (%d pen)", g, p)).otherwise(g.cast("string"))


def url_from_id(col, prefix: str, suffix: str = "") -> Column:
    """Null-safe URL built around an id."""
    c = _col(col)
    return F.when(c.isNotNull(), F.concat(F.lit(prefix), c.cast("string"), F.lit(suffix)))


def last_path_segment(col, default: str | None = None) -> Column:
    """Text after the last '/'."""
    seg = F.element_at(F.split(_col(col), "/"), -1)
    return seg if default is None else F.coalesce(seg, F.lit(default))


def remove_spaces(col) -> Column:
    """H14."""
    return F.replace(_col(col), F.lit(" "), F.lit(""))


def money_millions(col) -> Column:
    """H15: '%.1fM€', null -> 'N/A'."""
    c = _col(col)
    return F.when(c.isNull(), F.lit("N/A")).otherwise(
        F.format_string("%.1fM€", _exact_tenths(c / F.lit(1e6))))


def _exact_tenths(c: Column) -> Column:
    """Round to one decimal by the exact binary value, ties to even, as C's printf does.

    The JVM formats from the shortest decimal text, so 0.35 (just below it in
    binary) and 0.25 (a tie) come out otherwise.  With k tenths below x, 4x is
    compared with q = (2k + 1) / 5; both comparisons below are free of rounding.
    """
    x = F.abs(c)
    k = F.floor(x * 10).cast("double")
    odd = 2 * k + 1
    q, above = odd / 5, F.signum(odd / 5 - (odd - 4 * (odd / 5)))  # above: q was rounded up (1) or down (-1)
    up = (4 * x > q) | ((4 * x == q) & ((above > 0) | ((above == 0) & (k % 2 == 1))))
    tenths = F.signum(c) * (k + F.when(up, 1.0).otherwise(0.0)) / 10
    return F.when(x < 1e15, tenths).otherwise(c)


def zero_padded_id(col, prefix: str = "PLR_", width: int = 5) -> Column:
    """Prefix + zero-padded number."""
    return F.format_string(f"{prefix}%0{width}d", _col(col).cast("bigint"))


def count_or_zero(col) -> Column:
    """Null -> 0, integer."""
    return F.coalesce(_col(col), F.lit(0)).cast("bigint")


def id_to_string(col) -> Column:
    """H18 / §2.13.4: ids as whole-number strings (never '123.0')."""
    return _col(col).cast("bigint").cast("string")


# ------------------------------------------------------------------- dates
# Month names, each with its abbreviation as the first three letters.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_CLOCK = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?(\s*(am|pm))?\s*(z|utc|gmt|[+-]\d{2}:?\d{2})?$"
_COMPACT_CLOCK = r"(?<=^\d{8})[t ]?([01]\d|2[0-3])[0-5]\d([0-5]\d)?(z|[+-]\d{2}:?\d{2})?$"
_WEEKDAY = r"^(mon|tues?|wed(nes)?|thu(rs?)?|fri|sat(ur)?|sun)(day)?\b[.,]?\s*"
_MONTH = "^(" + "|".join(m if m == "may" else f"{m[:3]}({m[3:]})?" for m in MONTHS).replace("sep(tember)?", "sept?(ember)?") + ")$"


def lenient_date(col, pivot: int = 69) -> Column:
    """The date of a value on its own, with or without weekday and time of day; bad input -> null.

    What is left of the value are one to three tokens, each a number or a month's name:

    * a token of four digits is the year, in first or last place; else the last of three is, with two digits;
    * a month's name is the month, and the other short number the day;
    * of two short numbers the month comes first, unless it is above 12;
    * without a day the date is the first of the month, without a month that of the year;
    * eight digits are year, month and day; two-digit years below ``pivot`` are 20xx.
    """
    c = F.lower(F.trim(_col(col).cast("string")))
    c = F.regexp_replace(c, r"(?<=[t\s])" + _CLOCK, "")
    c = F.regexp_replace(F.regexp_replace(c, r"(?<=\d)t$", ""), _COMPACT_CLOCK, "")
    c = F.trim(F.regexp_replace(F.regexp_replace(c, _WEEKDAY, ""), r"(?<=\d)(st|nd|rd|th)\b", ""))
    c = F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    parts = F.split(F.regexp_replace(c, r"\.(?=[ ,-]|$)", ""), r"\s*[ ,./-]\s*")
    # arrays of one element name the tokens and the result, so that each is computed once
    found = F.transform(F.array(parts), lambda t: _year_month_day(t, pivot))
    return F.transform(found, lambda f: F.try_to_date(F.format_string("%04d-%02d-%02d", f["y"], f["m"], f["d"]), "yyyy-MM-dd"))[0]


def _year_month_day(tokens: Column, pivot: int) -> Column:
    """struct<y, m, d> of one to three tokens; null if they are no date."""
    n, t = F.size(tokens), [F.get(tokens, F.lit(i)) for i in range(3)]
    year4, short = ([x.rlike(r) for x in t] for r in (r"^\d{4}$", r"^\d{1,2}$"))
    named = [x.rlike(_MONTH) for x in t]
    month = [F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(x, 1, 3)).cast("int") for x in t]
    num = [x.try_cast("int") for x in t]
    ymd = lambda y, m, d: F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))
    one = F.lit(1)
    last = F.when(year4[2], num[2]).when(short[2], num[2] + F.when(num[2] < pivot, 2000).otherwise(1900))  # the year of three tokens
    return (
        F.when(n == 1, F.when(year4[0], ymd(num[0], one, one)))
        .when(n == 2, F.when(named[0] & year4[1], ymd(num[1], month[0], one)).when(year4[0] & named[1], ymd(num[0], month[1], one))
              .when(year4[0] & short[1], ymd(num[0], num[1], one)).when(short[0] & year4[1], ymd(num[1], num[0], one)))
        .when(n == 3, F.when(year4[0] & named[1] & short[2], ymd(num[0], month[1], num[2]))
              .when(year4[0] & short[1] & short[2], ymd(num[0], num[1], num[2]))
              .when(named[0] & short[1], ymd(last, month[0], num[1])).when(short[0] & named[1], ymd(last, month[1], num[0]))
              .when(short[0] & short[1] & (num[0] > 12), ymd(last, num[1], num[0])).when(short[0] & short[1], ymd(last, num[0], num[1]))))


def iso_date_string(col) -> Column:
    return F.date_format(_col(col), "yyyy-MM-dd")


def season_label(col) -> Column:
    """Month >= 8 -> 'y-(y+1)', else '(y-1)-y'; null -> null."""
    d = _col(col)
    start = F.when(F.month(d) >= 8, F.year(d)).otherwise(F.year(d) - 1)
    return F.when(d.isNotNull(), F.concat_ws("-", start.cast("string"), (start + 1).cast("string")))


def season_bounds(col, run_year: Column | None = None) -> tuple[Column, Column]:
    """H22: 'YYYY-YYYY' -> (Aug 1 of first year, May 31 of second).

    Unparseable names fall back to the run year (Aug 1 .. May 31 next year).
    """
    c = _col(col)
    parts = F.split(c, "-")
    y0 = F.get(parts, 0).try_cast("int")
    y1 = F.get(parts, 1).try_cast("int")
    ok = (F.size(parts) == 2) & y0.isNotNull() & y1.isNotNull()
    ry = run_year if run_year is not None else F.year(F.current_date())
    start = F.when(ok, F.make_date(y0, F.lit(8), F.lit(1))).otherwise(
        F.make_date(ry, F.lit(8), F.lit(1)))
    end = F.when(ok, F.make_date(y1, F.lit(5), F.lit(31))).otherwise(
        F.make_date(ry + 1, F.lit(5), F.lit(31)))
    return start, end


def run_date_col(run_date: str | None) -> Column:
    """The run date is a parameter; ``None`` means current_date()."""
    return F.to_date(F.lit(run_date)) if run_date else F.current_date()


def run_stamp(moment: str | None = None) -> Column:
    """H23: 'yyyyMMdd_HHmm' of a moment, of now without one."""
    at = F.to_timestamp(F.lit(moment)) if moment else F.current_timestamp()
    return F.date_format(at, "yyyyMMdd_HHmm")


def millions(col) -> Column:
    """H24."""
    return _col(col) / F.lit(1e6)


# -------------------------------------------------------------------- math
def per90(value, minutes) -> Column:
    """Minutes > 0 ? value/minutes*90 : 0; null -> 0."""
    v, m = _col(value), _col(minutes)
    return F.coalesce(F.when(m > 0, v / m * F.lit(90.0)).otherwise(F.lit(0.0)), F.lit(0.0))


def clip(col, lo: float, hi: float) -> Column:
    """Clamp; null stays null."""
    c = _col(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def min_max_scaled(value, lo, hi) -> Column:
    """(v-lo)/(hi-lo)*100 clipped to [0,100]; hi == lo -> 0; null -> 0."""
    v, lo, hi = _col(value), _col(lo), _col(hi)
    raw = F.when(hi == lo, F.lit(0.0)).otherwise((v - lo) / (hi - lo) * F.lit(100.0))
    return F.coalesce(clip(raw, 0.0, 100.0), F.lit(0.0))


def underdog_multiplier(rank) -> Column:
    """1 + 0.015 * (clip(rank, 1, 20) - 1); null rank -> null."""
    r = clip(_col(rank).cast("double"), 1.0, 20.0)
    return F.lit(1.0) + F.lit(0.015) * (r - F.lit(1.0))


def round_half_up(col, digits: int = 2) -> Column:
    """ROUND(x, d), half away from zero."""
    return F.round(_col(col), digits)


def radar_multiplier(mult) -> Column:
    """(m - 1)/0.285*100 clipped to [0, 100]."""
    return clip((_col(mult) - F.lit(1.0)) / F.lit(0.285) * F.lit(100.0), 0.0, 100.0)


__all__ = [n for n in dir() if not n.startswith("_") and n not in {"annotations", "Column", "F"}]
