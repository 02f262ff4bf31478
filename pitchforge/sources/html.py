"""HTML extraction over a column of pages.

Runs as JVM regular expressions (``split`` at row starts + ``posexplode``),
one page per row, so it scales with the pages table.  Row, link and value
patterns are parameters: the defaults describe a roster table (rows of class odd
or even in a ``table.items``, with a ``td.hauptlink`` link and a value cell);
other page layouts pass their own.

A row runs from its start tag to the next one, so tables inside its cells don't
end it; a class matches as one of several words, wherever the attribute stands.
Comments, scripts and styles are cut out first; links stay as written.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchforge.functions.scalars import last_path_segment

# Default roster layout patterns.
def start_tag(tag: str, *classes: str) -> str:
    """Pattern of a start tag that has all of ``classes`` among its class words."""
    each = "".join(rf"(?=[^>]*\sclass\s*=\s*[\"'](?:[^\"']*\s)?{c}[\s\"'])" for c in classes)
    return rf"<{tag}\b{each}[^>]*>"


ROSTER_TABLE = start_tag("table", "items")
ROSTER_ROW = start_tag("tr", "(?:odd|even)")
#: From the start of a main cell to its first link, past no other cell: target, then text.
ROSTER_LINK = (r"(?s)" + start_tag("td", "hauptlink")
               + r"(?:(?!</td>|<td\b).)*?<a\b(?:[^>]*?\shref\s*=\s*[\"']([^\"']*)[\"'])?[^>]*>(.*?)</a>")
ROSTER_VALUE = r"(?s)" + start_tag("td", "rechts", "hauptlink") + r"(.*?)</td>"
DEFAULT_VALUE = "€0"
UNKNOWN_ID = "Unknown"

#: Code points of named entities (HTML 4); a fixed space counts as a space.
NAMED = dict(name2codepoint) | {"apos": 39, "nbsp": 32}
#: What a reader does not see: comments, scripts and styles, each to its end or the page's.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"


def without_unseen(html: Column) -> Column:
    return F.regexp_replace(html, UNSEEN, "")


def decoded(col: Column) -> Column:
    """Text with its numeric and named entities decoded once; others stay as they are."""
    # one literal, which folds to a map
    names = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in NAMED.items())), F.lit(","), F.lit(":"))

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        code = (F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10).cast("int"))
                 .when(name.startswith("#"), F.substr(name, F.lit(2)).cast("int"))
                 .otherwise(F.try_element_at(names, name).cast("int")))
        code = F.when(code == 160, 32).otherwise(code)
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(known, F.concat(char, F.substr(piece, F.length(name) + 2))).otherwise(F.concat(F.lit("&"), piece))

    pieces = F.split(col, "&")
    after = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), one)
    return F.when(F.contains(col, F.lit("&")), F.concat(F.get(pieces, 0), F.array_join(after, ""))).otherwise(col)


def html_text(col: Column) -> Column:
    """Visible text of an HTML fragment: tags removed, entities decoded, stripped."""
    return F.regexp_replace(decoded(F.regexp_replace(col, r"<[^>]*>", "")), r"^\s+|\s+$", "")


#: A scope: tag and pattern of its start tag.
ROSTER_SCOPE = ("table", ROSTER_TABLE)


def inside(html: Column, scope: tuple[str, str] | None) -> Column:
    """From the first element that matches ``scope`` to its own end tag (to the
    page's end without one), elements of the same tag within it included; null
    if there is no such element."""
    if scope is None:
        return html
    tag, start = scope
    pieces = F.split(F.get(F.split(html, start, 2), 1), rf"(?=<{tag}\b|</{tag}\b)")
    none = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

    def step(acc, piece):
        depth = acc["depth"] + F.when(piece.startswith(f"</{tag}"), -1).when(piece.startswith(f"<{tag}"), 1).otherwise(0)
        over = (acc["depth"] == 0) | (depth == 0)
        return F.struct(F.when(over, 0).otherwise(depth).alias("depth"),
                        F.when(over, acc["text"]).otherwise(F.concat(acc["text"], piece)).alias("text"))

    return F.aggregate(pieces, none, step, lambda acc: acc["text"])


def extract_rows(pages: DataFrame, html_col: str, keep: list[str],
                 row_start: str = ROSTER_ROW, link_pattern: str = ROSTER_LINK,
                 value_pattern: str | None = ROSTER_VALUE, scope: tuple[str, str] | None = ROSTER_SCOPE,
                 default_value: str = DEFAULT_VALUE) -> DataFrame:
    """One output row per matching row of the scope that has a name link.

    Output: ``keep`` columns, row_idx, name, href ('' without one), item_id
    (last path segment of href, 'Unknown' when empty) and value (text of the
    value cell, also if that is empty; ``default_value`` without such a cell).
    """
    pieces = F.split(inside(without_unseen(F.col(html_col)), scope), row_start)
    pieces = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    rows = pages.select(*keep, F.posexplode(pieces).alias("row_idx", "__row"))
    has_link = F.regexp_extract(F.col("__row"), link_pattern, 0) != ""
    href = F.regexp_extract(F.col("__row"), link_pattern, 1)
    name = html_text(F.regexp_extract(F.col("__row"), link_pattern, 2))
    if value_pattern is None:
        value = F.lit(default_value)
    else:
        value = F.when(F.regexp_extract(F.col("__row"), value_pattern, 0) == "", F.lit(default_value)).otherwise(
            html_text(F.regexp_extract(F.col("__row"), value_pattern, 1)))
    seg = last_path_segment(href)
    return rows.filter(has_link).select(
        *keep, F.col("row_idx").cast("bigint").alias("row_idx"), name.alias("name"),
        href.alias("href"),
        F.when(F.coalesce(seg, F.lit("")) == "", F.lit(UNKNOWN_ID)).otherwise(seg).alias("item_id"),
        value.alias("value"))


def first_link(pages: DataFrame, html_col: str, base_url: str, keep: list[str],
               link_pattern: str = ROSTER_LINK, scope: tuple[str, str] | None = ROSTER_SCOPE) -> DataFrame:
    """The first link in a main cell of the scope, prefixed with
    ``base_url``; null when there is none."""
    href = F.regexp_extract(inside(without_unseen(F.col(html_col)), scope), link_pattern, 1)
    return pages.select(*keep, F.when(href != "", F.concat(F.lit(base_url), href))
                        .alias("first_url"))


__all__ = ["extract_rows", "first_link", "html_text", "inside", "start_tag", "ROSTER_ROW", "ROSTER_LINK",
           "ROSTER_VALUE", "ROSTER_TABLE", "ROSTER_SCOPE"]
