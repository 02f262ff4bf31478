"""Cases in which rows or letters were lost: folding, dates, HTML, SCD2 nulls, registry duplicates."""

import datetime

from pyspark.sql import functions as F

from pitchforge.functions import scalars as S
from pitchforge.functions.text import normalize_text
from pitchforge.operators import scd2
from pitchforge.plans.resolve import resolve_entities
from pitchforge.sources import html


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_text_folds_every_latin_block(spark):
    got = one(spark, ["Nguyễn Quang Hải", "éà", " Ødegård ", "O’Neil “X” – y…",
                      "ASCII Only ", None, "Łukasz Ƀ", "Ế Ẩ Ỹ"], normalize_text)
    assert got == ["nguyen quang hai", "ea", "odegard", "o'neil \"x\" - y...", "ascii only", "", "lukasz ƀ", "e a y"]


def test_lenient_dates(spark):
    got = one(spark, ["2026-05-04", "2026-05-04T10:00:00", "20260504", "04/05/2026", "25/12/2025", "2026-5-4 7:30",
                      "2026-05-04T10:00:00.123+02:00", "May 4, 2026", "4 May 2026", "junk", "2026-13-01", None, ""],
              S.lenient_date)
    may4 = datetime.date(2026, 5, 4)
    assert got == [may4, may4, may4, datetime.date(2026, 4, 5), datetime.date(2025, 12, 25), may4, may4, may4, may4,
                   None, None, None, None]


def test_date_grammar(spark):
    """Values that a reader meets, each on its own; ambiguous ones are pinned here."""
    may4 = datetime.date(2026, 5, 4)
    same = ["04-May-26", "2026-05-04 10:00 AM", "20260504T100000", "Monday, May 4, 2026", "2026.05.04", "5-4-2026", "5/4/26", "May 4th, 2026",
            "4 may 2026", "2026 May 4", "Mon 4 May 2026", "2026-05-04T10:00", "20260504 101010", "  2026-05-04  ", "Mon, 04 May 2026 10:00:00 GMT"]
    assert one(spark, same, S.lenient_date) == [may4] * len(same)
    other = {"1/2/26": (2026, 1, 2), "13/4/2026": (2026, 4, 13), "4.5.2026": (2026, 4, 5), "May 2026": (2026, 5, 1), "2026-05": (2026, 5, 1),
             "5/2026": (2026, 5, 1), "2026": (2026, 1, 1), "26-May-04": (2004, 5, 26), "1/2/70": (1970, 1, 2), "12/31/68": (2068, 12, 31),
             "Sept. 4, 2026": (2026, 9, 4), "Saturday 4 July 2026": (2026, 7, 4)}
    assert one(spark, list(other), S.lenient_date) == [datetime.date(*x) for x in other.values()]
    bad = ["13/13/2026", "2026-02-30", "2026-05-04 25:00", "4 mayo 2026", "May", "99999999", "00/00/0000", "1 2 3 4", "10:00"]
    assert one(spark, bad, S.lenient_date) == [None] * len(bad)


def test_names_of_any_script(spark):
    names = {"Иван Петров": "ivan petrov", "Γιώργος": "giorgos", "손흥민": "sonheungmin", "Ǿ": "o", "ﬁne": "fine", "Щукин Юрий": "shchukin iurii",
             "Θεόδωρος Ψ": "theodoros ps", "Їжак Ґ": "yizhak g", "Ǆ ǈ": "dz lj", "１２ Ａb": "12 ab", "김민재 Kim": "gimminjae kim", "Ёлка": "iolka",
             "José Щ ß": "jose shch ss", "中文": "中文"}
    assert one(spark, list(names), normalize_text) == list(names.values())


def test_money_and_rounding(spark):
    values = [1.2346e9, 250000.0, 50000.0, 350000.0, -1.26e6, 0.0, 12.35e6]
    assert one(spark, [*values, None], S.money_millions, "double") == [f"{v / 1e6:.1f}M€" for v in values] + ["N/A"]
    assert one(spark, [-1.005, -2.675, 2.5, None], lambda c: S.round_half_up(c, 1), "double") == [-1.0, -2.7, 2.5, None]


PAGE = """<table class="other"><tr class="odd"><td class="hauptlink"><a href="/no/0">No</a></td></tr></table>
<table id=t class="items big"><thead><tr><th>x</th></tr></thead><tbody>
<tr class="odd bg"><td><table class="inline-table"><tr><td><img></td><td class="hauptlink first"><a title="q" href="/a-b/spieler/1">A <b>B</b></a></td></tr>
<tr><td>Keeper</td></tr></table></td><td class="rechts hauptlink">€1.00m</td></tr>
<tr data-x="1" class='even'><td class="hauptlink"><img><a href="/c/spieler/2"></a></td><td class="hauptlink rechts"></td></tr>
<tr class="odd"><td>no link</td><td class="rechts">€9</td></tr>
<tr class="even"><td class="hauptlink"><a name="x">D</a></td></tr></tbody></table>
<table class="items"><tr class="odd"><td class="hauptlink"><a href="/late/3">Late</a></td></tr></table>"""


def test_roster_rows(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "id int, html string")
    got = [(r["id"], r["name"], r["item_id"], r["value"], r["href"]) for r in
           html.extract_rows(pages, "html", ["id"]).orderBy("id", "row_idx").collect()]
    assert got == [(1, "A B", "1", "€1.00m", "/a-b/spieler/1"), (1, "", "2", "", "/c/spieler/2"),
                   (1, "D", "Unknown", "€0", "")]


def test_first_link_is_the_main_cells(spark):
    page = ('<table class="items x"><tr class="odd"><td><a href="/crest">i</a></td><td class="hauptlink">'
            '<a class="c" href="/team/7">T</a></td></tr></table>')
    pages = spark.createDataFrame([(1, page), (2, "<table class='items'></table>")], "id int, html string")
    got = {r["id"]: r["first_url"] for r in html.first_link(pages, "html", "https://x", ["id"]).collect()}
    assert got == {1: "https://x/team/7", 2: None}


def test_null_flags_and_dates_stay_in_the_history(spark):
    day = datetime.date(2026, 5, 4)
    silver = spark.createDataFrame(
        [("a", 1.0, None, datetime.date(2026, 1, 1), None), ("b", 1.0, True, None, None), ("c", 1.0, True, day, None),
         ("d", 1.0, False, None, None)], "k string, v double, is_current boolean, valid_from date, valid_to date")
    new = spark.createDataFrame([("b", 2.0), ("c", 2.0), ("e", 5.0), ("e", 6.0)], "k string, v double")
    got = scd2.scd2_load(new, silver, "k", ["v"], F.lit(day))
    rows = sorted(((r["k"], r["v"], r["is_current"], r["valid_to"]) for r in got.collect()), key=str)
    kept = [r for r in rows if r[0] != "e"]
    assert kept == [("a", 1.0, None, None), ("b", 1.0, False, day), ("b", 2.0, True, None), ("c", 2.0, True, None),
                    ("d", 1.0, False, None)]
    assert len([r for r in rows if r[0] == "e"]) == 1  # one current version of a repeated key
    ordered = scd2.scd2_load(new.withColumn("n", F.col("v")), silver, "k", ["v"], F.lit(day), order=["n"])
    assert [r["v"] for r in ordered.where("k = 'e'").collect()] == [6.0]


def test_registry_duplicates_and_second_run(spark):
    left = spark.createDataFrame([("1", "anna berg", "Anna Berg", 1), ("2", "zzz qqq", "Zzz", 2)],
                                 "lid string, norm string, raw string, ord int")
    right = spark.createDataFrame([(7, "anna berg", "Anna Berg", 1), (8, "zzz qqq", "Zzz Qqq", 2)],
                                  "rid int, rnorm string, rraw string, rord int")
    names = dict(left_id="lid", left_norm="norm", left_raw="raw", left_order="ord", right_id="rid", right_norm="rnorm",
                 right_raw="rraw", right_order="rord")
    registry = spark.createDataFrame([("PLR_00001", "1", "9", "old"), ("PLR_00004", "1", "7", "Anna"),
                                      ("PLR_00002", "2", "unknown", "Zzz")],
                                     "internal_id string, left_id string, right_id string, display_name string")
    merged, after = resolve_entities(left, right, registry, **names)
    got = sorted((r["lid"], r["internal_id"], r["bridge_id"], r["rraw"]) for r in merged.collect())
    assert got == [("1", "PLR_00004", "7", "Anna Berg"), ("2", "PLR_00002", "unknown", None)]
    assert after.count() == 3  # the placeholder is known and isn't tried again
