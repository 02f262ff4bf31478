"""What a reader does not see, and entities."""

from pitchforge.sources.html import extract_rows, first_link

ROW = '<tr class="odd"><td class="hauptlink"><a href="/p/{0}">{1}</a></td><td class="rechts hauptlink">{2}</td></tr>'


def page(*rows, before=""):
    return f'{before}<table class="items">' + "".join(rows) + "</table>"


def test_comments_scripts_and_styles_are_not_read(spark):
    hidden = ROW.format(9, "Hidden", "x")
    html = page(f"<!-- {hidden} -->", ROW.format(1, "A", "1"), f"<script>var r = '{hidden}';</script>",
                f"<STYLE>{hidden}</STYLE >", ROW.format(2, "B", "2"), f"<!-- open {hidden}", before=f"<!--<table class='items'>{hidden}</table>-->")
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    assert [(r["id"], r["row_idx"], r["name"], r["item_id"], r["value"]) for r in extract_rows(pages, "html", ["id"]).collect()] == \
        [(1, 0, "A", "1", "1"), (1, 1, "B", "2", "2")]
    assert [r["first_url"] for r in first_link(pages, "html", "http://h", ["id"]).orderBy("id").collect()] == ["http://h/p/1", None, None]


def test_entities(spark):
    cases = {"Jos&eacute; &#193;lvarez": "Jos\u00e9 \u00c1lvarez", "&#x1F600;&#X41;": "\U0001f600A", "a &amp;lt; b": "a &lt; b", "R&D & Co": "R&D & Co",
             "&unknown; &#0; &#xD800; &#9999999;": "&unknown; &#0; &#xD800; &#9999999;", "x&nbsp;y&#160;z": "x y z", "&apos;&quot;&euro;&gt;": "'\"\u20ac>", "plain": "plain"}
    pages = spark.createDataFrame([(page(*[ROW.format(i, t, t) for i, t in enumerate(cases)]),)], "html string")
    got = {r["row_idx"]: (r["name"], r["value"]) for r in extract_rows(pages, "html", []).collect()}
    assert got == {i: (want, want) for i, want in enumerate(cases.values())}
