"""Resolution with birth date and team beside the name."""

from pitchforge.plans.resolve import resolve_entities

NAMES = dict(left_id="lid", left_norm="norm", left_raw="raw", left_order="ord", right_id="rid", right_norm="rnorm",
             right_raw="rraw", right_order="rord")
LEFT = [("1", "vinicius junior", "d1", 7), ("2", "anna berg", "d2", 7), ("3", "jose maria lopez", "d3", 8), ("4", "joe miller", "d4", 9),
        ("5", "zzz", None, 9), ("6", "twin one", "d5", 1), ("7", "twin two", "d5", 1), ("8", "ben smith", "d9", 2), ("9", None, "d8", 3)]
RIGHT = [(10, "vini jr", "d1", 7), (11, "anna berg", "d0", 7), (12, "anna berg", "d2", 7), (13, "jose lopez", "d3", 8),
         (14, "joe milner", "d4", 5), (15, "zzzzzzzz", None, 9), (16, "xx yy", "d5", 1), (17, "ben smith", "d9", 4),
         (18, "ben smyth", "d9", 2), (19, "someone", "d8", 3), (20, "other", "d3", 8)]


def frames(spark, left=LEFT, right=RIGHT):
    return (spark.createDataFrame([(i, n, (n or "").title(), k, b, t) for k, (i, n, b, t) in enumerate(left)],
                                  "lid string, norm string, raw string, ord int, born string, team int"),
            spark.createDataFrame([(i, n, n.title(), k, b, t) for k, (i, n, b, t) in enumerate(right)],
                                  "rid int, rnorm string, rraw string, rord int, dob string, club int"))


def test_evidence_and_best_match(spark):
    left, right = frames(spark)
    merged, registry = resolve_entities(left, right, None, second_key={"born": "dob", "team": "club"}, **NAMES)
    got = {r["lid"]: (r["bridge_id"], r["evidence"]) for r in merged.collect()}
    assert got == {
        "1": ("10", "key"),  # other name, but one left and one right row have this birth date and team
        "2": ("12", "key+name"),  # of two equal names the one with the same key
        "3": ("13", "key+name"),  # 77 of 100, and two right rows with the key
        "4": ("14", "name"),  # moved to another team
        "5": ("unknown", None), "6": ("unknown", None), "7": ("unknown", None),  # no key; a key of two left rows
        "8": ("18", "key+name"),  # nearly equal with the key, ahead of equal without
        "9": (None, None)}  # no name: as before, not resolved
    assert registry.count() == 8
    # without a second key only names count
    merged, _ = resolve_entities(left, right, None, **NAMES)
    assert {r["lid"]: r["bridge_id"] for r in merged.collect()} == {
        "1": "unknown", "2": "11", "3": "unknown", "4": "14", "5": "unknown", "6": "unknown", "7": "unknown", "8": "17", "9": None}


def test_placeholders_stay(spark):
    left, right = frames(spark)
    known = spark.createDataFrame([("PLR_00003", "1", "unknown", "V"), ("PLR_00004", "2", "11", "A")],
                                  "internal_id string, left_id string, right_id string, display_name string")
    merged, registry = resolve_entities(left, right, known, second_key={"born": "dob", "team": "club"}, **NAMES)
    got = {r["lid"]: (r["internal_id"], r["bridge_id"], r["evidence"]) for r in merged.collect()}
    assert got["1"] == ("PLR_00003", "unknown", None) and got["2"] == ("PLR_00004", "11", None)
    assert got["3"] == ("PLR_00005", "13", "key+name") and registry.count() == 8


def test_frequent_key_gives_no_pairs_of_all_rows(spark):
    """200 rows a side share one key: only similar names meet."""
    name = lambda i: f"{chr(97 + i % 26) * 5}{chr(97 + i // 26) * 5} {i:04d}{i:04d}"
    left, right = frames(spark, [(str(i), name(i), "d", 1) for i in range(200)], [(i, name(i) + "x", "d", 1) for i in range(200)])
    merged, _ = resolve_entities(left, right, None, second_key={"born": "dob", "team": "club"}, **NAMES)
    assert all(r["bridge_id"] == r["lid"] and r["evidence"] == "key+name" for r in merged.collect())


def test_no_rows(spark):
    left, right = frames(spark)
    merged, registry = resolve_entities(left.where("false"), right, None, second_key={"born": "dob", "team": "club"}, **NAMES)
    assert merged.count() == 0 == registry.count()
    merged, _ = resolve_entities(left, right.where("false"), None, second_key={"born": "dob", "team": "club"}, **NAMES)
    assert {r["bridge_id"] for r in merged.collect()} == {"unknown", None}
