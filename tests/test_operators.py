"""SCD2 scenario (FIXTURES §3.4), fuzzy lossless vs brute force, dense keys,
contract negatives, HTML golden, leaderboard and quadrant goldens (§3.5)."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitchforge.functions.scalars import run_date_col
from pitchforge.functions.text import token_sort_ratio_py
from pitchforge.operators import contract
from pitchforge.operators.dedupe import dense_key
from pitchforge.operators.fuzzy import fuzzy_best_match
from pitchforge.operators.scd2 import scd2_load
from pitchforge.plans import analytics
from pitchforge.session import cut_lineage
from pitchforge.sources.html import extract_rows

TRACKED = ["goals", "assists", "market_value", "team_a", "team_b"]
SCHEMA = "pid string, goals double, assists double, market_value double, team_a string, " \
         "team_b string, xg double"


def _load(spark, rows, silver, day, schema=SCHEMA):
    snap = spark.createDataFrame(rows, schema)
    return cut_lineage(scd2_load(snap, silver, "pid", TRACKED, run_date_col(day)), "t-silver")


def test_scd2_scenario(spark):
    s1 = _load(spark, [("P1", 5.0, None, None, "A", None, None), ("P2", 3.0, None, None, "A", None, 1.0),
                       ("P3", None, None, None, "A", None, None)], None, "2026-05-01")
    assert s1.filter("is_current").count() == 3
    s2 = _load(spark, [("P1", 6.0, None, None, "A", None, None), ("P2", 3.0, None, None, "A", None, 2.0),
                       ("P3", -1.0, None, None, "A", None, None), ("P4", 1.0, None, None, "B", None, None)],
               s1, "2026-05-04")
    rows = {(r.pid, r.valid_from): r for r in s2.collect()}
    assert len(rows) == 5 and s2.filter("is_current").count() == 4
    assert rows[("P1", dt.date(2026, 5, 1))].valid_to == dt.date(2026, 5, 4)
    assert rows[("P2", dt.date(2026, 5, 1))].xg == 1.0          # non-tracked stays stale
    assert rows[("P3", dt.date(2026, 5, 1))].goals is None      # null == -1
    s3 = _load(spark, [("P1", 7.0, None, None, "A", None, None), ("P2", 3.0, None, None, "A", None, 2.0),
                       ("P3", -1.0, None, None, "A", None, None), ("P4", 1.0, None, None, "B", None, None)],
               s2, "2026-05-04")
    assert s3.count() == 5 and s3.filter("is_current").count() == 4
    assert s3.filter("pid = 'P1' AND is_current").first().goals == 7.0
    s4 = _load(spark, [("P2", 3.0, None, None, "A", None, 2.0, "L"),
                       ("P3", -1.0, None, None, "A", None, None, "L"),
                       ("P4", 1.0, None, None, "B", None, None, "L")], s3, "2026-05-08",
               SCHEMA + ", league string")
    cur = {r.pid: r.league for r in s4.filter("is_current").collect()}
    assert cur == {"P1": None, "P2": "L", "P3": "L", "P4": "L"}
    assert s4.filter("NOT is_current AND league IS NOT NULL").count() == 0
    # invariants: one current row per key, no overlapping intervals
    assert s4.groupBy("pid").agg(F.sum(F.col("is_current").cast("int")).alias("c")) \
             .filter("c > 1").count() == 0


def _brute(left_names, right_rows, t=85):
    out = {}
    for ln in left_names:
        best = None
        for order, rn in right_rows:
            s = token_sort_ratio_py(ln, rn)
            if 200 * round(s * (len(" ".join(sorted(ln.split()))) + len(" ".join(sorted(rn.split())))) / 200) >= 0 and s >= t - 1e-9:
                if best is None or s > best[0] + 1e-12 or (abs(s - best[0]) <= 1e-12 and order < best[1]):
                    best = (s, order, rn)
        if best:
            out[ln] = best
    return out


def test_fuzzy_matches_brute_force(spark):
    rng = random.Random(7)
    words = ["kane", "harry", "son", "heung", "min", "bruno", "fernandes", "rodri", "lamine", "yamal",
             "alisson", "becker", "erling", "haaland", "vinicius", "junior"]
    right = [(i, " ".join(rng.sample(words, rng.randint(1, 3)))) for i in range(120)]

    def perturb(s):
        s = list(s)
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(s))
            s[i] = rng.choice("abcdefghijklmnopqrstuvwxyz ")
        return "".join(s).strip()
    left = sorted({perturb(r) for _, r in right[:80]} - {""})
    ldf = spark.createDataFrame([(n,) for n in left], "name string")
    rdf = spark.createDataFrame(right, "ord long, rname string")
    got = {r.name: (r.score, r.ord) for r in
           fuzzy_best_match(ldf, "name", rdf, "rname", "ord", ["ord"], 85).collect()}
    want = _brute(left, right)
    assert set(got) == set(want)
    for k, (s, o, _) in want.items():
        assert got[k][0] == pytest.approx(s) and got[k][1] == o


def test_dense_key(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("v"))
    keys = [r.k for r in dense_key(df, ["v"], "k").orderBy("v").collect()]
    assert keys == list(range(1, 501))


def test_contract_negative(spark):
    df = spark.createDataFrame([("1", None, "x")], "id string, name string, amount string")
    rules = [contract.Rule("id", "string", nullable=False), contract.Rule("name", "string", nullable=False),
             contract.Rule("amount", "double", coerce=True), contract.Rule("gone", "string")]
    rep = {(r.column, r.check): r.failures for r in contract.contract_report(df, rules).collect()}
    assert rep[("name", "not_null")] == 1 and rep[("amount", "coercible")] == 1
    assert rep[("gone", "missing")] == 1 and rep[("id", "not_null")] == 0
    with pytest.raises(contract.ContractError):
        contract.validate(df, rules)


def test_html_golden(spark):
    page = ('<table class="items"><tbody><tr class="odd"><td class="hauptlink">'
            '<a href="/a-b/profil/spieler/418560">A B</a></td><td class="rechts hauptlink">€1.00m'
            '</td></tr><tr class="even"><td>no link</td></tr></tbody></table>')
    rows = extract_rows(spark.createDataFrame([(1, page)], "id long, html string"), "html", ["id"]).collect()
    assert [(r.name, r.item_id, r.value, r.href) for r in rows] == \
        [("A B", "418560", "€1.00m", "/a-b/profil/spieler/418560")]


def test_leaderboard_and_quadrants(spark):
    df = spark.createDataFrame(
        [("A", "a", 10.0, 3.0, 1.0, 50.0, 5e6), ("B", "b", 10.0, 1.0, 1.0, 60.0, 50e6),
         ("C", "c", 12.0, 5.0, 1.0, 70.0, 5e6), ("D", "d", None, 0.0, 1.0, 80.0, 50e6)],
        "internal_player_id string, player_name string, goals double, penalty_goals double, "
        "assists double, scout_score double, market_value double").withColumns(
        {"position": F.lit("x"), "team": F.lit("t"), "league": F.lit("l")})
    order = [r.player_name for r in analytics.leaderboard(df, "goals").orderBy("rank").collect()]
    assert order == ["c", "b", "a", "d"]
    pts = spark.createDataFrame([("u", 5e6, 80.0), ("w", 50e6, 90.0), ("r", 5e6, 30.0),
                                 ("o", 50e6, 30.0)], "player_name string, market_value double, "
                                                     "scout_score double")
    labels = {r.player_name: r.quadrant for r in analytics.quadrants(pts).collect()}
    # means here are (27.5, 57.5): same sides as the (20, 60) example
    assert labels == {"u": "Underrated", "w": "World Class", "r": "Rotation / Normal", "o": "Overrated"}
