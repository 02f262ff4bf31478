"""Fixed values that code and oracles share are pinned here, so a slip in them shows."""

import hashlib
import json

from pitchforge.functions import positions as P
from pitchforge.functions import scalars as S
from pitchforge.plans import rating
from pitchforge.plans.silver_contract import MERGED_CONTRACT


def digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def test_scoring_matrix():
    config = rating.POSITION_CONFIG
    # position names of forwards lead to ST, though the matrix has a row for CF as well
    assert {g for g, _ in P.SCORING_GROUPS} == set(config) - {"CF"} and P.DEFAULT_SCORING_GROUP in config
    for group, cfg in config.items():
        assert abs(sum(cfg["weights"].values()) - 1.0) < 1e-9, group
    assert digest({g: {k: dict(c[k]) for k in ("weights", "penalties")} for g, c in config.items()}) == PINNED["config"]


def test_lookup_lists():
    got = {"groups": digest([[g, sorted(n)] for g, n in P.SCORING_GROUPS]),
           "comparison": digest([[g, sorted(n)] for g, n in P.COMPARISON_GROUPS]),
           "abbr": digest(P.POSITION_ABBR), "country": digest(P.LEAGUE_COUNTRY), "metrics": digest(P.GROUP_METRICS),
           "contract": digest([[r.column, r.dtype, r.nullable, r.coerce] for r in MERGED_CONTRACT])}
    assert got == {k: PINNED[k] for k in got}


def test_contract_shape():
    assert len(MERGED_CONTRACT) == 46 and {r.column for r in MERGED_CONTRACT if not r.nullable} == {
        "id_sfs", "name_sfs_raw", "name_sfs_norm", "updated_at_sfs"}


PINNED = {
    "config": "b3ef434154a411a0",
    "groups": "958babaacdb51e49",
    "comparison": "266e1dc6c1fd42a1",
    "abbr": "4956bc61403219d1",
    "country": "dc55f6740958dd14",
    "metrics": "fdff4eddc72cea90",
    "contract": "6eb015a979322862",
}
