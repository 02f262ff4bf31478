"""Driver contract: entry smoke, and a sample of queries against their DuckDB
oracle at sf0.001 (the full set runs via tools/check_oracles.py)."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SAMPLE = ["rating", "latest_join_topn", "scd2_same_day", "text_norm", "dedupe_keep_last",
          "html_rows", "contract_report", "minmax_group", "csv_all_string_parse"]


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT:
        return None
    if hasattr(v, "date") and hasattr(v, "hour") and (v.hour, v.minute, v.second) == (0, 0, 0) \
            and getattr(v, "microsecond", 0) == 0:
        return v.date()
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "final_scout_score" in df.columns


def test_every_query_has_name_matching_oracle():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sp = E.queries()[name](spark, SF).toPandas()
    dd = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    cols = sorted(sp.columns)
    a = sorted(tuple(map(str, map(_canon, r))) for r in sp[cols].astype(object).itertuples(index=False))
    b = sorted(tuple(map(str, map(_canon, r))) for r in dd[cols].astype(object).itertuples(index=False))
    assert a == b
