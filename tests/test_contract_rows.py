"""Failing values of a contract, row by row."""

import pytest

from pitchforge.operators import contract
from pitchforge.operators.contract import Rule


def test_failing_rows_and_bounded_error(spark):
    rows = [(i, None if i % 3 == 0 else f"n{i}", "x" if i % 10 == 0 else str(i), 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, name string, goals string, `a.b` double")
    rules = [Rule("name", "string", nullable=False), Rule("goals", "double", coerce=True), Rule("a.b", "double", nullable=False),
             Rule("gone", "string", nullable=False)]
    got = sorted(tuple(map(str, r)) for r in contract.failing_rows(df, rules, "id").collect())
    want = [(str(i), "name", "not_null", "None") for i in range(0, 100, 3)] + [(str(i), "goals", "coercible", "x") for i in range(0, 100, 10)]
    assert got == sorted(want)
    with pytest.raises(contract.ContractError) as e:
        contract.validate(df, rules, key="id", shown=5)
    assert e.value.rows == [(0, "goals", "coercible", "x"), (0, "name", "not_null", None), (3, "name", "not_null", None),
                            (6, "name", "not_null", None), (9, "name", "not_null", None)]
    assert {r[:2] for r in e.value.report_rows} == {("gone", "missing"), ("name", "not_null"), ("goals", "coercible")}
    contract.validate(df, rules[2:3], key="id")
    assert contract.failing_rows(df, rules[3:], "id").collect() == []
