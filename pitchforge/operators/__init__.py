"""Generic relational operators: every function takes DataFrames plus column
names and returns a lazy DataFrame."""

from pitchforge.operators import (  # noqa: F401
    aggregates, columns, contract, dedupe, fuzzy, joins, scaling, scd2, setops)
