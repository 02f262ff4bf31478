"""pitchforge: scouting-analytics table operators on Spark.

Every operator takes DataFrames plus table/column names and returns a lazy
DataFrame.  Sub-packages:

* ``sources``   – scans, landing zones, nested documents, CSV, HTML, sinks
* ``functions`` – Column-expression builders and the two Arrow UDFs
* ``operators`` – generic relational building blocks (dedupe, joins, scaling,
  fuzzy matching, contract, SCD2, set operations)
* ``plans``     – composites: rating, star schema, analytics, resolution
"""

from pitchforge.session import get_session, scratch_path  # noqa: F401

__all__ = ["get_session", "scratch_path"]
