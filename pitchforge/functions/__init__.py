"""Column-expression builders (JVM side) and the Arrow UDFs for text."""

from pitchforge.functions import positions, scalars, text  # noqa: F401
