"""Bank dataflows as PySpark DataFrame functions.

Every operator takes DataFrames (and an explicit ``as_of`` where a clock is needed) and returns a DataFrame, so that
Catalyst sees one declarative plan per output table.
"""

__version__ = "0.1.0"
