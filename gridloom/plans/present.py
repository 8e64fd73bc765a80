"""Final shaping of query results for comparison with an SQL oracle.

Integral columns become bigint, fractional ones double rounded to a fixed number
of places (sums taken in a different order differ in the last bits), dates and
timestamps fixed-format strings.  Only applied at the very end of a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.TimestampNTZType):
            c = F.substring(c.cast("string"), 1, 19)  # wall clock, no session time zone involved
        elif isinstance(t, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def map_text(m: F.Column) -> F.Column:
    """A map as ``key=value`` pairs in key order, comma-joined."""
    return F.array_join(F.array_sort(F.transform(
        F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ",")
