"""Output normalisation at the query boundary.

Registered queries return engine-neutral types so a result can be compared
with another engine's value for value: integers as BIGINT, decimals as DOUBLE
(converted once, after all exact arithmetic), dates and timestamps as ISO
text.  A single ``select`` of casts: no extra stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType | T.FloatType):
            c = c.cast("double")
        elif isinstance(t, T.ByteType | T.ShortType | T.IntegerType):
            c = c.cast("long")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.TimestampType | T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)
