"""Array helpers for flat stores and co-occurrence work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_array(c, sep: str = ",") -> Column:
    """``array<string>`` to a ``sep``-joined string; NULL array gives ``''``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat_ws(sep, col)


def split_list(c, sep: str = ",") -> Column:
    """A ``sep``-joined string back to an array (``''`` gives ``['']``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.split(col, sep)


def flatten_for_sink(df: DataFrame, sep: str = ",") -> DataFrame:
    """Join every ``array<string>`` column (found from the schema) for a flat store."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(join_array(F.col(f.name).cast("array<string>"), sep).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
