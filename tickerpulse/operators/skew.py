"""NULL keys: keep their rows away from a single reducer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_skip_nulls(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``big.join(small, keys, "left")`` where rows of ``big`` with a NULL
    key bypass the shuffle (they cannot match, and would otherwise all hash
    to one reducer); they get NULLs for ``small``'s columns."""
    has_keys = F.lit(True)
    for k in keys:
        has_keys = has_keys & F.col(k).isNotNull()
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema.fields if f.name not in keys]
    nulls = big.where(~has_keys).select(*big.columns, *extra)
    return big.where(has_keys).join(small, keys, "left").unionByName(nulls)
