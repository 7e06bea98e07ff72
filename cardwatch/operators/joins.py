"""Fact-to-dimension left joins that stay balanced when one key, or NULL, holds a third of the fact.

The planner and AQE choose broadcast or sort-merge from measured bytes; nothing is forced. For a
sort-merge join AQE splits an oversized fact partition over several tasks and gives each the
matching dimension partition (``spark.sql.adaptive.skewJoin.enabled``, on by default), so there is
no list of hot keys, no salt and no limit on either. It can only do so if both sides arrive by a
shuffle made for this join. A dimension that was de-duplicated by its key would already be
partitioned by that key, and no such shuffle would be planned; ``unique_by_key`` therefore
groups by the key and a hash of it, which the join cannot reuse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.dedupe import first_per_key

_HASH = "__key_hash"


def unique_by_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per key (the smallest); rows without a key are left out, as no fact row can match them."""
    keyed = dim.where(F.col(key).isNotNull()).withColumn(_HASH, F.xxhash64(key))
    return first_per_key(keyed, [_HASH, key]).drop(_HASH)


def dimension_join(fact: DataFrame, dim: DataFrame, key: str, strategy: str | None = None) -> DataFrame:
    """Left join on ``key``. ``strategy`` ("merge") asks for a join form; the rows are the same."""
    return fact.join(dim.hint(strategy) if strategy else dim, key, "left")
