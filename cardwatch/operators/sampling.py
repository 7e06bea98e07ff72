"""Reproducible sampling, class balancing, weights and splits.

``sample``/``randomSplit`` depend on the partitioning (same seed, different rows after a
repartition), so every draw here is a pure function of the row id: the first 8 hex digits of
``md5(salt || id)`` compared with ``fraction * 2^32``. Different salts keep the draws
independent (a split must not correlate with the sample it splits). All of it is row-local:
no shuffle, and identical in SQL engines that have ``md5``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.selection import hash_key, hash_order, smallest_k
from cardwatch.schemas import KEY_FEATURES

SALT_BALANCE = "s1:"
SALT_SAMPLE = "s2:"
SALT_LARGE = "s3:"
SALT_SPLIT = ""
LARGE_INPUT_ROWS = 50_000


def fraction_hex(fraction: float) -> str:
    """Threshold so that ``substr(md5(..),1,8) < hex`` keeps ``fraction`` of uniform hashes."""
    return format(min(2**32, math.ceil(fraction * 2**32)), "08x")


def hash_below(fraction: float, salt: str, id_col: str = "id") -> Column:
    h = F.substring(F.md5(F.concat(F.lit(salt), F.col(id_col).cast("string"))), 1, 8)
    return F.lit(True) if fraction >= 1 else h < F.lit(fraction_hex(fraction))


def complete_rows(df: DataFrame, subset=tuple(KEY_FEATURES)) -> DataFrame:
    """Training rows: no NULL in the key features."""
    return df.dropna(subset=list(subset))


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """One pass: negatives, positives and the minority size."""
    n0 = F.count_if(F.col(label_col) == 0)
    n1 = F.count_if(F.col(label_col) == 1)
    return df.agg(n0.alias("count_0"), n1.alias("count_1"), F.least(n0, n1).alias("minority"))


def class_weights(df: DataFrame, label_col: str = "label", weight_col: str = "class_weight") -> DataFrame:
    """weight = label * (n0 / n1) + (1 - label); the ratio is a scalar subquery (one value)."""
    c = class_counts(df, label_col)
    ratio = c.select(F.try_divide(F.col("count_0").cast("double"), F.col("count_1"))).scalar()
    lab = F.col(label_col).cast("double")
    return df.withColumn(weight_col, lab * ratio + (F.lit(1.0) - lab))


def undersample(df: DataFrame, label_col: str = "label", id_col: str = "id", salt: str = SALT_BALANCE, **limits) -> DataFrame:
    """Exactly ``minority`` rows of the classes 0 and 1: those first in ``md5(salt || id)`` order.

    Rows with another label, or none, belong to neither class and are left out. ``limits``: see ``smallest_k``."""
    keyed = df.withColumn("__hk", hash_key(F.col(id_col), salt))
    picked = smallest_k(
        keyed, "__hk", [hash_order(F.col(id_col), salt), F.col(id_col)],
        k_of=lambda counts: {g: min(counts.get(0, 0), counts.get(1, 0)) if g in (0, 1) else 0 for g in counts},
        group_col=label_col, **limits,
    )
    return picked.drop("__hk")


def sample_fraction(df: DataFrame, fraction: float, salt: str = SALT_SAMPLE, id_col: str = "id") -> DataFrame:
    return df.where(hash_below(fraction, salt, id_col))


def sample_if_large(df: DataFrame, fraction: float = 0.3, threshold: int = LARGE_INPUT_ROWS,
                    salt: str = SALT_LARGE, id_col: str = "id") -> DataFrame:
    """Sample only when the input has more than ``threshold`` rows (count as a scalar subquery)."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return df.where((n <= F.lit(threshold)) | hash_below(fraction, salt, id_col))


def split(df: DataFrame, train_fraction: float = 0.8, salt: str = SALT_SPLIT, id_col: str = "id"
          ) -> tuple[DataFrame, DataFrame]:
    inside = hash_below(train_fraction, salt, id_col)
    return df.where(inside), df.where(~inside)
