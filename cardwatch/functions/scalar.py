"""Scalar column functions. All are built-in Spark expressions (whole-stage codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# For a column given by name, each function is one SQL expression (one planner call); for a
# Column it composes the same expression from Column methods.

def money_to_double(c: ColumnOrName) -> Column:
    """``$1,234.50`` -> 1234.5; empty or malformed text -> NULL (never an error under ANSI)."""
    if isinstance(c, str):
        return F.expr(f"try_cast(regexp_replace({_q(c)}, '[$,]', '') AS DOUBLE)")
    return _try_double(F.regexp_replace(c, r"[$,]", ""))


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


def label_to_int(c: ColumnOrName = "label") -> Column:
    """'Yes' -> 1, anything else (including NULL) -> 0."""
    if isinstance(c, str):
        return F.expr(f"CASE WHEN {_q(c)} = 'Yes' THEN 1 ELSE 0 END")
    return F.when(c == "Yes", F.lit(1)).otherwise(F.lit(0))


def date_text(c: ColumnOrName) -> Column:
    """Date -> ``yyyy-MM-dd``."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def missing_text_to_null(c: ColumnOrName) -> Column:
    """Text that a float round trip turned into ``nan``/``NaN`` (or empty) becomes NULL."""
    if isinstance(c, str):
        return F.expr(f"CASE WHEN lower(trim({_q(c)})) IN ('nan', '') THEN CAST(NULL AS STRING) ELSE {_q(c)} END")
    return F.when(F.lower(F.trim(c)).isin("nan", ""), F.lit(None).cast("string")).otherwise(c)


def id_from_text(c: ColumnOrName) -> Column:
    """Numeric text -> bigint (fraction truncated); other text, NaN and what no bigint holds -> NULL.

    Whole numbers are never read as a double, so ids beyond 2^53 stay apart."""
    c = _col(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("decimal(38,10)").try_cast("bigint"))


def zip_text(c: ColumnOrName) -> Column:
    """Postal code as text: ``58523.0`` (a number's form) -> ``58523``; missing text -> NULL."""
    return F.regexp_replace(missing_text_to_null(c), r"\.0+$", "")


def vector_element(c: ColumnOrName, i: int, default: float = 0.0) -> Column:
    """Element ``i`` of an ML vector column, ``default`` when missing (no Python UDF)."""
    from pyspark.ml.functions import vector_to_array

    return F.coalesce(F.try_element_at(vector_to_array(_col(c)), F.lit(i + 1)), F.lit(default))


def class_text(pred: ColumnOrName) -> Column:
    """Predicted class code -> display text."""
    # The response texts of the scoring service.
    return F.when(_col(pred) == 1.0, F.lit("FRAUDE")).otherwise(F.lit("TRANSACTION NORMALE"))
