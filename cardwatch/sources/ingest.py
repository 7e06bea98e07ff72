"""Raw transaction file -> typed operational snapshot.

One distributed read replaces chunked row-at-a-time loading: ids must parse as numbers (else
the row is dropped) and are truncated to bigint; money text is parsed; missing values that a float
column turned into ``nan`` become NULL; every row is stamped with the snapshot date. Inside one
load the first row in file order (file name, place in the file) wins for each id; between loads the earliest snapshot does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import id_from_text, missing_text_to_null, money_to_double, zip_text
from cardwatch.operators.dedupe import first_of_repeated, first_per_key, insert_if_absent
from cardwatch.schemas import TRANSACTIONS
from cardwatch.sources.positions import is_file_read, with_place

TEXT_COLUMNS = ("client_id", "card_id", "use_chip", "merchant_id", "merchant_city", "merchant_state", "mcc", "errors")
POSITION = "position"


def with_position(lines: DataFrame) -> DataFrame:
    """Number the rows of a file read in file order: by file name, then by the place in the file, whatever splits the scan
    deals out first. Rows that don't come straight from files keep the order of their partitions."""
    return with_place(lines, POSITION) if is_file_read(lines) else lines.withColumn(POSITION, F.monotonically_increasing_id())


def ingest_transactions(raw: DataFrame, snapshot: dt.date) -> DataFrame:
    """Typed rows of one snapshot out of raw text rows (``schemas.TRANSACTIONS_RAW``), one row per id.

    ``position`` orders the rows; without that column the order of the read does."""
    placed = raw if POSITION in raw.columns else with_position(raw)
    typed = placed.withColumns({
        "id": id_from_text("id"),
        "amount": money_to_double("amount_raw"),
        **{c: missing_text_to_null(c) for c in TEXT_COLUMNS if c in raw.columns},
        "zip": zip_text("zip"),
        "date_insertion": F.lit(snapshot),
    }).where(F.col("id").isNotNull())
    typed = typed.select(*[F.col(f.name).cast(f.dataType) for f in TRANSACTIONS.fields], POSITION)
    return first_of_repeated(typed, ["id"], [POSITION]).drop(POSITION)


def dedupe_first_wins(df: DataFrame, keys: Sequence[str] = ("id",),
                      order: Sequence[str | Column] = ("date_insertion",)) -> DataFrame:
    """One row per key: first by ``order`` (map-side combined, safe for hot keys)."""
    return first_per_key(df, keys, order)


def append_new(target: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("id",),
               order: Sequence[str | Column] = ("date_insertion",)) -> DataFrame:
    """Rows to append: first row wins inside ``incoming``, existing keys are left alone."""
    return insert_if_absent(target, incoming, keys, order)
