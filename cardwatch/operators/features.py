"""Feature stages: category indexing and vector assembly (MLlib does the work, JVM-side)."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.schemas import CATEGORY_FEATURES, FEATURES


def category_indexer(columns=tuple(CATEGORY_FEATURES)) -> StringIndexer:
    """One multi-column indexer: most frequent value -> 0, ties alphabetical, NULL/unseen -> n labels.

    The label itself is never indexed: a frequency-ordered label index flips meaning when fraud
    is the majority, so ``prediction`` stays in label space (1.0 = fraud).
    """
    cols = list(columns)
    return StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols],
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def assembler(null_policy: str = "skip") -> VectorAssembler:
    """Eleven features in a fixed order. ``null_policy``: 'skip' drops rows with a NULL feature,
    'error' fails, 'keep' passes NaN on."""
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid=null_policy)


def index_categories(train: DataFrame, df: DataFrame | None = None) -> DataFrame:
    model = category_indexer().fit(train)
    return model.transform(train if df is None else df)


def features_as_columns(df: DataFrame, vector_col: str = "features") -> DataFrame:
    """Expose the assembled vector as named double columns (checkable outside MLlib)."""
    arr = vector_to_array(F.col(vector_col))
    return df.withColumns({f"f_{name}": arr[i] for i, name in enumerate(FEATURES)})
