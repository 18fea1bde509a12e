"""The domains that the given `labels` table tells apart, and the mixture wanted of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shares of the tokens after mixing. There shall be a quarter more tokens than before, so that
# good and poor documents are repeated rather than left out to make up for the toxic ones.
TARGETS = {"good": 0.88, "poor": 0.12, "toxic": 0.0}
BUDGET_RATIO = 1.25


def domains(labels: DataFrame) -> DataFrame:
    """doc_id, domain: toxic whatever the quality, else by quality. A row in which what
    decides is null has no domain and is left out."""
    domain = (
        F.when(F.col("toxic") == 1, "toxic")
        .when((F.col("toxic") == 0) & (F.col("quality") == 1), "good")
        .when((F.col("toxic") == 0) & (F.col("quality") == 0), "poor")
    )
    return labels.select("doc_id", domain.alias("domain")).filter(F.col("domain").isNotNull())
