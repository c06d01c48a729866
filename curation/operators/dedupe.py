"""A1: one row per key, best score first, earliest arrival on ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_best(df: DataFrame, key: str | list[str] = "canonical_url", score: str = "quality_score",
                ordinal: str = "ordinal") -> DataFrame:
    """Keep the highest ``score`` per key; a later row wins only when it is
    strictly better, so ties keep the first arrival (smallest ``ordinal``).

    ``row_number() = 1`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key is cut to one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(ordinal).asc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
