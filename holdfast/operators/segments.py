"""Customer segments by k-means on standardised columns."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, number
from holdfast.operators.scale import StandardScaler


def cluster_rows(df: DataFrame, columns: list[str], k: int = 3, seed: int = settings.SEED,
                 name: str = "cluster") -> DataFrame:
    """The complete rows with the number of their cluster."""
    complete = df.dropna(subset=columns)
    renamed = complete.withColumns({f"_z{i}": number(complete, c) for i, c in enumerate(columns)})
    scaled_names = [f"_z{i}" for i in range(len(columns))]
    scaled = StandardScaler(scaled_names).fit_transform(renamed)
    ready = VectorAssembler(inputCols=scaled_names, outputCol="_features").transform(scaled).persist()
    try:
        model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol=name).fit(ready)
    finally:
        ready.unpersist()
    assembled = VectorAssembler(inputCols=scaled_names, outputCol="_features").transform(scaled)
    return model.transform(assembled).select(*[column(c) for c in df.columns], F.col(name))
