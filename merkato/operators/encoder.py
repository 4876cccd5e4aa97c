"""Market embeddings: principal components of the markets' sequences."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.operators.clustering import principal_axes

# Fixed value: numbers in an embedding.
EMBEDDING = 32

def principal_embedding(sequences: DataFrame, size: int = EMBEDDING) -> DataFrame:
    """``(market, embedding)`` by PCA of the flattened sequence: the best linear autoencoder."""
    flat = sequences.select("market", F.flatten("sequence").alias("flat"))
    rows, width = flat.agg(F.count("*"), F.max(F.size("flat"))).first()
    model, centred = principal_axes(flat, "flat", max(1, min(size, rows - 1, width)))
    return model.transform(centred).select("market", vector_to_array("_pc").cast("array<float>").alias("embedding"))
