"""Documents: embedding, retrieval, and headline signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import Scorer, sentiment
from tidemill.functions.vectors import Embedder, cosine_similarity, cosine_to, text_embedding
from tidemill.operators import top_k


def document_embeddings(documents: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Documents whose embedding succeeded."""
    return _embedded(documents, embedder).filter(F.col("embedding").isNotNull())


def failed_embeddings(documents: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Documents whose embedding failed."""
    return _embedded(documents, embedder).filter(F.col("embedding").isNull()).select("file_name", "embedding")


def _embedded(documents: DataFrame, embedder: Embedder | None) -> DataFrame:
    return documents.select("file_name", "content", text_embedding("content", embedder).alias("embedding"))


def nearest(vectors: DataFrame, question: Column | Sequence[float], id_column: str = "file_name",
            vector_column: str = "embedding", k: int = 10) -> DataFrame:
    """The ``k`` rows closest to a question vector (a column such as a scalar subquery, or numbers)."""
    if isinstance(question, Column):
        scored = vectors.withColumn("_q", question).select(
            id_column, cosine_similarity(vector_column, "_q").alias("similarity"))
    else:
        scored = vectors.select(id_column, cosine_to(question)(F.col(vector_column)).alias("similarity"))
    return top_k(scored, [F.col("similarity").desc_nulls_last(), F.asc(id_column)], k)


SIGNAL_MARGIN = 0.05  # fixed value: scores within +-this are neutral


def headline_signals(news: DataFrame, scorer: Scorer | Mapping[str, float]) -> DataFrame:
    """Score per headline and BUY, SELL or HOLD; a headline is scored once."""
    score = F.col("sentiment_score")
    return news.withColumn("sentiment_score", sentiment("headline", scorer)).withColumn(
        "signal", F.when(score > SIGNAL_MARGIN, "BUY").when(score < -SIGNAL_MARGIN, "SELL").otherwise("HOLD"))
