"""Vector columns (``array<float>``): similarity and text embedding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalar import ColumnLike, as_col
from tidemill.functions.text import words

#: An embedder takes a list of texts and returns as many vectors, None where it has none.
Embedder = Callable[[Sequence[str]], Sequence[Sequence[float] | None]]
_WORD = re.compile(r"[^\W_]+")


def cosine_similarity(a: ColumnLike, b: ColumnLike) -> Column:
    """Cosine of two vector columns in JVM expressions; NULL for a zero vector."""
    a, b = (F.transform(as_col(v), lambda x: x.cast("double")) for v in (a, b))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    dot = total(F.zip_with(a, b, lambda x, y: x * y))
    squares = total(F.transform(a, lambda x: x * x)) * total(F.transform(b, lambda x: x * x))
    return F.try_divide(dot, F.sqrt(squares))


def cosine_to(question: Sequence[float]):
    """Arrow-batched cosine against one fixed vector: a matrix product per batch."""
    q = np.asarray(question, dtype="float64")
    q_norm = float(np.sqrt(q @ q))

    @F.pandas_udf(T.DoubleType())
    def similarity(vectors: pd.Series) -> pd.Series:
        known = vectors.notna().to_numpy()
        out = np.full(len(vectors), np.nan)
        if known.any() and q_norm > 0:
            m = np.vstack(vectors[known].to_numpy()).astype("float64")
            norms = np.sqrt((m * m).sum(axis=1)) * q_norm
            out[known] = np.divide(m @ q, norms, out=np.full(len(m), np.nan), where=norms > 0)
        return pd.Series(out, index=vectors.index).astype(object).where(~np.isnan(out), None)

    return similarity


def hashed_words(text: ColumnLike, dimensions: int = 32) -> Column:
    """Offline default embedding in JVM expressions: counts of words hashed into cells; NULL without words."""
    found = words(text)
    cells = F.transform(found, lambda w: (F.conv(F.substring(F.md5(w.cast("binary")), 1, 7), 16, 10).cast("int") % dimensions))
    # The cells are bound as the one element of an array, so that they are hashed once and not once per dimension.
    counts = F.transform(F.array(cells), lambda bound: F.transform(
        F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda c: F.size(F.filter(bound, lambda x: x == c)).cast("float")))[0]
    return F.when(F.exists(counts, lambda n: n > 0), counts)


def hashing_embedder(dimensions: int = 32) -> Embedder:
    """The same vectors as a batch embedder, for plans that take one."""

    def embed(text: str) -> list[float] | None:
        found = _WORD.findall(text.lower())
        if not found:
            return None
        cells = [0.0] * dimensions
        for word in found:
            cells[int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % dimensions] += 1.0
        return cells

    return lambda texts: [embed(t) for t in texts]


def embed_batch(embedder: Embedder, texts: list[str], attempts: int, errors: tuple[type[Exception], ...]) -> list:
    """Vectors of a list of texts.  A part that fails is halved and tried again; one text gets ``attempts`` tries, then None."""
    for _ in range(attempts if len(texts) == 1 else min(attempts, 1)):
        try:
            found = list(embedder(texts))
        except errors:
            continue
        if len(found) != len(texts):
            raise ValueError(f"the embedder returned {len(found)} vectors for {len(texts)} texts")
        return found
    if len(texts) <= 1 or attempts < 1:
        return [None] * len(texts)
    half = len(texts) // 2
    return [v for part in (texts[:half], texts[half:]) for v in embed_batch(embedder, part, attempts, errors)]


def text_embedding(text: ColumnLike, embedder: Embedder | None = None, attempts: int = 3,
                   errors: tuple[type[Exception], ...] = (Exception,)) -> Column:
    """Embed a text column; NULL for a text that fails ``attempts`` times with one of ``errors``.

    Without an ``embedder`` words are hashed in JVM expressions.  An embedder is
    any picklable function from a list of texts to as many vectors, such as a
    client of a hosted model; it is called once per Arrow batch, and again only
    for the halves of a batch that failed.  The call is marked non-deterministic
    so that the optimizer never repeats it when the column is used more than once.
    """
    if embedder is None:
        return hashed_words(text)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(texts: pd.Series) -> pd.Series:
        known = texts.notna().to_numpy()
        out = np.full(len(texts), None, dtype=object)
        if known.any():
            for at, vector in zip(np.flatnonzero(known), embed_batch(embedder, texts[known].tolist(), attempts, errors)):
                out[at] = vector
        return pd.Series(out, index=texts.index)

    return run.asNondeterministic()(as_col(text))
