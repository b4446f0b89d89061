"""Text scoring: a word lexicon in JVM expressions, or any scorer in batches."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalar import ColumnLike, as_col

#: A scorer takes a list of texts and returns as many scores: a hosted model gets one call per batch.
Scorer = Callable[[Sequence[str]], Sequence[float]]
_WORD = re.compile(r"[^\W_]+")


def words(text: ColumnLike) -> Column:
    """Lower-case words (letters and digits) of a text, in JVM expressions."""
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def lexicon_score(text: ColumnLike, lexicon: Mapping[str, float], spread: float = 15.0) -> Column:
    """Sum of word weights squeezed into [-1, 1] by ``s / sqrt(s^2 + spread)``; 0 for a NULL text."""
    weights = F.create_map(*[F.lit(x) for word, weight in lexicon.items() for x in (word, float(weight))])
    total = F.aggregate(words(text), F.lit(0.0), lambda s, w: s + F.coalesce(F.try_element_at(weights, w), F.lit(0.0)))
    total = F.coalesce(total, F.lit(0.0))
    return F.when(total == 0, F.lit(0.0)).otherwise(total / F.sqrt(total * total + F.lit(spread)))


def lexicon_scorer(lexicon: Mapping[str, float], spread: float = 15.0) -> Scorer:
    """The same score as a batch scorer, for plans that take one."""
    weights = dict(lexicon)

    def score(text: str) -> float:
        total = sum(weights.get(word, 0.0) for word in _WORD.findall(text.lower()))
        return total / math.sqrt(total * total + spread) if total else 0.0

    return lambda texts: [score(t) for t in texts]


def sentiment(text: ColumnLike, scorer: Scorer | Mapping[str, float]) -> Column:
    """Score per text in [-1, 1]; a NULL text scores 0.

    A lexicon (word to weight) is scored in JVM expressions.  A scorer is called
    once per Arrow batch with the texts that are not NULL.
    """
    if isinstance(scorer, Mapping):
        return lexicon_score(text, scorer)

    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        known = texts.notna()
        out = pd.Series(0.0, index=texts.index)
        if known.any():
            out[known] = [float(s) for s in scorer(texts[known].tolist())]
        return out

    # Non-deterministic, so that a plan that reads the score twice computes it once.
    return run.asNondeterministic()(as_col(text))
