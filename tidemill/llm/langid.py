"""Language identification with bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import map_batches, with_id

UNDETERMINED = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multipliers that spread the bits
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_PIECE = 200_000  # characters hashed at a time


class LanguageModel(NamedTuple):
    """``slices[row]`` has bit l % 64 of word l // 64 set if language l set that row; an n-gram is in the AND of its ``hashes`` rows."""

    languages: tuple[str, ...]
    slices: np.ndarray  # uint64, one row per position of the filter, a word per 64 languages
    hashes: int
    orders: tuple[int, ...]
    false_rate: np.ndarray  # per language: chance that an absent n-gram passes


def _lettered(text: str) -> np.ndarray:
    """Lower-cased code points, 32 for all but letters."""
    low = text.lower()
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if low.isascii():
        letter = (points >= 97) & (points <= 122)
    else:
        odd = np.unique(points)
        is_letter = np.fromiter((chr(c).isalpha() for c in odd.tolist()), dtype=bool, count=len(odd))
        letter = is_letter[np.searchsorted(odd, points)]
    return np.where(letter, points, 32).astype(np.uint32)


def ngram_hashes(line: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash of each n-gram of a folded line."""
    if len(line) < order:
        return np.zeros(0, dtype=np.uint64)
    wide = line.astype(np.uint64)
    n = len(wide) - order + 1
    h = np.full(n, order, dtype=np.uint64)
    for i in range(order):
        h = (h ^ wide[i:i + n]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def gram_hashes(text: str, orders: tuple[int, ...], piece: int = _PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """(order, hashes of its n-grams), piece by piece of the text.

    Every run of other than letters is one space, with a space at both ends.
    The last points of a piece go before the next, so a cut neither loses nor
    makes up an n-gram.
    """
    carry, old, reach = np.full(1, 32, dtype=np.uint32), 0, max(*orders, 2) - 1
    for at in range(0, len(text), piece):
        end = np.full(int(at + piece >= len(text)), 32, dtype=np.uint32)
        joint = np.concatenate((carry, _lettered(text[at:at + piece]), end))
        keep = joint != 32
        keep[1:] |= joint[:-1] != 32
        keep[0] = True
        line = joint[keep]
        for n in orders:
            yield n, ngram_hashes(line[max(0, old - (n - 1)):], n)
        carry = line[-reach:]
        old = len(carry)


def _rows(h: np.ndarray, hashes: int, size: int) -> list[np.ndarray]:
    step = (h * _MIX2) | np.uint64(1)
    mask = np.uint64(size - 1)
    return [((h >> np.uint64(20)) + np.uint64(i) * (step >> np.uint64(17))) & mask for i in range(hashes)]


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, orders: tuple[int, ...] = (2, 3),
        per_language: int = 1500, min_rate: float = 2e-5, filter_rate: float = 0.01, hashes: int = 3) -> LanguageModel:
    """Learn which n-grams belong to each language.

    At most ``per_language`` documents of each language are read, chosen by the
    hash of id and text; within them whole texts count.  An n-gram belongs to a
    language if it makes up ``min_rate`` of that language's n-grams of its
    order, so a language has at most len(orders) / min_rate of them: that bounds
    the filter, whatever the corpus.  Any number of languages, a word of each
    row for every 64; the model grows with them.  Rows with a null
    text or language teach nothing; with no row left the model knows no
    language and answers ``und``.
    """
    from pyspark.sql import Window

    named = labelled.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"),
                            F.col(f"`{lang_col}`").alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}  # a row per class of the model
    # Ranked without the texts.  The smallest hashes of a language lie below a bound that its row count gives, so
    # about twice per_language rows of it reach the ranking, however large it is.
    span = 1 << 40
    place = F.pmod(F.xxhash64("id", "text_hash"), F.lit(span))
    bounds = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(span, span * 2 * per_language // n)))]
    chosen = named.select("id", "lang", F.xxhash64("text").alias("text_hash")).withColumn("place", place)
    if bounds:
        chosen = chosen.where(F.col("place") < F.element_at(F.create_map(*bounds), F.col("lang")))
    chosen = (chosen.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "id", "text_hash")))
              .where(F.col("rank") <= per_language).select("id", "lang", "text_hash").distinct())
    # At most per_language ids for each class, so the broadcast is bounded and texts stay where they are.
    sample = (named.withColumn("text_hash", F.xxhash64("text"))
              .join(F.broadcast(chosen), ["id", "lang", "text_hash"], "left_semi").select("lang", "text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        got: dict[tuple[str, int], Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for n, hashed in gram_hashes(text, orders):
                grams, times = np.unique(hashed, return_counts=True)
                got.setdefault((lang, n), Counter()).update(dict(zip(grams.tolist(), times.tolist())))
        langs, ns, grams, times = [], [], [], []
        for (lang, n), c in got.items():
            langs += [lang] * len(c)
            ns += [n] * len(c)
            grams += c.keys()
            times += c.values()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(ns, pa.int32()),
             pa.array(np.array(grams, dtype=np.uint64).view(np.int64)), pa.array(times, pa.int64())],
            ["lang", "n", "gram", "times"])

    counts = map_batches(sample, count, "lang string, n int, gram long, times long")
    counts = counts.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    totals = counts.groupBy("lang", "n").agg(F.sum("times").alias("total"))
    kept = counts.join(totals, ["lang", "n"]).where(F.col("times") >= F.col("total") * min_rate)
    rows = kept.select("lang", "gram").toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    most = int(rows.groupby("lang").size().max()) if len(rows) else 1
    size = 1 << max(10, math.ceil(math.log2(most * hashes / -math.log(1 - filter_rate ** (1 / hashes)))))
    slices = np.zeros((size, -(-len(languages) // 64)), dtype=np.uint64)
    grams = {lang: own.to_numpy(dtype=np.int64).view(np.uint64) for lang, own in rows.groupby("lang")["gram"]}
    for bit, lang in enumerate(languages):
        for at in _rows(grams[lang], hashes, size):
            slices[at, bit // 64] |= np.uint64(1 << bit % 64)
    fill = np.array([np.mean((slices[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)) for b in range(len(languages))])
    return LanguageModel(languages, slices, hashes, orders, fill ** hashes)


def predict_text(model: LanguageModel, text: str | None) -> tuple[str, float]:
    """Language and score (0 to 1) of one text.

    The rows of an n-gram, ANDed, name all languages that contain it.  Hits per
    language are counted, freed of the share that false positives add, and the
    language with most wins; ties go to the first in alphabetical order.  The
    score is the winner's part of the n-grams.
    """
    if not text or not model.languages:
        return UNDETERMINED, 0.0
    hits, total = np.zeros(len(model.languages)), 0
    for _, h in gram_hashes(text, model.orders):
        first, *rest = _rows(h, model.hashes, len(model.slices))
        langs = model.slices[first]
        for rows in rest:
            langs &= model.slices[rows]
        total += len(h)
        for bit in range(len(hits)):
            hits[bit] += np.count_nonzero(langs[:, bit // 64] & np.uint64(1 << bit % 64))
    if not total:
        return UNDETERMINED, 0.0
    share = np.clip((hits / total - model.false_rate) / (1 - model.false_rate), 0, 1)
    best = int(np.argmax(share))
    return model.languages[best], float(share[best])


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row: one pass over whole texts, no shuffle.

    The model, of bounded size, goes to the workers as a broadcast.  Null texts
    and texts without letters are ``und`` with score 0.
    """
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model._asdict())

    def run(batch: pa.RecordBatch, known: LanguageModel) -> pa.RecordBatch:
        found = [predict_text(known, t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x[0] for x in found], pa.string()),
             pa.array([x[1] for x in found], pa.float64())], ["id", "lang_pred", "score"])

    return map_batches(named, run, with_id(named, "lang_pred string, score double"), lambda: LanguageModel(**shared.value))
