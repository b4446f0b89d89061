"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import map_batches, with_id
from tidemill.session import stored

_WORD = re.compile(r"[^\W\d_]+")
_START = 4  # letters that begin a longer word
# Byte kinds: 1 a capital letter, 2 a mark, 0 anything else.
_KIND = np.zeros(256, dtype=np.intp)
_KIND[65:91] = 1
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
STYLE = 4  # style features in front of the words


class Link(NamedTuple):
    """One category's model: a weight per chosen feature, one per earlier category, and an offset."""

    category: str
    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    offset: float


class Chain(NamedTuple):
    links: tuple[Link, ...]
    words: dict[int, int]  # word hash -> feature number
    cuts: tuple[float, ...]  # per category: from which probability on it applies


def word_hash(word: str) -> int:
    """Signed 64-bit hash of a word."""
    h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def text_words(text: str | None) -> set[str]:
    """Distinct words of a whole text (runs of letters, lower-cased), and the beginnings of longer ones."""
    if not text:
        return set()
    words = set(_WORD.findall(text.lower()))
    words.update([w[:_START] + "-" for w in words if len(w) > _START])
    return words


def style(text: str | None, words: int) -> list[float]:
    """Length, capitals, marks and variety of a text, each about 0 to 1."""
    if not text:
        return [0.0] * STYLE
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=3)
    n = len(raw)
    return [np.log1p(n) / 15, kinds[1] / n, kinds[2] / n, min(1.0, 6.0 * words / n)]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _chosen(rows: list[np.ndarray], y: np.ndarray, size: int, most: int) -> np.ndarray:
    """Words whose presence goes most with the label, either way (chi-square); style features always."""
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    label = np.repeat(y, [len(r) for r in rows])
    there = np.bincount(flat, minlength=size).astype(float)
    both = np.bincount(flat, weights=label, minlength=size)
    n, pos = len(y), y.sum()
    expect = there * pos / max(n, 1)
    score = (both - expect) ** 2 / np.maximum(expect * (1 - pos / max(n, 1)), 1e-9)
    score[there == 0] = -1
    best = np.argsort(-score[STYLE:], kind="stable")[:most] + STYLE
    return np.concatenate([np.arange(STYLE), best[score[best] > 0]])


def _dense(rows: list[np.ndarray], styles: np.ndarray, chosen: np.ndarray, size: int) -> np.ndarray:
    at = np.full(size, -1)
    at[chosen] = np.arange(len(chosen))
    x = np.zeros((len(rows), len(chosen)))
    for i, r in enumerate(rows):
        k = at[r]
        x[i, k[k >= 0]] = 1.0
    x[:, :STYLE] = styles
    return x


def _newton(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    """Logistic regression with an offset in the last weight, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-5:
            break
    return w


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F-measure on held-out probabilities, precision counting double, in the middle of the gap
    it lies in; 1.0 without positives."""
    if not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order] > 0)
    f = 1.25 * hits / (np.arange(1, len(p) + 1) + 0.25 * (y > 0).sum())
    f[:-1][p[order][1:] == p[order][:-1]] = -1  # no cut between equal values
    at = int(np.argmax(f))
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + below) / 2)


def fit_chain(rows: list[np.ndarray], styles: np.ndarray, labels: np.ndarray, categories: list[str], folds: np.ndarray,
              words: dict[int, int], most_features: int = 300, ridge: float = 0.3) -> tuple[Chain, np.ndarray]:
    """Train a chain; also returns its out-of-fold probabilities (documents x categories).

    Categories come in order.  Each model sees the earlier categories'
    probabilities; in training these are out-of-fold, made by models that have
    not seen the document, as those of new documents will be.
    """
    size = STYLE + len(words)
    held = np.zeros(labels.shape, dtype=float)
    links = []
    for k, category in enumerate(categories):
        y = labels[:, k].astype(float)

        def one(train: np.ndarray) -> Link:
            own = [rows[i] for i in train]
            chosen = _chosen(own, y[train], size, most_features)
            x = np.hstack([_dense(own, styles[train], chosen, size), held[train, :k]])
            w = _newton(x, y[train], ridge)
            return Link(category, chosen, w[:len(chosen)], w[len(chosen):-1], float(w[-1]))

        every = np.arange(len(rows))
        out = np.zeros(len(rows))
        for fold in np.unique(folds):
            train, test = every[folds != fold], every[folds == fold]
            if not len(train):
                train = test
            link = one(train)
            x = np.hstack([_dense([rows[i] for i in test], styles[test], link.features, size), held[test, :k]])
            out[test] = sigmoid(x @ np.concatenate([link.weights, link.earlier]) + link.offset)
        links.append(one(every))
        held[:, k] = out
    return Chain(tuple(links), words, tuple(best_cut(held[:, k], labels[:, k]) for k in range(len(categories)))), held


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, object], id_col: str = "doc_id",
          text_col: str = "text", label_id: str = "doc_id", most_rows: int = 6000, min_share: float = 0.001,
          folds: int = 5) -> Chain:
    """Fit a chain on at most ``most_rows`` labelled documents, those of smallest id hash.

    ``categories`` maps names, in chain order, to conditions on ``labels``.
    A word is a feature if at least ``min_share`` of the sample (and five
    documents) hold it, which bounds the vocabulary by the sample.  Rows with a
    null label or id teach nothing, a null text counts as empty, and repeated
    labels count once.  Without labelled documents every probability is 0.5 and
    no category applies.  Each category's cut is chosen on out-of-fold
    probabilities.
    """
    names = list(categories)
    keyed = F.col(f"`{label_id}`").cast("long")
    usable = labels.select(keyed.alias("id"), *[c.cast("int").alias(f"c{k}") for k, c in enumerate(categories.values())])
    usable = usable.dropna().groupBy("id").agg(*[F.max(f"c{k}").alias(f"c{k}") for k in range(len(names))])
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ids = usable.join(named.select("id").where("id is not null").distinct(), "id", "left_semi")
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    sample = named.join(F.broadcast(ids), "id")  # at most most_rows rows

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        words = [text_words(t) for t in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([[word_hash(w) for w in ws] for ws in words], pa.list_(pa.int64())),
             pa.array([style(t, len(ws)) for t, ws in zip(texts, words)], pa.list_(pa.float64())), *batch.columns[2:]],
            ["id", "words", "style", *[f"c{k}" for k in range(len(names))]])

    kinds = ", ".join(f"c{k} int" for k in range(len(names)))
    got = stored(map_batches(sample.select("id", "text", *[f"c{k}" for k in range(len(names))]), features,
                             f"id long, words array<long>, style array<double>, {kinds}"))
    n = got.count()
    if not n:
        return Chain(tuple(Link(c, np.zeros(0, int), np.zeros(0), np.zeros(k), 0.0) for k, c in enumerate(names)), {}, (1.0,) * len(names))
    vocabulary = (got.select(F.explode("words").alias("w")).groupBy("w").count()
                  .where(F.col("count") >= max(min(5, n), int(min_share * n))).select("w"))
    words = {r["w"]: STYLE + k for k, r in enumerate(vocabulary.orderBy("w").collect())}
    rows, styles, marks, fold = [], [], [], []
    for r in got.orderBy("id", F.hash("words")).toLocalIterator():
        rows.append(np.array([words[w] for w in r["words"] if w in words], dtype=np.int64))
        styles.append(r["style"])
        marks.append([r[f"c{k}"] for k in range(len(names))])
        fold.append(xxhash.xxh64_intdigest(str(r["id"])) % folds)
    return fit_chain(rows, np.array(styles), np.array(marks), names, np.array(fold), words)[0]


def chain_scores(chain: Chain, rows: list[np.ndarray], styles: np.ndarray) -> np.ndarray:
    """Probabilities (documents x categories), each category fed the earlier ones' probabilities."""
    out = np.full((len(rows), len(chain.links)), 0.5)
    size = 1 + max([STYLE, *chain.words.values(), *(int(f) for link in chain.links for f in link.features)])
    for k, link in enumerate(chain.links):
        if not len(link.features):
            continue
        weight = np.zeros(size)
        weight[link.features] = link.weights
        flat = weight[STYLE:]
        ends = np.cumsum([0] + [len(r) for r in rows])
        every = np.concatenate([*rows, np.zeros(0, dtype=np.int64)])
        sums = np.concatenate(([0.0], np.cumsum(flat[every - STYLE]))) if len(every) else np.zeros(1)
        z = sums[ends[1:]] - sums[ends[:-1]] + styles @ weight[:STYLE] + out[:, :k] @ link.earlier + link.offset
        out[:, k] = sigmoid(z)
    return out


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one probability per category) for every row of ``docs``; whole texts, one pass, no shuffle.

    The chain goes to the workers as a broadcast, as large as its vocabulary.
    Null and empty texts have no words and are scored as such.  Repeated rows
    and null ids keep a result row each.
    """
    names = [link.category for link in chain.links]
    used = {int(f) for link in chain.links for f in link.features if f >= STYLE}
    shared = docs.sparkSession.sparkContext.broadcast(([tuple(link) for link in chain.links], {w: f for w, f in chain.words.items() if f in used}, chain.cuts))

    def known() -> Chain:
        links, words, cuts = shared.value
        return Chain(tuple(Link(*x) for x in links), words, cuts)

    def run(batch: pa.RecordBatch, model: Chain) -> pa.RecordBatch:
        features = model.words
        spelled: dict[str, int] = {}
        rows, styles = [], []
        for text in batch.column(1).to_pylist():
            words = text_words(text)
            hit = []
            for w in words:
                f = spelled.get(w)
                if f is None:
                    f = features.get(word_hash(w), -1)
                    if len(spelled) < 200_000:
                        spelled[w] = f
                if f >= 0:
                    hit.append(f)
            rows.append(np.array(sorted(hit), dtype=np.int64))
            styles.append(style(text, len(words)))
        p = chain_scores(model, rows, np.array(styles).reshape(-1, STYLE))
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, k]) for k in range(len(names))]], ["id", *names])

    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(named, run, with_id(named, ", ".join(f"`{n}` double" for n in names)), known)
