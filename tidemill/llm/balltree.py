"""Ranked lexical search: exact top-k inner products over ball trees of sparse document vectors.

A document's vector holds one integer per term; the score of an item is its inner
product with the item's term weights.  Tasks build trees over blocks of documents.
Every node keeps a centroid and a radius; ``q.c + |q| r``, rounded up, bounds the
score of all its documents, and nodes are opened best bound first until no bound
reaches the k-th score.  At the leaves scores are exact 64-bit integers.

The items are a stated query set, taken in blocks of bounded size: a block's terms
go to every task, and document vectors carry those terms alone, which leaves the
scores as they are.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import map_batches
from tidemill.session import stored

#: Bytes of a text to term bytes: A-Z lower-cased, other ASCII but digits and letters a separator.
_TERM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32) for b in range(256))

BLOCK_ITEMS = 4_096
BLOCK_BYTES = 8_000_000
TREE_VECTORS = 16_384
TREE_VALUES = 4_000_000
LEAF = 64
#: Relative room for rounding in bounds; sums of a million doubles err by less.
ROOM = 1e-9


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text."""
    return text.translate(_TERM_BYTES).split()


# -- one tree ----------------------------------------------------------------------


@dataclass
class Node:
    rows: slice
    columns: np.ndarray
    centroid: np.ndarray
    radius: float
    children: tuple[int, ...] = ()


class BallTree:
    """Ball tree over sparse non-negative integer vectors, given as CSR arrays; no vector is empty.

    ``order`` maps places in the tree to the rows given.  Nodes are cut
    across the line between two means; no side is below a tenth, so the depth stays
    logarithmic.
    """

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int, leaf: int = LEAF):
        self.nodes: list[Node] = []
        count = len(starts) - 1
        self.order = np.arange(count)
        lengths = np.diff(starts)
        norms = np.add.reduceat(values.astype(np.float64) ** 2, starts[:-1]) if count else np.zeros(0)
        dense = np.zeros(width)

        def part(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            size = lengths[rows]
            at = np.cumsum(size) - size
            flat = np.arange(size.sum()) + np.repeat(starts[rows] - at, size)
            return at, columns[flat], values[flat]

        def along(at: np.ndarray, cols: np.ndarray, vals: np.ndarray, c: np.ndarray, v: np.ndarray) -> np.ndarray:
            dense[c] = v
            dots = np.add.reduceat(vals * dense[cols], at)
            dense[c] = 0.0
            return dots

        def row(r: int) -> tuple[np.ndarray, np.ndarray]:
            here = slice(starts[r], starts[r + 1])
            return columns[here], values[here].astype(np.float64)

        open_nodes = [(0, count, -1)] if count else []
        while open_nodes:
            low, high, parent = open_nodes.pop()
            rows = self.order[low:high]
            at, cols, vals = part(rows)
            used, inverse = np.unique(cols, return_inverse=True)
            centroid = np.bincount(inverse, weights=vals) / len(rows)
            square = norms[rows] - 2 * along(at, cols, vals, used, centroid) + centroid @ centroid
            # The difference of large sums may lose the last digits; the radius is rounded up by more than that.
            room = 1e-11 * (norms[rows].max() + centroid @ centroid)
            radius = math.sqrt(max(square.max(), 0.0) + room) * (1 + ROOM)
            self.nodes.append(Node(slice(low, high), used, centroid, radius))
            if parent >= 0:
                self.nodes[parent].children += (len(self.nodes) - 1,)
            if len(rows) <= leaf:
                continue
            a = rows[square.argmax()]
            to_a = along(at, cols, vals, *row(a))
            b = rows[(norms[rows] - 2 * to_a + norms[a]).argmax()]
            line = along(at, cols, vals, *row(b)) - to_a - (norms[b] - norms[a]) / 2
            # One step of two means from the far pair, cut halfway between the means, no side below a tenth.
            right = line > np.median(line) if (line > 0).all() or (line <= 0).all() else line > 0
            sums = [np.bincount(inverse, weights=np.where(np.repeat(side, lengths[rows]), vals, 0.0), minlength=len(used)) / max(side.sum(), 1)
                    for side in (~right, right)]
            line = along(at, cols, vals, used, sums[1] - sums[0]) - (sums[1] @ sums[1] - sums[0] @ sums[0]) / 2
            self.order[low:high] = rows[np.argsort(line, kind="stable")]
            least = -(-len(rows) // 10)
            middle = low + min(max(int((line <= 0).sum()), least), len(rows) - least)
            me = len(self.nodes) - 1
            open_nodes += [(middle, high, me), (low, middle, me)]
        at, self.columns, self.values = part(self.order) if count else (starts[:0], columns, values)
        self.starts = np.append(at, len(self.columns))

    def bound(self, node: int, weights: np.ndarray) -> float:
        """No score below the node is higher: centroid score plus radius times the norm of the weights met there, rounded up."""
        here = self.nodes[node]
        met = weights[here.columns]
        return float(met @ here.centroid + math.sqrt(met @ met) * here.radius) * (1 + ROOM)

    def scores(self, node: int, weights: np.ndarray) -> np.ndarray:
        """Exact scores of a node's vectors, in tree order."""
        rows = self.nodes[node].rows
        low, high = self.starts[rows.start], self.starts[rows.stop]
        return np.add.reduceat(weights[self.columns[low:high]] * self.values[low:high], self.starts[rows] - low)

    def search(self, weights: np.ndarray, least: Callable[[], int], found: Callable[[np.ndarray, np.ndarray], None]) -> int:
        """Hand rows and scores of leaves to ``found``, best bound first, while a bound reaches ``least()``; returns the leaves opened.

        ``weights`` are int64, one per column.
        """
        if not self.nodes:
            return 0
        as_double = weights.astype(np.float64)
        heap, leaves = [(-self.bound(0, as_double), 0)], 0
        while heap and -heap[0][0] >= least():
            node = heapq.heappop(heap)[1]
            if not self.nodes[node].children:
                leaves += 1
                found(self.order[self.nodes[node].rows], self.scores(node, weights))
            for child in self.nodes[node].children:
                upper = self.bound(child, as_double)
                if upper >= least():
                    heapq.heappush(heap, (-upper, child))
        return leaves


# -- a task's search ---------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """A block of items: their terms by number, and the numbers of each item's terms."""

    vocabulary: dict[bytes, int]
    items: list[tuple[int, np.ndarray]]


@dataclass
class Best:
    """The k best documents of an item so far: (-score, null id, id), in order."""

    k: int
    kept: list[tuple] = field(default_factory=list)

    def least(self) -> int:
        return -self.kept[-1][0] if len(self.kept) == self.k else 1

    def add(self, scores: np.ndarray, ids: list[list]) -> None:
        least = self.least()
        new = [(-int(s), i is None, 0 if i is None else i) for s, same in zip(scores.tolist(), ids) if s >= least for i in same]
        if new:
            self.kept = heapq.nsmallest(self.k, self.kept + new)


def _vectors(batch: pa.RecordBatch, docs: int, total: int) -> Iterator[tuple[object, bytes, np.ndarray, np.ndarray]]:
    """(id, key of equal vectors, columns, values) of the rows of a batch of (id, n, terms, tf)."""
    ids, n = batch.column("id").to_pylist(), batch.column("n").to_numpy()
    terms, tf = batch.column("terms"), batch.column("tf")
    at = terms.offsets.to_numpy()
    columns, count = terms.values.to_numpy(), tf.values.to_numpy().astype(np.int64)
    m = 100 - 90 + (90 * n.astype(np.int64) * docs) // total
    values = (1_000_000_000 * count) // (1000 * count + 8 * np.repeat(m, np.diff(at)))
    for i, doc in enumerate(ids):
        here = slice(at[i], at[i + 1])
        yield doc, columns[here].tobytes() + values[here].tobytes(), columns[here], values[here]


def _search_task(batches: Iterator[pa.RecordBatch], block: Block, weights: np.ndarray, docs: int, total: int, k: int,
                 id_type: pa.DataType, tree_vectors: int, leaf: int) -> Iterator[pa.RecordBatch]:
    best = [Best(k) for _ in block.items]
    held: dict[bytes, tuple[np.ndarray, np.ndarray, list]] = {}
    size, query = 0, np.zeros(len(block.vocabulary), dtype=np.int64)

    def flush() -> None:
        vectors = list(held.values())
        if not vectors:
            return
        starts = np.append(0, np.cumsum([len(v[0]) for v in vectors]))
        tree = BallTree(starts, np.concatenate([v[0] for v in vectors]), np.concatenate([v[1] for v in vectors]), len(query), leaf)
        ids = [heapq.nsmallest(k, v[2], key=lambda i: (i is None, 0 if i is None else i)) for v in vectors]
        for (_, terms), kept in zip(block.items, best):
            query[terms] = weights[terms]
            tree.search(query, kept.least, lambda rows, scores, kept=kept: kept.add(scores, [ids[r] for r in rows]))
            query[terms] = 0
        held.clear()

    for batch in batches:
        for doc, key, columns, values in _vectors(batch, docs, total):
            # Of equal vectors only the k smallest ids can rank, so a vector is kept once.
            if key not in held:
                held[key] = (columns, values, [])
                size += len(columns)
            same = held[key][2]
            same.append(doc)
            if len(same) > 8 * k:
                same[:] = heapq.nsmallest(k, same, key=lambda i: (i is None, 0 if i is None else i))
            if len(held) >= tree_vectors or size >= TREE_VALUES:
                flush()
                size = 0
    flush()
    rows = [(number, None if null else doc, -score) for (number, _), kept in zip(block.items, best) for score, null, doc in kept.kept]
    if rows:
        number, doc, score = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(doc, id_type), pa.array(score, pa.int64())], ["item", "id", "score"])


# -- the operator ------------------------------------------------------------------


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = 10, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES,
           tree_vectors: int = TREE_VECTORS, leaf: int = LEAF) -> DataFrame:
    """(item_id, rank, id, score): the ``k`` best documents of each item with a score above 0, ties by ascending id, a null id last.

    Items go in blocks of about ``block_items`` rows and ``block_bytes`` of text, all
    documents are read for each.  Null and empty texts have no terms.  Each
    item row is ranked by itself, also where ids repeat or are null; repeated
    document rows are ranked one after the other.  An empty table on either
    side gives no rows.
    """
    spark = docs.sparkSession
    asked = stored(items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").cast("binary").alias("text"))
                   .withColumn("item", F.monotonically_increasing_id()))
    rows, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(rows / block_items), math.ceil(size / block_bytes))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    found = None
    for b in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # bounded by block_items and block_bytes
        part = _search_block(texts, [(r["item"], bytes(r["text"] or b"")) for r in some], k, tree_vectors, leaf)
        part = stored(part) if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    return (found.join(asked.select("item", "item_id"), "item")
            .select("item_id", "rank", "id", "score"))


def _search_block(texts: DataFrame, asked: list[tuple[int, bytes]], k: int, tree_vectors: int, leaf: int) -> DataFrame:
    spark = texts.sparkSession
    vocabulary: dict[bytes, int] = {}
    items = []
    for number, text in sorted(asked):
        numbers = sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text)})
        if numbers:
            items.append((number, np.array(numbers, dtype=np.int64)))
    shared = spark.sparkContext.broadcast(Block(vocabulary, items))
    kind = T.StructType([texts.schema["id"], *T.StructType.fromDDL("n bigint, terms array<int>, tf array<int>").fields])

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value.vocabulary
        n, sizes, terms, tf, keep = [], [0], [], [], []
        for i, text in enumerate(batch.column("text")):
            words = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else ()
            if not words:
                continue
            met = sorted(Counter(known[w] for w in words if w in known).items())
            keep.append(i)
            n.append(len(words))
            terms += [t for t, _ in met]
            tf += [c for _, c in met]
            sizes.append(len(terms))
        offsets = pa.array(sizes, pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
             pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))], ["id", "n", "terms", "tf"])

    vectors = stored(map_batches(texts, counted, kind))
    docs, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most the terms of a block
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for r in holding:
        weights[r["term"]] = math.floor(1000 * math.log((2 * docs + 2) / (2 * r["count"] + 1)))
    weighed = spark.sparkContext.broadcast(weights)
    result = T.StructType([T.StructField("item", T.LongType()), texts.schema["id"], T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return iter(())
        chain = (b for part in ((first,), batches) for b in part)
        return _search_task(chain, shared.value, weighed.value, docs, total, k, first.schema.field("id").type, tree_vectors, leaf)

    best = vectors.where(F.size("terms") > 0).mapInArrow(run, result)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # Every task hands over k rows an item; a first ranking by groups of tasks keeps the last one small.
    group = F.pmod(F.spark_partition_id(), F.lit(256))
    halfway = (best.withColumn("task_group", group).withColumn("place", F.row_number().over(Window.partitionBy("item", "task_group").orderBy(*order)))
               .where(F.col("place") <= k))
    return (halfway.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= k).select("item", "rank", "id", "score"))
