"""SimHash fingerprints and near-duplicate groups by the generalised pigeonhole principle."""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import connected_components, map_batches
from tidemill.session import stored

_SLICE = 50_000  # shingles hashed at a time


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text, unsigned.

    A-Z are lower-cased; words are cut at space and \\x09-\\x0D; shingles are
    ``width`` words joined by a space, repeats included (fewer words: the whole
    sequence).  A bit is 1 if it is set in over half the XXH64 values.  No word
    at all gives 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - [len(w) + 1 for w in words]
    width = min(width, len(words))
    spans = zip(starts[:len(words) - width + 1].tolist(), (ends[width - 1:] - 1).tolist())
    ones, n = np.zeros(64, dtype=np.int64), 0
    while part := [line[s:e] for s, e in islice(spans, _SLICE)]:
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(seed)), dtype=np.uint64, count=len(part))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp) for every row, fp as a signed long; whole texts, no shuffle.  A null text counts as empty."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], ["id", "fp"])

    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(named, run, "id long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(df: DataFrame, count, length: int) -> np.ndarray:
    """Sum over tasks of a fixed-length vector of counts; only ``length`` numbers reach the driver."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = count(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = np.flatnonzero(got)
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(got[at].astype(np.int64))], ["i", "n"])

    out = np.zeros(length, dtype=np.float64)
    for row in map_batches(df, run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[row["i"]] = row["n"]
    return out


def group_bits(distinct: DataFrame, parts: int) -> list[list[int]]:
    """Deal the 64 bits into ``parts`` groups of equal size so that correlated bits share a group.

    Correlations are counted over all distinct fingerprints.  Each group starts
    with the strongest free pair and takes the free bit with the largest mean
    correlation to it until it is full.
    """
    def count(fp: np.ndarray) -> np.ndarray:
        x = _bits(fp).astype(np.float64)
        return np.concatenate(([len(x)], x.sum(axis=0), (x.T @ x).ravel()))

    got = _summed(distinct, count, 1 + 64 + 64 * 64)
    n, mean, both = max(got[0], 1.0), got[1:65] / max(got[0], 1.0), got[65:].reshape(64, 64)
    cov = both / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs(cov / np.outer(scale, scale))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(64)), []
    for p in range(parts):
        want = len(free) // (parts - p)
        if want <= 1:
            group = [free.pop(0)]
        else:
            sub = corr[np.ix_(free, free)]
            i, j = divmod(int(np.argmax(sub)), len(free))
            i, j = (0, 1) if i == j else (i, j)
            group = [free[i], free[j]]
            free = [b for b in free if b not in group]
            while len(group) < want:
                best = int(np.argmax(corr[np.ix_(free, group)].mean(axis=1)))
                group.append(free.pop(best))
        groups.append(sorted(group))
    return groups


def signatures(fp: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """(rows, parts) values of the bit groups."""
    u = fp.view(np.uint64)
    out = np.zeros((len(u), len(groups)), dtype=np.uint64)
    for p, bits in enumerate(groups):
        for to, bit in enumerate(bits):
            out[:, p] |= ((u >> np.uint64(bit)) & np.uint64(1)) << np.uint64(to)
    return out


def variants(width: int, radius: int) -> np.ndarray:
    """Masks that flip at most ``radius`` of ``width`` bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)],
                    dtype=np.uint64)


def allocate(cost: np.ndarray, distance: int) -> np.ndarray:
    """Thresholds per partition and row, by dynamic programming.

    ``cost[row, part, t + 1]`` is the estimated cost of threshold t, from -1
    (not probed) to ``distance``.  The general pigeonhole principle asks for
    sum(t + 1) = distance + 1: a pair within ``distance`` bits is then within t
    bits in at least one partition.  The cheapest such split is returned.
    """
    rows, parts, steps = cost.shape
    need = distance + 1
    best = np.full((rows, need + 1), np.inf)
    best[:, 0] = 0.0
    came = np.zeros((rows, parts, need + 1), dtype=np.int8)
    for p in range(parts):
        now = np.full_like(best, np.inf)
        for total in range(need + 1):
            for take in range(min(total, steps - 1) + 1):
                c = best[:, total - take] + cost[:, p, take]
                better = c < now[:, total]
                now[better, total] = c[better]
                came[better, p, total] = take
        best = now
    out = np.zeros((rows, parts), dtype=np.int8)
    left = np.full(rows, need)
    for p in range(parts - 1, -1, -1):
        out[:, p] = came[np.arange(rows), p, left]
        left = left - out[:, p]
    return out - 1


def _chunk_tables(hist: np.ndarray, widths: list[int], n: float) -> list[list[np.ndarray]]:
    """Per partition and byte of its signature: chance of each distance, by the value asked for."""
    apart = np.array([[(a ^ b).bit_count() for b in range(256)] for a in range(256)])
    out = []
    for p, width in enumerate(widths):
        tables = []
        for c in range((width + 7) // 8):
            h = hist[p, c] / max(n, 1.0)
            table = np.zeros((256, 9))
            for d in range(9):
                table[:, d] = ((apart == d) * h[None, :]).sum(axis=1)
            tables.append(table)
        out.append(tables)
    return out


def links(distinct: DataFrame, distance: int = 3, parts: int = 2, probe_cost: float = 1.0,
          check_cost: float = 0.05) -> DataFrame:
    """(a, b) for every pair of distinct fingerprints (column ``fp``) that differ in 1 to ``distance`` bits, a < b.

    Every fingerprint stands once per partition in the index.  As a query it
    probes each partition with all signatures within that partition's
    threshold; thresholds are its own, allocated by ``allocate`` from estimated
    candidate counts, so a crowded signature is left for a rarer one.  Probes
    meet the index in an equi-join that Spark can split by key, and the bit
    distance is checked inside the join: only links leave it.  With two
    partitions of 32 bits the work grows in proportion to the fingerprints up
    to some billions of them.
    """
    groups = group_bits(distinct, parts)
    widths = [len(g) for g in groups]
    chunks = max((w + 7) // 8 for w in widths)

    def histogram(fp: np.ndarray) -> np.ndarray:
        got = np.zeros((parts, chunks, 256), dtype=np.int64)
        sigs = signatures(fp, groups)
        for p in range(parts):
            for c in range(chunks):
                got[p, c] = np.bincount(((sigs[:, p] >> np.uint64(8 * c)) & np.uint64(255)).astype(np.int64), minlength=256)
        return got.ravel()

    hist = _summed(distinct, histogram, parts * chunks * 256).reshape(parts, chunks, 256)
    n = float(hist[0, 0].sum())
    tables = _chunk_tables(hist, widths, n)
    masks = [[variants(w, t) for t in range(distance + 1)] for w in widths]

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        sigs = signatures(fp, groups)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.tile(fp, parts)), pa.array(np.repeat(np.arange(parts, dtype=np.int32), len(fp))),
             pa.array(sigs.T.ravel().view(np.int64))], ["fp", "part", "sig"])

    index = stored(map_batches(distinct, place, "fp long, part int, sig long"))
    sizes = index.groupBy("part", "sig").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # Exact size of each crowded signature; the rest of a ball is estimated from byte histograms.
    crowds = (index.join(sizes, ["part", "sig"]).groupBy("fp")
              .agg(*[F.max(F.when(F.col("part") == p, F.col("size"))).alias(f"c{p}") for p in range(parts)]))
    asked = distinct.select("fp").join(crowds, "fp", "left")

    def probe(batch: pa.RecordBatch):
        every = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        known = np.stack([np.nan_to_num(batch.column(1 + p).to_numpy(zero_copy_only=False).astype(np.float64), nan=1.0)
                          for p in range(parts)], axis=1)
        sigs = signatures(every, groups)
        cost = np.zeros((len(every), parts, distance + 2))
        for p in range(parts):
            spread = np.zeros((len(every), distance + 1))
            spread[:, 0] = 1.0
            for c, table in enumerate(tables[p]):
                own = table[((sigs[:, p] >> np.uint64(8 * c)) & np.uint64(255)).astype(np.int64)]
                spread = np.stack([sum(spread[:, d - k] * own[:, k] for k in range(d + 1)) for d in range(distance + 1)], axis=1)
            for t in range(distance + 1):
                near = np.maximum(known[:, p] - 1, 0) + n * spread[:, 1:t + 1].sum(axis=1)
                cost[:, p, t + 1] = probe_cost * len(masks[p][t]) + check_cost * near
        chosen = allocate(cost, distance)
        for p in range(parts):
            for t in range(distance + 1):
                rows = np.flatnonzero(chosen[:, p] == t)
                m = masks[p][t]
                for at in range(0, len(rows), max(1, 100_000 // len(m))):
                    some = rows[at:at + max(1, 100_000 // len(m))]
                    sig = (sigs[some, p][:, None] ^ m[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(every[some], len(m))), pa.array(np.full(len(sig), p, dtype=np.int32)),
                         pa.array(sig.view(np.int64))], ["q", "part", "sig"])

    probes = map_batches(asked, probe, "q long, part int, sig long")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance
    return (probes.join(index, [probes["part"] == index["part"], probes["sig"] == index["sig"],
                                probes["q"] < index["fp"], near])
            .select(F.col("q").alias("a"), F.col("fp").alias("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    distance: int = 3, parts: int = 2) -> DataFrame:
    """(id, fp, component) for every row: documents linked, over any number of steps, by at most ``distance`` bits.

    Equal fingerprints are folded into one before the search, so a group of
    copies costs as much as one document.  ``component`` is the smallest id of
    the group.  Null and empty texts have fingerprint 0 and are linked like any
    other; repeated rows stay; a null id takes part in its group but never
    names it (a group of null ids only has a null component); an empty table
    gives an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width))
    classes = stored(prints.groupBy("fp").agg(F.min("id").alias("first")))
    groups = connected_components(links(classes.select("fp"), distance, parts).select("a", "b"))
    rooted = classes.join(groups.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = stored(rooted.join(lowest, "root").select("fp", "component"))
    return prints.join(named, "fp").select("id", "fp", "component")


def as_hex(fp):
    """Sixteen lower-case hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
