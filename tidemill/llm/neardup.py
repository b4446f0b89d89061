"""Embedding near-duplicates by PCA-ordered, tiled comparison with early stops."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import connected_components, map_batches
from tidemill.session import stored

_EPS = 1e-9  # room for rounding in the bounds; the final check uses the vectors as given


def clean_vectors(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """(id, v, further columns as m0, m1, ..; float or double parts) without vectors that are null, empty, zero or hold null or non-finite parts."""
    single = df.select(F.col(f"`{vec_col}`")).schema[0].dataType.simpleString() == "array<float>"
    v = F.col(f"`{vec_col}`").cast("array<float>" if single else "array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"),
                      *[F.col(f"`{c}`").alias(f"m{i}") for i, c in enumerate(more)])
            .where(F.col("v").isNotNull() & F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def principal_axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """Axes (columns) of the unit vectors in ``v``, strongest first, from second moments summed over all rows."""
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column(0), dims)
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims * dims, dtype=np.int32)), pa.array((u.T @ u).ravel())], ["i", "x"])

    total = np.zeros(dims * dims)
    for row in map_batches(vectors.select("v"), count, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        total[row["i"]] = row["x"]
    _, axes = np.linalg.eigh(total.reshape(dims, dims))
    return axes[:, ::-1]


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, steps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs whose rotated unit vectors may reach ``threshold``.

    Leading dimensions are accumulated first; what the rest can still add is at
    most the product of the suffix norms, and a pair stops as soon as that
    cannot reach the threshold.
    """
    dims = a.shape[1]
    cuts = [s for s in steps if s < dims] + [dims]
    part = a[:, :cuts[0]] @ b[:, :cuts[0]].T
    tail = lambda x, at: np.sqrt(np.maximum((x[:, at:] ** 2).sum(axis=1), 0))
    i, j = np.nonzero(part + np.outer(tail(a, cuts[0]), tail(b, cuts[0])) >= threshold - _EPS)
    part = part[i, j]
    for low, high in zip(cuts, cuts[1:]):
        keep_i, keep_j, keep_p = [], [], []
        ta, tb = tail(a, high), tail(b, high)
        for at in range(0, len(i), 200_000):
            x, y = i[at:at + 200_000], j[at:at + 200_000]
            p = part[at:at + 200_000] + np.einsum("ij,ij->i", a[x, low:high], b[y, low:high])
            ok = p + ta[x] * tb[y] >= threshold - _EPS
            keep_i.append(x[ok])
            keep_j.append(y[ok])
            keep_p.append(p[ok])
        i, j, part = (np.concatenate(k) if k else np.zeros(0, dtype=d) for k, d in
                      ((keep_i, np.int64), (keep_j, np.int64), (keep_p, np.float64)))
    return i, j


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row number reachable, by repeated minimum over the links."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", group_col: str = "label",
                    threshold: float = 0.93, block: int = 512, grid_dims: int = 2) -> DataFrame:
    """(id, n_links, component) for every row of ``vectors``, comparing rows of equal, non-null group.

    Unit vectors are rotated onto their principal axes.  The leading
    ``grid_dims`` coordinates place a vector in a cell as wide as the largest
    distance a link allows, so only neighbouring cells can link; cells are cut
    into blocks of about ``block`` rows, and each pair of blocks is one tile, a
    group of at most a few thousand rows.  Within a tile ``tile_links`` stops
    pairs early, and survivors are checked with the vectors as given, in double
    precision.  A tile returns one count per row and a spanning forest of its
    links, never its pairs.  Equal vectors of a group are folded into one that
    carries their number, so copies cost nothing.

    Vectors that are null, zero or with null or non-finite parts, and rows with
    a null group, have no links and are their own component.  Vectors link with
    those of their own length; lengths up to the same power of two are worked on
    together, the shorter ones filled with zeros, which change no cosine.  A null
    id stays, without links.  Repeated (id, vector) rows link with each other
    like other copies; rows that share an id count as one item that has the
    links of all of them.  An empty table gives an empty result.
    """
    base = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"))
    clean = clean_vectors(vectors, id_col, vec_col, group_col).where("m0 is not null")
    sized = clean.withColumn("n", F.size("v"))
    bands = sized.groupBy(F.ceil(F.log2(F.col("n"))).alias("band")).agg(F.max("n").alias("dims")).orderBy("band").collect()
    linked = None
    for b in bands:  # at most 31
        band = sized.where(F.ceil(F.log2(F.col("n"))) == b["band"])
        filled = F.concat("v", F.array_repeat(F.lit(0.0).cast(clean.schema["v"].dataType.elementType), F.lit(b["dims"]) - F.col("n")))
        rows = band.select("id", F.when(F.col("n") < b["dims"], filled).otherwise(F.col("v")).alias("v"),
                           F.concat_ws(":", F.col("n"), F.col("m0").cast("string")).alias("g"))
        part = _links_of(rows, b["dims"], threshold, block, min(grid_dims, b["dims"]))
        linked = part if linked is None else linked.unionByName(part)
    if linked is None:
        return base.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    linked = linked.groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    return base.join(linked, "id", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))


def _links_of(rows: DataFrame, dims: int, threshold: float, block: int, grid_dims: int) -> DataFrame:
    """(id, n_links, component) of the rows (id, v, g) that have a group, vectors being ``dims`` long."""
    # One row per distinct vector of a group.
    kind = rows.schema["v"].dataType.simpleString()
    reps = stored(rows.groupBy("g", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    axes = principal_axes(reps, dims)
    width = math.sqrt(max(2 - 2 * threshold, 1e-12)) + 1e-6

    def rotate(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column(1), dims)
        r = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes
        cells = np.floor(r[:, :grid_dims] / width).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(4)), pa.array(list(r), pa.list_(pa.float64())),
             pa.array(list(cells), pa.list_(pa.int32()))], ["g", "v", "rep", "copies", "r", "cell"])

    placed = map_batches(reps.select("g", "v", "rep", "copies"), rotate,
                         f"g string, v {kind}, rep long, copies long, r array<double>, cell array<int>")
    sizes = placed.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("rows")).select(
        "g", "cell", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    own = stored(placed.join(sizes, ["g", "cell"]).withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    # Tiles: a block of a cell against each block of the same or a neighbouring cell, once.
    blocks = own.select("g", "cell", "blocks").distinct().select("g", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("blk"))
    steps = F.array(*[F.array(*[F.lit(s) for s in shift]) for shift in _shifts(grid_dims)])
    left = blocks.select("g", F.col("cell").alias("c1"), F.col("blk").alias("b1"), F.explode(steps).alias("shift"))
    left = left.select("g", "c1", "b1", F.zip_with("c1", "shift", lambda x, y: x + y).alias("c2"))
    tiles = (left.join(blocks.select("g", F.col("cell").alias("c2"), F.col("blk").alias("b2")), ["g", "c2"])
             .where((F.col("c1") < F.col("c2")) | ((F.col("c1") == F.col("c2")) & (F.col("b1") <= F.col("b2")))))
    # Two hashes: one alone may name two tiles where there are very many.
    tiles = tiles.withColumn("tile", F.struct(F.xxhash64("g", "c1", "b1", "c2", "b2").alias("x"), F.xxhash64("b2", "c2", "g", "b1", "c1").alias("y")))
    tiles = stored(tiles)
    same = (F.col("c1") == F.col("c2")) & (F.col("b1") == F.col("b2"))
    sides = (tiles.select("g", F.col("c1").alias("cell"), F.col("b1").alias("blk"), "tile", F.lit(0).alias("side"), same.alias("same"))
             .unionByName(tiles.where(~same).select("g", F.col("c2").alias("cell"), F.col("b2").alias("blk"), "tile", F.lit(1).alias("side"), same.alias("same"))))
    dealt = own.select("g", "cell", "blk", "rep", "copies", "v", "r").join(sides, ["g", "cell", "blk"]).select(
        "tile", "side", "same", "rep", "copies", "v", "r")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        same = bool(pdf["same"].iloc[0])
        first = pdf[pdf["side"] == 0]
        second = first if same else pdf[pdf["side"] == 1]
        a, b = np.stack(first["r"].to_list()), (np.stack(second["r"].to_list()) if len(second) else np.zeros((0, dims)))
        if not len(b):
            return pd.DataFrame({"rep": [], "links": [], "other": []})
        i, j = tile_links(a, b, threshold, (8, 16, 32))
        if same:
            i, j = i[i < j], j[i < j]
        x, y = (np.stack(s["v"].to_list()).astype(np.float64) for s in (first, second))
        nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        sure = [np.einsum("ij,ij->i", x[i[k:k + 200_000]], y[j[k:k + 200_000]])
                / (nx[i[k:k + 200_000]] * ny[j[k:k + 200_000]]) >= threshold for k in range(0, len(i), 200_000)]
        ok = np.concatenate(sure) if sure else np.zeros(0, dtype=bool)
        i, j = i[ok], j[ok]
        ids = np.concatenate([first["rep"].to_numpy(), second["rep"].to_numpy()])
        copies = np.concatenate([first["copies"].to_numpy(), second["copies"].to_numpy()])
        j = j if same else j + len(first)
        n = len(first) if same else len(ids)
        links = np.zeros(n, dtype=np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        # The smallest reachable row of each row: a forest that joins what the links join.
        root = _roots(n, i, j)
        hit = np.flatnonzero(links)
        return pd.DataFrame({"rep": ids[hit], "links": links[hit], "other": ids[root[hit]]})

    found = stored(dealt.groupBy("tile").applyInPandas(compare, "rep long, links long, other long"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    # rep is an id, and an id with several rows may stand for several vectors: names are joined by value.
    named = (reps.select("g", "v", "rep", "copies").join(counts, "rep", "left")
             .join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .select("g", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    return rows.join(named, ["g", "v"]).select("id", "n_links", "component")


def _shifts(dims: int) -> list[tuple[int, ...]]:
    out: list[tuple[int, ...]] = [()]
    for _ in range(dims):
        out = [s + (x,) for s in out for x in (-1, 0, 1)]
    return out
