"""Approximate nearest neighbours with an LSH forest of sorted hash strings."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import map_batches
from tidemill.llm.neardup import clean_vectors
from tidemill.session import stored

_DEPTH = 48  # bits of a hash string


def fit_planes(clean: DataFrame, dims: int, trees: int, sample: int = 4000, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Random directions and their cuts: (dims, trees * _DEPTH) and (trees * _DEPTH).

    A bit says on which side of a cut a vector lies; the cut is the median over
    at most ``sample`` vectors, those of smallest id hash, so that the bits
    split the data evenly.
    """
    planes = np.random.default_rng(seed).standard_normal((dims, trees * _DEPTH))
    rows = clean.orderBy(F.xxhash64("id"), "id").select("v").limit(sample).collect()
    cuts = np.median(np.array([r["v"] for r in rows]) @ planes, axis=0) if rows else np.zeros(trees * _DEPTH)
    return planes, cuts


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
           trees: int = 32, share: float = 1.7, shard_bits: int = 4, shard_rows: int = 10_000,
           query_rows: int = 10_000) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of each query, by Euclidean distance in double precision.

    ``is_query`` is a condition on the column ``id``.  Every clean vector
    is in the index, as one hash string per tree; a tree is its sorted array of
    strings, cut by leading bits into shards of at most ``shard_rows`` rows.  A
    query descends in each tree to the entries that share its longest prefix,
    then ascends in all trees at once, one bit at a time, until the entries
    that share a prefix of that length number ``share`` times the indexed rows
    over all trees together.  All of them are compared; there is no other limit.

    Vectors that are null, empty, zero or hold null or non-finite parts take no
    part, nor do null ids.  Vectors of each length have a forest of their own.  Rows that repeat an id
    and vector count once.  Of equal vectors the k + 1 smallest ids enter, which
    is all that any answer can name.  Ties go to the smaller id.  A query with
    fewer than ``k`` others has fewer rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    clean = clean_vectors(vectors, id_col, vec_col).dropDuplicates(["id", "v"])
    asked = clean.where(is_query).groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("queries"))
    # One row per length; there is a distance within a length only.
    lengths = clean.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("rows")).join(asked, "dims").orderBy("dims").collect()
    found = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    for r in lengths:
        part = _search_length(clean.where(F.size("v") == r["dims"]), is_query, r["dims"], r["rows"], r["queries"], k, trees, share,
                              shard_bits, shard_rows, query_rows)
        found = part if len(lengths) == 1 else found.unionByName(stored(part))
    return found


def _search_length(clean: DataFrame, is_query, dims: int, n: int, n_queries: int, k: int, trees: int, share: float, shard_bits: int,
                   shard_rows: int, query_rows: int) -> DataFrame:
    """The search among vectors of one length."""
    spark = clean.sparkSession
    kind = clean.schema["v"].dataType.simpleString()
    planes, cuts = fit_planes(clean, dims, trees)
    model = spark.sparkContext.broadcast((planes, cuts))

    def strings(batch: pa.RecordBatch, shared) -> pa.RecordBatch:
        p, c = shared
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
        bits = ((x @ p) > c).reshape(len(x), trees, _DEPTH)
        weights = np.int64(1) << np.arange(_DEPTH - 1, -1, -1, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(list(bits @ weights), pa.list_(pa.int64()))], ["id", "v", "hs"])

    hashed = stored(map_batches(clean.select("id", "v"), strings, f"id long, v {kind}, hs array<long>", lambda: model.value))
    # Copies beyond the k + 1 smallest ids can be in no answer.  The rank filter cuts before the shuffle.
    by_vector = Window.partitionBy("v").orderBy("id")
    entries = hashed.withColumn("nth", F.row_number().over(by_vector)).where(F.col("nth") <= k + 1).drop("nth")
    entries = stored(entries)
    queries = hashed.where(is_query)
    # Entries per tree and prefix, for each length up to the depth at which a prefix holds about one row.
    deepest = max(shard_bits, min(20, int(np.ceil(np.log2(max(n, 2))))))
    tree = entries.select(F.posexplode("hs").alias("tree", "h"))
    leaves = tree.groupBy("tree", F.shiftright("h", _DEPTH - deepest).alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    levels = (leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
              .groupBy("tree", "level", F.expr(f"shiftright(prefix, {deepest} - level)").alias("prefix"))
              .agg(F.sum("rows").alias("rows")))
    levels = stored(levels)
    total = entries.count()
    asked = (queries.select("id", F.posexplode("hs").alias("tree", "h"))
             .select("id", "tree", "h", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("level"))
             .withColumn("prefix", F.expr(f"shiftright(shiftright(h, {_DEPTH - deepest}), {deepest} - level)")))
    # Synchronous ascent: the deepest level at which the trees together hold enough entries.
    reached = (asked.join(levels, ["tree", "level", "prefix"]).groupBy("id", "level").agg(F.sum("rows").alias("rows"))
               .where((F.col("rows") >= share * total) | (F.col("level") == 0))
               .groupBy("id").agg(F.max("level").alias("level")))
    sizes = levels.where(F.col("level") == shard_bits).select(
        "tree", F.col("prefix").alias("shard"), F.ceil(F.col("rows") / shard_rows).cast("int").alias("salts"))
    q_blocks = max(1, -(-n_queries // query_rows))
    probes = (queries.join(reached, "id").select("id", "v", "level", F.posexplode("hs").alias("tree", "h"))
              .withColumn("first", F.shiftright("h", _DEPTH - shard_bits))
              .withColumn("open", F.greatest(F.lit(0), F.lit(shard_bits) - F.col("level")))
              .withColumn("low", F.expr("shiftleft(shiftright(first, open), open)"))
              .select("id", "v", "level", "tree", "h", F.explode(F.expr("sequence(low, low + shiftleft(1L, open) - 1)")).alias("shard"))
              .join(sizes, ["tree", "shard"])
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
              .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int")))
    index = (entries.select("id", "v", F.posexplode("hs").alias("tree", "h"))
             .withColumn("shard", F.shiftright("h", _DEPTH - shard_bits)).join(sizes, ["tree", "shard"])
             .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))))
    key = ["tree", "shard", "salt", "block"]
    columns = [*key, "id", "v", "h", "level"]
    both = (index.withColumn("level", F.lit(-1)).select(*columns).unionByName(probes.select(*columns)))

    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        mine, ask = pdf[pdf["level"] < 0].sort_values(["h", "id"]), pdf[pdf["level"] >= 0]
        out: list[tuple[np.ndarray, ...]] = []
        if len(mine) and len(ask):
            h, ids, x = mine["h"].to_numpy(), mine["id"].to_numpy(), np.stack(mine["v"].to_list()).astype(np.float64)
            for qid, q, own, level in zip(ask["id"], ask["v"], ask["h"], ask["level"]):
                low = (own >> (_DEPTH - level)) << (_DEPTH - level)
                s, e = np.searchsorted(h, [low, low + (1 << (_DEPTH - level))])
                gap = x[s:e] - np.asarray(q, dtype=np.float64)
                far = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                other = np.flatnonzero(ids[s:e] != qid)
                best = other[np.lexsort((ids[s:e][other], far[other]))[:k]]
                out.append((np.full(len(best), qid), ids[s:e][best], far[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), cols)))

    found = both.groupBy(*key).applyInPandas(descend, "query_id long, id long, score double")
    found = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))
