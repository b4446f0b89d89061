"""The registered queries of this subpackage: thin bindings of the operators to the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import annforest, balltree, langid, lloyd, mixing, neardup, passages, pieces, pii, secrets, simhash, toxicity, warc
from tidemill.session import scratch_dir, tune

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_chain(docs: DataFrame, labels: DataFrame) -> toxicity.Chain:
    """Junk first, then toxicity, which is fed the probability of junk."""
    return toxicity.train(docs, labels, {"junk": F.col("quality") == 0, "toxic": F.col("toxic") == 1})


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxic_chain(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, chain)
    return scored.select(F.col("id").alias("doc_id"), F.col("junk").alias("p_junk"), F.col("toxic").alias("p_toxic"),
                         (F.col("junk") > chain.cuts[0]).alias("junk"), (F.col("toxic") > chain.cuts[1]).alias("toxic"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.pii_spans(table(spark, sf_dir, "documents")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)
    return found.select(F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"), MODEL_FILE).select(
        F.col("id").alias("doc_id"), F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long").alias("n_tokens"),
        "ids", "round_trip")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annforest.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").withColumnRenamed("ref_id", "ref_doc_id")


def labelled_domains(labels: DataFrame) -> DataFrame:
    """Domain of each document with a quality label: junk or prose."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "prose").alias("domain"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = mixing.fit(docs, labelled_domains(table(spark, sf_dir, "labels")))
    mixed = mixing.mix(docs, model, {"prose": 0.95, "junk": 0.05})
    return mixed.withColumnRenamed("id", "doc_id").drop("text_hash")


def op8_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
deg AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(deg.n, 0) AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v JOIN comp ON comp.x = v.vec_id LEFT JOIN deg ON deg.x = v.vec_id
"""


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    # A null doc_id has no remainder: such rows are not held out and teach like the others.
    held_out = F.coalesce(held_out, F.lit(False))
    model = langid.fit(docs.where(~held_out), "doc_id", "text", "lang")
    return langid.predict(docs, model).select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(tune(spark), "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, segment=8_192)
    return warc.page_table(warc.reassemble(warc.read_records(spark, path)))


OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.keeper > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.keeper > p.page_id THEN k.keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)
"""

def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(table(spark, sf_dir, "embeddings"), k=16, dims=64, rounds=3).withColumnRenamed("id", "vec_id")


def _op11_sql() -> str:
    """Three rounds and the last assignment, one step after the other."""
    near = """a{r} AS MATERIALIZED (
  SELECT vec_id, min(struct_pack(d := d, c := c)) AS n FROM (
    SELECT v.vec_id, c.c, list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v CROSS JOIN c{r} c) GROUP BY vec_id
)"""
    move = """m{r} AS (
  SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
    SELECT a.n.c AS c, unnest(v.q) AS x, generate_subscripts(v.q, 1) AS i FROM a{r} a JOIN v USING (vec_id)) GROUP BY c, i
), c{next} AS MATERIALIZED (
  SELECT c.c, coalesce(g.q, c.q) AS q FROM c{r} c LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM m{r} GROUP BY c) g ON g.c = c.c
)"""
    steps = [part.format(r=r, next=r + 1) for r in range(3) for part in (near, move)]
    return """WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, q FROM (SELECT sha256('1:' || vec_id) AS h, q FROM v ORDER BY h LIMIT 16)
), """ + ", ".join([*steps, near.format(r=3)]) + """
SELECT a.vec_id, CAST(a.n.c AS INTEGER) AS cluster, a.n.d AS distance,
       CAST(sum(a.n.d) OVER (PARTITION BY a.n.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.n.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c ON c.c = a.n.c
"""


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = balltree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return found.withColumnRenamed("id", "doc_id")


OP12_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
), whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM size
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, whole
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN size USING (doc_id), whole GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def _op13_sql() -> str:
    def text(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    kinds = {**secrets.BASE, **secrets.ADDED}
    found = " UNION ALL ".join(f"""
  SELECT row, {place} AS place, '{name}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
    start := list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
    size := length(m[i]), value := v[i]))) AS s, {kind.least} AS least
  FROM (SELECT row, regexp_extract_all(t, {text(kind.pattern)}, 0) AS m, regexp_extract_all(t, {text(kind.pattern)}, {kind.group}) AS v,
               string_split_regex(t, {text(kind.pattern)}) AS g FROM d)""" for place, (name, kind) in enumerate(kinds.items()))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents
), found AS ({found}
), spans AS (
  SELECT row, place, kind, CAST(s.start AS BIGINT) AS start, CAST(s.start + s.size AS BIGINT) AS stop, s.value AS value
  FROM found WHERE length(s.value) >= least
), held AS (
  SELECT value, count(DISTINCT source) AS owners FROM spans JOIN d USING (row) GROUP BY value
), told AS (
  SELECT s.*, kind || ':' || start || ':' || stop AS shown, owners >= 3 AS example,
         kind = 'private_key' OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
                                  AND len(list_distinct(string_split(value, ''))) >= 8) AS random
  FROM spans s JOIN held USING (value)
), by_row AS (
  SELECT row, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
         string_agg(shown, ',' ORDER BY start, place) FILTER (place < 3) AS base, string_agg(shown, ',' ORDER BY start, place) AS spans,
         count(*) FILTER (example) AS n_example, count(*) FILTER (random AND NOT example) AS n_live
  FROM told GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN by_row USING (row)
"""


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_pii, op3_simhash, op4_pieces, op5_nearest, op6_passages, op7_mixing, op8_embedding_neardup,
    op9_language, op10_warc, op11_centroids, op12_ranked, op13_secrets)}
ORACLE = {"op8_embedding_neardup": OP8_SQL, "op10_warc": OP10_SQL, "op11_centroids": _op11_sql(), "op12_ranked": OP12_SQL,
          "op13_secrets": _op13_sql()}
