"""Checks for documents, retrieval and headline signals."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.functions.text import lexicon_scorer, sentiment
from tidemill.functions.vectors import cosine_similarity, hashing_embedder, text_embedding
from tidemill.plans import corpus as c

declare(
    files="SELECT 'doc' || doc_id AS file_name, text AS content FROM {documents}",
    news="SELECT doc_id, CASE WHEN doc_id % 17 > 0 THEN text END AS headline FROM {documents}",
    vectors="SELECT vec_id AS file_name, embedding FROM {embeddings}",
)

_WORDS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"
_CELL = "(('0x' || md5(w)[1:7])::BIGINT % 32)"
_VEC = f"""SELECT file_name, {_CELL} AS cell, count(*)::DOUBLE AS n FROM (SELECT file_name, unnest({_WORDS.format('content')}) AS w FROM files) GROUP BY ALL"""

# Each document's vector as (cell, weight) rows, so that both engines can compare it.
check("q96_document_embeddings", "files", oracle=_VEC)(
    lambda f: c.document_embeddings(f, hashing_embedder()).select("file_name", F.posexplode("embedding").alias("cell", "n")).filter("n > 0"))


def _refuses_long(texts):
    if any(len(t) > 5000 for t in texts):
        raise ValueError("too long for the service")
    return [[1.0] for _ in texts]


check("q96_failed_embeddings", "files", oracle="SELECT file_name, NULL::VARCHAR AS embedding FROM files WHERE length(content) > 5000")(
    lambda f: c.failed_embeddings(f, _refuses_long).withColumn("embedding", F.to_json("embedding")))

_COS = """list_sum(list_transform(list_zip({a}, {b}), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))
   / sqrt(list_sum(list_transform({a}, lambda x: x::DOUBLE * x::DOUBLE)) * list_sum(list_transform({b}, lambda x: x::DOUBLE * x::DOUBLE)))"""


def _question(vectors):
    return vectors.agg(F.min_by("embedding", "file_name")).scalar()


check("q97_nearest_documents", "vectors", oracle=f"""
    WITH q AS (SELECT min_by(embedding, file_name) AS e FROM vectors)
    SELECT file_name, round({_COS.format(a='embedding', b='e')}, 9) AS similarity FROM vectors, q ORDER BY similarity DESC, file_name LIMIT 10""")(
    lambda v: c.nearest(v, _question(v)).withColumn("similarity", F.round("similarity", 9)))
check("q97_nearest_to_fixed_question", "vectors", oracle=f"""
    WITH q AS (SELECT [cos(i)::DOUBLE for i in range(len((SELECT any_value(embedding) FROM vectors)))] AS e)
    SELECT file_name, round({_COS.format(a='embedding', b='e')}, 9) AS similarity FROM vectors, q ORDER BY similarity DESC, file_name LIMIT 10""")(
    lambda v: c.nearest(v, _waves(v)).withColumn("similarity", F.round("similarity", 9)))


def _waves(vectors):
    import math
    return [math.cos(i) for i in range(vectors.agg(F.max(F.size("embedding"))).first()[0])]


check("x3_cosine_similarity", "vectors", oracle=f"""
    SELECT a.file_name, round({_COS.format(a='a.embedding', b='b.embedding')}, 9) AS similarity FROM vectors a JOIN vectors b ON b.file_name = a.file_name + 1""")(
    lambda v: v.alias("a").join(v.alias("b"), F.col("b.file_name") == F.col("a.file_name") + 1).select(
        "a.file_name", F.round(cosine_similarity("a.embedding", "b.embedding"), 9).alias("similarity")))

# Words that occur in the sample texts, so that every signal shows up.
SAMPLE_LEXICON = {"the": 1.0, "of": 0.5, "de": -1.0, "und": -0.75, "la": -0.25, "and": 0.25}
_S = " + ".join(f"len(list_filter(ws, lambda w: w = '{w}')) * {v}::DOUBLE" for w, v in SAMPLE_LEXICON.items())
check("q111_headline_signals", "news", oracle=f"""
    WITH t AS (SELECT *, coalesce({_WORDS.format('headline')}, []) AS ws FROM news), s AS (SELECT *, {_S} AS s FROM t)
    SELECT doc_id, headline, round(if(s = 0, 0, s / sqrt(s * s + 15)), 9) AS sentiment_score, CASE WHEN s / sqrt(s * s + 15) > 0.05 THEN 'BUY'
      WHEN s / sqrt(s * s + 15) < -0.05 THEN 'SELL' ELSE 'HOLD' END AS signal FROM s""")(
    lambda n: c.headline_signals(n, lexicon_scorer(SAMPLE_LEXICON)).withColumn("sentiment_score", F.round("sentiment_score", 9)))

check("x2_sentiment", "news", oracle=f"""
    WITH t AS (SELECT doc_id, coalesce({_WORDS.format('headline')}, []) AS ws FROM news), s AS (SELECT doc_id, {_S} AS s FROM t)
    SELECT doc_id, round(if(s = 0, 0, s / sqrt(s * s + 15)), 9) AS score FROM s""")(
    lambda n: n.select("doc_id", F.round(sentiment("headline", SAMPLE_LEXICON), 9).alias("score")))
check("x4_text_embedding", "files", oracle=f"""
    SELECT file_name, count(DISTINCT {_CELL}) AS cells, count(*) AS words FROM (SELECT file_name, unnest({_WORDS.format('content')}) AS w FROM files) GROUP BY 1""")(
    lambda f: f.select("file_name", text_embedding("content").alias("v")).select(
        "file_name", F.size(F.filter("v", lambda x: x > 0)).alias("cells"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("words")))
