"""Corpus pipeline: toxicity, near-duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``.  Stages stand any extra columns, null ids
and texts, repeated rows and an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import mixing, pieces, pii, simhash, toxicity
from tidemill.llm.queries import MODEL_FILE, labelled_domains, table, toxic_chain
from tidemill.session import stored, tune

ROW = "carried_row"
KEY = "dedup_key"


def _carried(docs: DataFrame) -> DataFrame:
    """Each row as one value beside its text, so that a pass over texts takes the row along without a join."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), F.col("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic; null and empty texts stay."""
    chain = toxic_chain(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_carried(docs), chain, id_col=ROW)
    return scored.where(F.col("toxic") <= chain.cuts[-1]).select("id.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group one row, that of smallest doc_id, a null one last; rows go by doc_id and text."""
    keyed = docs.withColumn(KEY, F.xxhash64("doc_id", F.col("text").cast("string")))
    found = simhash.near_duplicates(keyed, id_col=KEY, width=3, distance=3).select(F.col("id").alias(KEY), "component").distinct()
    named = keyed.select(KEY, "doc_id").distinct().join(found, KEY)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", KEY))[KEY]
    kept = named.groupBy("component").agg(best.alias(KEY)).select(KEY)
    return keyed.join(kept, KEY, "left_semi").dropDuplicates([KEY]).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every personal-data span replaced by its kind, n_chars following."""
    found = pii.pii_spans(_carried(docs), id_col=ROW)
    new = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.size("spans") > 0, F.length("masked").cast(kind)).otherwise(F.col("id.n_chars"))
    return found.select(*[new.get(c, F.col(f"id.`{c}`")).alias(c) for c in docs.columns])


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents thinned so that junk makes up about 5 % of the expected tokens, prose staying whole.

    Without replacement: a rate is at most 1, and a document stays if its rate,
    rounded up or down by a hash, is 1.
    """
    model = mixing.fit(docs, labelled_domains(table(spark, sf_dir, "labels")))
    mixed = mixing.mix(docs, model, {"prose": 0.95, "junk": 0.05}, hold="prose", max_rate=1.0)
    gone = mixed.where("copies = 0").select("id", "text_hash").distinct()
    mark = docs.withColumn("mix_hash", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(gone["id"]) & F.col("mix_hash").eqNullSafe(gone["text_hash"])
    return mark.join(gone, same, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of each document."""
    return pieces.encode_texts(docs, MODEL_FILE).select(
        F.col("id").alias("doc_id"), F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long").alias("n_tokens"),
        "ids", "round_trip")


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates), ("pii", mask_personal_data),
          ("mixing", mix_domains), ("sentencepiece", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
