"""Secrets in texts, told apart by how many owners hold them.

Patterns propose candidates with their places.  Every candidate value is hashed,
and the hashes are counted over the whole corpus by distinct repositories and
distinct owners.  A value that many owners hold is an example that people copy;
one that a single owner holds, and that looks random, may be a live credential.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import stored


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the secret value, and the least length of that value."""

    pattern: str
    group: int = 0
    least: int = 1


ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

#: Base kinds first.  A run shorter than the least length starts no match of its kind, so the length of a run stands in the pattern.
BASE: Mapping[str, Kind] = {
    "assign": Kind(ASSIGN, 2, 6),
    "access": Kind(r"AKIA[A-Z0-9]{16,}"),
    "hex": Kind(r"[0-9a-f]{24,}"),
}
ADDED: Mapping[str, Kind] = {
    "private_key": Kind(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    "code_host": Kind(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "url_login": Kind(r"://[^\x00-\x20/:@]{1,64}:([^\x00-\x20/:@]{1,128})@", 1, 1),
}
BLOCK = 256


def _running(steps: Column) -> Column:
    """Running totals of a short array."""
    return F.transform(steps, lambda _, i: F.aggregate(F.slice(steps, 1, i + 1), F.lit(0), lambda s, x: s + x))


def _ends(steps: Column) -> Column:
    """Running totals of an array of any length: inside blocks, and over the totals of blocks."""
    size = F.size(steps)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x))
    after = _running(totals)
    inner = F.transform(blocks, lambda b, i: F.transform(_running(b), lambda x: x + F.element_at(after, i + 1) - F.element_at(totals, i + 1)))
    return F.when(size > 0, F.flatten(inner)).otherwise(F.array().cast("array<int>"))


def _matches(df: DataFrame, text: str, name: str, place: int, kind: Kind) -> DataFrame:
    """``df`` with an array of the matches of a kind: (start, place, end, kind, value), code points, end exclusive.

    The parts between the matches give their places.  Texts without a match are read once.
    """
    whole, value, gaps, ends = (f"_{x}" for x in ("whole", "value", "gaps", "ends"))
    df = df.withColumn(whole, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)))
    some = F.size(whole) > 0
    none = F.array().cast("array<string>")
    df = df.withColumn(value, F.when(some, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))).otherwise(none) if kind.group else F.col(whole))
    df = df.withColumn(gaps, F.when(some, F.transform(F.split(text, kind.pattern, -1), F.length)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(ends, _ends(F.zip_with(whole, F.slice(F.col(gaps), 1, F.size(whole)), lambda m, g: F.length(m) + g)))
    found = F.transform(F.arrays_zip(F.col(whole).alias("whole"), F.col(value).alias("value"), F.col(ends).alias("end")), lambda m: F.struct(
        (m["end"] - F.length(m["whole"])).alias("start"), F.lit(place).alias("place"), m["end"].alias("end"), F.lit(name).alias("kind"), m["value"].alias("value")))
    return df.withColumn(f"_{name}", F.filter(found, lambda m: F.length(m["value"]) >= kind.least)).drop(whole, value, gaps, ends)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source",
               repo_col: str | None = None) -> DataFrame:
    """(id, owner, repo, spans) of every row; spans are ordered by start, then kind, and carry the hash of their value.

    ``repo`` is the hash of the text where no column names the repository, so
    that exact copies of a document count once.  A null text is empty; null
    owners are one unnamed owner.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    owner = F.col(f"`{owner_col}`").cast("string") if owner_col else F.lit(None).cast("string")
    df = docs.select(F.col(f"`{id_col}`").alias("id"), owner.alias("owner"), text.alias("_text"),
                     *([F.col(f"`{repo_col}`").cast("string").alias("repo")] if repo_col else []))
    kinds = {**BASE, **ADDED}
    for place, (name, kind) in enumerate(kinds.items()):
        df = _matches(df, "_text", name, place, kind)
    spans = F.array_sort(F.concat(*[F.col(f"_{name}") for name in kinds]))
    df = df.withColumn("_spans", spans)
    shaped = F.transform("_spans", lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                                                      F.sha2(m["value"], 256).alias("hash"), _random_looking(m["kind"], m["value"]).alias("random")))
    some = F.size("_spans") > 0
    repo = F.col("repo") if repo_col else F.when(some, F.sha2("_text", 256))
    return df.select("id", "owner", repo.alias("repo"), F.when(some, F.sha2("_text", 256)).alias("text_hash"), shaped.alias("spans"))


def _random_looking(kind: Column, value: Column) -> Column:
    """Digits beside letters and eight different characters or more; a private-key header always counts."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
    return mixed | (kind == "private_key")


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each candidate hash: (hash, owners, repos).

    Grouped by (hash, owner) and (hash, repository) before the hash alone, so a
    value that stands in a third of all rows reaches its last task as a few counts.
    """
    values = found.select(F.explode("spans.hash").alias("hash"), "owner", "repo")
    return values.groupBy("hash").agg(F.count_distinct(F.struct("owner")).alias("owners"), F.count_distinct(F.struct("repo")).alias("repos"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source",
         repo_col: str | None = None, example_owners: int = 3) -> DataFrame:
    """Spans of every row with the owners and repositories of their value and a verdict.

    (id, spans): a span is (kind, start, end, hash, owners, repos, verdict).  The
    verdict is ``example`` for a value of ``example_owners`` owners or more,
    else ``live`` if it looks random, else ``plain``.  One result row per input
    row, repeated rows included; null and empty texts have no spans; an empty
    table gives no rows; further columns of ``docs`` do not matter.
    """
    found = stored(candidates(docs, id_col, text_col, owner_col, repo_col))
    hits = found.where(F.size("spans") > 0)
    # Equal texts hold equal spans: each is joined with the counts once.
    held = hits.select("text_hash", F.explode("spans.hash").alias("hash")).distinct()
    counts = held.join(ownership(hits), "hash").groupBy("text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("hash", F.struct("owners", "repos")))).alias("counts"))

    def judged(span: Column) -> Column:
        n = F.element_at("counts", span["hash"])
        verdict = F.when(n["owners"] >= example_owners, "example").when(span["random"], "live").otherwise("plain")
        return F.struct(*[span[c].alias(c) for c in ("kind", "start", "end", "hash")], n["owners"].alias("owners"),
                        n["repos"].alias("repos"), verdict.alias("verdict"))

    told = hits.join(counts, "text_hash").select("id", F.transform("spans", judged).alias("spans"))
    kind = told.schema["spans"].dataType
    return told.unionByName(found.where(F.size("spans") == 0).select("id", F.array().cast(kind).alias("spans")))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts by base kind and verdict, the hash of the base spans and all spans as text."""

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return scanned.select("id", *[count("kind", k).alias(f"n_{k}") for k in BASE], F.sha2(shown(base), 256).alias("base_sha256"),
                          shown(F.col("spans")).alias("spans"), count("verdict", "live").alias("n_live"), count("verdict", "example").alias("n_example"))
