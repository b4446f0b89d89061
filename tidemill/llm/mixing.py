"""Mixing documents to target domain weights with soft memberships; DataFrame functions throughout."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import stored

BUCKETS = 8192  # per kind of feature


class Classifier(NamedTuple):
    """Naive Bayes over hashed word beginnings and endings: log odds against the first domain."""

    domains: tuple[str, ...]
    prior: tuple[float, ...]
    front: tuple[tuple[float, ...], ...]
    back: tuple[tuple[float, ...], ...]


def _words(docs: DataFrame, *more: str) -> DataFrame:
    """A row per word ``w`` of the column ``text``, cut at space and \\x09-\\x0D; ``parts`` is the number of rows.

    Leading, trailing and repeated space gives empty words, which callers count as none.
    """
    line = F.coalesce("text", F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        line = F.replace(line, F.lit(space), F.lit(" "))
    return (docs.select(*more, F.split(line, " ").alias("words"))
            .select(*more, F.size("words").alias("parts"), F.explode("words").alias("w")))


def _front() -> Column:
    return F.pmod(F.xxhash64(F.substring("w", 1, 4)), F.lit(BUCKETS)).cast("int")


def _back() -> Column:
    return F.pmod(F.xxhash64(F.substring("w", -2, 2)), F.lit(BUCKETS)).cast("int")


def _table(values: tuple[float, ...]) -> Column:
    """A constant array: one string literal, folded once by the planner."""
    return F.split(F.lit(",".join(f"{v:.4g}" for v in values)), ",").cast("array<double>")


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", domain_col: str = "domain", most_rows: int = 20_000) -> Classifier:
    """Learn word statistics of each domain from at most ``most_rows`` labelled documents, those of smallest id hash.

    ``labelled`` names the domain of some documents; null ids and domains teach
    nothing, and an id with several domains counts as the first by name.  Only
    2 x BUCKETS counts per domain reach the driver.
    """
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ids = (labelled.select(F.col(f"`{label_id}`").cast("long").alias("id"), F.col(f"`{domain_col}`").cast("string").alias("domain"))
           .dropna().groupBy("id").agg(F.min("domain").alias("domain")))
    ids = ids.join(named.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(most_rows)
    words = _words(named.join(F.broadcast(ids), "id"), "domain").where("w <> ''")  # at most most_rows ids
    cells = words.select("domain", F.explode(F.array(F.struct(F.lit(0).alias("kind"), _front().alias("b")),
                                                     F.struct(F.lit(1).alias("kind"), _back().alias("b")))).alias("x"))
    counts = cells.groupBy("domain", "x.kind", "x.b").count().collect()
    rows = {r["domain"]: r["n"] for r in ids.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = tuple(sorted(rows))
    if not domains:
        return Classifier((), (), (), ())
    tables = {(d, k): [0.5] * BUCKETS for d in domains for k in (0, 1)}
    for r in counts:
        tables[r["domain"], r["kind"]][r["b"]] += r["count"]

    def odds(kind: int) -> tuple[tuple[float, ...], ...]:
        all_of = {d: sum(tables[d, kind]) for d in domains}
        logs = {d: [math.log(c / all_of[d]) for c in tables[d, kind]] for d in domains}
        return tuple(tuple(a - b for a, b in zip(logs[d], logs[domains[0]])) for d in domains[1:])

    prior = tuple(math.log(rows[d] / rows[domains[0]]) for d in domains[1:])
    return Classifier(domains, prior, odds(0), odds(1))


def memberships(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text",
                weight: float = 60.0) -> DataFrame:
    """(id, text_hash, n, copies_in, p0, p1, ...): words of each document and its posterior of each domain.

    The log odds of a document are the mean over its words times
    ``weight``, or times its number of words if that is less: so many
    words' worth of evidence keeps memberships of long texts soft.  Whole texts
    count.  Words are summed within the task that reads them, so one row per
    document is shuffled.  Equal rows are one row with their number.
    """
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    named = named.withColumn("text_hash", F.xxhash64("text"))
    k = range(len(model.domains) - 1)
    words = _words(named, "id", "text_hash").withColumn("f", _front() + 1).withColumn("b", _back() + 1)
    there = F.col("w") != ""
    odds = [F.when(there, F.element_at(_table(model.front[i]), F.col("f")) + F.element_at(_table(model.back[i]), F.col("b")))
            .otherwise(0.0).alias(f"o{i}") for i in k]
    sums = (words.select("id", "text_hash", "parts", there.cast("int").alias("one"), *odds).groupBy("id", "text_hash", "parts")
            .agg(*[F.sum(f"o{i}").alias(f"o{i}") for i in k], F.sum("one").alias("n"), F.count(F.lit(1)).alias("rows")))
    # Equal rows were summed together.
    sums = sums.withColumn("copies_in", (F.col("rows") / F.col("parts")).cast("long")).select(
        "id", "text_hash", "copies_in", *[(F.col(f"o{i}") / F.greatest("n", F.lit(1))).alias(f"o{i}") for i in k],
        (F.col("n") / F.col("copies_in")).cast("long").alias("n"))
    strength = F.least(F.col("n"), F.lit(weight))
    logits = [F.lit(0.0)] + [F.lit(model.prior[i]) + F.col(f"o{i}") * strength for i in k]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    parts = [F.exp(z - F.col("top")).alias(f"e{i}") for i, z in enumerate(logits)]
    soft = sums.withColumn("top", top).select("id", "text_hash", "n", "copies_in", *parts)
    total = sum((F.col(f"e{i}") for i in range(len(logits))), F.lit(0.0))
    return soft.select("id", "text_hash", "n", "copies_in", *[(F.col(f"e{i}") / total).alias(f"p{i}") for i in range(len(logits))])


def solve(members: DataFrame, targets: list[float], hold: int | None = None, min_rate: float = 0.0,
          max_rate: float | None = None, rounds: int = 30, tolerance: float = 1e-4) -> tuple[DataFrame, list[float]]:
    """``members`` with ``rate``, and the expected token totals reached per domain.

    Projected gradient for: find rates r_i in [min_rate, max_rate] that minimise
    the squared distance of A(r) from t, where A_d(r) = sum_i r_i n_i p_id are
    the expected tokens and t_d is target d's share of as many tokens as there
    are, or, with ``hold``, of so many that domain ``hold`` keeps its tokens.
    Rates start at 1.  Gradients are taken in the metric that weighs a document
    by its tokens, and are scaled by the inverse of sum_i n_i p_i p_i' over the
    documents that are not at a bound: without bounds the first step meets the
    targets.  A step that does not bring A(r) nearer is halved.  A round is one
    aggregation of a few sums, and the driver holds a few numbers per round.  It
    ends when all domains are within ``tolerance`` of their targets or steps no
    longer help, as where bounds put a target out of reach.  Rates are written
    to the shared folder every ten steps.
    """
    k = range(len(targets))
    n = F.col("n") * F.col("copies_in")

    def sums(df: DataFrame, values: list[Column]) -> np.ndarray:
        row = df.agg(*[F.sum(n * v).alias(f"a{i}") for i, v in enumerate(values)]).first()
        return np.array([float(x or 0.0) for x in row])

    def products(rate: Column) -> list[Column]:
        free = rate > min_rate if max_rate is None else (rate > min_rate) & (rate < max_rate)
        return [F.when(free, F.col(f"p{i}") * F.col(f"p{j}")).otherwise(0.0) for i in k for j in k]

    def rate_after(steps: list[np.ndarray]) -> Column:
        rate = F.col("rate")
        for g in steps:
            rate = F.greatest(F.lit(min_rate), rate - sum((F.col(f"p{d}") * F.lit(float(g[d])) for d in k), F.lit(0.0)))
            rate = rate if max_rate is None else F.least(F.lit(float(max_rate)), rate)
        return rate

    squares = sums(members, [F.col(f"p{i}") * F.col(f"p{j}") for i in k for j in k]).reshape(len(targets), -1)
    share = squares.sum(axis=1)  # posteriors add up to 1
    every = share.sum()
    weight = sum(targets) or 1.0
    whole = every if hold is None or not targets[hold] else share[hold] / targets[hold] * weight
    goal = np.array(targets) / weight * whole
    held, reached, active = members.withColumn("rate", F.lit(1.0)), share, squares
    steps: list[np.ndarray] = []
    halved = 0
    for _ in range(rounds if every > 0 else 0):
        gap = reached - goal
        if (np.abs(gap) <= tolerance * np.maximum(goal, 1e-3 * whole)).all() or halved > 4:
            break
        if len(steps) == 10:
            held, steps = stored(held.withColumn("rate", rate_after(steps))), []
        # Free documents alone may not span all domains: all documents back them up.
        step = np.linalg.solve(active + 0.01 * squares + np.eye(len(targets)) * (1e-9 * every), gap) * 0.5 ** halved
        rate = rate_after([*steps, step])
        got = sums(held, [*(rate * F.col(f"p{d}") for d in k), *products(rate)])
        if np.linalg.norm(got[:len(targets)] - goal) > np.linalg.norm(gap) * 0.999:
            halved += 1
            continue
        steps, halved = [*steps, step], 0
        reached, active = got[:len(targets)], got[len(targets):].reshape(len(targets), -1)
    return held.withColumn("rate", rate_after(steps)), reached.tolist()


def mix(docs: DataFrame, model: Classifier, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        hold: str | None = None, min_rate: float = 0.0, max_rate: float | None = None) -> DataFrame:
    """(id, text_hash, n_tokens, rate, copies, p_<domain> ..): how often each document should be taken.

    Posteriors of the classifier are soft memberships; ``solve`` fits a
    nonnegative rate per document so that the expected tokens of each domain
    match the target weights.  ``copies`` rounds the rate up or down by a hash
    of id and text, so its mean is the rate and it is the same in every run.

    A domain without a target has weight 0.  Null and empty texts have no
    tokens and posteriors as the prior says.  Equal rows keep one result row
    each, with equal rates.  A null id is allowed.  Without a labelled domain
    every rate is 1; an empty table gives an empty result.
    """
    if not model.domains:
        model = Classifier(("all",), (), (), ())
        targets = {"all": 1.0}
    members = stored(memberships(docs, model, id_col, text_col))
    held = model.domains.index(hold) if hold in model.domains else None
    rated, _ = solve(members, [float(targets.get(d, 0.0)) for d in model.domains], held, min_rate, max_rate)
    toss = F.pmod(F.xxhash64("id", "text_hash"), F.lit(1 << 40)) / float(1 << 40)
    out = rated.select("id", "text_hash", F.col("n").alias("n_tokens"), "rate",
                       F.floor(F.col("rate") + toss).cast("long").alias("copies"),
                       *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(model.domains)], "copies_in")
    return out.withColumn("copies_in", F.explode(F.sequence(F.lit(1), F.col("copies_in")))).drop("copies_in")
