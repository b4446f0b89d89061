"""Vector and archive operators and the pipeline against brute force and the SQL oracle."""

import gzip
import random

import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from tidemill.llm import annforest, neardup, warc
from tidemill.llm.common import connected_components
from tidemill.llm.queries import ORACLE, QUERIES
from tidemill.session import scratch_dir


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_oracle(spark, sf, name):
    assert compare(QUERIES[name](spark, sf).toPandas(), connect(sf).execute(ORACLE[name]).df()) == ""


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(100)] + [(5, 5), (7777, 7777)]
    low = {x: x for e in edges for x in e}
    while True:
        new = dict(low)
        for a, b in edges:
            new[a] = new[b] = min(new[a], new[b], low[a], low[b])
        if new == low:
            break
        low = new
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == low
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    got = {}
    for r in QUERIES["op5_nearest"](spark, sf).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = []
    assert set(got) == set(ids[ids % 100 == 0])
    for q, found in got.items():
        far = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != q][:10]
        hits.append(len({ids[i] for i in order} & {v for v, _ in found.values()}) / 10)
        assert sorted(found) == list(range(1, 11))
        assert [found[k][1] for k in range(1, 11)] == pytest.approx(sorted(far[np.searchsorted(ids, found[k][0])] for k in range(1, 11)))
    assert np.mean(hits) >= 0.9


VECTORS = "vec_id long, embedding array<float>, label int, id string, v int, g string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows, far = [], rng.standard_normal((12, 16))
    for i in range(600):
        v = far[i % 12] + rng.standard_normal(16) * 0.12
        rows.append((i, [float(a) for a in v], i % 3 if i % 17 else None, "c", 1, "d"))
    copy = rows[40][1]
    rows += [(1000 + i, copy, rows[40][2], "c", 1, "d") for i in range(300)]
    rows += [(2000, None, 1, "c", 1, "d"), (2001, [0.0] * 16, 1, "c", 1, "d"), (2002, [float("nan")] * 16, 1, "c", 1, "d"),
             (2003, [None] * 16, 1, "c", 1, "d"), (2004, [], 1, "c", 1, "d"), (2005, [float("inf")] * 16, 1, "c", 1, "d"),
             (None, copy, 1, "c", 1, "d")]
    return spark.createDataFrame(rows, VECTORS)


def test_neardup_matches_brute_force(vectors):
    rows = [r for r in vectors.collect()]
    good = [r for r in rows if r["vec_id"] is not None and r["embedding"] and r["label"] is not None
            and all(a is not None and np.isfinite(a) for a in r["embedding"]) and any(r["embedding"])]
    x = np.array([r["embedding"] for r in good])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r["label"] for r in good])
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(link, False)
    comp = np.array([r["vec_id"] for r in good])
    while True:
        new = np.array([min([comp[i], *comp[link[i]]]) for i in range(len(comp))])
        if (new == comp).all():
            break
        comp = new
    want = {r["vec_id"]: (int(link[i].sum()), int(comp[i])) for i, r in enumerate(good)}
    got = neardup.near_duplicates(vectors, block=64).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_links"], r["component"]) == want.get(r["id"], (0, r["id"]))


def test_forest_with_copies_and_odd_vectors(vectors):
    got = annforest.search(vectors, F.col("id") % 100 == 0, k=10).collect()
    assert {r["query_id"] for r in got} == {*range(0, 600, 100), 1000, 1100, 1200}
    near = [(r["id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 1000]
    assert near == [(i, 0.0) for i in [40, *range(1001, 1010)]]


def test_small_and_empty_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (100, [0.0, 1.0], 1), (3, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    got = [(r["query_id"], r["rank"], r["id"]) for r in annforest.search(few, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3), (0, 2, 100), (100, 1, 0), (100, 2, 3)]
    none = few.limit(0)
    assert annforest.search(none, F.col("id") % 100 == 0).count() == 0 and neardup.near_duplicates(none).count() == 0


def test_tiles_lose_no_pair():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((5, 24))[rng.integers(0, 5, 200)] + rng.standard_normal((200, 24)) * 0.2
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    axes = np.linalg.eigh(u.T @ u)[1][:, ::-1]
    i, j = neardup.tile_links(u @ axes, u @ axes, 0.9, (4, 8))
    assert set(zip(*np.nonzero(u @ u.T >= 0.9))) <= set(zip(i.tolist(), j.tolist()))


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\n中</p>" * 9000
    rows = [(1, "http://a\r\nX: y", "a" * 2000), (7, "u", "a" * 2000), (3, None, "a" * 2000), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (8, "u", ""), (9, "u", long), (10, "u", long), (11, "u", long + "x"), (None, "u", "n" * 1500)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archives_come_back(spark, pages):
    path = scratch_dir(spark, "warc")
    warc.write_archives(pages, path, segment=5000, per_file=10)
    records = warc.read_records(spark, path)
    assert records.where("record_type = 'continuation'").count() > 50
    logical = warc.reassemble(records)
    assert logical.where("damage is not null").count() == 0
    got = {r["page_id"]: r for r in warc.page_table(logical).collect()}
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    assert set(got) == set(want)
    assert {k: (r["record_type"], r["refers_to"]) for k, r in got.items() if r["refers_to"]} == {
        1: ("revisit", 7), 3: ("revisit", 7), 9: ("revisit", 10)}
    payloads = {r["page_id"]: bytes(r["payload"]) for r in logical.where("payload is not null").collect()}
    assert all(payloads[k] == want[k] for k in payloads) and set(payloads) == set(want) - {1, 3, 9}
    assert all(r["payload_bytes"] == len(want[k]) for k, r in got.items())


def test_damaged_segments_are_named(spark, pages):
    path = scratch_dir(spark, "warc")
    warc.write_archives(pages, path, segment=5000, per_file=10)
    records = warc.read_records(spark, path)
    lost = warc.reassemble(records.where("segment is null or segment <> 2")).where("page_id in (10, 11)").collect()
    assert all("gap" in r["damage"] and r["payload"] is None for r in lost) and len(lost) == 2
    cut = warc.reassemble(records.where("total is null or segment is null")).where("page_id in (10, 11)").collect()
    assert all("total" in r["damage"] for r in cut)


def test_chunks_and_gzip_members():
    body = bytes(range(256)) * 50
    assert warc.dechunked(warc.chunked(body, 100)) == body
    assert warc.dechunked(b"5;a=b\r\nhello\r\n0\r\nT: x\r\n\r\n") == b"hello"
    with pytest.raises(ValueError):
        warc.dechunked(b"ff\r\nhello\r\n0\r\n\r\n")
    records = [r + b"\r\n\r\n" for r in warc.records_of(1, "u", body, None, 300)]
    plain = list(warc.parse_records(b"".join(records)))
    assert plain == list(warc.parse_records(b"".join(map(gzip.compress, records)))) and len(plain) > 10


def test_empty_pages(spark, pages):
    path = scratch_dir(spark, "warc")
    warc.write_archives(pages.limit(0), path)
    assert warc.page_table(warc.reassemble(warc.read_records(spark, path))).count() == 0


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("spans", F.lit("x")).withColumn("id", F.lit(1))
    extra = spark.createDataFrame([(None, None, None, None, None, "x", 2), (-5, "", "en", "s", 0, "x", 2),
                                   (-7, "mail me@example.org", "en", "s", 19, "x", 2), (-7, "mail me@example.org", "en", "s", 19, "x", 2)], docs.schema)
    docs = docs.unionByName(extra)
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs.count(), stage(spark, docs, sf).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "id"] and 0 < docs.count() <= before, name
        if name == "simhash_near_dedup":
            assert docs.where("doc_id = -7").count() == 1
            prints = QUERIES["op3_simhash"](spark, sf).where("doc_id <> component_id").select("doc_id")
            assert docs.join(prints, "doc_id").count() == 0
        if name == "pii":
            assert docs.where("doc_id = -7").first()["text"] == "mail <EMAIL>"
    assert pipeline.STAGES[-1][1](spark, docs, sf).where("round_trip = false").count() == 0
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_near_duplicates_go_by_row(spark, sf):
    import corpus_pipeline as pipeline

    rng = random.Random(2)
    one, two, three = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(80)) for _ in range(3))
    rows = [(5, one), (5, two), (4, one), (6, two), (6, two), *[(None, three)] * 40, (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in pipeline.drop_near_duplicates(spark, docs, sf).collect()), key=str)
    assert got == sorted([(4, one), (5, two), (None, three)], key=str)
