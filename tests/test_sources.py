"""Connectors, files, profiles and writers."""

import pytest
from pyspark.sql import functions as F

from tidemill.sinks import writers
from tidemill.sinks.keyed import KeyedTable
from tidemill.sources import cdc, decode, files, profiles


def test_kafka_options():
    assert decode.kafka_options("b:9092", "t") == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest"}
    assert decode.kafka_options("b:9092", "t", "1700000000000")["startingTimestamp"] == "1700000000000"
    assert decode.kafka_options("b:9092", "t", "latest", max_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    for bad in (lambda: decode.kafka_options("b", "t", "latest", stream=False), lambda: decode.kafka_options("b", "t", "yesterday")):
        with pytest.raises(ValueError):
            bad()


def test_jdbc_options():
    assert files.jdbc_query_options("jdbc:x", "SELECT 1", "u", "p") == {"url": "jdbc:x", "query": "SELECT 1", "fetchsize": "10000", "user": "u", "password": "p"}
    assert files.jdbc_table_options("jdbc:x", "t", "id", 0, 100, 8)["numPartitions"] == "8"


def test_intervals_from_numbers(spark):
    raw = spark.createDataFrame([('{"flight": "a", "delay": 90}',), ('{"flight": "b"}',)], "value string")
    got = decode.decode_json(raw, "flight string, delay int", intervals=("delay",))
    assert [r[0] for r in got.orderBy("flight").select(F.col("delay") >= F.expr("INTERVAL '1' HOUR")).collect()] == [True, None]


def test_text_tree_is_keyed_by_path(spark, tmp_path):
    (tmp_path / "docs" / "sql").mkdir(parents=True)
    (tmp_path / "docs" / "a.md").write_text("first\nsecond\n")
    (tmp_path / "docs" / "sql" / "b.md").write_text("third")
    (tmp_path / "docs" / "skip.bin").write_text("no")
    got = {r.file_name.rsplit("/docs/")[1]: r.content for r in files.read_text_tree(spark, str(tmp_path / "docs"), "*.md").collect()}
    assert got == {"a.md": "first\nsecond\n", "sql/b.md": "third"}


def test_infer_fields(spark):
    lines = ['{"id": 1, "price": 2.5, "big": 12345678901, "at": "2024-01-01T00:00:00Z", "name": "x", "ok": true, "mixed": 1}',
             '{"id": 2, "price": 3, "at": null, "name": "7", "mixed": "word"}', "garbage"]
    fields = files.infer_fields(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {r.field: (r.type, r.messages) for r in fields.collect()} == {
        "id": ("INT", 2), "price": ("DECIMAL", 2), "big": ("BIGINT", 1), "at": ("TIMESTAMP", 1), "name": ("VARCHAR", 2), "ok": ("BOOLEAN", 1), "mixed": ("VARCHAR", 2)}
    assert files.declared_schema(fields).startswith("at timestamp, big bigint, id int, mixed string")


def test_onboarding_a_topic(spark):
    """Infer, decode with the inferred schema, profile."""
    raw = spark.createDataFrame([('{"sku": "a", "qty": 2}',), ('{"sku": "b", "qty": 5}',), ('{"sku": "a"}',)], "value string")
    table = decode.decode_json(raw, files.declared_schema(files.infer_fields(raw)))
    stats = {r.column: (r.rows, r.nulls, r.minimum, r.maximum) for r in files.profile(table).collect()}
    assert stats == {"sku": (3, 0, "a", "b"), "qty": (3, 1, "2", "5")}
    assert [tuple(r) for r in files.describe(spark, table).collect()] == [("qty", "int", True), ("sku", "string", True)]


def test_envelopes(spark):
    lines = ['{"op": "r", "ts_ms": 1000, "after": {"id": 1, "v": "a"}}', '{"op": "c", "ts_ms": 2000, "source": {}, "after": {"id": 2, "v": "b"}}',
             '{"op": "u", "ts_ms": 3000, "before": {"id": 1, "v": "a"}, "after": {"id": 1, "v": "z"}}', '{"op": "d", "ts_ms": 4000, "before": {"id": 2, "v": "b"}, "after": null}',
             '{"op": "m", "ts_ms": 5000}']
    changes = cdc.decode_envelope(spark.createDataFrame([(x,) for x in lines], "value string"), "id int, v string")
    assert [tuple(r) for r in cdc.mirror(changes, ["id"]).collect()] == [(1, "z")]
    assert cdc.mirror(changes, ["id"], commit_ts=True).select(F.unix_seconds("commit_ts")).first()[0] == 3


def test_envelopes_go_by_the_upstream_log(spark):
    """Ties within a millisecond, snapshot rows without a place, and log files in order."""
    body = '"before": null, "after": {{"id": {0}, "v": "{1}"}}'
    change = lambda id, v, op, ts, source: f'{{"op": "{op}", "ts_ms": {ts}, "source": {source}, ' + body.format(id, v) + "}"
    lines = [change(1, "new", "u", 5, '{"lsn": 12, "ts_ms": 3}'), change(1, "old", "u", 5, '{"lsn": 11, "ts_ms": 3}'),
             change(2, "logged", "u", 5, '{"lsn": 7, "ts_ms": 2}'), change(2, "read", "r", 9_000_000, '{"ts_ms": 8000000}'),
             change(3, "b", "u", 5, '{"file": "bin.000002", "pos": 4, "row": 0}'), change(3, "a", "u", 5, '{"file": "bin.000001", "pos": 900, "row": 1}')]
    for order in (lines, lines[::-1]):
        changes = cdc.decode_envelope(spark.createDataFrame([(x,) for x in order], "value string"), "id int, v string")
        got = {r["id"]: r for r in cdc.mirror(changes, ["id"], commit_ts=True).withColumn("ms", F.unix_millis("commit_ts")).collect()}
        assert {k: r["v"] for k, r in got.items()} == {1: "new", 2: "logged", 3: "b"}
        assert got[1]["ms"] == 3 and got[3]["ms"] == 5


def test_exact_profile_lists_every_column(spark):
    rows = spark.createDataFrame([(1, 2.5, None), (1, 3.5, None)], "a int, b double, c string")
    got = {r["column"]: (r["distinct_values"], r["nulls"]) for r in files.profile(rows, exact=True).collect()}
    assert got == {"a": (1, 0), "b": (2, 0), "c": (0, 2)}


def test_an_empty_snapshot_stays_empty(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["k"], cluster_by=["k"], buckets=4)
    table.apply(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), 0)
    table.replace(spark, table.read(spark).limit(0))
    assert table.read(spark).count() == 0
    table.apply(spark.createDataFrame([(3, "c")], "k int, v string"), 1)
    assert [r["k"] for r in table.read(spark).collect()] == [3]


def test_change_numbers_have_no_bands(spark):
    from tidemill.checks.streams import _feed_upsert

    feed = spark.createDataFrame([(7, 1, "a", 5, "c"), (7, 1, "z", 900_000_000_000, "u"), (8, 1, "a", 6, "c"), (8, 1, "a", 400_000_001, "d")],
                                 "trip_id long, rider_id long, trip_status string, seq long, op string").withColumn("commit_ts", F.lit(None).cast("timestamp"))
    assert [(r["trip_id"], r["trip_status"]) for r in _feed_upsert(spark, feed).collect()] == [(7, "z")]


def test_tables_are_created_then_appended(spark):
    rows = spark.range(3).withColumn("v", F.lit("x"))
    writers.append_to_table(spark, rows, "tm_append")
    writers.append_to_table(spark, rows.select("v", "id"), "tm_append")
    assert spark.table("tm_append").count() == 6
    writers.create_table_as(rows.select(F.col("id").cast("string").alias("id")), "tm_copy")
    assert spark.table("tm_copy").schema.simpleString() == "struct<id:string>"
    spark.sql("DROP TABLE tm_append")
    spark.sql("DROP TABLE tm_copy")


def test_messages_and_defaults(spark):
    rows = spark.createDataFrame([(1, None)], "id int, v string")
    assert tuple(writers.as_messages(rows, key=["id"]).first()) == ('{"id":1}', '{"id":1}')
    assert tuple(writers.with_defaults(rows, {"v": "d", "w": 5}).first()) == (1, "d", 5)


def test_scratch_dir_prefers_the_shared_folder(spark):
    from tidemill.session import scratch_dir
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_merged_profiles_equal_one_scan(spark, tmp_path):
    """Counts and extremes are exact, sketches lie in their bound, a batch that runs twice counts once, and data rows are not read again."""
    from decimal import Decimal

    rows = [(i, None if i % 5 == 0 else i % 700, f"t{i % 90}", Decimal(i) / 4, [i], (i % 3 == 0, float(i))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, n int, s string, d decimal(12,2), a array<long>, p struct<ok: boolean, x: double>")
    view = profiles.ProfileView(str(tmp_path / "p"))
    assert view.read(spark) is None
    for i in (0, 1, 1, 2, 3):
        view.handler(df.where(F.col("id") % 4 == i).limit(0) if i == 3 else df.where(F.col("id") % 3 == i), i)
    got = {r["column"]: r for r in view.read(spark).collect()}
    assert set(got) == {"id", "n", "s", "d", "a", "p.ok", "p.x"}
    assert [(got[c]["rows"], got[c]["nulls"], got[c]["minimum"], got[c]["maximum"]) for c in ("id", "n", "s", "d", "p.ok")] == [
        (3000, 0, "0", "2999"), (3000, 600, "1", "699"), (3000, 0, "t0", "t9"), (3000, 0, "0.00", "749.75"), (3000, 0, "false", "true")]
    assert got["a"]["rows"] == 3000 and got["a"]["distinct_about"] is None
    assert abs(got["id"]["distinct_about"] - 3000) < 3000 * 0.06 and abs(got["n"]["distinct_about"] - 560) < 560 * 0.06
    assert abs(got["p.x"]["median_about"] - 1500) < 3000 * 0.04
    state = view.state(spark)
    assert profiles.profile_of(profiles.merged(state)).select("column", "rows").exceptAll(view.read(spark).select("column", "rows")).count() == 0


def test_nested_fields(spark):
    texts = ['{"a": 1, "b": {"c": [1, 2], "d": null}, "e": [{"f": "x"}]}', '{"a": 2.5, "b": {"c": []}}', '{"e": [{"g": true}], "z": "t"}', "[1]", "nope", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert {(r["field"], r["type"]) for r in profiles.nested_fields(df).collect()} == {
        ("a", "DECIMAL(21,1)"), ("b.c[]", "BIGINT"), ("b.d", "VOID"), ("e[].f", "STRING"), ("e[].g", "BOOLEAN"), ("z", "STRING")}
    assert profiles.nested_fields(df.limit(0)).count() == 0
