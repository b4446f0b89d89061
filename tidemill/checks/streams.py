"""Checks that run on Structured Streaming, and source and sink checks.

The streaming checks land a sample table as several files whose rows are mixed
in time, replay them one file per micro-batch, and compare the final state with
the batch oracle: late rows must count.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tidemill.checks import logistics as logistics_checks
from tidemill.checks import segments as segments_checks
from tidemill.checks.harness import check, declare
from tidemill.functions.scalar import moment, span
from tidemill.operators import diff_results, hop, latest_by, range_frame, tumble, upsert
from tidemill.plans import energy, health, markets, pricing, web
from tidemill.session import scratch_dir
from tidemill.sinks import writers
from tidemill.sinks.keyed import KeyedTable
from tidemill.sinks.staged import StagedUpserts
from tidemill.sources import cdc, decode, files, landed
from tidemill.sources.profiles import ProfileView, nested_fields
from tidemill.streaming.joins import interval_join, outer_interval_view
from tidemill.streaming.catalog import VIEWS
from tidemill.streaming.expiry import present, retained, rocks_state, running_totals
from tidemill.streaming.runners import Keyed, MaintainedView, Slots, start_append, start_handler, start_native
from tidemill.streaming.views import ViewGraph

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
FILES = 3
FILE_ROWS = 250_000


@contextmanager
def small_state(spark):
    """A state partition for two cores, whatever the master: a replay is a few short batches, and each opens every partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(before), max(1, spark.sparkContext.defaultParallelism // 2))))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def as_stream(spark, df, parts: int = FILES):
    """Land a frame as files mixed in time, and replay them as a stream of ``parts`` batches.

    A batch is one file, or several where one would hold more than ``FILE_ROWS`` rows: more rows are landed and read by more tasks.
    """
    path = scratch_dir(spark, "landing")
    each = max(1, -(-df.count() // (parts * FILE_ROWS)))
    df.repartition(parts * each, F.xxhash64(*df.columns)).write.parquet(path)
    return files.replay(spark, path, df.schema, max_files=each)


def native(spark, plan, keys, *frames, mode="update"):
    """Final state of a native streaming plan over replayed frames."""
    table = KeyedTable(scratch_dir(spark, "result"), keys)
    with small_state(spark):
        query = start_native(plan(*[as_stream(spark, f) for f in frames]), table, scratch_dir(spark, "checkpoint"), mode=mode)
        query.awaitTermination()
    return table.read(spark)


def maintained(spark, compute, keys, scope, derive=None, keyed=None, slots=None, **frames):
    """Final state of a maintained view over replayed frames."""
    view = MaintainedView(scratch_dir(spark, "view"), compute, keys, scope, derive=derive, buckets=4, keyed=keyed, slots=slots)
    return followed(spark, view, **frames)


def followed(spark, view, parts=FILES, **frames):
    """Final state of a view over replayed frames."""
    with small_state(spark):
        view.start({n: as_stream(spark, f, parts) for n, f in frames.items()}, scratch_dir(spark, "checkpoint")).awaitTermination()
    return view.read(spark)


def in_order(spark, df, order, parts=FILES):
    """Land a frame as files that follow ``order``, rows without it last, and replay them as a stream."""
    path = scratch_dir(spark, "landing")
    low, high = df.agg(F.min(order), F.max(order)).first()
    step = F.least(F.lit(parts - 1), F.floor((F.col(order) - F.lit(low)) * parts / F.greatest(F.lit(1), F.lit(high) - F.lit(low))))
    for i in range(parts):
        df.where(F.coalesce(step, F.lit(parts - 1)) == i).drop(order).coalesce(1).write.mode("append").parquet(path)
    return files.replay(spark, path, df.drop(order).schema)


def appended(spark, stream, fmt="parquet"):
    path = scratch_dir(spark, "append")
    start_append(stream, path, scratch_dir(spark, "checkpoint"), fmt=fmt).awaitTermination()
    return path


def messages(events):
    return events.select(F.col("ts").alias("timestamp"), F.to_json(F.struct(*events.columns)).alias("value"))


# -- sources -----------------------------------------------------------------------------------

E = "events"
check("s1_json_decode", E, oracle="SELECT event_id, ts, user_id, event_type, value, NULL::VARCHAR AS missing FROM events")(
    lambda e: decode.decode_json(messages(e.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))),
                                 "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, missing string"))
check("s2_start_position", E, oracle="SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20'")(
    lambda e: decode.decode_json(decode.ingested_since(messages(e), "2024-01-20 00:00:00"), "event_id bigint, event_type string"))


def _started_at(spark, events):
    """Messages read by streams that start at the earliest file, at the time of the second load, after the first load's offset, and after all files."""
    folder, kinds = scratch_dir(spark, "landing"), "event_id bigint, event_type string"
    early = F.coalesce(F.col("timestamp") < moment("2024-01-20 00:00:00"), F.lit(False))
    lines = messages(events.select("event_id", "event_type", "ts"))
    lines.where(early).select("value").write.text(folder)
    micros, name = landed.landed(folder)[-1]
    lines.where(~early).select("value").write.mode("append").text(folder)
    second = next(at for at, _ in landed.landed(folder) if at > micros)
    found = []
    for label, start in (("earliest", "earliest"), ("time", str(second // 1000)), ("offset", f'{{"micros": {micros}, "name": "{name}"}}'), ("latest", "latest")):
        read = decode.decode_json(landed.read_landed(spark, folder, start), kinds)
        found.append(spark.read.schema(kinds).parquet(appended(spark, read)).select(F.lit(label).alias("start"), "event_id", "event_type"))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


check("s2_start_reader", E, wants_spark=True, oracle="""SELECT 'earliest' AS start, event_id, event_type FROM events UNION ALL
    SELECT unnest(['time', 'offset']), event_id, event_type FROM events WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-20'""")(lambda spark, sf, e: _started_at(spark, e))


def _ingested_later(spark, events):
    """Rows of the files that came after a first load, told by the files' own time."""
    path = scratch_dir(spark, "landing")
    early = F.coalesce(F.col("ts") < moment("2024-01-10 00:00:00"), F.lit(False))
    events.filter(early).write.parquet(path)
    landed = F.col("_metadata.file_modification_time")
    border = spark.read.schema(events.schema).parquet(path).agg(F.max(landed)).first()[0]
    events.filter(~early).write.mode("append").parquet(path)
    return spark.read.schema(events.schema).parquet(path).filter(landed > F.lit(border))


check("s3_ingest_time_pruning", E, wants_spark=True, oracle="SELECT event_type, count(*) AS n FROM events WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-10' GROUP BY 1")(
    lambda spark, sf, e: _ingested_later(spark, e).groupBy("event_type").agg(F.count("*").alias("n")))
check("s4_query_on_source", E, oracle="SELECT event_type AS page_id, count(*) AS total_visits, count(DISTINCT user_id) AS unique_visitors, max(ts) AS last_visit_time FROM events GROUP BY 1")(
    lambda e: web.page_visits(decode.decode_json(messages(e.select("event_type", "user_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"))),
                              "event_type string, user_id bigint, ts timestamp_ntz").withColumnsRenamed({"event_type": "page_id", "ts": "timestamp"})))
check("s5_stream_to_table", E, wants_spark=True, oracle="SELECT * FROM events")(
    lambda spark, sf, e: spark.read.schema(e.schema).parquet(appended(spark, as_stream(spark, e))))
check("s6_insert_defaults", "customer", oracle="SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'general') AS c_mktsegment, 50 AS heart_rate_min, 'admin' AS update_by FROM customer")(
    lambda c: writers.with_defaults(c.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")),
                                    {"c_mktsegment": "general", "heart_rate_min": 50, "update_by": "admin"}))


def _envelopes(feed, columns):
    row = F.struct(*columns)
    return feed.select(F.to_json(F.struct("op", (F.unix_millis(F.col("commit_ts").cast("timestamp"))).alias("ts_ms"),
        F.struct(F.col("seq").alias("lsn"), F.unix_millis(F.col("commit_ts").cast("timestamp")).alias("ts_ms")).alias("source"),
                                          F.when(F.col("op") == "d", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"))).alias("value"))


_TRIP = "trip_id bigint, rider_id bigint, trip_status string, is_surge bigint"
_LAST = "SELECT {0} FROM trip_feed QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY seq DESC) = 1 AND op <> 'd'"
check("s7_change_feed_mirror", "trip_feed", oracle=_LAST.format("trip_id, rider_id, trip_status, is_surge"))(
    lambda f: cdc.mirror(cdc.decode_envelope(_envelopes(f, ["trip_id", "rider_id", "trip_status", "is_surge"]), _TRIP), ["trip_id"]))
check("s8_mirror_with_commit_time", "trip_feed", oracle=_LAST.format("trip_id, trip_status, commit_ts"))(
    lambda f: cdc.mirror(cdc.decode_envelope(_envelopes(f, ["trip_id", "rider_id", "trip_status", "is_surge"]), _TRIP), ["trip_id"], commit_ts=True)
    .select("trip_id", "trip_status", "commit_ts"))
check("s9_document_mirror", "order_feed", oracle="SELECT _id, payload, commit_ts FROM order_feed QUALIFY row_number() OVER (PARTITION BY _id ORDER BY seq DESC) = 1 AND op <> 'd'")(cdc.mirror_documents)


def _landed_json(spark, e):
    path = scratch_dir(spark, "json")
    e.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).repartition(FILES).write.json(path)
    return path


check("s11_json_folder_stream", E, wants_spark=True, oracle="SELECT * FROM events")(
    lambda spark, sf, e: spark.read.schema(e.schema).parquet(appended(spark, files.read_ndjson(
        spark, _landed_json(spark, e), EVENT, stream=True, max_files=1).drop("_corrupt_record"))))


def _broken_lines(spark, e):
    path = scratch_dir(spark, "ndjson")
    line = F.to_json(F.struct("event_id", "event_type"))
    e.select(F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{oops "), F.col("event_id"))).otherwise(line).alias("value")).write.text(path)
    return files.read_ndjson(spark, path, "event_id bigint, event_type string")


check("s12_ndjson_with_broken_lines", E, wants_spark=True, oracle="""SELECT if(event_id % 10 > 0, event_id, NULL) AS event_id, if(event_id % 10 > 0, event_type, NULL) AS event_type,
    if(event_id % 10 = 0, '{oops ' || event_id, NULL) AS _corrupt_record FROM events""")(lambda spark, sf, e: _broken_lines(spark, e))
declare(file_versions="""SELECT CASE WHEN lang = 'fr' THEN 'doc' ELSE 'new' END || doc_id AS file_name, '# ' || text AS content, doc_id AS version FROM {documents}
    UNION ALL SELECT CASE WHEN lang = 'fr' THEN 'doc' ELSE 'new' END || doc_id, '## ' || text, doc_id + 1 FROM {documents}""")
check("s13_upsert_by_path", "files", "file_versions", oracle="""SELECT 'doc' || doc_id AS file_name, if(lang = 'fr', '## ', '') || text AS content, if(lang = 'fr', doc_id + 1, 0) AS version FROM documents
    UNION ALL SELECT 'new' || doc_id, '## ' || text, doc_id + 1 FROM documents WHERE lang IS DISTINCT FROM 'fr'""")(
    lambda f, v: upsert(f.withColumn("version", F.lit(0).cast("bigint")), v, ["file_name"], ["version"]))


def _typed_copy(spark, e):
    path = scratch_dir(spark, "copy")
    e.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("value").cast("decimal(18,2)").alias("value")).write.parquet(path)
    return spark.read.parquet(path)


check("s14_typed_table_copy", E, wants_spark=True, oracle="SELECT event_id, (props->>'k')::BIGINT AS k, value FROM events")(lambda spark, sf, e: _typed_copy(spark, e))
check("s25_infer_fields", E, oracle="""SELECT c.field, c.type, n AS messages FROM (VALUES ('event_id', 'INT'), ('ts', 'TIMESTAMP'), ('user_id', 'INT'), ('event_type', 'VARCHAR'), ('value', 'DECIMAL'), ('props', 'VARCHAR')) c(field, type),
    (SELECT count(*) AS n FROM events)""")(lambda e: files.infer_fields(messages(e)))
check("s26_profile", E, oracle="\nUNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, min({c})::VARCHAR AS minimum, max({c})::VARCHAR AS maximum FROM events"""
                                                 for c in ("event_id", "ts", "user_id", "event_type", "value", "props")))(
    lambda e: files.profile(e, exact=True).select("column", "rows", "nulls", "distinct_values", "minimum", "maximum"))


def _profile_by_batch(spark, e):
    """The profile of a stream, merged from the states of its batches; fields inside a struct count too."""
    view = ProfileView(scratch_dir(spark, "profile"))
    nested = e.select("event_id", "ts", F.struct("user_id", "event_type", "value").alias("body"))
    with small_state(spark):
        start_handler(as_stream(spark, nested), view.handler, scratch_dir(spark, "checkpoint")).awaitTermination()
    return view.read(spark).select("column", "rows", "nulls", "minimum", "maximum")


check("s26_profile_by_batch", E, wants_spark=True, oracle="\nUNION ALL ".join(f"""SELECT '{n}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, min({c})::VARCHAR AS minimum, max({c})::VARCHAR AS maximum FROM events"""
                                                                          for c, n in (("event_id", "event_id"), ("ts", "ts"), ("user_id", "body.user_id"), ("event_type", "body.event_type"), ("value", "body.value"))))(
    lambda spark, sf, e: _profile_by_batch(spark, e))
check("s25_nested_fields", E, oracle="""SELECT c.field, c.type FROM (VALUES ('id', 'BIGINT'), ('user.id', 'BIGINT'), ('user.kind', 'STRING'), ('tags[]', 'STRING'), ('steps[].at', 'BIGINT'),
    ('steps[].ok', 'BOOLEAN')) c(field, type), (SELECT count(*) AS n FROM events) WHERE n > 0""")(
    lambda e: nested_fields(e.select(F.to_json(F.struct(
        F.col("event_id").alias("id"), F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"), F.array("event_type").alias("tags"),
        F.array(F.struct(F.col("event_id").alias("at"), (F.col("event_id") > 3).alias("ok"))).alias("steps"))).alias("value"))))


def _graph(spark, e):
    graph = ViewGraph()
    graph.add("tm_daily_users", lambda daily: daily.groupBy("day").agg(F.count("*").alias("users")), reads=["tm_daily"])
    graph.add("tm_daily", lambda rows: rows.select(F.date_trunc("day", "ts").alias("day"), "user_id").distinct(), reads=["tm_events"])
    graph.add("tm_events", lambda: e)
    graph.build(spark)
    return spark.table("tm_daily_users")


check("s28_view_graph", E, wants_spark=True, oracle="SELECT date_trunc('day', ts) AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1")(lambda spark, sf, e: _graph(spark, e))

# -- sinks ----------------------------------------------------------------------------------------

_COUNTS = "SELECT user_id, count(*) AS n, max(ts) AS last FROM events GROUP BY 1"


def _per_user(events):
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))


check("s15_upsert_sink", E, wants_spark=True, oracle=_COUNTS)(lambda spark, sf, e: native(spark, _per_user, ["user_id"], e))


def _appended_changes(spark, e):
    """The change feed between two states of a result, forced to appends and written by the file sink of a stream."""
    early = _per_user(e.filter(F.col("ts") < moment("2024-01-10 00:00:00"))).drop("last")
    changes = diff_results(early, _per_user(e).drop("last"), ["user_id"])
    path = appended(spark, writers.append_only(as_stream(spark, changes)))
    return spark.read.schema(changes.drop("op").schema).parquet(path)


check("s16_append_only_sink", E, wants_spark=True, oracle="SELECT user_id, b.n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) b LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1) a USING (user_id) WHERE a.n IS DISTINCT FROM b.n")(
    lambda spark, sf, e: _appended_changes(spark, e))


def _messages_out(spark, e):
    path = appended(spark, writers.as_messages(as_stream(spark, e.select("event_id", "event_type", "value"))), fmt="text")
    return decode.decode_json(spark.read.text(path), "event_id bigint, event_type string, value double")


check("s17_message_sink", E, wants_spark=True, oracle="SELECT event_id, event_type, value FROM events")(lambda spark, sf, e: _messages_out(spark, e))
check("s18_lake_append", E, wants_spark=True, oracle="SELECT event_id, value FROM events WHERE event_type = 'error'")(
    lambda spark, sf, e: spark.read.schema("event_id bigint, value double").parquet(appended(spark, as_stream(spark, e).filter("event_type = 'error'").select("event_id", "value"))))


def _feed_upsert(spark, feed):
    """Change rows applied batch by batch, dealt by key hash: deletes remove, later versions win inside a batch."""
    table = KeyedTable(scratch_dir(spark, "trips"), ["trip_id"])
    rows = feed.withColumn("op", F.when(F.col("op") == "d", "Delete").otherwise("UpdateInsert"))
    for batch_id in range(4):
        table.apply(rows.filter(F.pmod(F.xxhash64("trip_id"), F.lit(4)) == batch_id), batch_id, order=["seq"])
        if batch_id == 1:
            table.compact(spark)
    return table.read(spark).select("trip_id", "rider_id", "trip_status", "commit_ts")


check("s19_lake_upsert", "trip_feed", wants_spark=True, oracle=_LAST.format("trip_id, rider_id, trip_status, commit_ts"))(lambda spark, sf, f: _feed_upsert(spark, f))
check("s20_view_to_lake", E, wants_spark=True, oracle="SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")(
    lambda spark, sf, e: native(spark, lambda x: x.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")), ["user_id", "event_type"], e))


def _commit_every(spark, e, n=3, files_=5):
    """Counts written in commits of ``n`` batches, each batch delivered twice: the batches behind the last whole commit do not show."""
    sink = StagedUpserts(scratch_dir(spark, "lake"), ["user_id", "event_type"], n)

    def twice(batch, batch_id):
        for _ in range(2):
            sink.handler(batch, batch_id)

    with small_state(spark):
        counts = in_order(spark, e.withColumn("file", F.col("event_id") % files_), "file", files_).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
        start_handler(counts, twice, scratch_dir(spark, "checkpoint"), mode="update").awaitTermination()
    return sink.read(spark)


check("s20_commit_every", E, wants_spark=True, oracle="SELECT user_id, event_type, count(*) AS n FROM events WHERE event_id % 5 < 3 GROUP BY ALL")(lambda spark, sf, e: _commit_every(spark, e))
check("s23_read_lake_files", "orders", wants_spark=True, oracle="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")(
    lambda spark, sf, o: spark.read.schema(o.schema).parquet(appended(spark, as_stream(spark, o, 2))).groupBy("o_orderstatus").agg(F.count("*").alias("n")))
check("s24_result_changes", E, oracle="""WITH a AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL), b AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY ALL)
    SELECT user_id, event_type, coalesce(b.n, a.n) AS n, CASE WHEN a.n IS NULL THEN 'Insert' WHEN b.n IS NULL THEN 'Delete' ELSE 'UpdateInsert' END AS op FROM a FULL JOIN b USING (user_id, event_type) WHERE a.n IS DISTINCT FROM b.n""")(
    lambda e: diff_results(_by_type(e.filter(F.col("ts") < moment("2024-01-15 00:00:00"))), _by_type(e.filter(F.col("ts") >= moment("2024-01-05 00:00:00"))), ["user_id", "event_type"]))


def _by_type(e):
    return e.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


# -- streaming operators ------------------------------------------------------------------------------

_W = "time_bucket(INTERVAL '1 day', ts) AS window_start, window_start + INTERVAL 1 DAY AS window_end"
_KEYS = ["window_start", "window_end"]
check("st1_tumble", E, wants_spark=True, oracle=f"SELECT event_type, {_W}, count(*) AS n, sum(event_id)::BIGINT AS s FROM events GROUP BY ALL")(
    lambda spark, sf, e: native(spark, lambda x: tumble(x, "ts", "1 day").groupBy("event_type", *_KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("s")), ["event_type", *_KEYS], e))
check("st2_hop", E, wants_spark=True, oracle="SELECT time_bucket(INTERVAL '6 hours', ts) - k * INTERVAL 6 HOUR AS window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n FROM events, range(4) t(k) GROUP BY ALL")(
    lambda spark, sf, e: native(spark, lambda x: hop(x, "ts", "6 hours", "24 hours").groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n")), _KEYS, e))
check("st3_window_over_view", "edits", wants_spark=True, oracle="""SELECT time_bucket(INTERVAL '1 day', edit_timestamp) AS window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS total_contributions,
    count(*) FILTER (gender = 'unknown') AS contributions_by_unknown, count(*) FILTER (gender <> 'unknown') AS contributions_by_male_or_female FROM edits WHERE registration IS NOT NULL AND edit_count IS NOT NULL GROUP BY window_start""")(
    lambda spark, sf, d: native(spark, lambda x: web.edits_by_gender(web.clean_edits(x), "1 day"), _KEYS, d))
check("st4_window_then_join", E, "customer", wants_spark=True, oracle=f"SELECT c_mktsegment, {_W}, count(*) AS n FROM events JOIN customer ON c_custkey = user_id GROUP BY ALL")(
    lambda spark, sf, e, c: native(spark, lambda x: tumble(x, "ts", "1 day").join(c, F.col("c_custkey") == F.col("user_id")).groupBy("c_mktsegment", *_KEYS).agg(F.count(F.lit(1)).alias("n")), ["c_mktsegment", *_KEYS], e))
check("st5_unwindowed_aggregate", "visits", wants_spark=True, oracle="SELECT page_id, count(*) AS total_visits, count(DISTINCT user_id) AS unique_visitors, max(timestamp) AS last_visit_time FROM visits GROUP BY 1")(
    lambda spark, sf, v: maintained(spark, lambda visits: web.page_visits(visits), ["page_id"], ["page_id"], visits=v))
check("st6_view_on_view", E, wants_spark=True, oracle="""SELECT user_id, window_start, n, sum(n) OVER (PARTITION BY user_id ORDER BY window_start RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW)::BIGINT AS n4 FROM
    (SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS n FROM events GROUP BY ALL)""")(
    lambda spark, sf, e: maintained(spark, lambda events: range_frame(tumble(events, "ts", "1 day").groupBy("user_id", "window_start").agg(F.count("*").alias("n")),
                                    ["user_id"], "window_start", "3 days", {"n4": F.sum("n")}), ["user_id", "window_start"], ["user_id"],
                                    # A row bears on the window it lies in and on those up to three days later.
                                    slots=Slots({"events": "ts"}, "window_start", before="1 day", after="3 days", width="8 days"), events=e))
check("st7_late_rows", E, wants_spark=True, oracle="SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n FROM events GROUP BY ALL")(
    lambda spark, sf, e: native(spark, lambda x: tumble(x, "ts", "1 hour").groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n")), _KEYS, e))
check("st8_windowed_join", "consumption", "production", wants_spark=True, oracle="""SELECT meter_id, window_end, a AS energy_consumed, b AS energy_produced, a - b AS total_energy
    FROM (SELECT meter_id, time_bucket(INTERVAL '1 day', consumption_time) + INTERVAL 1 DAY AS window_end, sum(energy_consumed) AS a FROM consumption GROUP BY ALL)
    JOIN (SELECT meter_id, time_bucket(INTERVAL '1 day', production_time) + INTERVAL 1 DAY AS window_end, sum(energy_produced) AS b FROM production GROUP BY ALL) USING (meter_id, window_end)""")(
    lambda spark, sf, c, p: maintained(spark, lambda consumed, produced: energy.energy_per_house(consumed, produced, "1 day"), ["meter_id", "window_end"], ["meter_id"], consumed=c, produced=p))


def _joined_streams(spark, o, c, bound):
    left = as_stream(spark, o, 2)
    right = as_stream(spark, c, 2)
    out = bound(left, right)
    with small_state(spark):
        return spark.read.schema(out.schema).parquet(appended(spark, out))


check("st9_unbounded_stream_join", "orders", "customer", wants_spark=True, oracle="SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey")(
    lambda spark, sf, o, c: _joined_streams(spark, o, c, lambda a, b: a.join(b, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")))


def _interval_join(views, clicks):
    return interval_join(views, clicks, [F.col("click_user") == F.col("user_id")], "ts", "click_ts", "3 HOURS", "3 HOURS").select("event_id", "click_id")


check("st10_interval_stream_join", E, wants_spark=True, oracle="""SELECT v.event_id, c.event_id AS click_id FROM events v JOIN events c ON c.user_id = v.user_id AND c.ts BETWEEN v.ts - INTERVAL 3 HOUR AND v.ts + INTERVAL 3 HOUR
    WHERE v.event_type = 'view' AND c.event_type = 'click'""")(
    lambda spark, sf, e: _joined_streams(spark, e.filter("event_type = 'view'").select("event_id", "user_id", "ts"),
        e.filter("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"), F.col("ts").alias("click_ts")), _interval_join))


def _outer_intervals(spark, e, how):
    views = e.where("event_type = 'view'").select("event_id", "user_id", "ts")
    clicks = e.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"), F.col("ts").alias("click_ts"))
    view = outer_interval_view(scratch_dir(spark, "view"), {"user_id": "click_user"}, "ts", "click_ts", "event_id", "click_id", "3 hours", "3 hours", how,
                               width="10 days", buckets=4)
    return followed(spark, view, left=views, right=clicks).select("event_id", "user_id", "ts", "click_id", "click_user", "click_ts")


for _how in ("left", "full"):
    check(f"st10_{_how}_interval_join", E, wants_spark=True, oracle=f"""SELECT v.event_id, v.user_id, v.ts, c.event_id AS click_id, c.user_id AS click_user, c.ts AS click_ts
        FROM (FROM events WHERE event_type = 'view') v {_how} JOIN (FROM events WHERE event_type = 'click') c
        ON c.user_id = v.user_id AND c.ts BETWEEN v.ts - INTERVAL 3 HOUR AND v.ts + INTERVAL 3 HOUR""")(lambda spark, sf, e, how=_how: _outer_intervals(spark, e, how))


def _changes_by_clock(spark, rows, ts, keep):
    """Rows that came and left as the event clock went on, from a replay in order of time."""
    changes = retained(in_order(spark, rows.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp"))), "_us"), ts, keep, buckets=2)
    with rocks_state(spark):
        return spark.read.schema(changes.schema).parquet(appended(spark, changes))


def _expiry(spark, rows):
    changes = _changes_by_clock(spark, rows, "datetime", "2 days")
    return present(changes).withColumn("state", F.lit("present")).unionByName(changes.where("op = 'Delete'").drop("op").withColumn("state", F.lit("gone")))


check("st_expiry", "flow", wants_spark=True, oracle="""SELECT road_id, datetime, traffic_flow, CASE WHEN datetime >= (SELECT max(datetime) FROM flow) - INTERVAL 2 DAY THEN 'present' ELSE 'gone' END AS state
    FROM flow WHERE datetime IS NOT NULL""")(lambda spark, sf, f: _expiry(spark, f.select("road_id", "datetime", "traffic_flow")))
check("st_expiring_sales", "unit_sales", wants_spark=True, oracle="""SELECT warehouse_id, product_id, sum(quantity_sold)::BIGINT AS total_quantity_sold FROM unit_sales
    WHERE timestamp >= (SELECT max(timestamp) FROM unit_sales) - INTERVAL 60 DAY GROUP BY ALL""")(
    lambda spark, sf, s: running_totals(_changes_by_clock(spark, s.select("warehouse_id", "product_id", "quantity_sold", "timestamp"), "timestamp", "60 days"),
                                        ["warehouse_id", "product_id"], {"total_quantity_sold": F.col("quantity_sold")}))
check("st11_sliding_retention", "flow", wants_spark=True, oracle="SELECT road_id, datetime, traffic_flow FROM flow WHERE datetime >= (SELECT max(datetime) FROM flow) - INTERVAL 2 DAY")(
    lambda spark, sf, f: maintained(spark, lambda flow: flow.filter(F.col("datetime") >= flow.agg(F.max("datetime")).scalar() - span("2 days")).select("road_id", "datetime", "traffic_flow"),
                                    ["road_id", "datetime", "traffic_flow"], [], flow=f))
check("st12_latest_state", E, wants_spark=True, oracle="SELECT DISTINCT ON (user_id) user_id, event_id, event_type, ts FROM events ORDER BY user_id, ts DESC")(
    lambda spark, sf, e: native(spark, lambda x: latest_by(x.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]), ["user_id"], e))


def _delivered_twice(spark, e):
    """Every batch is processed twice, as after a lost driver; the result must not notice."""
    view = MaintainedView(scratch_dir(spark, "view"), lambda events: _per_user(events), ["user_id"], ["user_id"], compact_every=2, buckets=4)

    def handler(batch, batch_id):
        view.process({"events": batch}, batch_id)
        view.process({"events": batch}, batch_id)

    with small_state(spark):
        start_handler(as_stream(spark, e), handler, scratch_dir(spark, "checkpoint")).awaitTermination()
    return view.read(spark)


check("st13_delivered_twice", E, wants_spark=True, oracle=_COUNTS)(lambda spark, sf, e: _delivered_twice(spark, e))


def _complete_mode(spark, e):
    table = KeyedTable(scratch_dir(spark, "top"), ["user_id"])
    top = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user_id").limit(10)
    with small_state(spark):
        start_native(top, table, scratch_dir(spark, "checkpoint"), mode="complete").awaitTermination()
    changes = table.changes(spark)
    return changes.filter(F.col("batch") == changes.agg(F.max("batch")).scalar()).select("user_id", "n")


check("st14_complete_mode_top", E, wants_spark=True, oracle="SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10")(
    lambda spark, sf, e: _complete_mode(spark, as_stream(spark, e)))
check("st15_trend_alerts", "vitals", wants_spark=True, oracle="""SELECT patient_id, time_bucket(INTERVAL '1 day', measure_time) + INTERVAL 1 DAY AS measure_time, arg_max(heart_rate, measure_time) - arg_min(heart_rate, measure_time) AS heart_rate_increase
    FROM vitals GROUP BY 1, time_bucket(INTERVAL '1 day', vitals.measure_time) HAVING heart_rate_increase >= 20 AND arg_min(blood_oxygen, vitals.measure_time) - arg_max(blood_oxygen, vitals.measure_time) >= 5""")(
    lambda spark, sf, v: maintained(spark, lambda vitals: health.trend_alerts(vitals, "1 day"), ["patient_id", "measure_time"], ["patient_id"], vitals=v)
    .select("patient_id", "measure_time", "heart_rate_increase"))
check("st_rolling_price", "ticks", wants_spark=True, oracle="""SELECT asset_id, timestamp, round((avg(price) OVER f)::DECIMAL(38,10), 2)::DOUBLE AS average_price, round((avg(ask_price - bid_price) OVER f)::DECIMAL(38,10), 2)::DOUBLE AS bid_ask_spread
    FROM ticks WINDOW f AS (PARTITION BY asset_id ORDER BY timestamp RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)""")(
    lambda spark, sf, t: maintained(spark, lambda ticks: markets.price_and_spread(ticks, "6 hours"), ["asset_id", "timestamp"], ["asset_id"],
                                    slots=Slots({"ticks": "timestamp"}, "timestamp", after="6 hours"), ticks=t))
# Dimensions that change: rows are inserted, a third is updated (and moves), a seventh is deleted, in any order of arrival.
declare(
    member_changes="""SELECT id, age, city, 1 AS version, 'insert' AS op FROM {members} UNION ALL
        SELECT id, age + 1, 'city ' || (id + 7) % 25, 2, 'update' FROM {members} WHERE id % 3 = 0 UNION ALL SELECT id, age, city, 3, 'delete' FROM {members} WHERE id % 7 = 0""",
    user_name_changes="""SELECT user_id, first_name, last_name, age, 1 AS version, 'insert' AS op FROM {user_names} UNION ALL
        SELECT user_id, 'new ' || first_name, last_name, age + 1, 2, 'update' FROM {user_names} WHERE user_id % 3 = 0 UNION ALL SELECT user_id, first_name, last_name, age, 3, 'delete' FROM {user_names} WHERE user_id % 7 = 0""",
    inventory_changes="""SELECT *, 1 AS version, 'insert' AS op FROM {product_inventory} UNION ALL
        SELECT product_id, product_name, stock_level - 3, reorder_threshold, base_price, 2, 'update' FROM {product_inventory} WHERE product_id % 3 = 0 UNION ALL
        SELECT *, 3, 'delete' FROM {product_inventory} WHERE product_id % 7 = 0""",
)
_VERSIONS = lambda key: Keyed((key,), ("version",), "op")
_LAST = "(SELECT * FROM (SELECT DISTINCT ON ({1}) * FROM {0} ORDER BY {1}, version DESC) WHERE op <> 'delete')"
check("st_changed_city_age", "member_changes", wants_spark=True, oracle=f"""SELECT * FROM (SELECT city, avg(age) AS avg_age FROM {_LAST.format('member_changes', 'id')} GROUP BY city) WHERE avg_age >= 42""")(
    lambda spark, sf, m: maintained(spark, lambda users: web.city_average_age(users, 42), ["city"], ["city"], keyed={"users": _VERSIONS("id")}, users=m))
check("st_changed_actions", "user_actions", "user_name_changes", wants_spark=True, oracle=f"""SELECT a.user_id, first_name, last_name, age, page_id, num_actions, window_end FROM
    (SELECT user_id, page_id, time_bucket(INTERVAL '1 day', action_time) + INTERVAL 1 DAY AS window_end, count(action) AS num_actions FROM user_actions GROUP BY ALL) a
    LEFT JOIN {_LAST.format('user_name_changes', 'user_id')} u ON u.user_id = a.user_id""")(
    lambda spark, sf, a, u: maintained(spark, lambda visits, users: web.actions_per_window(visits, users, "1 day"), ["user_id", "page_id", "window_end"], ["user_id"],
                                       keyed={"users": _VERSIONS("user_id")}, visits=a, users=u))
check("st_changed_stock", "inventory_changes", "purchases", "restocks", wants_spark=True, oracle=f"""WITH deltas AS (SELECT product_id, w, sum(n) AS n FROM (
      SELECT product_id, time_bucket(INTERVAL '30 days', purchase_time, TIMESTAMP '1970-01-01') AS w, -quantity_purchased AS n FROM purchases UNION ALL
      SELECT product_id, time_bucket(INTERVAL '30 days', restock_time, TIMESTAMP '1970-01-01'), quantity_restocked FROM restocks) GROUP BY ALL)
    SELECT i.product_id, w AS inventory_window, (stock_level + coalesce(sum(n) OVER (PARTITION BY i.product_id ORDER BY w), 0))::BIGINT AS current_inventory
    FROM {_LAST.format('inventory_changes', 'product_id')} i LEFT JOIN deltas d ON d.product_id = i.product_id""")(
    lambda spark, sf, i, b, r: maintained(spark, lambda inventory, purchases, restocks: pricing.stock_status(inventory, purchases, restocks, "30 days"),
                                          ["product_id", "inventory_window"], ["product_id"], keyed={"inventory": _VERSIONS("product_id")}, inventory=i, purchases=b, restocks=r)
    .select("product_id", "inventory_window", "current_inventory"))
declare(product_changes="""SELECT *, 1 AS version, 'insert' AS op FROM {products} UNION ALL
        SELECT product_id, product_name || ' II', brand, category, 2, 'update' FROM {products} WHERE product_id % 3 = 0 UNION ALL
        SELECT *, 3, 'delete' FROM {products} WHERE product_id % 7 = 0""")
check("st_top_products", "item_sales", "product_changes", wants_spark=True, oracle=f"""SELECT category, product_name, sum(quantity)::BIGINT AS total_quantity_sold, time_bucket(INTERVAL '1 day', sale_timestamp) AS window_start
    FROM item_sales JOIN {_LAST.format('product_changes', 'product_id')} p USING (product_id) GROUP BY ALL ORDER BY total_quantity_sold DESC, category, product_name, window_start LIMIT 5""")(
    lambda spark, sf, s, p: followed(spark, VIEWS["top_products"].at(scratch_dir(spark, "view"), size="1 day", buckets=4, keyed={"products": _VERSIONS("product_id")}), 2, sales=s, products=p)
    .drop("window_end"))
check("st_order_eta", "order_updates", "gps", "road_cells", wants_spark=True, oracle=logistics_checks.ETA_ORACLE)(
    lambda spark, sf, o, g, r: logistics_checks.eta_rounded(followed(spark, VIEWS["order_eta"].at(scratch_dir(spark, "view"), buckets=4), 2, updates=o, gps=g, traffic=r)))
check("st_customer_segments", "shop_events", "shop_orders", wants_spark=True, oracle=segments_checks.SEGMENTS_ORACLE)(
    lambda spark, sf, e, o: followed(spark, VIEWS["customer_segments"].at(scratch_dir(spark, "view"), as_of="2024-01-31 00:00:00", buckets=4), 2, events=e, orders=o))
check("x7_batch_handler", E, wants_spark=True, oracle="SELECT event_type, count(*) AS n FROM events GROUP BY 1")(lambda spark, sf, e: _handled(spark, e))


def _handled(spark, e):
    path = scratch_dir(spark, "handled")

    def handler(batch, batch_id):
        writers.write_batch(batch.groupBy("event_type").agg(F.count("*").alias("n")), path, batch_id)

    start_handler(as_stream(spark, e), handler, scratch_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).groupBy("event_type").agg(F.sum("n").alias("n"))
