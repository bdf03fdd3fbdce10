"""Time series, streaming ingest and reads, keyed state, search."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.model import TimeseriesSpec
from recordlake.operators import keystate, postings, search, timeseries
from recordlake.registry.base import Group, table
from recordlake.registry.shapes import BODY, WIDE_SQL, wide
from recordlake.session import work_path
from recordlake.sources.tables import read_records
from recordlake.streaming import ingest, reads
from recordlake.streaming import keystate as streamed_state

G = Group()

SPEC = TimeseriesSpec("ts", ("user_id", "event_type"), ("value",), precision="SECOND", shards=4, retention="10 DAYS", compaction="6 HOURS")


def events(spark, folder):
    return table(spark, folder, "events")


def event_stream(spark, folder):
    """The event files as a stream."""
    schema = events(spark, folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(folder)


@G.add("t1_ts_ingest", "SELECT date_trunc('second', ts) AS ts, user_id, event_type, value, CAST(ts AS DATE) AS day, true AS sharded FROM events")
def t1(spark, folder):
    out = timeseries.ts_ingest(events(spark, folder), SPEC)
    return out.withColumn("sharded", F.col("shard").between(0, 3)).drop("shard")


@G.add("t1_rejected_rows", "SELECT event_id, 'null_timestamp' AS code FROM events WHERE event_type = 'click'")
def t1_rejected(spark, folder):
    """Samples without a time are not lost: they come back as rejected rows."""
    timeless = events(spark, folder).withColumn("ts", F.when(F.col("event_type") != "click", F.col("ts")))
    return timeseries.ts_rejected(timeless, SPEC).select("event_id", "code")


@G.add("t1_partitioned_write", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def t1_write(spark, folder):
    path = work_path(spark, "series")
    timeseries.write_series(timeseries.ts_ingest(events(spark, folder), SPEC), SPEC, path)
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@G.add("t2_ts_retention", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY")
def t2(spark, folder):
    return timeseries.ts_retention(events(spark, folder), SPEC, F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00"))).select("event_id", "ts")


@G.add("t3_ts_compact", "SELECT event_id, value, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS compacted FROM events")
def t3(spark, folder):
    out = timeseries.ts_compact(events(spark, folder), SPEC)
    return out.select("event_id", "value", F.col("compacted").cast("timestamp_ntz").alias("compacted"))


@G.add("t4_ts_downsample", """SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, user_id, event_type, count(*) AS samples, min(value) AS value_min, max(value) AS value_max,
 CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / count(value) AS value_avg, arg_min(value, (ts, event_id)) AS value_first, arg_max(value, (ts, event_id)) AS value_last FROM events GROUP BY 1, 2, 3""")
def t4(spark, folder):
    out = timeseries.ts_downsample(events(spark, folder), SPEC, "1 HOURS", tie=["event_id"])
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@G.add("t4_from_rollups", """SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, user_id, event_type, count(*) AS samples, min(value) AS value_min, max(value) AS value_max,
 CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / count(value) AS value_avg, arg_min(value, (ts, event_id)) AS value_first, arg_max(value, (ts, event_id)) AS value_last FROM events GROUP BY 1, 2, 3""")
def t4_rollups(spark, folder):
    """Hours from stored minutes; a third of the samples comes late, into minutes and files that are there."""
    rows = events(spark, folder)
    minutes = timeseries.Rollup(spark, work_path(spark, "minutes"), SPEC, "1 MINUTES", ["event_id"], rows)
    for late in (False, True):
        minutes.add(rows.where((F.col("event_id") % 3 == 0) == late))
    return minutes.read("1 HOURS").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@G.add("t5_stream_downsample", """SELECT window_start, user_id, event_type, samples, value_min, value_max, value_sum FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, user_id, event_type,
 count(*) AS samples, min(value) AS value_min, max(value) AS value_max, CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS value_sum FROM events GROUP BY 1, 2, 3)
 WHERE window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 30 MINUTE FROM events)""")
def t5(spark, folder):
    """Windows the watermark has closed, from a stream over the event files."""
    stream = event_stream(spark, folder)
    out = work_path(spark, "downsample")
    reads.stream_to(reads.stream_downsample(stream, SPEC, "1 HOURS", "30 MINUTES"), f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# ---- chunked ingest -------------------------------------------------------------------------
# Session: the event type. Chunk: the week. Key: user and type.
CHUNK_SQL = "(SELECT event_type AS session, CAST((day(ts) - 1) // 7 + 1 AS BIGINT) AS seq, event_id AS row_no, user_id, event_type, value FROM events)"
COLUMNS = ["user_id", "event_type", "value"]


def with_chunks(df):
    return df.select(F.col("event_type").alias("session"), (F.floor((F.dayofmonth("ts") - 1) / 7) + 1).cast("bigint").alias("seq"),
                     F.col("event_id").alias("row_no"), *COLUMNS)


def event_files(spark, folder):
    """The events as a stream of five files, one per micro-batch; chunks reach over several of them."""
    path, rows = work_path(spark, "events"), events(spark, folder)
    rows.repartitionByRange(5, "event_id").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _streamed(spark, folder, mode):
    """The whole stream once, then all of it again: the second delivery must change nothing."""
    target = ingest.StreamTarget(work_path(spark, "ingest"), ["user_id", "event_type"], COLUMNS, mode)
    ingest.stream_load(with_chunks(event_files(spark, folder)), target).awaitTermination()
    ingest.stream_load(with_chunks(event_files(spark, folder)), target, "replay").awaitTermination()
    return target


def _schema(spark, folder):
    return events(spark, folder).select(*COLUMNS).schema


def _sessions(spark, folder):
    """As above with sessions: errors have no options, signups are rolled back, views do not end. Users of
    clicks that divide by 7 have no key. The table is compacted between two deliveries."""
    target = ingest.StreamTarget(work_path(spark, "sessions"), ["user_id", "event_type"], COLUMNS, "IGNORE", gated=True)
    rows = with_chunks(event_files(spark, folder))
    opened = F.when((F.col("seq") == 1) & (F.col("session") != "error"), F.lit("opt"))
    keyless = (F.col("event_type") == "click") & (F.col("user_id") % 7 == 0)
    rows = rows.withColumn("options", opened).withColumn("commit", F.lit(None).cast("boolean")).withColumn(
        "user_id", F.when(~keyless, F.col("user_id")))
    ingest.stream_load(rows, target).awaitTermination()
    ends = spark.createDataFrame([(s, s != "signup") for s in ("click", "purchase", "signup", "error")], "session string, commit boolean")
    control = ends.select("session", *[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c not in ("session", "commit")], "commit")
    ingest.append_chunks(control, 0, target, "control")
    ingest.compact(spark, target, _schema(spark, folder))
    ingest.stream_load(rows, target, "replay").awaitTermination()
    return target


@G.add("x1_stream_upsert", "SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def x1(spark, folder):
    return ingest.read_table(spark, _streamed(spark, folder, "UPDATE"), _schema(spark, folder))


def _late(spark, folder, mode):
    """The first weeks arrive after the later ones have been compacted, then some of them again."""
    target = ingest.StreamTarget(work_path(spark, "late"), ["user_id", "event_type"], COLUMNS, mode)
    rows, schema = with_chunks(events(spark, folder)), _schema(spark, folder)
    for i, (low, high) in enumerate([(4, 9), (2, 3), (1, 1), (2, 4)]):
        ingest.append_chunks(rows.where(F.col("seq").between(low, high)), i, target)
        if i in (0, 2):
            ingest.compact(spark, target, schema)
    return target


@G.add("x1_late_chunk", "SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def x1_late(spark, folder):
    return ingest.read_table(spark, _late(spark, folder, "UPDATE"), _schema(spark, folder))


@G.add("x2_late_errors", f"""SELECT session, seq, row_no, 'duplicate_key' AS code, 'user_id,event_type' AS field, 'key already present: ' || user_id || ',' || event_type AS message FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY seq, row_no) AS rk FROM {CHUNK_SQL}) WHERE rk > 1""")
def x2_late(spark, folder):
    """ERROR mode: which row of a key is the first, and which fail, is as if no chunk had been late."""
    return ingest.read_errors(spark, _late(spark, folder, "ERROR"), _schema(spark, folder))


@G.add("x2_chunk_acks", f"""SELECT session, seq, count(*) AS received, count(*) FILTER (WHERE rk = 1) AS inserted, CAST(0 AS BIGINT) AS updated, count(*) FILTER (WHERE rk > 1) AS ignored, CAST(0 AS BIGINT) AS failed FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY seq, row_no) AS rk FROM {CHUNK_SQL}) GROUP BY 1, 2""")
def x2(spark, folder):
    return ingest.read_acks(spark, _streamed(spark, folder, "IGNORE"), _schema(spark, folder))


GATED_SQL = f"""(SELECT *, CASE WHEN session = 'error' THEN 'missing_options' WHEN session = 'signup' THEN 'rolled_back' WHEN session = 'view' THEN 'open' END AS code,
 event_type = 'click' AND user_id % 7 = 0 AS keyless FROM {CHUNK_SQL})"""


@G.add("x2_error_rows", f"""SELECT session, seq, row_no, coalesce(code, 'null_key') AS code, CASE WHEN code IS NULL THEN 'user_id' END AS field, CASE WHEN code IS NULL THEN 'key column is null: user_id' END AS message
 FROM {GATED_SQL} WHERE code IS NOT NULL OR keyless""")
def x2_errors(spark, folder):
    return ingest.read_errors(spark, _sessions(spark, folder), _schema(spark, folder))


@G.add("x2_session_summary", f"""SELECT session, coalesce(min(code), 'loaded') AS state, count(*) FILTER (WHERE code IS NULL) AS received, count(*) FILTER (WHERE code IS NULL AND NOT keyless AND rk = 1) AS inserted, CAST(0 AS BIGINT) AS updated,
 count(*) FILTER (WHERE code IS NULL AND NOT keyless AND rk > 1) AS ignored, count(*) FILTER (WHERE code IS NULL AND keyless) AS failed, count(*) FILTER (WHERE code IS NOT NULL) AS held
 FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY seq, row_no) AS rk FROM {GATED_SQL}) GROUP BY 1""")
def x2_summary(spark, folder):
    return ingest.read_summary(spark, _sessions(spark, folder), _schema(spark, folder))


@G.add("x3_session_gate", f"""SELECT session, seq, count(*) AS n, CASE WHEN session = 'error' THEN NULL ELSE 'opt-' || session END AS options, CASE WHEN session = 'error' THEN 'missing_options' WHEN session = 'signup' THEN 'rolled_back' WHEN session = 'view' THEN 'open' END AS code
 FROM {CHUNK_SQL} GROUP BY 1, 2""")
def x3(spark, folder):
    rows = with_chunks(events(spark, folder))
    opened = F.when((F.col("seq") == 1) & (F.col("session") != "error"), F.concat(F.lit("opt-"), F.col("session")))
    ends = rows.select("session").distinct().where("session <> 'view'").withColumn("commit", F.col("session") != "signup")
    gated = ingest.session_gate(rows.withColumn("options", opened), ends)
    return gated.groupBy("session", "seq", "options", "code").agg(F.count(F.lit(1)).alias("n"))


@G.add("x4_stream_read", "SELECT count(*) AS rows, false AS truncated FROM events")
def x4(spark, folder):
    """A stream read to its end; the summary is what comes back."""
    stream = event_files(spark, folder)
    seen = reads.stream_until(stream, work_path(spark, "read"), lambda batch, batch_id: True)
    return spark.createDataFrame([(seen["rows"], seen["truncated"])], "rows bigint, truncated boolean")


@G.add("x4_stop_and_resume", "SELECT count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids, true AS stopped, false AS truncated FROM events")
def x4_resume(spark, folder):
    """A read that stops on the data, and a second one that goes on from there: every row is seen once."""
    stream, checkpoint, ids = event_files(spark, folder), work_path(spark, "read"), []
    half = events(spark, folder).count() // 2
    counted = []

    def handle(batch, batch_id):
        row = batch.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")).first()
        counted.append(row["n"])
        ids.append(row["ids"])
        return sum(counted) < half

    first = reads.stream_until(stream, checkpoint, handle)
    second = reads.stream_until(stream, checkpoint, lambda batch, batch_id: handle(batch, batch_id) or True)
    return spark.createDataFrame([(first["rows"] + second["rows"], sum(ids), first["truncated"], second["truncated"])],
                                 "rows bigint, ids bigint, stopped boolean, truncated boolean")


@G.add("x5_stream_decode", f"SELECT 'good' AS sink, NULL AS code, count(*) AS n FROM {WIDE_SQL} WHERE event_type = 'view' OR (event_type = 'click' AND CAST(body->>'$.k' AS BIGINT) <= 127) UNION ALL SELECT 'bad', CASE WHEN event_type = 'error' THEN 'missing_field' ELSE 'type_mismatch' END, count(*) FROM {WIDE_SQL} WHERE NOT (event_type = 'view' OR (event_type = 'click' AND CAST(body->>'$.k' AS BIGINT) <= 127)) GROUP BY 2")
def x5(spark, folder):
    root = work_path(spark, "decode")
    stream = spark.readStream.schema(wide(spark, folder).schema).parquet(_wide_file(spark, folder))
    recs = read_records(stream, "body", F.col("event_id").cast("string"), F.col("event_type"))
    reads.stream_decode(recs, BODY, root).awaitTermination()
    good, bad = reads.decoded_rows(spark, root)
    good = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("sink"), F.lit(None).cast("string").alias("code"), "n")
    bad = bad.groupBy("code").agg(F.count(F.lit(1)).alias("n")).select(F.lit("bad").alias("sink"), "code", "n")
    return good.unionByName(bad)


def _wide_file(spark, folder) -> str:
    path = work_path(spark, "wide")
    wide(spark, folder).write.parquet(path)
    return path


# ---- keyed state ----------------------------------------------------------------------------


def command_log(df):
    """view GET, click SET for an hour, purchase SET for good, error GETDEL, signup INCR on its own key."""
    kind = F.col("event_type")
    command = (F.when(kind == "view", "GET").when(kind.isin("click", "purchase"), "SET").when(kind == "error", "GETDEL").otherwise("INCR"))
    prefix = F.when(kind == "signup", F.lit("n:")).otherwise(F.lit("u:"))
    return df.select(
        F.concat(prefix, F.col("user_id").cast("string")).alias("key"), "ts", F.col("event_id").alias("seq"), command.alias("command"),
        F.when(kind.isin("click", "purchase"), F.concat(F.lit("v"), F.col("event_id"))).alias("value"),
        F.when(kind == "click", F.lit(3600)).cast("bigint").alias("ttl"))


KV_SQL = """WITH c AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS now, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) AS rn FROM events WHERE event_type <> 'signup'),
 s AS (SELECT *, max(CASE WHEN event_type IN ('click', 'purchase') THEN rn END) OVER w AS set_rn, max(CASE WHEN event_type = 'error' THEN rn END) OVER w AS del_rn, max(CASE WHEN event_type = 'view' THEN now END) OVER w AS get_now,
 last_value(CASE WHEN event_type IN ('click', 'purchase') THEN event_id END IGNORE NULLS) OVER w AS set_id FROM c WINDOW w AS (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 a AS (SELECT s.*, CASE WHEN e.event_type = 'click' THEN CAST(floor(epoch(e.ts)) AS BIGINT) + 3600 END AS expiry FROM s LEFT JOIN events e ON e.event_id = set_id),
 l AS (SELECT *, set_rn IS NOT NULL AND (del_rn IS NULL OR set_rn > del_rn) AND (expiry IS NULL OR get_now IS NULL OR get_now < expiry) AS alive FROM a)
 SELECT event_id AS seq, CASE WHEN event_type IN ('click', 'purchase') THEN 'OK' WHEN alive AND (event_type = 'error' OR expiry IS NULL OR expiry > now) THEN 'v' || set_id END AS result,
 CASE WHEN event_type = 'view' AND alive AND expiry <= now THEN 'expired' END AS code FROM l
 UNION ALL SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) AS VARCHAR), NULL FROM events WHERE event_type = 'signup'"""


@G.add("h1_kv_replay", KV_SQL)
def h1(spark, folder):
    return keystate.kv_replay(command_log(events(spark, folder))).select("seq", "result", "code")


@G.add("h1_kv_stream", KV_SQL)
def h1_stream(spark, folder):
    root = work_path(spark, "kv")
    stream = event_stream(spark, folder)
    streamed_state.stream_commands(command_log(stream), root).awaitTermination()
    return streamed_state.read_results(spark, root).select("seq", "result", "code")


@G.add("h4_counters", "SELECT 'n:' || user_id AS key, CAST(count(*) AS VARCHAR) AS state_value FROM events WHERE event_type = 'signup' GROUP BY user_id")
def h4(spark, folder):
    replayed = keystate.kv_replay(command_log(events(spark, folder)))
    return keystate.final_state(replayed).where("state_kind = 'int'").select("key", "state_value")


@G.add("h3_exists", "SELECT event_id AS seq, CASE WHEN n > 0 THEN '1' ELSE '0' END AS result FROM (SELECT event_id, event_type, count(*) FILTER (WHERE event_type = 'click') OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM events) WHERE event_type <> 'click'")
def h3(spark, folder):
    """Entries that expire at once, but are never read: they still exist."""
    log = events(spark, folder).select(
        F.col("user_id").cast("string").alias("key"), "ts", F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "click", "SET").otherwise("EXISTS").alias("command"), F.lit("x").alias("value"), F.lit(0).cast("bigint").alias("ttl"))
    return keystate.kv_replay(log).where("command = 'EXISTS'").select("seq", "result")


@G.add("h6_command_batches", "SELECT CAST(user_id AS VARCHAR) || '-' || day(ts) AS batch_id, count(*) AS n, bool_or(event_type = 'error') AS rejected FROM events GROUP BY 1")
def h6(spark, folder):
    """One malformed command rejects its whole batch."""
    log = events(spark, folder).select(
        F.col("user_id").cast("string").alias("key"), "ts", F.col("event_id").alias("seq"),
        F.concat_ws("-", F.col("user_id"), F.dayofmonth("ts")).alias("batch_id"),
        F.when(F.col("event_type") == "error", "DROP").otherwise("INCR").alias("command"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("ttl"))
    out = keystate.kv_replay(log)
    return out.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("code").isin("malformed", "batch_rejected") & F.col("result").isNull()).alias("_r")).select(
        "batch_id", "n", F.coalesce("_r", F.lit(False)).alias("rejected"))


# ---- search ---------------------------------------------------------------------------------
TOKENS_SQL = r"(SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS toks FROM documents)"
QUERY = ["the", "erst", "lytion", "onen"]


def _bm25_sql(words: list[str]) -> str:
    tf = ", ".join(f"len(list_filter(toks, lambda t: t = '{w}')) AS tf{i}" for i, w in enumerate(sorted(words)))
    stats = ", ".join(f"count(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(words)))
    score = " + ".join(f"ln(1.0 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * len * n / total))" for i in range(len(words)))
    hit = " OR ".join(f"tf{i} > 0" for i in range(len(words)))
    return f"""WITH c AS (SELECT doc_id, len(toks) AS len, {tf} FROM {TOKENS_SQL}), s AS (SELECT count(*)::DOUBLE AS n, sum(len)::DOUBLE AS total, {stats} FROM c),
 r AS (SELECT doc_id, round({score}, 6) AS score FROM c, s WHERE {hit}) SELECT doc_id, score, CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r ORDER BY score DESC, doc_id LIMIT 25"""


def _documents(spark, folder):
    return table(spark, folder, "documents")


@G.add("v1_full_text", _bm25_sql(QUERY))
def v1(spark, folder):
    return search.full_text(_documents(spark, folder), QUERY, 25)


@G.add("v1_indexed", _bm25_sql(QUERY))
def v1_indexed(spark, folder):
    """From a stored index, in ranges of 256 documents."""
    return postings.TextIndex.build(_documents(spark, folder), work_path(spark, "text"), range_rows=256).search(QUERY, 25)


WEIGHTS = {"the": 0.5, "erst": 2.0, "lytion": 1.5, "onen": 1.0}
SPARSE_SQL = f"""(SELECT doc_id, round(sum(CASE t {' '.join(f"WHEN '{t}' THEN CAST({w} AS DOUBLE)" for t, w in WEIGHTS.items())} END / n), 6) AS score FROM (SELECT doc_id, unnest(toks) AS t, len(toks) AS n FROM {TOKENS_SQL}) WHERE t IN ({', '.join(f"'{t}'" for t in WEIGHTS)}) GROUP BY 1)"""


def sparse_vectors(spark, folder):
    """One entry per token occurrence, weighted by one over the length."""
    toks = _documents(spark, folder).select("doc_id", search.tokens(F.col("text")).alias("tokens"))
    # A text without tokens has no entries.
    return toks.select("doc_id", "tokens", F.array_repeat(F.lit(1.0) / F.nullif(F.size("tokens"), F.lit(0)), F.size("tokens")).alias("weights"))


@G.add("v2_sparse_neighbors", f"SELECT doc_id, score, CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM {SPARSE_SQL} ORDER BY score DESC, doc_id LIMIT 25")
def v2(spark, folder):
    return search.sparse_neighbors(sparse_vectors(spark, folder), WEIGHTS, 25, "doc_id")


@G.add("v2_indexed", f"SELECT doc_id, score, CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM {SPARSE_SQL} ORDER BY score DESC, doc_id LIMIT 25")
def v2_indexed(spark, folder):
    """From a stored index, in ranges of 256 vectors."""
    return postings.SparseIndex.build(sparse_vectors(spark, folder), work_path(spark, "sparse"), "doc_id", range_rows=256).search(WEIGHTS, 25)


CENTROID_SQL = "(SELECT label, list(v ORDER BY dim) AS q FROM (SELECT label, dim, avg(CAST(x AS DOUBLE)) AS v FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"


def centroids(spark, folder):
    """The mean vector of every label: as many queries as there are labels."""
    per_dim = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x")).groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("v"))
    # One entry per dimension, so the list is as long as the vector.
    packed = per_dim.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("dim", "v"))).alias("l"))
    return packed.select(F.col("label").alias("query_id"), F.transform("l", lambda s: s["v"]).alias("embedding"))


@G.add("v3_dense_neighbors", f"""SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM
 (SELECT c.label AS query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS score FROM embeddings e, {CENTROID_SQL} c)) WHERE rank <= 10""")
def v3(spark, folder):
    return search.dense_neighbors(table(spark, folder, "embeddings"), centroids(spark, folder), 10)


@G.add("v4_fuse", f"""SELECT doc_id, round(sum(1.0 / (60 + rank)), 9) AS score FROM (SELECT doc_id, rank FROM ({_bm25_sql(QUERY)}) UNION ALL SELECT doc_id, rank FROM
 (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM {SPARSE_SQL} ORDER BY score DESC, doc_id LIMIT 25)) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def v4(spark, folder):
    docs = _documents(spark, folder)
    return search.fuse([search.full_text(docs, QUERY, 25), search.sparse_neighbors(sparse_vectors(spark, folder), WEIGHTS, 25, "doc_id")], limit=20)


@G.add("l4_score_order", "SELECT doc_id, score FROM (" + _bm25_sql(QUERY) + ") WHERE rank <= 5")
def l4(spark, folder):
    best = search.full_text(_documents(spark, folder), QUERY, 25)
    return best.orderBy(F.desc("score"), "doc_id").limit(5).select("doc_id", "score")
