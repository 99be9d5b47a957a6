"""Sources, row transforms, partition layouts, user functions and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.operators import rows, sinks
from millrace.plans.registry import LINES_SQL, SENSOR_SQL, WORDS_SQL, query
from millrace.session import scratch
from millrace.sources import custom, logs, records, tables
from millrace.streaming import live


def sensors(spark, sf):
    return tables.sensor(tables.events(spark, sf))


def lines(spark, sf):
    documents = tables.table(spark, sf, "documents").select("doc_id", "text")
    return tables.document_lines(tables.spread(documents, tables.read_tasks(spark)))


def _epoch():
    return F.unix_timestamp(F.col("ts").cast("timestamp"))


def _sensor_csv(spark, sf):
    return sensors(spark, sf).select(F.concat_ws(",", "id", _epoch(), "vc").alias("value"), "event_id")


# Sources

@query("text_lines", "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def text_lines(spark, sf):
    folder = scratch(spark, "lines")
    logs.Log(folder, "files").write(tables.table(spark, sf, "documents").select(F.col("text").alias("value")))
    return logs.text_lines(spark, folder).withColumnRenamed("value", "line")


@query("inline_rows", """
SELECT event_id, kind FROM events
LEFT JOIN (VALUES ('view', 'touch'), ('click', 'touch'), ('signup', 'trade'), ('purchase', 'trade')) k(event_type, kind)
USING (event_type)""")
def inline_rows(spark, sf):
    """Rows given in the program, used beside a stored table; they are four, so broadcast."""
    kinds = records.from_rows(
        spark,
        [("view", "touch"), ("click", "touch"), ("signup", "trade"), ("purchase", "trade")],
        "event_type STRING, kind STRING",
    )
    return tables.events(spark, sf).join(F.broadcast(kinds), "event_type", "left").select("event_id", "kind")


@query("parse_records", """
SELECT event_id, CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000000 AS ts, CAST(floor(value) AS INTEGER) AS vc
FROM events""")
def parse_records(spark, sf):
    return records.parse(_sensor_csv(spark, sf), records.SENSOR, keep=("event_id",))


@query("parse_empty_fields", """
SELECT event_id, user_id AS order_id, event_type,
       CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) ELSE '' END AS tx_id,
       epoch_us(ts) // 1000000 AS ts
FROM events""")
def parse_empty_fields(spark, sf):
    tx = F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).otherwise("")
    text = F.concat_ws(",", "user_id", "event_type", tx, _epoch())
    return records.parse(
        tables.events(spark, sf).select(text.alias("value"), "event_id"), records.ORDER, keep=("event_id",)
    )


_PARSED = "SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000000 AS ts, CAST(floor(value) AS INTEGER) AS vc FROM events"


@query("csv_table", _PARSED)
def csv_table(spark, sf):
    folder = scratch(spark, "csv")
    sinks.append_csv(sensors(spark, sf).select("id", _epoch().alias("ts"), "vc"), folder)
    logs.csv_table(spark, folder, records.SENSOR, "sensor_csv")
    return spark.sql("SELECT id, ts, vc FROM sensor_csv")


@query("log_source", "SELECT concat(user_id, ',', epoch_us(ts) // 1000000, ',', CAST(floor(value) AS INTEGER)) AS value FROM events")
def log_source(spark, sf):
    log = logs.Log(scratch(spark, "log"), "files")
    log.write(_sensor_csv(spark, sf))
    return live.drain(log.read_stream(spark), "append").drop("batch")


@query("log_csv_table", _PARSED)
def log_csv_table(spark, sf):
    log = logs.Log(scratch(spark, "log"), "files", start="earliest")
    log.write(_sensor_csv(spark, sf))
    return live.drain(logs.csv_values(log.read_stream(spark), records.SENSOR), "append").drop("batch")


@query("live_lines", "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def live_lines(spark, sf):
    folder = scratch(spark, "feed")
    logs.Log(folder, "files").write(tables.table(spark, sf, "documents").select(F.col("text").alias("value")))
    return live.drain(logs.live_lines(spark, folder), "append").drop("batch").withColumnRenamed("value", "line")


_EVENT_RECORD = "event_id BIGINT, user_id BIGINT, event_type STRING, ts STRING"


def _event_text():
    return F.to_json(F.struct("event_id", "user_id", "event_type", F.col("ts").cast("string").alias("ts")))


def _event_records(spark, sf, *conditions):
    """The events as records of a user-defined log, one commit for each condition."""
    custom.register(spark)
    path = scratch(spark, "records")
    rows_ = tables.events(spark, sf)
    for condition in conditions:
        rows_.where(condition).select(_event_text().alias("value")).write.format("record_log").mode("append").option("path", path).save()
    return path


def _parsed(records_):
    return records_.select(F.from_json("value", _EVENT_RECORD).alias("r")).select("r.*").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("custom_source", "SELECT event_id, user_id, event_type, ts FROM events")
def custom_source(spark, sf):
    path = _event_records(spark, sf, "true")
    return _parsed(spark.read.format("record_log").option("path", path).load())


@query("custom_source_live", "SELECT event_id, user_id, event_type FROM events")
def custom_source_live(spark, sf):
    """Two commits, the second after the stream has read the first."""
    checkpoint, out = scratch(spark, "progress"), scratch(spark, "emitted")
    path = _event_records(spark, sf, "event_type = 'click'")
    for condition in ("event_type <> 'click'", None):
        log = _parsed(spark.readStream.format("record_log").option("path", path).load())
        emitted = live.drain(log.select("event_id", "user_id", "event_type"), "append", checkpoint=checkpoint, out=out)
        if condition:
            later = tables.events(spark, sf).where(condition).select(_event_text().alias("value"))
            later.write.format("record_log").mode("append").option("path", path).save()
    return emitted.drop("batch")


# Row transforms

@query("map_project", "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents")
def map_project(spark, sf):
    return tables.table(spark, sf, "documents").select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query("map_suffix", "SELECT conv_id, turn, text || '-myMap' AS text FROM conversations")
def map_suffix(spark, sf):
    return rows.append_suffix(tables.table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text")


@query("flatmap_words", f"WITH {WORDS_SQL} SELECT doc_id, line_no, pos, word FROM w")
def flatmap_words(spark, sf):
    return document_words(spark, sf)


def document_words(spark, sf):
    words = rows.explode_words(lines(spark, sf), "line", "doc_id", "line_no")
    return words.select("doc_id", F.col("line_no").cast("bigint"), F.col("pos").cast("bigint"), "word")


@query("filter_prefix", f"WITH {LINES_SQL} SELECT doc_id, line FROM l WHERE starts_with(line, 'Un')")
def filter_prefix(spark, sf):
    return lines(spark, sf).where(F.col("line").startswith("Un")).select("doc_id", "line")


@query("process_pairs", f"WITH {WORDS_SQL} SELECT doc_id, word, CAST(1 AS BIGINT) AS one FROM w")
def process_pairs(spark, sf):
    return document_words(spark, sf).select("doc_id", "word", F.lit(1).cast("bigint").alias("one"))


def _split(spark, sf):
    return rows.split_output(
        sensors(spark, sf), F.col("vc") >= 30,
        [F.col(c) for c in ("event_id", "id", "ts", "vc")], [F.col("id"), F.col("vc")],
    )


@query("split_main", f"WITH {SENSOR_SQL} SELECT event_id, id, ts, vc FROM s WHERE vc >= 30")
def split_main(spark, sf):
    return _split(spark, sf)[0]


@query("split_side", f"WITH {SENSOR_SQL} SELECT id, vc FROM s WHERE vc < 30")
def split_side(spark, sf):
    return _split(spark, sf)[1]


@query("union_all", """
SELECT event_id AS id, ts, user_id FROM events
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP), o_custkey FROM orders""")
def union_all(spark, sf):
    """Two whole inputs of one type; repeated rows stay."""
    events = tables.events(spark, sf).select(F.col("event_id").alias("id"), "ts", "user_id")
    orders = tables.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts"), F.col("o_custkey").alias("user_id"))
    return events.unionByName(orders)


@query("co_map", """
SELECT 'left' AS side, role AS mapped FROM conversations
UNION ALL SELECT 'right', CAST(event_id * 2 AS VARCHAR) FROM events""")
def co_map(spark, sf):
    return rows.connect(
        tables.table(spark, sf, "conversations"), tables.events(spark, sf),
        F.col("role"), (F.col("event_id") * 2).cast("string"), "mapped",
    )


@query("table_filter", f"WITH {SENSOR_SQL} SELECT id, ts, vc FROM s WHERE id = 1 AND vc >= 20")
def table_filter(spark, sf):
    return sensors(spark, sf).where(F.col("id") == 1).where("vc >= 20").select("id", "ts", "vc")


# Partition layout

@query("layout_key", "SELECT user_id, CAST(1 AS BIGINT) AS partitions, count(*) AS ct FROM events GROUP BY user_id")
def layout_key(spark, sf):
    """Every key in one partition, after redistribution by key."""
    placed = rows.by_key(tables.events(spark, sf).select("user_id"), tables.tasks(spark), "user_id")
    return placed.select("user_id", F.spark_partition_id().alias("p")).groupBy("user_id").agg(
        F.count_distinct("p").alias("partitions"), F.count(F.lit(1)).alias("ct")
    )


@query("layout_spread", "SELECT event_id, user_id FROM events UNION ALL SELECT event_id, user_id FROM events")
def layout_spread(spark, sf):
    events = tables.events(spark, sf).select("event_id", "user_id")
    return rows.spread_random(events, tables.tasks(spark)).unionByName(rows.spread_evenly(events, tables.tasks(spark)))


@query("layout_rescale", "SELECT event_id, user_id FROM events")
def layout_rescale(spark, sf):
    return rows.rescale(tables.events(spark, sf).select("event_id", "user_id"), max(1, tables.tasks(spark) // 2))


@query("layout_replicate", "SELECT event_id, CAST(i AS INTEGER) AS consumer FROM events, range(4) r(i)")
def layout_replicate(spark, sf):
    return rows.replicate(tables.events(spark, sf).select("event_id"), 4)


@query("layout_global", "SELECT event_type, count(*) AS ct FROM events GROUP BY event_type")
def layout_global(spark, sf):
    return rows.to_one(tables.events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("ct")))


# User functions

@query("udf_substring", "SELECT event_id, substr(props, 2, 2) AS a, substr(props, 3, 1) AS b FROM events")
def udf_substring(spark, sf):
    p = F.col("props")
    return tables.events(spark, sf).select(
        "event_id", udfs.substring_range(p, 1, 3).alias("a"), udfs.substring_range(p, 2, 3).alias("b")
    )


@query("udf_sql", "SELECT event_id, substr(props, 1, 4) AS a FROM events")
def udf_sql(spark, sf):
    udfs.register_substring(spark)
    return spark.sql("SELECT event_id, substring_range(props, 0, 4) AS a FROM {e}", e=tables.events(spark, sf))


@query("udf_batches", "SELECT event_id, substr(props, 2, 2) AS a FROM events")
def udf_batches(spark, sf):
    return tables.events(spark, sf).select("event_id", udfs.substring_batches(1, 3)("props").alias("a"))


@query("udtf_words", f"WITH {WORDS_SQL} SELECT doc_id, line_no, pos, word FROM w")
def udtf_words(spark, sf):
    spark.udtf.register("split_table", udfs.words_of_table())
    lines(spark, sf).createOrReplaceTempView("_lines_to_split")
    return spark.sql(
        "SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(pos AS BIGINT) AS pos, word "
        "FROM split_table(TABLE(_lines_to_split))"
    )


@query("udaf_count", "SELECT event_type, count(*) AS ct FROM events GROUP BY event_type")
def udaf_count(spark, sf):
    return udfs.count_by_key(tables.events(spark, sf).select("event_type"), "event_type")


@query("udaf_mean", f"WITH {SENSOR_SQL} SELECT id, CAST(sum(vc) AS DOUBLE) / count(*) AS mean FROM s GROUP BY id")
def udaf_mean(spark, sf):
    return udfs.mean_by_key(sensors(spark, sf).select("id", "vc"), "id", "vc")


_JSON_SQL = """
SELECT event_id, '{"id":' || user_id || ',"vc":' || CAST(floor(value) AS BIGINT) || '}' AS value FROM events"""


@query("to_json_rows", _JSON_SQL)
def to_json_rows(spark, sf):
    return sensors(spark, sf).select("event_id", F.to_json(F.struct("id", "vc")).alias("value"))


# Sinks, read back

@query("sink_json_log", "SELECT user_id AS id, epoch_us(ts) // 1000000 AS ts, CAST(floor(value) AS BIGINT) AS vc FROM events")
def sink_json_log(spark, sf):
    log = logs.Log(scratch(spark, "topic"), "files")
    stream = tables.sensor(tables.event_stream(spark, sf)).select("id", _epoch().alias("ts"), "vc")
    log.write_stream(logs.json_values(stream), scratch(spark, "progress"), availableNow=True).awaitTermination()
    schema = "id BIGINT, ts BIGINT, vc BIGINT"
    return log.read(spark).select(F.from_json("value", schema).alias("r")).select("r.*")


_NEWEST = f"""WITH {SENSOR_SQL}
SELECT id, arg_max(event_id, event_id) AS event_id, arg_max(ts, event_id) AS ts, arg_max(vc, event_id) AS vc FROM s GROUP BY id"""


@query("sink_upsert", _NEWEST)
def sink_upsert(spark, sf):
    """A batch into a keyed table, a snapshot, and a batch that changes rows of the snapshot."""
    path = scratch(spark, "keyed")
    readings = sensors(spark, sf)
    sinks.upsert(readings.where("vc < 30"), 0, path, "id", "event_id")
    sinks.compact(spark, path, "id", "event_id")
    sinks.upsert(readings.where("vc >= 30"), 1, path, "id", "event_id")
    return sinks.upserted(spark, path, "id", "event_id")


@query("sink_upsert_live", _NEWEST)
def sink_upsert_live(spark, sf):
    path = scratch(spark, "keyed")
    stream = tables.sensor(tables.event_stream(spark, sf))
    stream.writeStream.foreachBatch(
        lambda batch, batch_id: sinks.upsert(batch, batch_id, path, "id", "event_id")
    ).option("checkpointLocation", scratch(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return live.plain_time(sinks.upserted(spark, path, "id", "event_id"), "ts")


@query("sink_docs", f"WITH {SENSOR_SQL} SELECT id, epoch_us(ts) // 1000000 AS ts, vc FROM s WHERE vc >= 20")
def sink_docs(spark, sf):
    path = scratch(spark, "docs")
    sinks.append_documents(sensors(spark, sf).where("vc >= 20").select("id", _epoch().alias("ts"), "vc"), path)
    return spark.read.schema("id BIGINT, ts BIGINT, vc BIGINT").json(path)


@query("sink_csv", f"WITH {SENSOR_SQL} SELECT CAST(id AS VARCHAR) AS id, count(*) AS ct FROM s GROUP BY id")
def sink_csv(spark, sf):
    path = scratch(spark, "csv")
    sinks.append_csv(sensors(spark, sf).groupBy("id").agg(F.count("id").alias("ct")), path)
    return logs.csv_table(spark, path, "id STRING, ct BIGINT", "sensor_counts")


_READINGS_SQL = f"WITH {SENSOR_SQL} SELECT event_id, id, vc FROM s"


def _read_records(spark, path):
    log = spark.read.format("record_log").option("path", path).load()
    return log.select(F.from_json("value", "event_id BIGINT, id BIGINT, vc BIGINT").alias("r")).select("r.*")


@query("custom_sink", _READINGS_SQL)
def custom_sink(spark, sf):
    custom.register(spark)
    path = scratch(spark, "records")
    readings = sensors(spark, sf).select(F.to_json(F.struct("event_id", "id", "vc")).alias("value"))
    readings.write.format("record_log").mode("append").option("path", path).save()
    return _read_records(spark, path)


@query("custom_sink_live", _READINGS_SQL)
def custom_sink_live(spark, sf):
    custom.register(spark)
    path = scratch(spark, "records")
    readings = tables.sensor(tables.event_stream(spark, sf)).select(F.to_json(F.struct("event_id", "id", "vc")).alias("value"))
    readings.writeStream.format("record_log").option("path", path).option(
        "checkpointLocation", scratch(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return _read_records(spark, path)


# SQL over tables and named connectors

@query("sql_inline", f"WITH {SENSOR_SQL} SELECT id, ts, vc FROM s WHERE id = 1")
def sql_inline(spark, sf):
    return spark.sql("SELECT id, ts, vc FROM {t} WHERE id = 1", t=sensors(spark, sf))


@query("sql_view", f"WITH {SENSOR_SQL} SELECT id, ts, vc FROM s WHERE id = 1")
def sql_view(spark, sf):
    sensors(spark, sf).createOrReplaceTempView("sensor")
    return spark.sql("SELECT id, ts, vc FROM sensor WHERE id = 1")


def _sensor_log(spark, sf):
    log = logs.Log(scratch(spark, "topic"), "files", start="earliest")
    log.write(logs.to_csv_values(sensors(spark, sf).select("id", "vc")))
    return log


@query("sql_filter_insert", f"WITH {SENSOR_SQL} SELECT CAST(id AS VARCHAR) AS id, CAST(vc AS INTEGER) AS vc FROM s WHERE id = 1")
def sql_filter_insert(spark, sf):
    """From one log to another through SQL, as a stream."""
    source, target = _sensor_log(spark, sf), logs.Log(scratch(spark, "topic"), "files")
    schema = "id STRING, vc INT"
    named = logs.Tables(spark)
    named.source("source_sensor", lambda s: logs.csv_values(source.read_stream(s), schema))
    named.sink("sink_sensor", lambda df: target.write_stream(
        logs.to_csv_values(df), scratch(spark, "progress"), availableNow=True
    ).awaitTermination())
    named.insert("sink_sensor", "SELECT * FROM source_sensor WHERE id = '1'")
    return logs.csv_values(target.read(spark), schema)


@query("sql_upsert_agg", f"WITH {SENSOR_SQL} SELECT CAST(id AS VARCHAR) AS id, CAST(count(*) AS INTEGER) AS vc FROM s GROUP BY id")
def sql_upsert_agg(spark, sf):
    """A streaming SQL aggregate kept current in a keyed table."""
    source, path = _sensor_log(spark, sf), scratch(spark, "keyed")
    named = logs.Tables(spark)
    named.source("source_counted", lambda s: logs.csv_values(source.read_stream(s), "id STRING, vc INT"))

    def write(batch, batch_id):
        sinks.upsert(batch.withColumn("at", F.lit(batch_id)), batch_id, path, "id", "at")

    named.sink("sink_counted", lambda df: df.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", scratch(spark, "progress")
    ).trigger(availableNow=True).start().awaitTermination())
    named.insert("sink_counted", "SELECT id, CAST(count(*) AS INT) AS vc FROM source_counted GROUP BY id")
    return sinks.upserted(spark, path, "id", "at").select("id", "vc")
