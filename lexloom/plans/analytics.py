"""Star-schema and event queries: scans with pushdown, joins the optimiser plans, windows, streaming over files."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.session import shared_dir
from lexloom.sources.files import output_names
from lexloom.streaming.ingest import sessions, stream_table, windowed_counts
from lexloom.tables import load

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("q1_pricing_summary", """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""")
def q1(spark, d):
    df = load(spark, d, "lineitem").filter("l_shipdate <= TIMESTAMP_NTZ '1998-09-02'")
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"),
    )


@query("q3_open_orders", """SELECT o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'BUILDING' AND l_shipdate > o_orderdate GROUP BY o_orderkey ORDER BY round(sum(l_extendedprice * (1 - l_discount)), 2) DESC, o_orderkey LIMIT 10""")
def q3(spark, d):
    c = load(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    j = c.join(load(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey")).join(load(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).filter("l_shipdate > o_orderdate")
    g = j.groupBy("o_orderkey").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
    return g.orderBy(F.desc("revenue"), "o_orderkey").limit(10)


@query("q5_nation_revenue", """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY n_name""")
def q5(spark, d):
    j = load(spark, d, "lineitem").join(load(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(load(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("q_latest_order", """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1""")
def q_latest(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate").withColumn("k", F.row_number().over(w)).filter("k = 1").select("o_custkey", "o_orderkey")


_HOURS = "SELECT epoch_us(time_bucket(INTERVAL '60 minutes', ts)) AS window_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"


@query("rs_event_windows", _HOURS)
def rs_windows(spark, d):
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return windowed_counts(e).select(F.unix_micros("window_start").alias("window_us"), "event_type", "n", "total")


@query("rs_event_windows_stream", _HOURS)
def rs_stream(spark, d):
    """The same counts by Structured Streaming over the files, run to the end of what is there; every batch replaces the result."""
    schema = load(spark, d, "events").schema
    counted = windowed_counts(stream_table(spark, f"{d}/events.parque[t]", schema).withColumn("ts", F.col("ts").cast("timestamp")))
    out = f"{shared_dir(spark)}/lexloom-stream-{uuid.uuid4().hex}"
    sink = lambda batch, _: batch.write.mode("overwrite").parquet(f"{out}/table")
    counted.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", f"{out}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{out}/table").select(F.unix_micros("window_start").alias("window_us"), "event_type", "n", "total")


@query("rs_event_sessions", """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS edge, event_id FROM events),
    s AS (SELECT *, sum(edge) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT user_id, epoch_us(min(ts)) AS session_us, count(*) AS n FROM s GROUP BY user_id, k""")
def rs_sessions(spark, d):
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(e).select("user_id", F.unix_micros("session_start").alias("session_us"), "n")


@query("src02_output_names", """WITH p AS (SELECT DISTINCT '/in/' || source || '/' || document_id || '.pdf' AS path, source, CASE WHEN source = 'harun_hc' THEN 'judgment' ELSE document_id END AS s FROM doc_text WHERE source IS NOT NULL),
    f AS (SELECT '/in/' || source || '/' || substr(document_id, 4, 8) || '/' || CASE WHEN source = 'harun_hc' THEN 'judgment' ELSE document_id END || '.pdf' AS path, substr(document_id, 4, 8) AS parent, CASE WHEN source = 'harun_hc' THEN 'judgment' ELSE document_id END AS stem FROM (SELECT DISTINCT source, document_id FROM doc_text WHERE source IS NOT NULL))
    SELECT path, stem, CASE WHEN count(*) OVER (PARTITION BY stem) = 1 THEN stem ELSE substr(parent || '_' || stem, 1, 110) || '_' || substr(sha1(path), 1, 8) END AS output FROM f""")
def src02(spark, d):
    docs = load(spark, d, "doc_text").filter("source IS NOT NULL").select("source", "document_id").distinct()
    stem = F.when(F.col("source") == "harun_hc", "judgment").otherwise(F.col("document_id"))
    return output_names(docs.select(F.concat(F.lit("/in/"), "source", F.lit("/"), F.substring("document_id", 4, 8), F.lit("/"), stem, F.lit(".pdf")).alias("path")))
