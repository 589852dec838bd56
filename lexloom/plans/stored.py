"""Queries of sources and sinks: files written to the shared folder, read back by the operators, beside the rows they must give."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.text import tokens
from lexloom.operators import retrieval as R
from lexloom.operators.index import stored_index
from lexloom.plans.cases import Cases, values_sql
from lexloom.plans.relations import _exact, bm25, index_of
from lexloom.session import materialise, shared_dir
from lexloom.sources import files
from lexloom.streaming.ingest import ingest, stream_table
from lexloom.tables import load

C = Cases()
QUERIES, SQL = C.queries, C.sql


def put(spark: SparkSession, tree: dict[str, str]) -> str:
    """A new folder of the shared file system with the given small files; its path."""
    root = f"{shared_dir(spark)}/lexloom-files-{uuid.uuid4().hex}"
    for name, text in tree.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(text.encode()))
        out.close()
    return root


def filed(name: str, tree: dict[str, str], op, ddl: str, rows: list) -> None:
    QUERIES[name] = lambda spark, d: op(spark, put(spark, tree))
    SQL[name] = values_sql(ddl, rows)


filed("src01_expand_paths", {"a.pdf": "x", "in/b.pdf": "xy", "in/c.txt": "", "in/deep/d.PDF.pdf": "xyz"}, lambda spark, root: files.input_files(spark, root).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length").orderBy("path"), "name string, length bigint", [("a.pdf", 1), ("b.pdf", 2), ("d.PDF.pdf", 3)])
filed("src14_raw_log", {"log.jsonl": '{"page_number": 1, "raw": "one"}\nbroken\n{"page_number": 2, "raw": "two"}\n{"page_number": 1, "raw": "again"}\n{"raw": "no page"}\n'}, files.raw_log, "page_number int, raw string", [(1, "again"), (2, "two")])
filed("src26_parsed_folder", {"a.json": '{"document": {"id": "A"},\n "pages": [{"page_number": 1}]}', "manifest.json": '{"document": {"id": "M"}}', "bad.json": "{not json", "b.json": '{"document": {"id": "B"}, "pages": []}'},
      lambda spark, root: files.parsed_folder(spark, root, "document struct<id:string>, pages array<struct<page_number:int>>").select("stem", F.col("document.id").alias("id"), F.size("pages").alias("pages")), "stem string, id string, pages int", [("a", "A", 1), ("b", "B", 0)])
filed("src29_statute_sidecars", {"5_stamp.txt": "Page 1\n\nTHE STAMP ACT, 1899\nbody", "6_none.txt": "nothing\nhere", "7_late.txt": "x\n" * 25 + "THE LATE ACT"}, lambda spark, root: files.sidecar_titles(spark, root).select("file", "title"), "file string, title string", [("5_stamp.txt", "THE STAMP ACT, 1899"), ("6_none.txt", None), ("7_late.txt", None)])
filed("src23_email_source", {"m.eml": "From: A <a@x.org>\nTo: b@x.org, c@x.org\nCc: d@x.org\nDate: Mon, 1 Jan 2001 10:00:00 +0000\nSubject: Notice\nContent-Type: text/plain\n\nThe body.\n"},
      lambda spark, root: files.email_records(spark, root).select("from", F.size("to").alias("n_to"), F.size("cc").alias("n_cc"), "subject", F.trim(F.regexp_replace("body_text", r"\s+$", "")).alias("body")), "from string, n_to int, n_cc int, subject string, body string", [("A <a@x.org>", 2, 1, "Notice", "The body.")])
SQL["src23_email_source"] = SQL["src23_email_source"].replace(" AS from,", ' AS "from",')


def guarded(df: DataFrame) -> DataFrame:
    """Whether writing to `out` beside inputs is allowed."""

    def allowed(out: str, inputs: str) -> bool:
        try:
            files.check_output(out, inputs.split(";"))
        except ValueError:
            return False
        return True

    ok = F.udf(allowed, "boolean")  # a check of a handful of paths, not a data path
    return df.select("out", ok("out", "inputs").alias("allowed"))


C.add("src27_read_only_guard", "out string, inputs string", [("/data/out", "/data/in"), ("/data/in", "/data/in/"), ("/data/in/deep/x", "/else;/data/in"), ("/data/input", "/data/in"), ("/data/a/../in/x", "/data/in")], guarded, "out string, allowed boolean", [("/data/out", True), ("/data/in", False), ("/data/in/deep/x", False), ("/data/input", True), ("/data/a/../in/x", False)])


def round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The statute table exported as ordered JSONL and read again."""
    out = f"{shared_dir(spark)}/lexloom-export-{uuid.uuid4().hex}"
    s = load(spark, d, "statute_index").select("statute_id", "title", "act_year")
    files.export_jsonl(s, out, ["statute_id"])
    return spark.read.schema(s.schema).json(out)


C.table("src28_jsonl_round_trip", round_trip, "SELECT statute_id, title, act_year FROM statute_index")
C.add("src33_run_manifest", "status string, error string, pages int", [("done", None, 3), ("done", None, 4), ("failed", "broken", None)], lambda df: files.manifest(df).select("status", F.col("documents").cast("int").alias("documents"), F.col("failures").cast("int").alias("failures"), F.col("pages").cast("int").alias("pages")),
      "status string, documents int, failures int, pages int", [("done", 2, 0, 7), ("failed", 1, 1, None)])


def label_sheet(spark: SparkSession, d: str) -> DataFrame:
    """A sheet written as CSV with a header and read again: blank labels are left out."""
    out = f"{shared_dir(spark)}/lexloom-sheet-{uuid.uuid4().hex}"
    rows = spark.createDataFrame([("1", "right", "a, b"), ("2", " ", "x"), ("3", None, "y"), ("4", "wrong", 'say "so"')], "sample_id string, label string, notes string")
    rows.write.option("header", True).option("escape", '"').csv(out)
    return spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(out).filter(F.trim("label") != "")


QUERIES["src38_label_sheet"] = label_sheet
SQL["src38_label_sheet"] = values_sql("sample_id string, label string, notes string", [("1", "right", "a, b"), ("4", "wrong", 'say "so"')])


def gold_records(records: DataFrame, paths: DataFrame) -> DataFrame:
    """doc_id, page, path: gold pages neither discarded nor flagged, with the path of their document, by page where the table has pages."""
    kept = records.filter(~F.coalesce("discarded", F.lit(False)) & ~F.coalesce("flagged", F.lit(False)))
    j = kept.alias("r").join(paths.alias("p"), F.expr("r.doc_id = p.doc_id AND (p.page IS NULL OR p.page = r.page)"))
    return j.select("r.doc_id", "r.page", "p.path")


C.many("src41_gold_pages", {"records": ("doc_id string, page int, discarded boolean, flagged boolean", [("a", 1, None, None), ("a", 2, True, None), ("b", 1, False, True), ("c", 7, False, False), ("d", 1, None, None)]), "paths": ("doc_id string, page int, path string", [("a", 1, "/a1"), ("a", 2, "/a2"), ("c", None, "/c")])},
       gold_records, "doc_id string, page int, path string", [("a", 1, "/a1"), ("c", 7, "/c")])


def replayed(spark: SparkSession, d: str) -> DataFrame:
    """event_id of the events table ingested twice as a stream, the second time as after a lost log: nothing is added twice."""
    out = f"{shared_dir(spark)}/lexloom-ingest-{uuid.uuid4().hex}"
    schema = load(spark, d, "events").schema
    for k in range(2):
        ingest(stream_table(spark, f"{d}/events.parque[t]", schema), lambda b: b.select("event_id", "event_type"), f"{out}/table", f"{out}/log{k}", ["event_id"])
    return spark.read.parquet(f"{out}/table")


C.table("rs_ingest_once", replayed, "SELECT DISTINCT event_id, event_type FROM events")


def in_flight(spark: SparkSession, d: str) -> DataFrame:
    """documents and sources seen so far by a report over the table a stream is filling."""
    out = f"{shared_dir(spark)}/lexloom-flight-{uuid.uuid4().hex}"
    schema = load(spark, d, "doc_text").schema
    ingest(stream_table(spark, f"{d}/doc_text.parque[t]", schema), lambda b: b.select("document_id", "source"), f"{out}/table", f"{out}/log", ["document_id"])
    return spark.read.parquet(f"{out}/table").groupBy("source").agg(F.count("*").alias("documents"))


C.table("rs04_in_flight_report", in_flight, "SELECT source, count(*) AS documents FROM (SELECT DISTINCT document_id, source FROM doc_text) GROUP BY source")


def hash_vectors(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, bucket, weight: counts of crc32(token) mod 256, to unit length."""
    words = df.select(key, F.explode(tokens(text)).alias("t")).groupBy(key, F.pmod(F.crc32(F.encode("t", "utf-8")), F.lit(256)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    norm = words.groupBy(key).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return words.join(norm, key).select(key, "bucket", (F.col("n") / F.col("norm")).alias("weight"))


def sharded(spark: SparkSession, d: str, shards: int = 4) -> DataFrame:
    """id, bucket: chunks embedded shard by shard into a stored table, resumed after half of the shards: those done are not done again,
    and the assembly fails if any chunk is short."""
    out = f"{shared_dir(spark)}/lexloom-shards-{uuid.uuid4().hex}"
    chunks = load(spark, d, "chunks").filter("text IS NOT NULL").groupBy("id").agg(F.min("text").alias("text")).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    for run in (range(shards // 2), range(shards)):  # the first run stops half way
        have = {r.shard for r in spark.read.parquet(out).select("shard").distinct().collect()} if run.stop == shards else set()
        for k in run:
            if k not in have:
                part = chunks.filter(F.col("shard") == k)
                hash_vectors(part, "id", "text").withColumn("shard", F.lit(k)).write.mode("append").parquet(out)
    made = spark.read.parquet(out)
    asked = chunks.filter(F.size(tokens("text")) > 0).count()
    if made.select("id").distinct().count() != asked:
        raise ValueError(f"{asked} chunks were to be embedded; run again to finish")
    return made.groupBy("id").agg(F.count("*").alias("buckets"), F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("norm"))


C.table("rs02_sharded_embedding", sharded)


def persisted(spark: SparkSession, d: str) -> DataFrame:
    """tables and rows of the stored index, opened a second time without being built again."""
    index_of(spark, d)
    again = stored_index(load(spark, d, "chunks"), "id", "text", "chunks", load(spark, d, "chunks"))
    return again.terms.agg(F.count("*").alias("terms"), F.sum("df").alias("postings"))


C.table("src37_index_persistence", persisted, """WITH c AS (SELECT id, min(text) AS text FROM chunks WHERE text IS NOT NULL GROUP BY id), t AS (SELECT DISTINCT id, unnest(list_transform(regexp_extract_all(text, '([A-Za-z]+|[0-9]+[A-Za-z]*)', 1), lambda x: lower(x))) AS term FROM c)
    SELECT count(DISTINCT term) AS terms, count(*)::HUGEINT AS postings FROM t""")  # fmt: skip


def legs(every: dict[str, DataFrame], use: tuple[str, ...]) -> DataFrame:
    """Fused results of a subset of the legs."""
    return R.fuse([(k, leg) for k, leg in every.items() if k in use], "id")


def by_leg(spark: SparkSession, d: str) -> DataFrame:
    """Hits of each leg alone and of the blend: legs, queries, hits. Each leg is searched once."""
    every = {"exact": materialise(_exact(spark, d), "leg"), "bm25": materialise(bm25(spark, d), "leg")}
    out = None
    for use in (("exact",), ("bm25",), ("exact", "bm25")):
        one = legs(every, use).agg(F.lit("+".join(use)).alias("legs"), F.countDistinct("query_id").alias("queries"), F.count("*").alias("hits"))
        out = one if out is None else out.unionByName(one)
    return out


def _by_leg_sql() -> str:
    from lexloom.plans.relations import _BM25, _EXACT

    top = lambda s: f"(SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, f, id) AS k FROM ({s}))"
    e, b = "SELECT query_id, id, round(1.0 / (60 + rank), 12) AS s, rank AS f FROM e WHERE rank <= 100", "SELECT query_id, id, round(1.0 / (60 + rank), 12) AS s, rank AS f FROM r WHERE rank <= 100"
    u = "SELECT query_id, id, round(sum(1.0 / (60 + rank)), 12) AS s, min(leg * 1000 + rank) AS f FROM (SELECT query_id, id, rank, 0 AS leg FROM e WHERE rank <= 100 UNION ALL SELECT query_id, id, rank, 1 FROM r WHERE rank <= 100) GROUP BY query_id, id"
    one = lambda name, s: f"SELECT '{name}' AS legs, count(DISTINCT query_id) AS queries, count(*) AS hits FROM {top(s)} WHERE k <= 10"
    return f"{_BM25}, {_EXACT} {one('exact', e)} UNION ALL {one('bm25', b)} UNION ALL {one('exact+bm25', u)}"


C.table("ud07_legs_selector", by_leg, _by_leg_sql())
