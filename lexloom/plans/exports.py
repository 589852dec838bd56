"""Queries of exported forms: tables as markdown, judgment bodies as law-document nodes, reporter headers, page facts, stored records."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.legal import citations
from lexloom.operators import pages as P
from lexloom.plans.cases import Cases
from lexloom.plans.graph import case_ecli
from lexloom.session import shared_dir
from lexloom.tables import load

C = Cases()
QUERIES, SQL = C.queries, C.sql


def table_markdown(rows):
    """A pipe table of an array of rows: short rows padded, line breaks in cells as blanks, the first row as head; '' for none."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    cell = lambda c: F.trim(F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "\n ", "  "), "[ \t]+", " "))
    padded = F.transform(rows, lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, cell), F.array_repeat(F.lit(""), width - F.size(r))), " | "), F.lit(" |")))
    divider = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(padded, 1, 1), F.array(divider), F.slice(padded, F.lit(2), F.greatest(F.size(rows), F.lit(1)))), "\n")).otherwise("")


C.add("fn43_table_markdown", "case_no int, rows array<array<string>>", [(0, [["a", "b\nc"], ["d"]]), (1, []), (2, [["x  y"]])], lambda df: df.select("case_no", table_markdown(F.col("rows")).alias("markdown")), "case_no int, markdown string", [(0, "| a | b c |\n| --- | --- |\n| d |  |"), (1, ""), (2, "| x y |\n| --- |")])

_B = "document_id string, page int, ord int, block_id string, type string, text string, decorative boolean"


def body_nodes(blocks):
    """document_id, eid, kind, num, text, block_id: content blocks numbered apart as headings and paragraphs, in reading order, with the
    paragraph number printed in front."""
    b = blocks.filter((F.trim("text") != "") & ~F.col("type").isin("header", "footer", "footnote") & ~F.coalesce("decorative", F.lit(False))).withColumn("kind", F.when(F.col("type") == "heading", "heading").otherwise("paragraph"))
    n = F.row_number().over(Window.partitionBy("document_id", "kind").orderBy("page", "ord"))
    num = F.when(F.col("kind") == "paragraph", F.nullif(F.regexp_extract(F.trim("text"), r"^(\d{1,3})\.\s", 1), F.lit("")))
    return b.select("document_id", F.concat_ws("_", F.when(F.col("kind") == "heading", "heading").otherwise("para"), n).alias("eid"), "kind", num.alias("num"), F.trim("text").alias("text"), "block_id")


C.add("fn50_judgment_body", _B, [("d", 1, 0, "a", "heading", "ORDER", None), ("d", 1, 1, "b", "text", "1. The plea", False), ("d", 1, 2, "c", "footer", "9", None), ("d", 1, 3, "e", "text", " ", None), ("d", 2, 0, "f", "text", "No number", True), ("d", 2, 1, "g", "list", "Second", None)], body_nodes,
      "document_id string, eid string, kind string, num string, text string, block_id string", [("d", "heading_1", "heading", None, "ORDER", "a"), ("d", "para_1", "paragraph", "1", "1. The plea", "b"), ("d", "para_2", "paragraph", None, "Second", "g")])


def work_uris(df):
    """document_id, uri: of a judgment by its case identifier and date where both are known, else by the hash of its id."""
    e = case_ecli(F.col("court"), F.col("neutral"), F.col("decided"), F.col("number"))
    part = lambda i: F.lower(F.element_at(F.split(e, ":"), i))
    known = F.when(e.isNotNull() & F.col("decided").isNotNull(), F.concat_ws("/", F.lit("/akn/pk/judgment"), part(3), "decided", part(5)))
    return df.select("document_id", F.coalesce(known, F.concat(F.lit("/akn/pk/judgment/hash/"), F.substring(F.sha2("document_id", 256), 1, 16))).alias("uri"))


C.add("src34_work_uri", "document_id string, court string, neutral string, decided string, number string", [("a", "lahore_high_court", "2023 LHC 5924", "2023-05-06", None), ("b", None, None, None, None)], work_uris, "document_id string, uri string", [("a", "/akn/pk/judgment/lhc/2023-05-06/5924"), ("b", "x")])
SQL["src34_work_uri"] = "SELECT 'a' AS document_id, '/akn/pk/judgment/lhc/2023-05-06/5924' AS uri UNION ALL SELECT 'b', '/akn/pk/judgment/hash/' || substr(sha256('b'), 1, 16)"


def reporter_headers(blocks):
    """document_id, citation, block_id: the report a document is a print of: one of the first three content blocks of its first page is
    a citation of a non-neutral series for four fifths of its length."""
    first = blocks.withColumn("_p", F.min("page").over(Window.partitionBy("document_id"))).filter((F.col("page") == F.col("_p")) & (F.trim("text") != "") & ~F.coalesce("decorative", F.lit(False)))
    top = first.withColumn("_n", F.row_number().over(Window.partitionBy("document_id").orderBy("ord"))).filter("_n <= 3").withColumn("key", F.concat_ws("\u0001", "document_id", "block_id"))
    m = citations.citation_mentions(top, "key").filter((F.col("jurisdiction") == "PK") & ~F.col("series").isin(*citations.NEUTRAL)).select("key", "id", "start", F.length("text").alias("n"))
    bare = F.length(F.regexp_replace(F.trim(F.regexp_replace("text", r"\s+", " ")), r"[\[\]().,:;\s-]+$", ""))
    hit = top.join(m, "key").filter(F.col("n") >= bare * 0.8)
    one = hit.withColumn("_k", F.row_number().over(Window.partitionBy("document_id").orderBy("ord", "start"))).filter("_k = 1")
    return one.select("document_id", F.col("id").alias("citation"), "block_id")


C.add("fn34_reporter_header", _B, [("a", 1, 0, "x", "heading", "2008 SCMR 598.", None), ("b", 1, 0, "x", "text", "The case of Ali (2008 SCMR 598) was relied on below", None), ("c", 1, 0, "x", "text", "2023 LHC 5", None), ("c", 1, 1, "y", "text", "PLD 2015 SC 123", None), ("d", 1, 0, "p", "text", "one", None), ("d", 1, 1, "q", "text", "two", None), ("d", 1, 2, "r", "text", "three", None), ("d", 1, 3, "s", "text", "2008 SCMR 598", None)],
      reporter_headers, "document_id string, citation string, block_id string", [("a", "2008 SCMR 598", "x"), ("c", "PLD 2015 SC 123", "y")])


def page_facts(blocks):
    """document_id, page, en, ur, blocks, quality: per page the shares of letters by script and the quality weighed by length."""
    ur, every = F.regexp_count("text", F.lit(r"[\p{L}&&[؀-￿]]")), F.regexp_count("text", F.lit(r"\p{L}"))
    g = blocks.groupBy("document_id", "page").agg(F.sum(ur).alias("u"), F.sum(every).alias("e"), F.count("*").cast("int").alias("blocks"), F.sum(F.length("text")).alias("n"), F.sum(P.quality("text") * F.length("text")).alias("q"))
    return g.select("document_id", "page", F.when(F.col("e") > 0, F.round((F.col("e") - F.col("u")) / F.col("e"), 3)).alias("en"), F.when(F.col("e") > 0, F.round(F.col("u") / F.col("e"), 3)).alias("ur"), "blocks", F.when(F.col("n") > 0, F.round(F.col("q") / F.col("n"), 3)).otherwise(0.0).alias("quality"))


C.add("src35_page_facts", "document_id string, page int, text string", [("d", 1, "abcd"), ("d", 1, "یہ"), ("d", 2, "?!"), ("d", 2, "abcd efgh")], page_facts, "document_id string, page int, en double, ur double, blocks int, quality double", [("d", 1, 0.667, 0.333, 2, 0.9), ("d", 2, 1.0, 0.0, 2, 0.809)])


def stored_records(spark, d):
    """source, documents, blocks of the tables documents and blocks written apart (blocks by source) and read again, one source pruned."""
    out = f"{shared_dir(spark)}/lexloom-records-{uuid.uuid4().hex}"
    docs = load(spark, d, "doc_text").filter("source IS NOT NULL").groupBy("document_id").agg(F.min("source").alias("source"), F.min("document_kind").alias("kind"))
    docs.write.parquet(f"{out}/documents")
    blocks = load(spark, d, "segments").select("document_id", "block_id", "page").distinct().join(spark.read.parquet(f"{out}/documents").select("document_id", "source"), "document_id")
    blocks.write.partitionBy("source").parquet(f"{out}/blocks")
    b = spark.read.parquet(f"{out}/blocks").filter("source = 'harun_hc'").groupBy("source").agg(F.count("*").alias("blocks"))
    return spark.read.parquet(f"{out}/documents").groupBy("source").agg(F.count("*").alias("documents")).join(b, "source")


C.table("src32_record_sinks", stored_records, """WITH t AS (SELECT document_id, min(source) AS source FROM doc_text WHERE source IS NOT NULL GROUP BY document_id), s AS (SELECT DISTINCT document_id, block_id, page FROM segments)
    SELECT source, (SELECT count(*) FROM t WHERE source = 'harun_hc') AS documents, count(*) AS blocks FROM s JOIN t USING (document_id) WHERE source = 'harun_hc' GROUP BY source""")  # fmt: skip


def st01(spark, d):
    """The mention spans of a document that lie in no other: sorted by start and, longest first, by end, a span is inside another
    if it ends no later than the latest end before it."""
    m = load(spark, d, "provision_mentions").filter("char_end > char_start").select("document_id", "char_start", "char_end").distinct()
    w = Window.partitionBy("document_id").orderBy("char_start", F.desc("char_end")).rowsBetween(Window.unboundedPreceding, -1)
    return m.withColumn("top", F.max("char_end").over(w)).filter("top IS NULL OR char_end > top").drop("top")


C.table("st01_span_subsumption", st01, """WITH m AS (SELECT DISTINCT document_id, char_start, char_end FROM provision_mentions WHERE char_end > char_start)
    SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.document_id = m.document_id AND o.char_start <= m.char_start AND o.char_end >= m.char_end AND (o.char_start <> m.char_start OR o.char_end <> m.char_end))""")  # fmt: skip
