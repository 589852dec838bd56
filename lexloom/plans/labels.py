"""Queries of document records: kinds and labels by path, filled and compared fields, retraction, identity, plug-ins."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from lexloom import plugins
from lexloom.functions.text import script_of
from lexloom.plans.cases import Cases
from lexloom.plans.legal import court_of, numbered, same_case, same_date, same_name
from lexloom.sources.files import input_files

C = Cases()
QUERIES, SQL = C.queries, C.sql

C.add("prj01_content_filter", "block_id string, type string, text string, decorative boolean", [("a", "text", "x", None), ("b", "header", "x", None), ("c", "footnote", "x", False), ("d", "text", " \t", None), ("e", "list", "x", True), ("f", "footer", "x", None), ("g", "table", "x", False), ("h", "text", None, None)],
      lambda df: df.filter(~F.col("type").isin("header", "footer", "footnote") & ~F.coalesce("decorative", F.lit(False)) & (F.regexp_replace("text", r"\s", "") != "")).select("block_id"), "block_id string", [("a",), ("g",)])
# The corpora a path can name, in order.
CORPORA = ("pakistancode", "lhc", "sc", "ihc")
_PATHS = [("/data/LHC/2023LHC1.pdf", "lhc"), ("/data/sc/lhc/x.pdf", "lhc"), ("/x/ihc_old/x.pdf", "unknown"), ("ihc/a/judgment.pdf", "ihc"), ("pakistancode/5_x.pdf", "pakistancode")]


def corpus_of(path):
    parts, out = F.split(F.lower(path), "/"), None
    for c in CORPORA:
        out = F.when(F.array_contains(parts, c), c) if out is None else out.when(F.array_contains(parts, c), c)
    return out.otherwise("unknown")


C.add("prj03_corpus_of_path", "case_no int, path string", numbered([p[0] for p in _PATHS]), lambda df: df.select("case_no", corpus_of(F.col("path")).alias("corpus")), "case_no int, corpus string", numbered([p[1] for p in _PATHS]))
# The fields a statute has none of.
JUDGMENT_ONLY = "parties petitioner respondent judges bench counsel case_number court court_id hearing_date hearing_date_iso decision_date decision_date_iso sections".split()


def document_kinds(df):
    """path, kind, statute_id, year, category, metadata (of a statute without the fields only judgments have), by the file's name."""
    name, folder = F.element_at(F.split("path", "/"), -1), F.element_at(F.split("path", "/"), -2)
    statute = name.rlike(r"(?i)^\d+_.+?\.pdf$")
    kind = F.when(statute, "statute").when(name.rlike(r"(?i)^order_\d{8}_\d+\.pdf$"), "order").otherwise("judgment")
    part = lambda p, i: F.when(statute, F.nullif(F.regexp_extract(name, p, i), F.lit("")))
    slug = F.concat(F.lit("_"), F.regexp_replace(name, r"(?i)\.pdf$", ""), F.lit("_"))
    year = F.when(statute, F.nullif(F.regexp_extract(slug, r"_(1[6-9]\d{2}|20\d{2})_", 1), F.lit("")).cast("int"))
    category = F.when(statute, F.initcap(F.trim(F.translate(F.regexp_replace(folder, r"(?i)_laws?$", ""), "_", " "))))
    meta = F.when(statute, F.map_filter("metadata", lambda k, v: ~k.isin(*JUDGMENT_ONLY))).otherwise(F.col("metadata"))
    return df.select("path", kind.alias("kind"), part(r"^(\d+)_", 1).alias("statute_id"), year.alias("year"), category.alias("category"), F.array_join(F.sort_array(F.map_keys(meta)), "+").alias("fields"))


_META = "map<string,string>"
C.add("prj05_document_kind", f"path string, metadata {_META}", [("code/criminal_laws/5_pakistan_penal_code_1860.pdf", {"title": "t", "judges": "x", "citations": "c"}), ("ihc/C-1-2020/order_05032021_1.pdf", {"judges": "x"}), ("lhc/2023LHC1.pdf", {"court": "c", "judges": "x"})], document_kinds,
      "path string, kind string, statute_id string, year int, category string, fields string", [("code/criminal_laws/5_pakistan_penal_code_1860.pdf", "statute", "5", 1860, "Criminal", "citations+title"), ("ihc/C-1-2020/order_05032021_1.pdf", "order", None, None, None, "judges"), ("lhc/2023LHC1.pdf", "judgment", None, None, None, "court+judges")])


def checked_labels(df):
    """document_id, field, value, state: what a label fills (confidence 0.5, no box) or, by the field's own comparison, disagrees with.

    df: document_id, metadata (map), labels (map with case_number, year, decision_date, judge, neutral_citation, court, court_id,
    parties, petitioner, respondent, category). A stated value is never overwritten; fields without a label give no row."""
    m, lab = (lambda f: F.nullif(F.col("metadata")[f], F.lit(""))), (lambda f: F.nullif(F.col("labels")[f], F.lit("")))
    agree = {
        "case_number": lambda: same_case(F.col("labels")["case_number"], F.col("labels")["year"].cast("int"), m("case_number")), "decision_date": lambda: same_date(lab("decision_date"), m("decision_date")), "judges": lambda: same_name(lab("judge"), m("judges")),
        "neutral_citation": lambda: m("neutral_citation") == lab("neutral_citation"), "court": lambda: court_of(m("court")).eqNullSafe(lab("court_id")), "court_id": lambda: m("court_id") == lab("court_id"), "parties": lambda: F.lit(True), "petitioner": lambda: F.lit(True),
        "respondent": lambda: F.lit(True), "category": lambda: m("category") == lab("category"),
    }
    stated = {"judges": "judge"}
    rows = [F.struct(F.lit(f).alias("field"), F.coalesce(m(f), lab(stated.get(f, f))).alias("value"), F.when(lab(stated.get(f, f)).isNull(), None).when(m(f).isNull(), "filled").when(~test(), "disagrees").alias("state")) for f, test in agree.items()]
    return df.select("document_id", F.explode(F.filter(F.array(*rows), lambda r: r["state"].isNotNull())).alias("r")).select("document_id", "r.field", "r.value", "r.state")


_LABELLED = [("a", {"case_number": "Civil Appeal No.08-B of 2026", "court": "IN THE LAHORE HIGH COURT", "judges": "Mr. Justice Babar Sattar, J.", "petitioner": "A"}, {"case_number": "8", "year": "2026", "decision_date": "11-09-2025", "judge": "Babar Sattar", "court": "Lahore High Court", "court_id": "lahore_high_court", "petitioner": "B"}),
             ("b", {"case_number": "C.A. No. 5", "decision_date": "12.09.2025", "court": "SUPREME COURT", "category": "tax"}, {"case_number": "5", "year": "2026", "decision_date": "11-09-2025", "court": "x", "court_id": "lahore_high_court", "category": "civil"}), ("c", {}, {})]
C.add("prj06_label_check", f"document_id string, metadata {_META}, labels {_META}", _LABELLED, checked_labels, "document_id string, field string, value string, state string",
      [("a", "decision_date", "11-09-2025", "filled"), ("a", "court_id", "lahore_high_court", "filled"), ("b", "case_number", "C.A. No. 5", "disagrees"), ("b", "decision_date", "12.09.2025", "disagrees"), ("b", "court", "SUPREME COURT", "disagrees"), ("b", "court_id", "lahore_high_court", "filled"), ("b", "category", "tax", "disagrees")])
# The fields a document that is no court's loses.
SCALARS = "court court_id bench case_number decision_date decision_date_iso hearing_date hearing_date_iso parties petitioner respondent neutral_citation".split()
LISTS = "judges counsel citations".split()


def retracted(df):
    """document_id, kind, metadata, lists: a document of a kind that is no court's, or whose court stands in no heading, loses twelve
    fields (nulled) and three lists (emptied); unknown kinds and statutes stay. df: document_id, kind, heading (names a court), metadata, lists."""
    guessed = ~F.col("heading") & F.col("metadata")["court_id"].isNotNull()
    go = ~F.col("kind").isin("unknown", "statute") & ~(F.col("kind").isin("judgment", "order") & ~guessed)
    meta = F.when(go, F.transform_values("metadata", lambda k, v: F.when(~k.isin(*SCALARS), v))).otherwise(F.col("metadata"))
    lists = F.when(go, F.transform_values("lists", lambda k, v: F.when(k.isin(*LISTS), F.array().cast("array<string>")).otherwise(v))).otherwise(F.col("lists"))
    return df.select("document_id", go.alias("retracted"), meta["court"].alias("court"), meta["title"].alias("title"), F.size(lists["judges"]).alias("judges"), F.size(lists["acts"]).alias("acts"))


_LISTS = {"judges": ["x"], "acts": ["a", "b"]}
C.add("prj07_retracted_fields", f"document_id string, kind string, heading boolean, metadata {_META}, lists map<string,array<string>>",
      [("a", "contract", False, {"court": "c", "court_id": "i", "title": "t"}, _LISTS), ("b", "judgment", True, {"court": "c", "court_id": "i", "title": "t"}, _LISTS), ("c", "order", False, {"court": "c", "court_id": "i", "title": "t"}, _LISTS), ("d", "order", False, {"court": "c", "title": "t"}, _LISTS), ("e", "statute", False, {"court": "c", "court_id": "i"}, _LISTS), ("f", "unknown", False, {"court": "c", "court_id": "i"}, _LISTS)],
      retracted, "document_id string, retracted boolean, court string, title string, judges int, acts int", [("a", True, None, "t", 0, 2), ("b", False, "c", "t", 1, 2), ("c", True, None, "t", 0, 2), ("d", False, "c", "t", 1, 2), ("e", False, "c", None, 1, 2), ("f", False, "c", None, 1, 2)])
C.add("prj11_readings", "content string, block_id string, text string, source string", [("pdf", "p1_b0", "words", "native"), ("pdf", "p1_b1", "", "ocr")],
      lambda df: df.select(F.concat(F.substring(F.sha2("content", 256), 1, 16), F.lit("/"), "block_id").alias("uid"), F.array(F.struct("text", F.col("source").alias("engine"), F.lit("local").alias("policy"), F.array().cast("array<string>").alias("checks"), F.lit(True).alias("accepted"))).alias("r"), "text").select("uid", F.size("r").alias("readings"), F.col("r")[0]["engine"].alias("engine"), (F.col("r")[0]["text"] == F.col("text")).alias("accepted_is_text")),
      "uid string, readings int, engine string, accepted_is_text boolean", [("4f5f3f7a2e1b40c5/p1_b0", 1, "native", True), ("4f5f3f7a2e1b40c5/p1_b1", 1, "ocr", True)])
SQL["prj11_readings"] = "SELECT substr(sha256('pdf'), 1, 16) || '/' || b AS uid, 1 AS readings, e AS engine, true AS accepted_is_text FROM (VALUES ('p1_b0', 'native'), ('p1_b1', 'ocr')) AS t(b, e)"

_WORDS = [("a", "The the court"), ("b", "302A"), ("c", "?!")]
_BUCKETS = [("a", zlib.crc32(b"the") % 256, round(2 / 5**0.5, 6)), ("a", zlib.crc32(b"court") % 256, round(1 / 5**0.5, 6)), ("b", zlib.crc32(b"302a") % 256, 1.0)]
C.add("fn10_hash_buckets", "id string, text string", _WORDS, lambda df: _hashed(df), "id string, bucket int, weight double", _BUCKETS)
C.add("ud03_embedder", "id string, text string", _WORDS, lambda df: plugins.embedded(df, "id", "text", plugins.HashEmbedder).select("id", F.posexplode("vector").alias("bucket", "w")).filter("w > 0").select("id", "bucket", F.round("w", 6).alias("weight")), "id string, bucket int, weight double", _BUCKETS)


def _hashed(df):
    from lexloom.plans.stored import hash_vectors

    return hash_vectors(df, "id", "text").withColumn("weight", F.round("weight", 6))


class _Lines:
    """An engine for plain text: a block per line; empty files are an error."""

    name, policy = "lines", "local"

    def parse(self, content: bytes, document_id: str):
        text = content.decode()
        if not text.strip():
            raise ValueError("nothing to read")
        for i, line in enumerate(text.splitlines()):
            yield {"document_id": document_id.rpartition("/")[2], "page": 1, "ord": i, "block_id": f"p1_b{i}", "type": "text", "text": line, "bbox": None}


class _Broken(_Lines):
    name, policy = "broken", "local"

    def parse(self, content: bytes, document_id: str):
        raise RuntimeError("no model here")


class _Remote(_Lines):
    name, policy = "remote", "third_party"


def engines(spark, d):
    """Files of a folder through three engines: one that fails, one whose policy isn't allowed, one that reads lines."""
    from lexloom.plans.stored import put

    root = put(spark, {"a.txt": "one\ntwo\n", "b.txt": " "})
    files = input_files(spark, root, "*.txt").select("path").join(spark.read.format("binaryFile").load(root).select("path", "content"), "path")
    made = plugins.parse_files(files, [_Broken(), _Remote(), _Lines()])
    return made.select(F.element_at(F.split("document_id", "/"), -1).alias("document_id"), "ord", "text", "engine", "error")


C.table("ud01_engine_protocol", engines, """SELECT * FROM (VALUES ('a.txt', 0, 'one', 'lines', NULL), ('a.txt', 1, 'two', 'lines', NULL), ('b.txt', NULL, NULL, NULL, 'broken: no model here; lines: nothing to read')) AS t(document_id, ord, text, engine, error)""")
C.add("ud02_enricher_protocol", "document_id string, text string, court string", [("a", "IN THE LAHORE HIGH COURT", None), ("b", "x", "given")],
      lambda df: plugins.enriched(df, [lambda r: r.withColumn("court", F.coalesce("court", court_of(F.col("text")))), lambda r: r.withColumn("script", script_of("text")["script"])]).select("document_id", "court", "script"), "document_id string, court string, script string", [("a", "lahore_high_court", "Latn"), ("b", "given", "Latn")])
C.add("ud06_fact_with_evidence", "document_id string, citation string, page int, block_id string", [("d", "2008 SCMR 598", 3, "p3_b1"), ("d", "2008 SCMR 598", 1, "p1_b1")],
      lambda df: df.groupBy("document_id", "citation").agg(F.sort_array(F.collect_list(F.struct("page", "block_id"))).alias("e")).select("document_id", plugins.fact(F.col("citation"), "deterministic", "lexloom.citations", "1", F.lit(1.0), F.col("e")).alias("f")).select("document_id", "f.value", "f.method", "f.review", F.size("f.evidence").alias("evidence"), F.col("f.evidence")[0]["page"].alias("first_page")),
      "document_id string, value string, method string, review string, evidence int, first_page int", [("d", "2008 SCMR 598", "deterministic", "unreviewed", 2, 1)])
_CONTRACT = "document struct<id:string,document_kind:string>, pages array<struct<page_number:int,blocks:array<struct<id:string,text:string>>>>"
C.add("ud11_schema_contract", "case_no int, body string", [(0, '{"document": {"id": "a", "document_kind": "judgment"}, "pages": [{"page_number": 1, "blocks": [{"id": "b", "text": "t", "extra": 5}]}], "more": 1}'), (1, '{"document": {"id": "a"}}'), (2, "{broken")],
      lambda df: df.select("case_no", F.from_json("body", _CONTRACT).alias("r"), F.try_parse_json("body").alias("v")).select("case_no", F.col("r.document.id").alias("id"), F.coalesce(F.size("r.pages"), F.lit(-1)).alias("pages"), F.try_variant_get("v", "$.pages[0].blocks[0].extra", "int").alias("extra")),
      "case_no int, id string, pages int, extra int", [(0, "a", 1, 5), (1, "a", -1, None), (2, None, -1, None)])
