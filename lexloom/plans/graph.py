"""Queries of the citation graph, resolution, gold labels, statute runs and reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.legal.provisions import kind_of_title
from lexloom.operators.closure import closure
from lexloom.plans.cases import Cases
from lexloom.plans.legal import COURTS, numbered
from lexloom.tables import load

C = Cases()
QUERIES, SQL = C.queries, C.sql

_CITE = "\\b((?:19|20)[0-9]{2} [A-Z]{2,4} [0-9]+)\\b"
_MENTIONS = f"SELECT document_id, para_id, page, unnest(regexp_extract_all(text, '{_CITE}', 1)) AS cited FROM (SELECT DISTINCT document_id, para_id, page, text FROM paras WHERE text IS NOT NULL)"


def distinct_authorities(mentions):
    """document_id, cited, first_page, mentions, para_ids: one row per authority of a document, with every place it is mentioned."""
    places = F.transform(F.sort_array(F.collect_list(F.struct("page", "para_id"))), lambda x: x["para_id"])
    return mentions.groupBy("document_id", "cited").agg(F.min("page").alias("first_page"), F.count("*").alias("mentions"), places.alias("para_ids"))


def ag06(spark, d):
    p = load(spark, d, "paras").filter("text IS NOT NULL").select("document_id", "para_id", "page", "text").distinct()
    return distinct_authorities(p.select("document_id", "para_id", "page", F.explode(T.citations("text")).alias("cited")))


C.table("ag06_distinct_authorities", ag06, f"SELECT document_id, cited, min(page) AS first_page, count(*) AS mentions, list(para_id ORDER BY page NULLS FIRST, para_id) AS para_ids FROM ({_MENTIONS}) GROUP BY document_id, cited")

_GROUPS = """WITH RECURSIVE e AS (SELECT citation_a AS x, citation_b AS y FROM cite_pairs WHERE citation_a IS NOT NULL AND citation_b IS NOT NULL UNION SELECT citation_b, citation_a FROM cite_pairs WHERE citation_a IS NOT NULL AND citation_b IS NOT NULL),
    r AS (SELECT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x), g AS (SELECT x AS alias, min(y) AS root FROM r GROUP BY x)"""
C.table("ag07_parallel_groups", lambda spark, d: closure(load(spark, d, "cite_pairs"), "citation_a", "citation_b").select(F.col("value").alias("alias"), "root"), _GROUPS + " SELECT alias, root FROM g")


def resolved(edges, held, linked, groups):
    """from_judgment, alias, to_judgment, rung (alias, case_name, parallel), ambiguous. The targets of a group of parallel aliases are
    the judgments any of them is held under, else those a printed name linked one of them to; several are none; a judgment's own is none.
    edges: from_judgment, alias; held, linked: alias, judgment_id; groups: alias, root (aliases without one stand alone)."""
    every = edges.select("alias").unionByName(groups.select("alias")).distinct().join(groups, "alias", "left").select("alias", F.coalesce("root", "alias").alias("root"))
    own = lambda df, name: df.groupBy("alias").agg(F.collect_set("judgment_id").alias(name))
    per = every.join(own(held, "h"), "alias", "left").join(own(linked, "l"), "alias", "left")
    of = per.groupBy("root").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("h")))).alias("gh"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("l")))).alias("gl"))
    j = per.join(of, "root").withColumn("targets", F.when(F.size("gh") > 0, F.col("gh")).otherwise(F.col("gl")))
    rung = F.when((F.size("gh") > 0) & F.col("h").isNotNull(), "alias").when((F.size("gh") == 0) & F.col("l").isNotNull(), "case_name").otherwise("parallel")
    a = j.select("alias", F.when(F.size("targets") == 1, F.col("targets")[0]).alias("to"), F.when(F.size("targets") == 1, rung).alias("rung"), (F.size("targets") > 1).alias("ambiguous"))
    mine = F.col("to") == F.col("from_judgment")
    return edges.select("from_judgment", "alias").distinct().join(a, "alias").select("from_judgment", "alias", F.when(mine, None).otherwise(F.col("to")).alias("to_judgment"), F.when(mine, None).otherwise(F.col("rung")).alias("rung"), "ambiguous")


C.many("ag08_resolution_cases", {
    "edges": ("from_judgment string, alias string", [("j1", "a"), ("j1", "a"), ("j1", "b"), ("j2", "c"), ("j2", "d"), ("j3", "e"), ("j9", "a"), ("j1", "f"), ("j1", "g"), ("j2", "z")]),
    "held": ("alias string, judgment_id string", [("a", "j9"), ("d", "j4"), ("d", "j5"), ("p", "j7")]), "linked": ("alias string, judgment_id string", [("b", "j8"), ("e", "j6"), ("g", "j6"), ("g", "j7")]),
    "groups": ("alias string, root string", [("a", "a"), ("b", "a"), ("f", "f"), ("p", "f")])}, resolved,
    "from_judgment string, alias string, to_judgment string, rung string, ambiguous boolean",
    [("j1", "a", "j9", "alias", False), ("j1", "b", "j9", "parallel", False), ("j2", "c", None, None, False), ("j2", "d", None, None, True), ("j3", "e", "j6", "case_name", False), ("j9", "a", None, None, False), ("j1", "f", "j7", "parallel", False), ("j1", "g", None, None, True), ("j2", "z", None, None, False)])


def ag08(spark, d):
    edges = load(spark, d, "documents").filter("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("from_judgment"), F.explode(T.citations("text")).alias("alias"))
    held = load(spark, d, "chunks").filter("citation IS NOT NULL").select(F.col("citation").alias("alias"), F.col("document_id").alias("judgment_id")).distinct()
    groups = closure(load(spark, d, "cite_pairs"), "citation_a", "citation_b").select(F.col("value").alias("alias"), "root")
    return resolved(edges, held, spark.createDataFrame([], "alias string, judgment_id string"), groups)


C.table("ag08_resolution_ladder", ag08, _GROUPS + f""", ed AS (SELECT DISTINCT doc_id::VARCHAR AS from_judgment, unnest(regexp_extract_all(text, '{_CITE}', 1)) AS alias FROM documents WHERE text IS NOT NULL),
    h AS (SELECT DISTINCT citation AS alias, document_id FROM chunks WHERE citation IS NOT NULL), al AS (SELECT alias FROM ed UNION SELECT alias FROM g), ro AS (SELECT al.alias, coalesce(g.root, al.alias) AS root FROM al LEFT JOIN g USING (alias)),
    t AS (SELECT root, min(document_id) AS one, count(DISTINCT document_id) AS n FROM ro JOIN h USING (alias) GROUP BY root)
    SELECT from_judgment, ed.alias, CASE WHEN n = 1 THEN one END AS to_judgment, CASE WHEN n = 1 THEN CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.alias = ed.alias) THEN 'alias' ELSE 'parallel' END END AS rung, coalesce(n > 1, false) AS ambiguous
    FROM ed JOIN ro ON ed.alias = ro.alias LEFT JOIN t ON t.root = ro.root""")  # fmt: skip

C.table("jn01_document_lookup", lambda spark, d: load(spark, d, "provision_mentions").select("mention_id", "document_id").distinct().join(load(spark, d, "doc_text").select("document_id", "source", "document_kind").distinct(), "document_id"),
        "SELECT m.mention_id, m.document_id, t.source, t.document_kind FROM (SELECT DISTINCT mention_id, document_id FROM provision_mentions) m JOIN (SELECT DISTINCT document_id, source, document_kind FROM doc_text) t USING (document_id)")


def jn03(spark, d):
    """The exact leg: chunks whose citation the query's text names, in chunk order; every fiftieth document asks."""
    asked = load(spark, d, "documents").filter("doc_id % 50 = 0 AND text IS NOT NULL").select(F.col("doc_id").alias("query_id"), F.explode(F.array_distinct(T.citations("text"))).alias("citation"))
    hit = asked.join(load(spark, d, "chunks").filter("citation IS NOT NULL").select("id", "citation").distinct(), "citation").select("query_id", "id").distinct()
    return hit.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("id")))


C.table("jn03_exact_citation_leg", jn03, f"""SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY id) AS rank FROM (SELECT DISTINCT q.query_id, c.id FROM
    (SELECT doc_id AS query_id, unnest(regexp_extract_all(text, '{_CITE}', 1)) AS citation FROM documents WHERE doc_id % 50 = 0 AND text IS NOT NULL) q JOIN chunks c USING (citation))""")  # fmt: skip


def jn04(spark, d):
    """One query per mention, repeats kept: the chunks holding its key, and whether the text around it is long enough to ask in context."""
    m = load(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.length(F.trim("text")).alias("n"), F.explode(T.citations("text")).alias("citation"))
    gold = load(spark, d, "chunks").filter("citation IS NOT NULL").groupBy("citation").agg(F.countDistinct("id").alias("gold"), F.min("id").alias("first_gold"))
    return m.join(gold, "citation").select("doc_id", "citation", "gold", "first_gold", (F.col("n") >= 200).alias("in_context"))


C.table("jn04_gold_label_join", jn04, f"""SELECT m.doc_id, m.citation, g.gold, g.first_gold, m.n >= 200 AS in_context FROM (SELECT doc_id, length(trim(text)) AS n, unnest(regexp_extract_all(text, '{_CITE}', 1)) AS citation FROM documents WHERE text IS NOT NULL) m
    JOIN (SELECT citation, count(DISTINCT id) AS gold, min(id) AS first_gold FROM chunks WHERE citation IS NOT NULL GROUP BY citation) g USING (citation)""")  # fmt: skip


def jn08(spark, d):
    """Per kind of document: mentions linked to a held statute, how many were read before the statute's text as held, and statutes named."""
    m = load(spark, d, "provision_mentions").select("mention_id", "document_id", "statute_id", F.year("read_at").alias("decided")).distinct()
    k = load(spark, d, "doc_text").groupBy("document_id").agg(F.min("document_kind").alias("kind"))
    s = load(spark, d, "statute_index").select("statute_id", F.coalesce("updated_till", "act_year").alias("current"))
    j = m.join(k, "document_id").join(F.broadcast(s), "statute_id", "left")
    return j.groupBy("kind").agg(F.count("*").alias("mentions"), F.count("statute_id").alias("linked"), F.count_if(F.col("decided") < F.col("current")).alias("version_risk"), F.countDistinct("statute_id").alias("statutes"))


C.table("jn08_statute_run", jn08, """SELECT k.kind, count(*) AS mentions, count(m.statute_id) AS linked, count(*) FILTER (m.decided < coalesce(s.updated_till, s.act_year)) AS version_risk, count(DISTINCT m.statute_id) AS statutes
    FROM (SELECT DISTINCT mention_id, document_id, statute_id, year(read_at) AS decided FROM provision_mentions) m JOIN (SELECT document_id, min(document_kind) AS kind FROM doc_text GROUP BY document_id) k USING (document_id)
    LEFT JOIN statute_index s ON s.statute_id = m.statute_id GROUP BY k.kind""")  # fmt: skip
C.many("jn26_parse_freshness", {"state": ("stage string, documents bigint", [("chunk", 3), ("index", 5)]), "parsed": ("stage string, name string", [("chunk", "a"), ("chunk", "b"), ("chunk", "c"), ("index", "a"), ("new", "x")])},
       lambda state, parsed: parsed.groupBy("stage").agg(F.count("*").alias("n")).join(state, "stage", "full").select("stage", (~F.coalesce(F.col("n") == F.col("documents"), F.lit(False))).alias("rerun")), "stage string, rerun boolean", [("chunk", False), ("index", True), ("new", True)])


def locate_values(values, blocks):
    """field, page, block_id, confidence: the first block (page, then order) that holds a value on the bounds of words; value and text
    compared in lower case with single blanks. values: document_id, field, value; blocks: document_id, page, ord, block_id, text."""
    low = lambda c: F.regexp_replace(F.lower(c), r"\s+", " ")
    v = values.select("document_id", "field", F.trim(low("value")).alias("v")).filter("v != ''")
    j = v.join(blocks.select("document_id", "page", "ord", "block_id", low("text").alias("t")), "document_id")
    held = F.expr(r"rlike(t, concat('(?<![0-9a-z])\\Q', v, '\\E(?![0-9a-z])'))")
    first = j.filter(held).groupBy("document_id", "field").agg(F.min(F.struct("page", "ord", "block_id")).alias("at"))
    return values.select("document_id", "field").join(first, ["document_id", "field"], "left").select("field", "at.page", "at.block_id", F.when(F.col("at").isNull(), "no_source_span").otherwise("located").alias("status"))


C.many("jn19_value_location", {"values": ("document_id string, field string, value string", [("d", "section", "13"), ("d", "case", "W.P.  No. 5/2001"), ("d", "judge", "Mr. X"), ("d", "none", None)]), "blocks": ("document_id string, page int, ord int, block_id string, text string", [("d", 2, 0, "c", "section 13 applies"), ("d", 1, 1, "b", "w.p. no. 5/2001 filed"), ("d", 1, 0, "a", "in 2013 and A13")])},
       locate_values, "field string, page int, block_id string, status string", [("section", 2, "c", "located"), ("case", 1, "b", "located"), ("judge", None, None, "no_source_span"), ("none", None, None, "no_source_span")])


def section_summary(sections):
    """statutes, sections, median_chars (the upper of two), thin (under 40 characters), ambiguous (a number its act has twice)."""
    own = sections.withColumn("n", F.count("*").over(Window.partitionBy("act", "number"))).withColumn("len", F.length("text"))
    w = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, 0)
    by = own.groupBy("len").agg(F.count("*").alias("c"))  # one row per length, few
    mid = by.withColumn("upto", F.sum("c").over(w)).withColumn("all", F.sum("c").over(Window.partitionBy())).filter(F.col("upto") > F.floor(F.col("all") / 2)).agg(F.min("len").alias("median_chars"))
    return own.agg(F.countDistinct("act").cast("int").alias("statutes"), F.count("*").cast("int").alias("sections"), F.count_if(F.col("len") < 40).cast("int").alias("thin"), F.count_if(F.col("n") > 1).cast("int").alias("ambiguous")).crossJoin(F.broadcast(mid))


C.add("ag17_section_summary", "act string, number string, text string", [("a", "1", "x" * 10), ("a", "2", "x" * 50), ("a", "2", "x" * 60), ("b", "1", "x" * 100)], section_summary, "statutes int, sections int, thin int, ambiguous int, median_chars int", [(2, 4, 1, 2, 60)])


def outcome_accuracy(labels, results):
    """label, not_run, correct, unaccepted, wrong: what became of each labelled judgment (labels: judgment_id, label; results: judgment_id, outcome, accepted)."""
    j = labels.filter(F.trim("label") != "").join(results.withColumn("ran", F.lit(True)), "judgment_id", "left")
    state = F.when(F.col("ran").isNull(), "not_run").when(~F.coalesce("accepted", F.lit(False)), "unaccepted").when(F.col("outcome") == F.col("label"), "correct").otherwise("wrong")
    return j.withColumn("s", state).groupBy("label").agg(*[F.count_if(F.col("s") == s).cast("int").alias(s) for s in ("not_run", "correct", "unaccepted", "wrong")])


C.many("ag24_outcome_accuracy", {"labels": ("judgment_id string, label string", [("1", "allowed"), ("2", "allowed"), ("3", "dismissed"), ("4", "dismissed"), ("5", " ")]), "results": ("judgment_id string, outcome string, accepted boolean", [("1", "allowed", True), ("2", "dismissed", True), ("3", "dismissed", False), ("5", "allowed", True)])},
       outcome_accuracy, "label string, not_run int, correct int, unaccepted int, wrong int", [("allowed", 0, 1, 0, 1), ("dismissed", 1, 0, 1, 0)])


def timeline_report(events):
    """kind, events, dated, effective, whole_section of amendment events (section, kinds, year, effective, whole_section)."""
    k = events.withColumn("kind", F.explode("kinds"))
    return k.groupBy("kind").agg(F.count("*").cast("int").alias("events"), F.count("year").cast("int").alias("dated"), F.count("effective").cast("int").alias("effective"), F.count_if("whole_section").cast("int").alias("whole_section"))


C.add("ag25_amendment_report", "section string, kinds array<string>, year int, effective string, whole_section boolean", [("5", ["substituted", "added"], 1990, "1990-01-02", True), ("6", ["added"], None, None, False)], timeline_report, "kind string, events int, dated int, effective int, whole_section int", [("substituted", 1, 1, 1, 1), ("added", 2, 1, 1, 1)])


def case_ecli(court, neutral, decided, number):
    """ECLI:PK:CODE:YEAR:ORDINAL: the neutral citation's, else the initials of the case's type and its numbers (25 characters); null
    unless every fact is there."""
    code = F.try_element_at(F.create_map(*[F.lit(x) for c in COURTS for x in (c[0], c[3])]), F.coalesce(court, F.lit("")))
    n = F.nullif(F.regexp_extract(neutral, r"^\d{4}\s+[A-Z]+\s+(\d+)$", 1), F.lit(""))
    form = r"(?is)^(.*?)\s*\bNos?\b\.?\s*(.+)$"
    initials = F.upper(F.array_join(F.transform(F.regexp_extract_all(F.regexp_extract(number, form, 1), F.lit("([A-Za-z]+)"), F.lit(1)), lambda w: F.substring(w, 1, 1)), ""))
    numbers = F.array_join(F.regexp_extract_all(F.regexp_extract(number, form, 2), F.lit(r"(\d+)"), F.lit(1)), ".")
    ordinal = F.when((initials != "") & (numbers != ""), F.substring(F.concat(initials, numbers), 1, 25))
    year = F.when(F.substring(decided, 1, 4).rlike(r"^\d{4}$"), F.substring(decided, 1, 4))
    return F.when(n.isNotNull(), F.concat_ws(":", F.lit("ECLI:PK"), code, F.substring(neutral, 1, 4), n)).otherwise(F.concat(F.lit("ECLI:PK:"), code, F.lit(":"), year, F.lit(":"), ordinal))


_ECLI = [("lahore_high_court", "2023 LHC 5924", None, None, "ECLI:PK:LHC:2023:5924"), ("supreme_court_pakistan", None, "2020-05-06", "Criminal Appeal No. 599 of 2020", "ECLI:PK:SC:2020:CA599.2020"), ("supreme_court_pakistan", None, None, "C.A. No. 5", None), ("unknown", None, "2020-05-06", "C.A. No. 5", None), ("sindh_high_court", None, "2020-05-06", "no number", None)]
C.add("fn42_ecli", "case_no int, court string, neutral string, decided string, number string", numbered([e[:4] for e in _ECLI]), lambda df: df.select("case_no", case_ecli(F.col("court"), F.col("neutral"), F.col("decided"), F.col("number")).alias("ecli")), "case_no int, ecli string", numbered([(e[4],) for e in _ECLI]))
C.add("fn42_law_id", "case_no int, year int, number string", [(0, 1997, "27"), (1, None, "27"), (2, 2001, None)], lambda df: df.select("case_no", F.when(F.col("year").isNotNull() & F.col("number").isNotNull(), F.concat_ws("/", F.lit("eli/pk/act"), "year", "number")).alias("eli")), "case_no int, eli string", [(0, "eli/pk/act/1997/27"), (1, None), (2, None)])


def supported(sentence, cited):
    """Every figure and every capitalised name but the first word of a sentence stands in the cited text."""
    squeezed = F.regexp_replace(cited, r"\s", "")
    figures = F.transform(F.regexp_extract_all(sentence, F.lit(r"(\d[\d,./-]*)"), F.lit(1)), lambda x: F.rtrim(x, F.lit(".,-/")))
    rest = F.regexp_extract(F.trim(sentence), r"(?s)^\S+ (.*)$", 1)
    names = F.transform(F.regexp_extract_all(rest, F.lit(r"\b([A-Z][a-z]{2,})\b"), F.lit(1)), F.lower)
    return F.forall(figures, lambda x: squeezed.contains(x)) & F.forall(names, lambda x: F.lower(cited).contains(x))


_SUPPORT = [("Bashir paid Rs. 5,000 to Ali.", "ALI received 5,000 from the buyer", True), ("The sum was 700.", "a sum of 7 00 rupees", True), ("The sum was 700.", "a sum of 70", False), ("He met Karim", "he met someone", False), ("Karim left", "nobody", True)]
C.add("fn47_summary_support", "case_no int, sentence string, cited string", numbered([s[:2] for s in _SUPPORT]), lambda df: df.select("case_no", supported(F.col("sentence"), F.col("cited")).alias("ok")), "case_no int, ok boolean", numbered([s[2] for s in _SUPPORT]))


def nested(sections):
    """document_id, path, section: sections under their part and chapter (part_N/chp_N), run numbers telling parts reopened apart."""
    w = Window.partitionBy("document_id").orderBy("ord")
    new_part = F.when(~F.col("part").eqNullSafe(F.lag("part").over(w)), 1).otherwise(0)
    s = sections.withColumn("_p", new_part).withColumn("part_run", F.sum("_p").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    new_chapter = F.when((F.col("_p") == 1) | ~F.col("chapter").eqNullSafe(F.lag("chapter").over(w)), 1).otherwise(0)
    s = s.withColumn("_c", new_chapter).withColumn("chapter_run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    path = F.concat_ws("/", F.when(F.col("part").isNotNull(), F.concat(F.lit("part_"), "part")), F.when(F.col("chapter").isNotNull(), F.concat(F.lit("chp_"), "chapter")))
    return s.groupBy("document_id", "part_run", "chapter_run", path.alias("path")).agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "number"))), lambda x: x["number"]).alias("sections")).drop("part_run", "chapter_run")


C.add("wn14_nested_parts", "document_id string, ord int, number string, part string, chapter string", [("d", 0, "1", None, None), ("d", 1, "2", "I", "1"), ("d", 2, "3", "I", "1"), ("d", 3, "4", "II", "1"), ("d", 4, "5", "II", None), ("d", 5, "6", "I", "1")], nested, "document_id string, path string, sections array<string>",
      [("d", "", ["1"]), ("d", "part_I/chp_1", ["2", "3"]), ("d", "part_II/chp_1", ["4"]), ("d", "part_II", ["5"]), ("d", "part_I/chp_1", ["6"])])


def catalogue(rows):
    """statute_id, title, year, repealed: one entry per file hash, one in force before a repealed one, then by title; an id two entries
    share gets the hash's start on all but the first. rows: blob_sha256, status, title, act_number."""
    one = rows.withColumn("_n", F.row_number().over(Window.partitionBy("blob_sha256").orderBy(F.col("status") == "Repealed", "title"))).filter("_n = 1")
    slug = F.regexp_replace(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "_"), "^_|_$", "")
    found = lambda c: F.nullif(F.regexp_extract(c, r"\b((?:18|19|20)\d{2})\b", 1), F.lit(""))
    s = one.withColumn("base", F.concat(F.lit("punjab_"), slug)).withColumn("_k", F.row_number().over(Window.partitionBy("base").orderBy("blob_sha256")))
    return s.select(F.when(F.col("_k") == 1, F.col("base")).otherwise(F.concat_ws("_", "base", F.substring("blob_sha256", 1, 6))).alias("statute_id"), "title", F.coalesce(found("act_number"), found("title")).cast("int").alias("year"), (F.col("status") == "Repealed").alias("repealed"))


C.add("src30_catalogue_scan", "blob_sha256 string, status string, title string, act_number string", [("aaaaaaaa", "Repealed", "Stamp Act 1899", None), ("aaaaaaaa", "In force", "The Stamp Act 1899", "II of 1900"), ("bbbbbbbb", "In force", "The Stamp Act 1899", None), ("cccccccc", "Repealed", "Mills Ordinance", "no year")], catalogue,
      "statute_id string, title string, year int, repealed boolean", [("punjab_the_stamp_act_1899", "The Stamp Act 1899", 1900, False), ("punjab_the_stamp_act_1899_bbbbbb", "The Stamp Act 1899", 1899, False), ("punjab_mills_ordinance", "Mills Ordinance", None, True)])
_KIND = [("Code of Criminal Procedure Order", "code"), ("Police Order 2002", "order"), ("Rules of the Act", "act"), ("nothing", None)]
C.add("fn28_instrument_cases", "case_no int, title string", numbered([k[0] for k in _KIND]), lambda df: df.select("case_no", F.pandas_udf(lambda t: pd.Series([kind_of_title(x) for x in t], dtype=object), "string")("title").alias("kind")), "case_no int, kind string", numbered([(k[1],) for k in _KIND]))
