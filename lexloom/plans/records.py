"""Queries over records: identities, labels, status ladders, sparse retrieval, limits, caches."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.operators import retrieval as R
from lexloom.tables import load

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("prj03_corpus", """SELECT doc_id, CASE WHEN list_contains(p, 'gazette_n') THEN 'gazette_n' WHEN list_contains(p, 'gazette_s') THEN 'gazette_s' WHEN list_contains(p, 'harun_hc') THEN 'harun_hc' WHEN list_contains(p, 'delm_hc') THEN 'delm_hc' ELSE 'unknown' END AS corpus
    FROM (SELECT doc_id, string_split(lower('in/' || coalesce(source, '') || '/' || doc_id || '.pdf'), '/') AS p FROM documents)""")
def prj03(spark, d):
    """The first known corpus that is a component of the path."""
    parts = F.split(F.lower(F.concat(F.lit("in/"), F.coalesce("source", F.lit("")), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf"))), "/")
    known, out = ("gazette_n", "gazette_s", "harun_hc", "delm_hc"), None
    for k in known:
        out = F.when(F.array_contains(parts, k), k) if out is None else out.when(F.array_contains(parts, k), k)
    return load(spark, d, "documents").select("doc_id", out.otherwise("unknown").alias("corpus"))


@query("prj06_label_fill", """SELECT doc_id, coalesce(nullif(court_id, ''), source || '_court') AS court, CASE WHEN nullif(court_id, '') IS NULL THEN 'label' ELSE 'text' END AS origin,
    CASE WHEN nullif(court_id, '') IS NULL OR source IS NULL THEN NULL ELSE court_id <> source || '_court' END AS disagrees FROM documents""")
def prj06(spark, d):
    """The label fills an empty field, never overwrites, and is compared where both are stated."""
    own, label = F.nullif("court_id", F.lit("")), F.concat("source", F.lit("_court"))
    differs = F.when(own.isNotNull() & label.isNotNull(), F.col("court_id") != label)
    return load(spark, d, "documents").select("doc_id", F.coalesce(own, label).alias("court"), F.when(own.isNull(), "label").otherwise("text").alias("origin"), differs.alias("disagrees"))


@query("prj07_retract", "SELECT doc_id, CASE WHEN document_kind IN ('judgment', 'order_sheet') THEN court_id END AS court_id, CASE WHEN document_kind IN ('judgment', 'order_sheet') THEN decision_date END AS decision_date FROM documents")
def prj07(spark, d):
    court = F.coalesce(F.col("document_kind").isin("judgment", "order_sheet"), F.lit(False))
    return load(spark, d, "documents").select("doc_id", F.when(court, F.col("court_id")).alias("court_id"), F.when(court, F.col("decision_date")).alias("decision_date"))


@query("prj11_block_identity", "SELECT DISTINCT substr(sha256(document_id), 1, 16) || '/' || block_id AS uid, page FROM segments")
def prj11(spark, d):
    return load(spark, d, "segments").select(F.concat(F.substring(F.sha2("document_id", 256), 1, 16), F.lit("/"), "block_id").alias("uid"), "page").distinct()


_MENTIONS = "(SELECT DISTINCT mention_id, document_id, statute_id, mention_role, section_found FROM provision_mentions WHERE statute_id IS NOT NULL)"


@query("ag11_status_ladder", f"""SELECT statute_id, CASE WHEN count(*) FILTER (mention_role = 'charge') > 0 THEN 'charged' WHEN count(*) FILTER (mention_role = 'ratio') > 0 THEN 'decided' WHEN count(*) FILTER (mention_role = 'relief') > 0 THEN 'asked' ELSE 'named' END AS status,
    count(DISTINCT document_id) AS documents FROM {_MENTIONS} GROUP BY statute_id""")
def ag11(spark, d):
    """The strongest role a statute ever has, by fixed order, and the documents that name it."""
    m = load(spark, d, "provision_mentions").filter("statute_id IS NOT NULL").groupBy("statute_id").agg(
        *[F.bool_or(F.coalesce(F.col("mention_role") == r, F.lit(False))).alias(r) for r in ("charge", "ratio", "relief")], F.count_distinct("document_id").alias("documents")
    )
    return m.select("statute_id", F.when(F.col("charge"), "charged").when(F.col("ratio"), "decided").when(F.col("relief"), "asked").otherwise("named").alias("status"), "documents")


@query("ag13_label_agreement", "SELECT source, count(*) AS scored, round(avg(CASE WHEN court_id = source || '_court' THEN 1.0 ELSE 0.0 END), 4) AS agreement FROM documents WHERE court_id IS NOT NULL AND source IS NOT NULL GROUP BY source")
def ag13(spark, d):
    df = load(spark, d, "documents").filter("court_id IS NOT NULL AND source IS NOT NULL")
    return df.groupBy("source").agg(F.count("*").alias("scored"), F.round(F.avg((F.col("court_id") == F.concat("source", F.lit("_court"))).cast("double")), 4).alias("agreement"))


@query("ag25_timeline_report", "SELECT kind, count(DISTINCT statute_id || '|' || section) AS sections, count(*) AS events, count(*) FILTER (pinpoint IS NOT NULL) AS pinned, count(*) FILTER (loaded_at > read_at + INTERVAL '1 day') AS late FROM provision_mentions GROUP BY kind")
def ag25(spark, d):
    late = F.col("loaded_at") > F.col("read_at") + F.expr("INTERVAL '1' DAY")
    return load(spark, d, "provision_mentions").groupBy("kind").agg(
        F.count_distinct(F.concat("statute_id", F.lit("|"), "section")).alias("sections"), F.count("*").alias("events"), F.count("pinpoint").alias("pinned"), F.count_if(late).alias("late")
    )


@query("wn04_back_references", """WITH p AS (SELECT DISTINCT document_id, page, regexp_extract(para_id, '_b([0-9]+)', 1)::INT AS no, regexp_extract(text, '^([0-9]{1,2})[.] ', 1)::INT AS n FROM paras WHERE regexp_matches(text, '^[0-9]{1,2}[.] ')),
    w AS (SELECT *, max(n) OVER (PARTITION BY document_id ORDER BY page, no, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top, row_number() OVER (PARTITION BY document_id, n ORDER BY page, no) AS seen FROM p)
    SELECT document_id, page, no, n FROM w WHERE NOT (top IS NOT NULL AND n < top AND seen > 1)""")
def wn04(spark, d):
    """Numbered paragraphs without those that fall back to a number already seen."""
    p = load(spark, d, "paras").filter(F.col("text").rlike("^[0-9]{1,2}[.] ")).select("document_id", "page", F.regexp_extract("para_id", "_b([0-9]+)", 1).cast("int").alias("no"), F.regexp_extract("text", "^([0-9]{1,2})[.] ", 1).cast("int").alias("n")).distinct()
    w = Window.partitionBy("document_id").orderBy("page", "no", "n").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("top", F.max("n").over(w)).withColumn("seen", F.row_number().over(Window.partitionBy("document_id", "n").orderBy("page", "no")))
    return p.filter(F.col("top").isNull() | (F.col("n") >= F.col("top")) | (F.col("seen") == 1)).select("document_id", "page", "no", "n")


@query("tk03_sparse_top", """WITH c AS (SELECT id, min(title) AS t FROM chunks WHERE title IS NOT NULL GROUP BY id), t AS (SELECT id, term, count(*) AS w FROM (SELECT id, unnest(list_transform(regexp_extract_all(t, '([A-Za-z]+|[0-9]+[A-Za-z]*)', 1), lambda x: lower(x))) AS term FROM c) GROUP BY id, term),
    q AS (SELECT candidate_id AS query_id, term, count(*) AS w FROM (SELECT candidate_id, unnest(list_transform(regexp_extract_all(p, '([A-Za-z]+|[0-9]+[A-Za-z]*)', 1), lambda x: lower(x))) AS term FROM (SELECT candidate_id, min(petitioner) AS p FROM candidates WHERE candidate_id % 50 = 0 AND petitioner IS NOT NULL GROUP BY candidate_id)) GROUP BY candidate_id, term),
    s AS (SELECT query_id, id, sum(q.w * t.w)::DOUBLE AS score FROM q JOIN t USING (term) GROUP BY query_id, id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) SELECT query_id, id, score, rank FROM r WHERE rank <= 10""")
def tk03(spark, d):
    """The dot product of token-count maps, for every candidate whose id is divisible by 50 against all chunk titles."""
    chunks = load(spark, d, "chunks").filter("title IS NOT NULL").groupBy("id").agg(F.min("title").alias("t"))
    docs = R.postings(chunks, "id", "t").withColumnRenamed("tf", "w")
    q = load(spark, d, "candidates").filter("candidate_id % 50 = 0 AND petitioner IS NOT NULL").groupBy(F.col("candidate_id").alias("query_id")).agg(F.min("petitioner").alias("t"))
    asked = R.postings(q, "query_id", "t").withColumnRenamed("tf", "qw")
    s = docs.join(asked, "term").groupBy("query_id", "id").agg(F.sum(F.col("w") * F.col("qw")).cast("double").alias("score"))
    return R.ranked(s, "id", 10)


@query("tk08_input_limit", "SELECT document_id FROM (SELECT DISTINCT document_id FROM doc_text) ORDER BY document_id LIMIT 25")
def tk08(spark, d):
    return load(spark, d, "doc_text").select("document_id").distinct().orderBy("document_id").limit(25)


@query("fn37_version_status", """SELECT statute_id, CASE WHEN updated_till IS NULL THEN 'undated' WHEN act_year IS NULL THEN 'unknown_year' WHEN updated_till > act_year + 50 THEN 'long_amended' WHEN updated_till > act_year THEN 'amended' ELSE 'current' END AS status FROM statute_index""")
def fn37(spark, d):
    u, a = F.col("updated_till"), F.col("act_year")
    status = F.when(u.isNull(), "undated").when(a.isNull(), "unknown_year").when(u > a + 50, "long_amended").when(u > a, "amended").otherwise("current")
    return load(spark, d, "statute_index").select("statute_id", status.alias("status"))


@query("fn46_plain_text", "SELECT DISTINCT document_id, para_id, trim(regexp_replace(regexp_replace(text, '[\\x{E000}-\\x{F8FF}]', '', 'g'), '[ \\t\\n]+', ' ', 'g')) AS plain FROM paras WHERE text IS NOT NULL")
def fn46(spark, d):
    t = F.regexp_replace(F.regexp_replace("text", "[\\uE000-\\uF8FF]", ""), "[ \\t\\n]+", " ")
    return load(spark, d, "paras").filter("text IS NOT NULL").select("document_id", "para_id", F.trim(t).alias("plain")).distinct()


@query("fn47_figures_supported", """SELECT DISTINCT p.mention_id, list_filter(regexp_extract_all(quote, '([0-9]+)', 1), lambda x: NOT contains(sentence, x)) = [] AS supported FROM provision_mentions p WHERE quote IS NOT NULL AND sentence IS NOT NULL""")
def fn47(spark, d):
    """Whether every figure of a quote stands in its sentence."""
    figures = F.regexp_extract_all("quote", F.lit("([0-9]+)"), F.lit(1))
    ok = F.forall(figures, lambda x: F.contains(F.col("sentence"), x))
    return load(spark, d, "provision_mentions").filter("quote IS NOT NULL AND sentence IS NOT NULL").select("mention_id", ok.alias("supported")).distinct()


@query("fn23_decision_ladder", """SELECT DISTINCT id, coalesce(nullif(regexp_extract(text, 'decided on ([0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4})', 1), ''), nullif(regexp_extract(text, 'By order dated ([0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4})', 1), ''), nullif(regexp_extract(text, 'before ([0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4})', 1), '')) AS printed FROM chunks WHERE text IS NOT NULL""")
def fn23(spark, d):
    date = "([0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4})"
    steps = [F.nullif(F.regexp_extract("text", f"{cue} {date}", 1), F.lit("")) for cue in ("decided on", "By order dated", "before")]
    return load(spark, d, "chunks").filter("text IS NOT NULL").select("id", F.coalesce(*steps).alias("printed")).distinct()


@query("rs03_result_cache", "SELECT DISTINCT sha1(document_id || '|v1') AS key FROM doc_text WHERE document_id NOT IN (SELECT document_id FROM chunks WHERE chunk_order > 0)")
def rs03(spark, d):
    """The keys (document, version) that a cache of results doesn't hold yet."""
    done = load(spark, d, "chunks").filter("chunk_order > 0").select("document_id")
    return load(spark, d, "doc_text").join(done, "document_id", "left_anti").select(F.sha1(F.concat("document_id", F.lit("|v1"))).alias("key")).distinct()

