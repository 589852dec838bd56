"""Queries of joins, aggregates, windows, top-k and set operations over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import retrieval as R
from lexloom.operators import spans as S
from lexloom.operators.index import stored_index
from lexloom.plans.scalars import QUALITY_SQL
from lexloom.session import broadcast_if_small, materialise
from lexloom.tables import load

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("prj01_content_blocks", "SELECT DISTINCT document_id, block_id, page FROM segments WHERE block_type NOT IN ('header', 'footer', 'footnote') AND char_end > char_start")
def prj01(spark, d):
    keep = ~F.col("block_type").isin("header", "footer", "footnote") & (F.col("char_end") > F.col("char_start"))
    return load(spark, d, "segments").filter(keep).select("document_id", "block_id", "page").distinct()


@query("prj02_flatten", """WITH r AS (SELECT DISTINCT document_id, para_id, page, trim(text, ' ') AS t, regexp_extract(para_id, '_b([0-9]+)', 1)::INT AS no FROM paras WHERE trim(text, ' ') <> ''),
    s AS (SELECT *, coalesce(sum(length(t) + 1) OVER (PARTITION BY document_id ORDER BY page, no, para_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM r)
    SELECT document_id, para_id, char_start, char_start + length(t) AS char_end FROM s""")
def prj02(spark, d):
    return S.flatten(load(spark, d, "paras"))


@query("jn02_alias_join", """WITH a AS (SELECT citation, count(DISTINCT document_id) AS holders, min(document_id) AS doc FROM chunks WHERE citation IS NOT NULL GROUP BY citation)
    SELECT p.pair_id, a.doc AS document_id, coalesce(holders, 0) AS holders FROM (SELECT DISTINCT pair_id, citation_a FROM cite_pairs) p LEFT JOIN (SELECT citation, holders, CASE WHEN holders = 1 THEN doc END AS doc FROM a) a ON a.citation = p.citation_a""")
def jn02(spark, d):
    """Each pair's first citation to the one document that holds it; none where several hold it."""
    held = load(spark, d, "chunks").filter("citation IS NOT NULL").select("citation", "document_id").distinct()
    a = held.groupBy("citation").agg(F.count("*").alias("holders"), F.min("document_id").alias("doc"))
    p = load(spark, d, "cite_pairs").select("pair_id", F.col("citation_a").alias("citation")).distinct()
    return p.join(a, "citation", "left").select("pair_id", F.when(F.col("holders") == 1, F.col("doc")).alias("document_id"), F.coalesce("holders", F.lit(0)).alias("holders"))


_WORDS = "array_to_string(regexp_extract_all(lower(regexp_replace(quote, '^(section|article)s? [^ ]+ of ', '')), '[a-z0-9]+'), ' ')"


@query("jn07_title_links", f"""WITH n AS (SELECT DISTINCT quote AS name, {_WORDS} AS needle FROM provision_mentions WHERE regexp_matches(quote, '^(section|article)s? [^ ]+ of ')),
    h AS (SELECT statute_id, title, act_year, ' ' || array_to_string(x, ' ') || ' ' AS hay FROM (SELECT statute_id, title, act_year, unnest(haystacks) AS x FROM statute_index WHERE title IS NOT NULL)),
    m AS (SELECT name, statute_id, row_number() OVER (PARTITION BY name ORDER BY length(title), statute_id) AS k FROM n JOIN h ON contains(hay, ' ' || needle || ' ')
      WHERE regexp_extract(needle, '([0-9]{{4}})$', 1) = '' OR act_year IS NULL OR act_year = regexp_extract(needle, '([0-9]{{4}})$', 1)::INT)
    SELECT name, statute_id FROM m WHERE k = 1""")
def jn07(spark, d):
    quotes = load(spark, d, "provision_mentions").filter(F.col("quote").rlike("^(section|article)s? [^ ]+ of ")).select(F.col("quote").alias("name")).distinct()
    bare = F.lower(F.regexp_replace("name", "^(section|article)s? [^ ]+ of ", ""))
    names = quotes.withColumn("needle", F.array_join(F.regexp_extract_all(bare, F.lit("([a-z0-9]+)"), F.lit(1)), " "))
    names = names.withColumn("year", F.when(F.col("needle").rlike("[0-9]{4}$"), F.regexp_extract("needle", "([0-9]{4})$", 1).cast("int")))
    return S.link_titles(names, load(spark, d, "statute_index").filter("title IS NOT NULL"))


@query("jn10_reference_back", """WITH m AS (SELECT DISTINCT mention_id, document_id, kind, char_start, statute_id FROM provision_mentions)
    SELECT mention_id, last_value(statute_id IGNORE NULLS) OVER (PARTITION BY document_id, kind ORDER BY char_start, mention_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bound_to
    FROM m QUALIFY statute_id IS NULL""")
def jn10(spark, d):
    """A mention without a statute binds to the latest statute of its kind named before it (as-of, one window per document)."""
    m = load(spark, d, "provision_mentions").select("mention_id", "document_id", "kind", "char_start", "statute_id").distinct()
    w = Window.partitionBy("document_id", "kind").orderBy(F.asc_nulls_last("char_start"), "mention_id").rowsBetween(Window.unboundedPreceding, -1)
    return m.withColumn("bound_to", F.last("statute_id", ignorenulls=True).over(w)).filter("statute_id IS NULL").select("mention_id", "bound_to")


@query("jn12_concern_versions", """WITH m AS (SELECT DISTINCT mention_id, statute_id, section, year(read_at) AS decided FROM provision_mentions WHERE kind = 'section' AND statute_id IS NOT NULL)
    SELECT mention_id, CASE WHEN s.statute_id IS NULL THEN 'section_not_indexed' WHEN s.updated_till IS NULL THEN 'undated' WHEN decided > s.updated_till THEN 'text_older_than_decision' ELSE 'current' END AS version_status
    FROM m LEFT JOIN statute_index s USING (statute_id)""")
def jn12(spark, d):
    m = load(spark, d, "provision_mentions").filter("kind = 'section' AND statute_id IS NOT NULL").select("mention_id", "statute_id", "section", F.year("read_at").alias("decided")).distinct()
    s = load(spark, d, "statute_index").select("statute_id", "updated_till", F.lit(True).alias("held"))
    status = F.when(F.col("held").isNull(), "section_not_indexed").when(F.col("updated_till").isNull(), "undated").when(F.col("decided") > F.col("updated_till"), "text_older_than_decision").otherwise("current")
    return m.join(s, "statute_id", "left").select("mention_id", status.alias("version_status"))


@query("jn16_span_blocks", """WITH c AS (SELECT DISTINCT id, document_id, char_start, char_end FROM chunks), b AS (SELECT DISTINCT document_id, block_id, page, char_start, char_end FROM segments WHERE char_end > char_start),
    m AS (SELECT c.id, c.document_id, b.block_id, b.page, b.char_start AS b0 FROM c JOIN b ON c.document_id = b.document_id AND b.char_start < c.char_end AND b.char_end > c.char_start WHERE c.char_end > c.char_start),
    g AS (SELECT id, document_id, min(page) AS page_first, max(page) AS page_last, list(block_id ORDER BY b0, block_id) AS block_ids FROM m GROUP BY id, document_id)
    SELECT k.id, k.document_id, page_first, page_last, coalesce(block_ids, []) AS block_ids FROM (SELECT DISTINCT id, document_id FROM c) k LEFT JOIN g ON k.id = g.id AND k.document_id = g.document_id""")
def jn16(spark, d):
    blocks = load(spark, d, "segments").select("document_id", "char_start", "char_end", "block_id", "page").distinct()
    return S.spans_to_blocks(load(spark, d, "chunks").select("id", "document_id", "char_start", "char_end").distinct(), blocks)


@query("jn22_skip_existing", "SELECT DISTINCT document_id FROM doc_text WHERE document_id NOT IN (SELECT document_id FROM provision_mentions WHERE document_id IS NOT NULL)")
def jn22(spark, d):
    return load(spark, d, "doc_text").select("document_id").distinct().join(load(spark, d, "provision_mentions").select("document_id"), "document_id", "left_anti")


_NUM = "regexp_extract(section, '^([0-9]+)', 1)"


@query("jn23_missing_numbers", f"""WITH s AS (SELECT DISTINCT statute_id, {_NUM}::INT AS n FROM provision_mentions WHERE statute_id IS NOT NULL AND {_NUM} <> '' AND length({_NUM}) <= 4),
    t AS (SELECT statute_id, max(n) AS top FROM s GROUP BY statute_id), g AS (SELECT statute_id, unnest(range(1, top + 1))::INT AS n FROM t)
    SELECT statute_id, n FROM (SELECT g.statute_id, g.n, row_number() OVER (PARTITION BY g.statute_id ORDER BY g.n) AS k FROM g ANTI JOIN s ON g.statute_id = s.statute_id AND g.n = s.n) WHERE k <= 50""")
def jn23(spark, d):
    """The first 50 section numbers up to each statute's highest that no mention names."""
    num = F.regexp_extract("section", "^([0-9]+)", 1)
    s = load(spark, d, "provision_mentions").filter(F.col("statute_id").isNotNull() & (num != "") & (F.length(num) <= 4)).groupBy("statute_id").agg(F.collect_set(num.cast("int")).alias("seen"))
    miss = F.slice(F.array_except(F.sequence(F.lit(1), F.greatest(F.lit(1), F.array_max("seen"))), "seen"), 1, 50)
    return s.select("statute_id", F.explode(miss).alias("n"))


@query("jn25_regression_diff", """WITH a AS (SELECT source, count(DISTINCT document_id) AS n FROM doc_text GROUP BY source), b AS (SELECT source, count(DISTINCT document_id) AS n FROM chunks GROUP BY source)
    SELECT coalesce(a.source, b.source) AS source, CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'gone' WHEN a.n <> b.n THEN 'moved' ELSE 'same' END AS state FROM a FULL JOIN b ON a.source IS NOT DISTINCT FROM b.source""")
def jn25(spark, d):
    count = lambda t, n: load(spark, d, t).groupBy("source").agg(F.count_distinct("document_id").alias(n))
    a, b = count("doc_text", "na"), count("chunks", "nb").withColumnRenamed("source", "s2")
    state = F.when(F.col("na").isNull(), "new").when(F.col("nb").isNull(), "gone").when(F.col("na") != F.col("nb"), "moved").otherwise("same")
    return a.join(b, F.col("source").eqNullSafe(F.col("s2")), "full").select(F.coalesce("source", "s2").alias("source"), state.alias("state"))


def _chunks(spark, d):
    """id, text: the least text of each id. Only the texts of ids that stand in several rows are brought together."""
    rows = load(spark, d, "chunks").filter("text IS NOT NULL").select("id", "text")
    again = materialise(rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "repeated-ids", n=F.count(F.lit(1)))
    small = broadcast_if_small(again, again.counts["n"])
    same = rows["id"].eqNullSafe(small["id"])
    return rows.join(small, same, "left_anti").unionByName(rows.join(small, same, "left_semi").groupBy("id").agg(F.min("text").alias("text")))


# a stated query set: the citations and party titles of every fiftieth candidate
def _questions(spark, d):
    q = load(spark, d, "candidates").filter("candidate_id % 50 = 0 AND petitioner IS NOT NULL AND respondent IS NOT NULL")
    return q.groupBy(F.col("candidate_id").alias("query_id")).agg(F.min(F.concat_ws(" ", "petitioner", "respondent")).alias("text"))


_BM25 = """WITH c AS (SELECT id, min(text) AS text FROM chunks WHERE text IS NOT NULL GROUP BY id),
    t AS (SELECT id, unnest(list_transform(regexp_extract_all(text, '([A-Za-z]+|[0-9]+[A-Za-z]*)', 1), lambda x: lower(x))) AS term FROM c),
    p AS (SELECT id, term, count(*) AS tf FROM t GROUP BY id, term), l AS (SELECT c.id, count(t.term) AS dl FROM c LEFT JOIN t ON c.id = t.id GROUP BY c.id),
    w AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM l), f AS (SELECT term, count(*) AS df, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM p, w GROUP BY term),
    q0 AS (SELECT candidate_id AS query_id, min(petitioner || ' ' || respondent) AS text FROM candidates WHERE candidate_id % 50 = 0 AND petitioner IS NOT NULL AND respondent IS NOT NULL GROUP BY candidate_id),
    q AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest(list_transform(regexp_extract_all(text, '([A-Za-z]+|[0-9]+[A-Za-z]*)', 1), lambda x: lower(x))) AS term FROM q0) GROUP BY query_id, term),
    s AS (SELECT query_id, p.id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN p USING (term) JOIN f USING (term) JOIN l ON p.id = l.id, w GROUP BY query_id, p.id),
    r AS (SELECT query_id, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM s WHERE score > 0)"""


@query("ag01_bm25_statistics", _BM25 + " SELECT term, df, round(idf, 6) AS idf FROM f")
def ag01(spark, d):
    return index_of(spark, d).terms.select("term", "df", F.round("idf", 6).alias("idf"))


def index_of(spark, d):
    """The stored index of the chunks' texts: built once for the files as they are, then opened."""
    return stored_index(lambda: _chunks(spark, d), "id", "text", "chunks", load(spark, d, "chunks"))


def bm25(spark, d, depth=100):
    s = index_of(spark, d).top(_questions(spark, d), depth).withColumn("score", F.round("score", 6))
    return R.ranked(s, "id", depth)


@query("ag02_bm25_ranking", _BM25 + " SELECT query_id, id, score, rank FROM r WHERE rank <= 100")
def ag02(spark, d):
    return bm25(spark, d)


_EXACT = """e AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY id) AS rank FROM
      (SELECT DISTINCT q0.query_id, c.id FROM (SELECT candidate_id AS query_id, regexp_extract(lower(petitioner), '([a-z]{5,})', 1) AS w FROM candidates WHERE candidate_id % 50 = 0 AND petitioner IS NOT NULL) q0
       JOIN (SELECT id, unnest(regexp_extract_all(lower(title), '([a-z]{5,})', 1)) AS w FROM chunks) c ON c.w = q0.w WHERE q0.w <> ''))"""


def _first_words(spark, d):
    """query_id, w: the first long word of each query's petitioner."""
    q = load(spark, d, "candidates").filter("candidate_id % 50 = 0 AND petitioner IS NOT NULL")
    return q.select(F.col("candidate_id").alias("query_id"), F.regexp_extract(F.lower("petitioner"), "([a-z]{5,})", 1).alias("w")).filter("w != ''").distinct()


def _title_words(spark, d):
    """w, id: the chunks whose title holds an asked word, once."""
    c = load(spark, d, "chunks").select("id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("title"), F.lit("([a-z]{5,})"), F.lit(1)))).alias("w"))
    return c.join(_first_words(spark, d).select("w").distinct(), "w", "left_semi").select("w", "id").distinct()


def _exact(spark, d, depth=100):
    """The first `depth` chunks, in order of id, whose title holds the first long word of the petitioner. Each word's chunks are
    numbered once, not once for each query that asks for it."""
    first = _title_words(spark, d).withColumn("k", F.row_number().over(Window.partitionBy("w").orderBy("id"))).filter(F.col("k") <= depth)
    hit = _first_words(spark, d).join(first, "w").select("query_id", "id").distinct()
    return hit.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("id"))).filter(F.col("rank") <= depth)


_FUSED = _BM25 + ", " + _EXACT + """, u AS (SELECT query_id, id, rank, 0 AS leg FROM e WHERE rank <= 100 UNION ALL SELECT query_id, id, rank, 1 FROM r WHERE rank <= 100),
    z AS (SELECT query_id, id, sum(1.0 / (60 + rank)) AS score, min(leg * 1000 + rank) AS first FROM u GROUP BY query_id, id),
    h AS (SELECT query_id, id, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, first, id) AS rank FROM z)"""


def fused(spark, d):
    return R.fuse([("exact", _exact(spark, d)), ("bm25", bm25(spark, d))], "id")


@query("tk01_rank_fusion", _FUSED + " SELECT query_id, id, score, rank FROM h WHERE rank <= 10")
def tk01(spark, d):
    return fused(spark, d).withColumn("score", F.round("score", 9))


@query("ag03_recall_mrr", _FUSED + """, gold AS (SELECT DISTINCT query_id, id FROM e), fr AS (SELECT g.query_id, min(h.rank) AS r FROM gold g LEFT JOIN (SELECT * FROM h WHERE rank <= 10) h ON g.query_id = h.query_id AND g.id = h.id GROUP BY g.query_id)
    SELECT 'title' AS kind, count(*) AS queries, round(avg(coalesce(1.0 / r, 0)), 4) AS mrr, round(avg(CASE WHEN r <= 1 THEN 1.0 ELSE 0 END), 4) AS recall_1,
    round(avg(CASE WHEN r <= 5 THEN 1.0 ELSE 0 END), 4) AS recall_5, round(avg(CASE WHEN r <= 10 THEN 1.0 ELSE 0 END), 4) AS recall_10 FROM fr HAVING count(*) > 0""")
def ag03(spark, d):
    """The gold chunks of a query are those whose title holds its word: of these only the hits among them are joined, and one row
    without a chunk for each query that has any."""
    hits, held, asked = materialise(fused(spark, d), "fused"), materialise(_title_words(spark, d), "title-words"), _first_words(spark, d)
    found = hits.join(asked, "query_id").join(held, ["w", "id"]).select("query_id", "id").distinct()
    some = asked.join(held.select("w").distinct(), "w", "left_semi").select("query_id", F.lit(None).cast("string").alias("id")).distinct()
    return R.recall_mrr(hits, found.unionByName(some).withColumn("kind", F.lit("title")), "id")


@query("tk02_dense_top", """WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 50 = 0), v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    s AS (SELECT query_id, vec_id, round(list_cosine_similarity(q.e, v.e), 9) AS score FROM q, v), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s WHERE score > 0)
    SELECT query_id, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10""")
def tk02(spark, d):
    v = load(spark, d, "embeddings").select("vec_id", "embedding")
    q = v.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return R.dense_top(q, v, 10).withColumn("score", F.round("score", 6))


@query("ag04_exact_duplicates", "SELECT min(doc_id) AS kept, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY sha256(text) HAVING count(*) > 1")
def ag04(spark, d):
    return load(spark, d, "documents").filter("text IS NOT NULL").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("kept"), F.count("*").alias("copies")).filter("copies > 1").select("kept", "copies")


_EDGES = """WITH e AS (SELECT DISTINCT d.doc_id, u.cited, regexp_extract(d.decision_date, '([0-9]{4})', 1) AS y FROM documents d, (SELECT unnest(regexp_extract_all(d.text, '\\b((?:19|20)[0-9]{2} [A-Z]{2,4} [0-9]+)\\b', 1)) AS cited) u)"""


def _edges(spark, d):
    docs = load(spark, d, "documents").filter("text IS NOT NULL")
    return docs.select("doc_id", F.explode(T.citations("text")).alias("cited"), F.regexp_extract("decision_date", "([0-9]{4})", 1).alias("y")).distinct()


@query("ag05_citation_graph", _EDGES + """ SELECT cited AS node, 'authority' AS kind, 0::BIGINT AS cites, count(*) AS cited_by FROM e GROUP BY cited
    UNION ALL SELECT doc_id::VARCHAR, 'document', count(*), 0 FROM e GROUP BY doc_id""")
def ag05(spark, d):
    """Both sides of every edge from one reading of the texts."""
    sides = F.expr("stack(2, cited, 'authority', 0L, 1L, cast(doc_id AS string), 'document', 1L, 0L) AS (node, kind, cites, cited_by)")
    return _edges(spark, d).select(sides).groupBy("node", "kind").agg(F.sum("cites").alias("cites"), F.sum("cited_by").alias("cited_by"))


@query("ag05_anachronisms", _EDGES + " SELECT doc_id, cited, y::INT AS citing_year FROM e WHERE y <> '' AND substr(cited, 1, 4)::INT > y::INT")
def ag05b(spark, d):
    return _edges(spark, d).filter("y != '' AND cast(substr(cited, 1, 4) AS int) > cast(y AS int)").select("doc_id", "cited", F.col("y").cast("int").alias("citing_year"))


@query("ag09_provision_edges", """WITH m AS (SELECT DISTINCT mention_id, document_id, statute_id, kind, section, mention_role, method, pinpoint, section_found FROM provision_mentions WHERE statute_id IS NOT NULL)
    SELECT document_id, statute_id, kind, section, count(*) AS mentions, count(*) FILTER (mention_role = 'ratio') AS ratio, count(*) FILTER (mention_role = 'charge') AS charge, count(*) FILTER (method = 'title') AS by_title,
    bool_or(section_found) AS section_found, coalesce(list_sort(list(DISTINCT pinpoint) FILTER (pinpoint IS NOT NULL)), []) AS pinpoints FROM m GROUP BY document_id, statute_id, kind, section""")
def ag09(spark, d):
    m = load(spark, d, "provision_mentions").filter("statute_id IS NOT NULL").select("mention_id", "document_id", "statute_id", "kind", "section", "mention_role", "method", "pinpoint", "section_found").distinct()
    pins = F.sort_array(F.collect_set("pinpoint"))
    return m.groupBy("document_id", "statute_id", "kind", "section").agg(
        F.count("*").alias("mentions"), F.count_if(F.col("mention_role") == "ratio").alias("ratio"), F.count_if(F.col("mention_role") == "charge").alias("charge"),
        F.count_if(F.col("method") == "title").alias("by_title"), F.bool_or("section_found").alias("section_found"), pins.alias("pinpoints"),
    )


@query("ag10_identity", """WITH c AS (SELECT document_id, min(citation) AS citation, min(structure['case_number']) AS case_number FROM chunks GROUP BY document_id)
    SELECT document_id, CASE WHEN citation IS NOT NULL THEN 'neutral' WHEN case_number IS NOT NULL THEN 'court' ELSE 'document' END AS rung, 'j_' || substr(sha1(coalesce(citation, case_number, document_id)), 1, 16) AS judgment_id FROM c""")
def ag10(spark, d):
    c = load(spark, d, "chunks").groupBy("document_id").agg(F.min("citation").alias("citation"), F.min(F.col("structure")["case_number"]).alias("case_number"))
    rung = F.when(F.col("citation").isNotNull(), "neutral").when(F.col("case_number").isNotNull(), "court").otherwise("document")
    return c.select("document_id", rung.alias("rung"), F.concat(F.lit("j_"), F.substring(F.sha1(F.coalesce("citation", "case_number", "document_id")), 1, 16)).alias("judgment_id"))


@query("ag12_run_report", f"""WITH t AS ({QUALITY_SQL}), n AS (SELECT source, q, row_number() OVER (PARTITION BY source ORDER BY q) - 1 AS k, count(*) OVER (PARTITION BY source) AS n FROM t)
    SELECT source, max(n) AS documents, min(q) AS worst, max(q) FILTER (k = n // 10) AS p10, max(q) FILTER (k = n // 2) AS median FROM n GROUP BY source""")
def ag12(spark, d):
    """Per source: documents, least quality, and the values at n div 10 and n div 2 of the sorted ones (no interpolation).
    Quality takes a few values, so counts per value are cumulated, not the rows of a source."""
    g = load(spark, d, "documents").groupBy("source", T.quality("text").alias("q")).agg(F.count("*").alias("c"))
    w = Window.partitionBy("source").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("source")))
    at = lambda k: F.min(F.when(F.col("upto") > F.floor(F.col("n") / k), F.col("q")))
    return g.groupBy("source").agg(F.max("n").alias("documents"), F.min("q").alias("worst"), at(10).alias("p10"), at(2).alias("median"))


@query("ag16_weighted_share", """WITH s AS (SELECT method, count(*) AS size FROM provision_mentions WHERE method IS NOT NULL GROUP BY method), l AS (SELECT method, count(*) AS n, avg(CASE WHEN section_found THEN 1.0 ELSE 0 END) AS p FROM provision_mentions WHERE section_found IS NOT NULL AND method IS NOT NULL GROUP BY method)
    SELECT method, n, round(p, 6) AS share, round((p + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS low,
    round((p + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS high, round(size * 1.0 / n, 6) AS weight FROM l JOIN s USING (method)""")
def ag16(spark, d):
    m = load(spark, d, "provision_mentions").filter("method IS NOT NULL")
    g = m.groupBy("method").agg(F.count("*").alias("size"), F.count("section_found").alias("n"), F.avg(F.col("section_found").cast("double")).alias("p")).filter("n > 0")
    low, high = T.wilson(F.col("p"), F.col("n"))
    return g.select("method", "n", F.round("p", 6).alias("share"), F.round(low, 6).alias("low"), F.round(high, 6).alias("high"), F.round(F.col("size") / F.col("n"), 6).alias("weight"))


@query("ag17_ambiguous_numbers", """WITH m AS (SELECT statute_id, section, count(DISTINCT pinpoint) AS pins, count(*) AS n FROM provision_mentions WHERE statute_id IS NOT NULL AND section IS NOT NULL GROUP BY statute_id, section)
    SELECT statute_id, section, n, pins > 1 AS ambiguous FROM m""")
def ag17(spark, d):
    m = load(spark, d, "provision_mentions").filter("statute_id IS NOT NULL AND section IS NOT NULL")
    return m.groupBy("statute_id", "section").agg(F.count("*").alias("n"), (F.count_distinct("pinpoint") > 1).alias("ambiguous"))


@query("ag18_repeated_bands", """SELECT document_id, key FROM (SELECT document_id, page, regexp_replace(trim(text), '[0-9]+', '#', 'g') AS key FROM paras WHERE bbox[2] < 130 OR bbox[4] > 707) WHERE key <> '' GROUP BY document_id, key HAVING count(DISTINCT page) >= 2""")
def ag18(spark, d):
    p = load(spark, d, "paras").filter((F.col("bbox")[1] < 130) | (F.col("bbox")[3] > 707)).select("document_id", "page", F.regexp_replace(F.trim("text"), "[0-9]+", "#").alias("key")).filter("key != ''")
    return p.groupBy("document_id", "key").agg(F.count_distinct("page").alias("n")).filter("n >= 2").select("document_id", "key")


@query("ag21_language_share", """SELECT document_id, round(sum(a) * 1.0 / sum(a + l), 4) AS rtl_share FROM (SELECT DISTINCT document_id, length(regexp_replace(text, '[^\\x{0600}-\\x{06FF}]', '', 'g')) AS a, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS l, para_id FROM paras WHERE text IS NOT NULL)
    GROUP BY document_id HAVING sum(a + l) > 0""")
def ag21(spark, d):
    n = lambda p: F.length(F.regexp_replace("text", p, ""))
    p = load(spark, d, "paras").filter("text IS NOT NULL").select("document_id", n("[^\\u0600-\\u06FF]").alias("a"), n("[^A-Za-z]").alias("l"), "para_id").distinct()
    return p.groupBy("document_id").agg(F.sum("a").alias("a"), F.sum(F.col("a") + F.col("l")).alias("s")).filter("s > 0").select("document_id", F.round(F.col("a") / F.col("s"), 4).alias("rtl_share"))


@query("ag23_cost_estimate", "SELECT source, count(*) AS calls, sum(floor(length(text) / 4) + 40)::BIGINT AS tokens FROM documents WHERE text IS NOT NULL GROUP BY source")
def ag23(spark, d):
    return load(spark, d, "documents").filter("text IS NOT NULL").groupBy("source").agg(F.count("*").alias("calls"), F.sum(F.floor(F.length("text") / 4) + 40).alias("tokens"))


@query("ag24_kind_by_role", "SELECT kind, count(*) FILTER (mention_role = 'ratio') AS ratio, count(*) FILTER (mention_role = 'charge') AS charge, count(*) FILTER (mention_role = 'relief') AS relief FROM provision_mentions GROUP BY kind")
def ag24(spark, d):
    return load(spark, d, "provision_mentions").groupBy("kind").pivot("mention_role", ["ratio", "charge", "relief"]).agg(F.count(F.lit(1))).na.fill(0)


@query("wn01_numbering", """WITH p AS (SELECT DISTINCT document_id, page, regexp_extract(para_id, '_b([0-9]+)', 1)::INT AS no, regexp_extract(text, '^([0-9]{1,2})[.] ', 1)::INT AS n FROM paras WHERE regexp_matches(text, '^[0-9]{1,2}[.] ')),
    l AS (SELECT document_id, page, n, lag(n) OVER (PARTITION BY document_id ORDER BY page, no, n) AS prev FROM p)
    SELECT document_id, n, CASE WHEN n > prev + 1 THEN 'gap' ELSE 'regression' END AS issue FROM l WHERE prev IS NOT NULL AND n <> 1 AND n <> prev + 1""")
def wn01(spark, d):
    p = load(spark, d, "paras").filter(F.col("text").rlike("^[0-9]{1,2}[.] ")).select("document_id", "page", F.regexp_extract("para_id", "_b([0-9]+)", 1).cast("int").alias("no"), F.regexp_extract("text", "^([0-9]{1,2})[.] ", 1).cast("int").alias("n")).distinct()
    l = p.withColumn("prev", F.lag("n").over(Window.partitionBy("document_id").orderBy("page", "no", "n")))  # noqa: E741
    return l.filter("prev IS NOT NULL AND n != 1 AND n != prev + 1").select("document_id", "n", F.when(F.col("n") > F.col("prev") + 1, "gap").otherwise("regression").alias("issue"))


@query("wn02_reading_order", """WITH c AS (SELECT DISTINCT document_id, id, chunk_order FROM chunks), n AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY chunk_order, id) - 1 AS want FROM c) SELECT id FROM n WHERE want <> chunk_order""")
def wn02(spark, d):
    c = load(spark, d, "chunks").select("document_id", "id", "chunk_order").distinct()
    return c.withColumn("want", F.row_number().over(Window.partitionBy("document_id").orderBy("chunk_order", "id")) - 1).filter("want != chunk_order").select("id")


@query("wn03_restarts", "SELECT document_id, count(*) FILTER (regexp_matches(text, '^1[.] ')) AS restarts FROM (SELECT DISTINCT document_id, para_id, text FROM paras) GROUP BY document_id")
def wn03(spark, d):
    return load(spark, d, "paras").select("document_id", "para_id", "text").distinct().groupBy("document_id").agg(F.count_if(F.col("text").rlike("^1[.] ")).alias("restarts"))


@query("wn13_page_runs", """WITH s AS (SELECT DISTINCT document_id, char_start, block_id, page, coalesce(contains_rtl, false) AS tag FROM segments), l AS (SELECT *, CASE WHEN tag IS DISTINCT FROM lag(tag) OVER w THEN 1 ELSE 0 END AS edge FROM s WINDOW w AS (PARTITION BY document_id ORDER BY char_start, block_id)),
    g AS (SELECT *, sum(edge) OVER (PARTITION BY document_id ORDER BY char_start, block_id ROWS UNBOUNDED PRECEDING) AS run FROM l)
    SELECT document_id, run::BIGINT AS run, bool_or(tag) AS rtl, count(*) AS blocks, min(page) AS page_first, max(page) AS page_last FROM g GROUP BY document_id, run""")
def wn13(spark, d):
    s = load(spark, d, "segments").select("document_id", "char_start", "block_id", "page", F.coalesce("contains_rtl", F.lit(False)).alias("tag")).distinct()
    w = Window.partitionBy("document_id").orderBy("char_start", "block_id")
    g = s.withColumn("edge", F.when(F.col("tag").eqNullSafe(F.lag("tag").over(w)), 0).otherwise(1)).withColumn("run", F.sum("edge").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy("document_id", "run").agg(F.bool_or("tag").alias("rtl"), F.count("*").alias("blocks"), F.min("page").alias("page_first"), F.max("page").alias("page_last"))


@query("wn15_backward_year", """WITH c AS (SELECT DISTINCT candidate_id, decision_year, court_id FROM candidates)
    SELECT candidate_id, first_value(decision_year IGNORE NULLS) OVER (PARTITION BY court_id ORDER BY candidate_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS decided FROM c WHERE court_id IS NOT NULL""")
def wn15(spark, d):
    c = load(spark, d, "candidates").filter("court_id IS NOT NULL").select("candidate_id", "decision_year", "court_id").distinct()
    w = Window.partitionBy("court_id").orderBy("candidate_id").rowsBetween(0, Window.unboundedFollowing)
    return c.select("candidate_id", F.first("decision_year", ignorenulls=True).over(w).alias("decided"))


@query("wn16_carry_instrument", """WITH m AS (SELECT DISTINCT mention_id, document_id, page, char_start, statute_id FROM provision_mentions)
    SELECT mention_id, last_value(statute_id IGNORE NULLS) OVER (PARTITION BY document_id, page ORDER BY char_start, mention_id ROWS UNBOUNDED PRECEDING) AS carried FROM m""")
def wn16(spark, d):
    m = load(spark, d, "provision_mentions").select("mention_id", "document_id", "page", "char_start", "statute_id").distinct()
    w = Window.partitionBy("document_id", "page").orderBy(F.asc_nulls_last("char_start"), "mention_id").rowsBetween(Window.unboundedPreceding, 0)
    return m.select("mention_id", F.last("statute_id", ignorenulls=True).over(w).alias("carried"))


@query("tk04_most_common", "SELECT statute_id, count(*) AS n FROM provision_mentions WHERE statute_id IS NOT NULL GROUP BY statute_id ORDER BY n DESC, min(mention_id) LIMIT 20")
def tk04(spark, d):
    g = load(spark, d, "provision_mentions").filter("statute_id IS NOT NULL").groupBy("statute_id").agg(F.count("*").alias("n"), F.min("mention_id").alias("f"))
    return g.orderBy(F.desc("n"), "f").limit(20).select("statute_id", "n")


@query("tk05_worst_documents", f"SELECT doc_id, q FROM ({QUALITY_SQL}) ORDER BY q, doc_id LIMIT 10")
def tk05(spark, d):
    return load(spark, d, "documents").select("doc_id", T.quality("text").alias("q")).orderBy("q", "doc_id").limit(10)


@query("tk06_stratified_sample", """SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR || '|11'), doc_id) AS k FROM documents) WHERE k <= 5""")
def tk06(spark, d):
    """Five documents of each source, drawn by a seeded hash."""
    w = Window.partitionBy("source").orderBy(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("|11"))), "doc_id")
    return load(spark, d, "documents").select("source", "doc_id").withColumn("k", F.row_number().over(w)).filter("k <= 5").select("source", "doc_id")


@query("st02_ordered_distinct", """WITH t AS (SELECT DISTINCT id, text FROM chunks WHERE text IS NOT NULL), w AS (SELECT id, text, unnest(regexp_extract_all(text, '\\b((?:19|20)[0-9]{2} [A-Z]{2,4} [0-9]+)\\b', 1)) AS c, generate_subscripts(regexp_extract_all(text, '\\b((?:19|20)[0-9]{2} [A-Z]{2,4} [0-9]+)\\b', 1), 1) AS i FROM t),
    f AS (SELECT id, text, c, min(i) AS i FROM w GROUP BY id, text, c) SELECT id, list(c ORDER BY i) AS cited FROM f GROUP BY id, text""")
def st02(spark, d):
    c = load(spark, d, "chunks").filter("text IS NOT NULL").select("id", "text").distinct()
    return c.select("id", F.array_distinct(T.citations("text")).alias("cited")).filter("size(cited) > 0")


@query("st03_shared_blocks", """SELECT DISTINCT a.id, len(list_intersect(a.block_ids, b.block_ids)) AS shared FROM chunks a JOIN chunks b ON a.document_id = b.document_id AND b.chunk_order = a.chunk_order + 1""")
def st03(spark, d):
    c = load(spark, d, "chunks").select("id", "document_id", "chunk_order", "block_ids").distinct()
    b = c.select("document_id", (F.col("chunk_order") - 1).alias("chunk_order"), F.col("block_ids").alias("nxt"))
    return c.join(b, ["document_id", "chunk_order"]).select("id", F.size(F.array_intersect("block_ids", "nxt")).cast("bigint").alias("shared")).distinct()


@query("st04_bag_union", "SELECT citation, count(*) AS n FROM (SELECT citation_a AS citation FROM cite_pairs UNION ALL SELECT citation_b FROM cite_pairs UNION ALL SELECT citation FROM chunks) GROUP BY citation")
def st04(spark, d):
    p = load(spark, d, "cite_pairs")
    u = p.select(F.col("citation_a").alias("citation")).unionByName(p.select(F.col("citation_b").alias("citation"))).unionByName(load(spark, d, "chunks").select("citation"))
    return u.groupBy("citation").agg(F.count("*").alias("n"))


@query("st05_evidence", "SELECT document_id, statute_id, list_sort(list(DISTINCT mention_id)) AS evidence FROM provision_mentions WHERE statute_id IS NOT NULL GROUP BY document_id, statute_id")
def st05(spark, d):
    return load(spark, d, "provision_mentions").filter("statute_id IS NOT NULL").groupBy("document_id", "statute_id").agg(F.sort_array(F.collect_set("mention_id")).alias("evidence"))


@query("ud13_search_output", _FUSED + " SELECT h.query_id, h.rank, h.id, c.citation, c.page_start, c.page_end, substr(c.text, 1, 220) AS quote FROM h JOIN (SELECT id, min(citation) AS citation, min(page_start) AS page_start, max(page_end) AS page_end, min(text) AS text FROM chunks GROUP BY id) c ON c.id = h.id WHERE h.rank <= 10")
def ud13(spark, d):
    """The least of texts begins with the least of their beginnings, so the beginnings of the hits' texts are enough."""
    hits = materialise(fused(spark, d), "fused", n=F.count(F.lit(1)))
    c = load(spark, d, "chunks").select("id", "citation", "page_start", "page_end", F.substring("text", 1, 220).alias("quote"))
    c = c.join(broadcast_if_small(hits.select("id").distinct(), hits.counts["n"]), "id", "left_semi")
    c = c.groupBy("id").agg(F.min("citation").alias("citation"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.min("quote").alias("quote"))
    return hits.join(c, "id").select("query_id", "rank", "id", "citation", "page_start", "page_end", "quote")
