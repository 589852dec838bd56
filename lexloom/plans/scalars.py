"""Queries of the scalar functions and predicates over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions.kinds import kind, kind_sql
from lexloom.tables import load

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


@query("fn01_tokens", "SELECT id, chunk_order, len(t) AS n_tokens, t[1] AS first_token FROM (SELECT DISTINCT id, chunk_order, list_transform(regexp_extract_all(text, '([A-Za-z]+|[0-9]+[A-Za-z]*)', 1), lambda x: lower(x)) AS t FROM chunks WHERE text IS NOT NULL)")
def fn01(spark, d):
    df = load(spark, d, "chunks").filter("text IS NOT NULL").select("id", "chunk_order", T.tokens("text").alias("t")).distinct()
    return df.select("id", "chunk_order", F.size("t").cast("bigint").alias("n_tokens"), F.try_element_at("t", F.lit(1)).alias("first_token"))


@query("fn02_approximate_tokens", "SELECT doc_id, (floor(length(text) / 4) + 1)::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def fn02(spark, d):
    return load(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", T.approximate_tokens("text").alias("n"))


@query("prj04_indexed_text", "SELECT id, CASE WHEN trim(prefix) <> '' THEN trim(trim(prefix) || chr(10) || chr(10) || text) ELSE text END AS indexed FROM chunks")
def prj04(spark, d):
    return load(spark, d, "chunks").select("id", T.indexed_text("prefix", "text").alias("indexed"))


@query("prj18_judgment_window", "SELECT document_id, right(text, least(14000, greatest(3000, floor(length(text) * 0.3)::INT))) AS closing FROM doc_text WHERE text IS NOT NULL")
def prj18(spark, d):
    return load(spark, d, "doc_text").filter("text IS NOT NULL").select("document_id", T.closing_window("text", 0.3, 3000, 14000).alias("closing"))


_AR = "[\\x{0600}-\\x{06FF}\\x{0750}-\\x{077F}\\x{FB50}-\\x{FDFF}\\x{FE70}-\\x{FEFC}]"


@query("prj10_script_direction", f"""SELECT document_id, para_id, CASE WHEN a AND NOT l THEN 'Arab' WHEN l AND NOT a THEN 'Latn' ELSE 'Zyyy' END AS script,
    CASE WHEN a AND l THEN 'mixed' WHEN a THEN 'rtl' ELSE 'ltr' END AS direction
    FROM (SELECT document_id, para_id, regexp_matches(text, '{_AR}') AS a, regexp_matches(text, '[A-Za-z]') AS l FROM paras WHERE text IS NOT NULL)""")
def prj10(spark, d):
    return load(spark, d, "paras").filter("text IS NOT NULL").select("document_id", "para_id", T.script_of("text").alias("s")).select("document_id", "para_id", "s.script", "s.direction")


@query("prj08_sensitivity", "SELECT document_id, list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in T.SENSITIVE.items()) + "], lambda x: x IS NOT NULL) AS found FROM doc_text WHERE text IS NOT NULL")
def prj08(spark, d):
    return load(spark, d, "doc_text").filter("text IS NOT NULL").select("document_id", T.sensitivity("text").alias("found"))


@query("prj17_page_number", "SELECT document_id, para_id FROM paras WHERE regexp_matches(text, '^\\s*[-–—]?\\s*[0-9]+\\s*[-–—]?\\s*$')")
def prj17(spark, d):
    return load(spark, d, "paras").filter(T.page_number_only("text")).select("document_id", "para_id")


@query("prj16_distinctive_title", f"""SELECT statute_id, len(list_filter(regexp_extract_all(lower(title), '([a-z]{{3,}})', 1), lambda w: w NOT IN ({_quoted(T.STOCK_TITLE)}) AND NOT regexp_matches(w, '^[ivxlc]+$'))) > 0 AS distinctive
    FROM statute_index WHERE title IS NOT NULL""")
def prj16(spark, d):
    return load(spark, d, "statute_index").filter("title IS NOT NULL").select("statute_id", T.distinctive_title("title").alias("distinctive"))


@query("fn28_instrument_kind", """SELECT statute_id, CASE WHEN regexp_matches(lower(title), '^(the )?code\\b') THEN 'code'
    ELSE regexp_extract_all(lower(title), '\\b(act|ordinance|code|rules|regulation|order)\\b', 1)[-1] END AS kind FROM statute_index WHERE title IS NOT NULL""")
def fn28(spark, d):
    return load(spark, d, "statute_index").filter("title IS NOT NULL").select("statute_id", T.instrument_kind("title").alias("kind"))


_party = "lower(replace(petitioner, chr(65533), ' '))"
for _n in (
    "\\b(and|&)\\s+(\\d+|one|two|three|four|five|six|seven|eight|nine|ten|another|others?)\\b(\\s+others?)?", "\\betc\\b\\.?", "\\bthrough\\b.*$", "\\bthr\\b\\.?.*$",
    "\\(since\\s+dec(ease)?d\\)", "\\blrs\\b\\.?", "\\bm/s\\b\\.?", "\\bmessrs\\b\\.?", "\\bmst\\b\\.?", "\\bmr\\b\\.?", "\\bsyed\\b", "\\bch\\b\\.?", "^\\s*the\\s+", "\\b(pvt|private|ltd|limited)\\b\\.?",
    "[^a-z ]+",
):
    _party = f"regexp_replace({_party}, '{_n}', ' ', 'g')"
_party = f"""array_to_string(list_filter(string_split_regex({_party}, ' +'), lambda w: w <> '' AND w NOT IN
    ('and', 'of', 'the', 'through', 'thr', 'v', 'vs', 'versus', 'others', 'another', 'etc', 'in', 'for')), ' ')"""


@query("fn17_party_key", f"SELECT candidate_id, {_party} AS party FROM candidates WHERE petitioner IS NOT NULL")
def fn17(spark, d):
    return load(spark, d, "candidates").filter("petitioner IS NOT NULL").select("candidate_id", T.party_key("petitioner").alias("party"))


@query("prj15_generic_party", """SELECT c.candidate_id, coalesce(bool_or(p = g.phrase OR starts_with(p, g.phrase || ' ')), false) OR length(p) < 4 AS generic
    FROM (SELECT DISTINCT candidate_id, regexp_replace(trim(lower(respondent)), '^the ', '') AS p FROM candidates WHERE respondent IS NOT NULL) c CROSS JOIN generic_parties g GROUP BY c.candidate_id, p""")
def prj15(spark, d):
    heads = [r.phrase for r in load(spark, d, "generic_parties").collect()]  # a fixed table of a dozen phrases
    p = F.regexp_replace(F.trim(F.lower("respondent")), "^the ", "")
    test = F.lit(False)
    for h in heads:
        test = test | (p == h) | p.startswith(h + " ")
    rows = load(spark, d, "candidates").filter("respondent IS NOT NULL").select("candidate_id", p.alias("p"), (test | (F.length(p) < 4)).alias("generic"))
    return rows.distinct().select("candidate_id", "generic")


@query("fn07_act_short", """SELECT statute_id, array_to_string(list_transform(list_filter(regexp_extract_all(upper(regexp_replace(title, '^(?i)the ', '')), '([A-Z]{3,})', 1), lambda w: w NOT IN ('THE', 'AND')), lambda w: w[1]), '') AS short_form
    FROM statute_index WHERE title IS NOT NULL""")
def fn07(spark, d):
    return load(spark, d, "statute_index").filter("title IS NOT NULL").select("statute_id", T.act_short("title").alias("short_form"))


@query("fn13_citations", "SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '\\b((?:19|20)[0-9]{2} [A-Z]{2,4} [0-9]+)\\b', 1))) AS citation FROM documents WHERE text IS NOT NULL")
def fn13(spark, d):
    return load(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.explode(F.array_distinct(T.citations("text"))).alias("citation"))


@query("fn22_decision_dates", """SELECT doc_id, decision_date AS printed, strftime(coalesce(
    CASE WHEN regexp_matches(trim(decision_date), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN try_strptime(trim(decision_date), '%Y-%m-%d') END,
    CASE WHEN regexp_matches(trim(decision_date), '^[0-9]{1,2}\\.[0-9]{1,2}\\.[0-9]{4}$') THEN try_strptime(trim(decision_date), '%d.%m.%Y') END,
    CASE WHEN regexp_matches(trim(decision_date), '^[0-9]{1,2} [A-Z][a-z]+ [0-9]{4}$') THEN try_strptime(trim(decision_date), '%d %B %Y') END,
    CASE WHEN regexp_matches(trim(decision_date), '^[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}$') THEN try_strptime(trim(decision_date), '%B %d, %Y') END), '%Y-%m-%d') AS iso
    FROM documents WHERE decision_date IS NOT NULL""")
def fn22(spark, d):
    return load(spark, d, "documents").filter("decision_date IS NOT NULL").select("doc_id", F.col("decision_date").alias("printed"), T.to_iso("decision_date").alias("iso"))


@query("fn40_document_kind", kind_sql("documents", "doc_id"))
def fn40(spark, d):
    rows = load(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", kind(F.col("text")).alias("c"))
    return rows.select("doc_id", "c.kind", F.round("c.confidence", 4).alias("confidence"))


def _ladder(col, pairs, default) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({col}, '{p}') THEN '{k}'" for k, p in pairs) + (f" ELSE '{default}'" if default else "") + " END"


@query("fn30_sentence_role", f"SELECT DISTINCT mention_id, {_ladder('lower(sentence)', T.ROLES, 'mention')} AS role FROM provision_mentions WHERE sentence IS NOT NULL")
def fn30(spark, d):
    return load(spark, d, "provision_mentions").filter("sentence IS NOT NULL").select("mention_id", T.role_of("sentence").alias("role")).distinct()


@query("fn33_disposition", f"""SELECT document_id, {_ladder('w', T.DISPOSALS, None)} AS outcome FROM
    (SELECT document_id, lower(right(text, least(6000, greatest(2000, floor(length(text) * 0.25)::INT)))) AS w FROM doc_text WHERE text IS NOT NULL)""")
def fn33(spark, d):
    return load(spark, d, "doc_text").filter("text IS NOT NULL").select("document_id", T.disposition("text").alias("outcome"))


_SPACE = "\\s\\x0B\\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
# doc_id, source, q: the whole quality rule over documents, loops included.
QUALITY_SQL = f"""SELECT doc_id, source, CASE WHEN coalesce(s, 0) = 0 THEN 0.0 ELSE greatest(0.0, round(0.9 - CASE WHEN l < s * 0.5 THEN 0.5 ELSE 0 END - CASE WHEN contains(text, chr(65533)) THEN 0.3 ELSE 0 END
      - CASE WHEN running OR often THEN 0.4 ELSE 0 END, 4)) END AS q
    FROM (SELECT *, len(list_filter(range(1, len(w) - 2), lambda i: w[i] = w[i + 1] AND w[i] = w[i + 2] AND w[i] = w[i + 3])) > 0 AS running,
        CASE WHEN len(w) >= 6 THEN list_max(map_values(list_aggregate(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]), 'histogram'))) >= 4 ELSE false END AS often
      FROM (SELECT doc_id, source, text, length(regexp_replace(text, '[{_SPACE}]', '', 'g')) AS s, length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS l,
          list_filter(string_split_regex(lower(text), '[{_SPACE}]+'), lambda x: x <> '') AS w FROM documents))"""


@query("fn41_text_quality", f"SELECT doc_id, q AS quality FROM ({QUALITY_SQL})")
def fn41(spark, d):
    return load(spark, d, "documents").select("doc_id", T.quality("text").alias("quality"))


@query("fn10_hash_embedding", None)
def fn10(spark, d):
    """Counts of crc32(token) mod 256, scaled to unit length."""
    words = load(spark, d, "chunks").select("id", F.explode(T.tokens("text")).alias("t"))
    sparse = words.groupBy("id", F.pmod(F.crc32(F.encode("t", "utf-8")), F.lit(256)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    norm = sparse.groupBy("id").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return sparse.join(norm, "id").select("id", "bucket", (F.col("n") / F.col("norm")).alias("weight"))


@query("fn45_box_geometry", """WITH b AS (SELECT DISTINCT document_id, page, block_id, bbox FROM segments WHERE len(bbox) = 4),
    p AS (SELECT document_id, page, min(bbox[1]) AS x0, min(bbox[2]) AS y0, max(bbox[3]) AS x1, max(bbox[4]) AS y1, sum((bbox[3] - bbox[1]) * (bbox[4] - bbox[2])) AS ink FROM b GROUP BY document_id, page)
    SELECT document_id, page, x0, y0, x1, y1, round(ink / ((x1 - x0) * (y1 - y0)), 4) AS cover FROM p WHERE x1 > x0 AND y1 > y0""")
def fn45(spark, d):
    b = load(spark, d, "segments").filter("size(bbox) = 4").select("document_id", "page", "block_id", "bbox").distinct()
    at = lambda i: F.col("bbox")[i]
    p = b.groupBy("document_id", "page").agg(F.min(at(0)).alias("x0"), F.min(at(1)).alias("y0"), F.max(at(2)).alias("x1"), F.max(at(3)).alias("y1"), F.sum(T.area(F.col("bbox"))).alias("ink"))
    whole = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return p.filter("x1 > x0 AND y1 > y0").select("document_id", "page", "x0", "y0", "x1", "y1", F.round(F.col("ink") / whole, 4).alias("cover"))


@query("fn42_case_id", """SELECT id, CASE WHEN regexp_matches(c, ' No\\. ') THEN upper(regexp_replace(split_part(c, ' No.', 1), '[^A-Za-z]', '', 'g')) || '/' || regexp_extract(c, 'No\\. ([0-9]+)', 1) || '/' || regexp_extract(c, 'of ([0-9]{4})', 1) END AS case_id
    FROM (SELECT DISTINCT id, structure['case_number'] AS c FROM chunks) WHERE c IS NOT NULL""")
def fn42(spark, d):
    rows = load(spark, d, "chunks").select("id", F.col("structure")["case_number"].alias("c")).filter("c IS NOT NULL").distinct()
    kind = F.upper(F.regexp_replace(F.substring_index("c", " No.", 1), "[^A-Za-z]", ""))
    made = F.concat_ws("/", kind, F.regexp_extract("c", r"No\. ([0-9]+)", 1), F.regexp_extract("c", "of ([0-9]{4})", 1))
    return rows.select("id", F.when(F.col("c").rlike(r" No\. "), made).alias("case_id"))


@query("fn14_decision_year", """SELECT doc_id, CASE WHEN regexp_matches(decision_date, '^[0-9]{4}') THEN substr(decision_date, 1, 4)::INT ELSE regexp_extract_all(decision_date, '([0-9]{4})', 1)[-1]::INT END AS decided
    FROM documents WHERE regexp_matches(decision_date, '[0-9]{4}')""")
def fn14(spark, d):
    last = F.try_element_at(F.regexp_extract_all("decision_date", F.lit("([0-9]{4})"), F.lit(1)), F.lit(-1))
    year = F.when(F.col("decision_date").rlike("^[0-9]{4}"), F.substring("decision_date", 1, 4)).otherwise(last).cast("int")
    return load(spark, d, "documents").filter(F.col("decision_date").rlike("[0-9]{4}")).select("doc_id", year.alias("decided"))
