"""Lines repeated across one source's documents (problem 4).

A state is kept that new partitions are merged into as deltas: the documents counted (with source and version), the wordings
each stands with, count deltas per (source, wording), documents per source, and the wordings now repeated. A merge
reads only what it touches: counts of the wordings that the new partition, or the earlier version of a document it replaces,
holds, and of wordings repeated before in the sources concerned. Wordings whose standing crossed the threshold (either way)
are reported, and only documents holding one are rebuilt. Parts are appended and compacted now and then; a state can be
stored and opened again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.session import broadcast_if_small, materialise
from lexloom.tables import load

SHARE, LEAST = 0.2, 5


def wording(line):
    """A line apart from case, spacing, punctuation and numbers: its letters (with their marks) in lower case."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}]+", "")


def _key(word):
    """128 bits that stand for the wording in shuffles."""
    return [F.xxhash64(word).alias("w1"), F.xxhash64(F.lit(7), word).alias("w2")]


def document_lines(paras: DataFrame, docs: DataFrame) -> DataFrame:
    """document_id, para_id, line_no, source, w1, w2: each line with letters of each distinct paragraph of a sourced document."""
    sources = docs.select("document_id", "source").filter("document_id IS NOT NULL AND source IS NOT NULL").distinct()
    lines = (
        paras.select("document_id", "para_id", F.posexplode(F.split("text", "\n")).alias("_i", "_line"))
        .select("document_id", "para_id", (F.col("_i") + 1).alias("line_no"), wording("_line").alias("_w"))
        .filter(F.col("_w").rlike(r"\p{L}"))
        .select("document_id", "para_id", "line_no", *_key(F.col("_w")))
    )
    return lines.join(sources, "document_id")


KEY = ["source", "w1", "w2"]
_WORDING = "source string, w1 bigint, w2 bigint"
TABLES = {"docs": "document_id string, source string, version int", "stands": f"document_id string, version int, {_WORDING}", "counts": f"{_WORDING}, n bigint", "totals": "source string, n bigint", "standing": _WORDING}
COMPACT = 8  # parts a table of the state may have before they are written as one


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class LineState:
    """The counted state; see `empty`, `merge`, `save`, `open`. Its tables are lists of parts (TABLES)."""

    spark: SparkSession
    share: float = SHARE
    least: int = LEAST
    version: int = 0
    parts: dict[str, list[DataFrame]] = field(default_factory=dict)
    crossed: DataFrame | None = None  # source, w1, w2, now (boolean): the crossings of the last merge

    @staticmethod
    def empty(spark: SparkSession, share: float = SHARE, least: int = LEAST) -> LineState:
        return LineState(spark, share, least)

    def table(self, name: str) -> DataFrame:
        return _union(self.parts.get(name) or [self.spark.createDataFrame([], TABLES[name])])

    def save(self, root: str) -> None:
        """Write the state, compacted, under a folder of the shared file system."""
        for name in TABLES:
            self._compacted(name, self.table(name)).write.mode("overwrite").parquet(f"{root}/{name}")
        self.spark.createDataFrame([(self.share, self.least, self.version)], "share double, least int, version int").write.mode("overwrite").parquet(f"{root}/bounds")

    @staticmethod
    def open(spark: SparkSession, root: str) -> LineState:
        r = spark.read.parquet(f"{root}/bounds").first()
        return LineState(spark, r.share, r.least, r.version, {name: [spark.read.schema(ddl).parquet(f"{root}/{name}")] for name, ddl in TABLES.items()})

    def _compacted(self, name: str, table: DataFrame) -> DataFrame:
        if name == "counts":
            return table.groupBy(*KEY).agg(F.sum("n").alias("n")).filter("n != 0")
        if name == "totals":
            return table.groupBy("source").agg(F.sum("n").alias("n"))
        if name in ("docs", "stands") and self.version > 1:
            live = self.live().select("document_id", "version").distinct()
            return table.join(live, ["document_id", "version"], "left_semi")
        return table

    def live(self) -> DataFrame:
        """document_id, source, version of the newest version of each document."""
        docs = self.table("docs")
        if self.version < 2:
            return docs
        return docs.join(docs.groupBy("document_id").agg(F.max("version").alias("version")), ["document_id", "version"])

    def merge(self, lines: DataFrame, docs: DataFrame) -> LineState:
        """The state with a new partition merged in. A document counted before is retracted and counted as it is now.

        lines: as document_lines gives them; docs: document_id, source. Null ids and sources are left out.
        """
        now = self.version + 1
        new_docs = docs.select("document_id", "source").filter("document_id IS NOT NULL AND source IS NOT NULL").distinct().withColumn("version", F.lit(now))
        new_docs = materialise(new_docs, "line-docs")
        stands = materialise(lines.select("document_id", F.lit(now).alias("version"), *KEY).distinct(), "line-stands")
        counted = stands.groupBy(*KEY).agg(F.count("*").alias("n"))
        per_source = new_docs.groupBy("source").agg(F.count("*").alias("n"))
        if self.version:
            again = materialise(self.live().join(new_docs.select("document_id").distinct(), "document_id", "left_semi"), "line-again", n=F.count(F.lit(1)))
            if again.counts["n"]:  # retract what the earlier versions of these documents stood with
                gone = self.table("stands").join(again.select("document_id", "version").distinct(), ["document_id", "version"], "left_semi")
                counted = counted.unionByName(gone.groupBy(*KEY).agg((-F.count("*")).alias("n"))).groupBy(*KEY).agg(F.sum("n").alias("n")).filter("n != 0")
                per_source = per_source.unionByName(again.groupBy("source").agg((-F.count("*")).alias("n"))).groupBy("source").agg(F.sum("n").alias("n"))
        delta, grown = materialise(counted, "line-counts"), materialise(per_source, "line-totals", shrunk=F.count_if(F.expr("n < 0")))
        made = {"docs": new_docs, "stands": stands, "counts": delta, "totals": grown}
        after = LineState(self.spark, self.share, self.least, now, {k: [*self.parts.get(k, []), v] for k, v in made.items()})
        after._cross(self, delta, grown)
        for name in ("docs", "stands", "counts", "totals"):
            if len(after.parts[name]) > COMPACT:
                after.parts[name] = [materialise(after._compacted(name, after.table(name)), f"line-{name}")]
        return after

    def _cross(self, before: LineState, delta: DataFrame, grown: DataFrame) -> None:
        """Standing and crossings after a merge, from the wordings and sources it touched."""
        counts, old = self.table("counts"), before.table("standing")
        sources = grown.select("source")  # those of one partition
        if before.version == 0:
            asked = counts
        else:
            held = old.join(sources, "source", "left_semi")
            asked = counts.join(delta.select(*KEY).unionByName(held).distinct(), KEY, "left_semi")
            if grown.counts["shrunk"]:  # a smaller source lowers the bar for all its wordings
                asked = counts.join(grown.filter("n < 0").select("source"), "source", "left_semi").unionByName(asked.join(grown.filter("n < 0").select("source"), "source", "left_anti"))
            asked = asked.groupBy(*KEY).agg(F.sum("n").alias("n"))
        totals = materialise(self.table("totals").groupBy("source").agg(F.sum("n").alias("all")), "line-sums", n=F.count(F.lit(1)))
        enough = asked.filter(F.col("n") >= self.least).join(broadcast_if_small(totals, totals.counts["n"]), "source").filter(F.col("n") >= F.col("all") * self.share).select(*KEY)
        if before.version:
            enough = enough.unionByName(old.join(sources, "source", "left_anti"))
        standing = materialise(enough, "line-standing")
        self.parts["standing"] = [standing]
        self.crossed = standing.join(old, KEY, "left_anti").withColumn("now", F.lit(True)).unionByName(old.join(standing, KEY, "left_anti").withColumn("now", F.lit(False)))

    def documents_of(self, wordings: DataFrame) -> DataFrame:
        """document_id: the documents that hold one of the wordings, as they are now."""
        hit = _probe(self.table("stands"), materialise(wordings.select(*KEY), "line-crossed"))
        return (hit.join(self.live(), ["document_id", "version", "source"]) if self.version > 1 else hit).select("document_id").distinct()

    def rebuild(self, paras: DataFrame, docs: DataFrame) -> DataFrame:
        """document_id, para_id, text: the paragraphs, without repeated lines, of just the documents that hold a wording
        that crossed in the last merge; those that lose no line (any more) come out as they are."""
        concerned = materialise(self.documents_of(self.crossed), "line-concerned", n=F.count(F.lit(1)))
        ids = broadcast_if_small(concerned, concerned.counts["n"])
        own = paras.join(ids, "document_id", "left_semi").select("document_id", "para_id", "text")
        lost = repeated_lines(document_lines(own, docs.join(ids, "document_id", "left_semi")), self)
        return _without(own, lost, "left")


SALTS = 16


def _probe(rows: DataFrame, wordings: DataFrame) -> DataFrame:
    """The rows whose wording is listed. Listed wordings are hot by nature: broadcast while few, else salted."""
    n = wordings.count()
    if n <= 200_000:
        return rows.join(F.broadcast(wordings), KEY, "left_semi")
    spread = wordings.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("document_id"), F.lit(SALTS)).cast("int")).join(spread, [*KEY, "_salt"], "left_semi").drop("_salt")


def repeated_lines(lines: DataFrame, state: LineState) -> DataFrame:
    """document_id, para_id, line_no: the lines (of document_lines) whose wording the state holds as repeated in its source."""
    return _probe(lines, state.table("standing")).select("document_id", "para_id", "line_no").distinct()


def _without(paras: DataFrame, found: DataFrame, how: str) -> DataFrame:
    drop = found.groupBy("document_id", "para_id").agg(F.collect_set("line_no").alias("_gone"))
    hit = paras.select("document_id", "para_id", "text").distinct().join(drop, ["document_id", "para_id"], how)
    kept = F.expr("filter(transform(split(text, '\\n'), (x, i) -> IF(array_contains(_gone, i + 1), NULL, x)), x -> x IS NOT NULL)")
    return hit.select("document_id", "para_id", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))


def cleaned_paragraphs(paras: DataFrame, found: DataFrame) -> DataFrame:
    """document_id, para_id, text: the paragraphs that lose a line, without their repeated lines; emptied paragraphs have text ''.

    found: document_id, para_id, line_no. Repeated rows of paras come out once.
    """
    return _without(paras, found, "inner")


PARTS = 2  # partitions a whole corpus is merged in


def _half(df: DataFrame, k: int, of: int = PARTS) -> DataFrame:
    """The rows of a document whose id's md5 falls to k."""
    return df.filter(F.pmod(F.conv(F.substring(F.md5("document_id"), 1, 4), 16, 10).cast("int"), F.lit(of)) == k)


def find_repeated_lines(paras: DataFrame, docs: DataFrame, share: float = SHARE, least: int = LEAST, parts: int = PARTS) -> DataFrame:
    """document_id, para_id, line_no: every line repeated within its source, line_no from 1.

    The corpus is merged into an empty state in `parts` partitions by document. A wording is counted once per document
    however often it stands there; all documents of the source count in the total, with or without paragraphs. Null texts
    have no lines; documents without a source or unknown to docs have no repeated lines; lines without a letter are never
    reported; repeated rows count once. Further columns are not read.
    """
    lines = materialise(document_lines(paras.select("document_id", "para_id", "text"), docs), "lines")
    state = LineState.empty(paras.sparkSession, share, least)
    for k in range(parts):
        state = state.merge(_half(lines, k, parts), _half(docs, k, parts))
    return repeated_lines(lines, state)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return find_repeated_lines(load(spark, d, "paras"), load(spark, d, "doc_text"))


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    return cleaned_paragraphs(load(spark, d, "paras"), p4_found(spark, d))


def _grown(paras: DataFrame, docs: DataFrame) -> LineState:
    """The state after the second half of the corpus (by md5 of the id) has been merged into that of the first."""
    first = LineState.empty(paras.sparkSession).merge(document_lines(_half(paras, 0), _half(docs, 0)), _half(docs, 0))
    return first.merge(document_lines(_half(paras, 1), _half(docs, 1)), _half(docs, 1))


def p4_incremental(spark: SparkSession, d: str) -> DataFrame:
    """document_id: the documents to rebuild when the second half of the corpus arrives after the first."""
    state = _grown(load(spark, d, "paras"), load(spark, d, "doc_text"))
    return state.documents_of(state.crossed)


def p4_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """The paragraphs of just these documents, rebuilt."""
    paras, docs = load(spark, d, "paras"), load(spark, d, "doc_text")
    return _grown(paras, docs).rebuild(paras, docs)


QUERIES = {"p4_found": p4_found, "p4_clean": p4_clean, "p4_incremental": p4_incremental, "p4_rebuilt": p4_rebuilt}

_FOUND = r"""
    WITH s AS (SELECT DISTINCT document_id, source FROM doc_text WHERE source IS NOT NULL AND document_id IS NOT NULL),
    l0 AS (SELECT DISTINCT document_id, para_id, text FROM paras WHERE text IS NOT NULL),
    l1 AS (SELECT document_id, para_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM l0),
    l AS (SELECT l1.*, s.source, regexp_replace(lower(line), '[^\p{L}\p{M}]+', '', 'g') AS w FROM l1 JOIN s USING (document_id)),
    t AS (SELECT source, count(*) AS n FROM s GROUP BY source),
    c AS (SELECT l.source, w FROM l JOIN t USING (source) WHERE regexp_matches(w, '\p{L}') GROUP BY l.source, w, n
          HAVING count(DISTINCT document_id) >= 5 AND count(DISTINCT document_id) >= 0.2 * n),
    f AS (SELECT DISTINCT document_id, para_id, line_no::INT AS line_no FROM l JOIN c USING (source, w))"""

_CROSSED = _FOUND.rsplit("c AS (", 1)[0] + r"""
    h AS (SELECT *, ('0x' || substr(md5(document_id), 1, 4))::INT % 2 AS half FROM s),
    t1 AS (SELECT source, count(*) AS n FROM h WHERE half = 0 GROUP BY source),
    n AS (SELECT l.source, w, count(DISTINCT document_id) AS n2, count(DISTINCT CASE WHEN half = 0 THEN document_id END) AS n1 FROM l JOIN h USING (document_id) WHERE regexp_matches(w, '\p{L}') GROUP BY l.source, w),
    x AS (SELECT n.source, w FROM n JOIN t USING (source) LEFT JOIN t1 USING (source) WHERE (n2 >= 5 AND n2 >= 0.2 * t.n) != (n1 >= 5 AND n1 >= 0.2 * coalesce(t1.n, 0))),
    c AS (SELECT l.source, w FROM l JOIN t USING (source) WHERE regexp_matches(w, '\p{L}') GROUP BY l.source, w, n
          HAVING count(DISTINCT document_id) >= 5 AND count(DISTINCT document_id) >= 0.2 * n),
    f AS (SELECT DISTINCT document_id, para_id, line_no::INT AS line_no FROM l JOIN c USING (source, w)),
    o AS (SELECT DISTINCT document_id FROM l JOIN x USING (source, w))"""
SQL = {
    "p4_found": _FOUND + " SELECT document_id, para_id, line_no FROM f",
    "p4_clean": _FOUND
    + """ SELECT l1.document_id, l1.para_id, coalesce(string_agg(CASE WHEN f.line_no IS NULL THEN line END, chr(10) ORDER BY l1.line_no), '') AS text
        FROM l1 LEFT JOIN f ON l1.document_id = f.document_id AND l1.para_id = f.para_id AND l1.line_no = f.line_no
        WHERE (l1.document_id, l1.para_id) IN (SELECT (document_id, para_id) FROM f) GROUP BY l1.document_id, l1.para_id""",
    "p4_incremental": _CROSSED + " SELECT document_id FROM o",
    "p4_rebuilt": _CROSSED
    + """ SELECT l1.document_id, l1.para_id, coalesce(string_agg(CASE WHEN f.line_no IS NULL THEN line END, chr(10) ORDER BY l1.line_no), '') AS text
        FROM l1 LEFT JOIN f ON l1.document_id = f.document_id AND l1.para_id = f.para_id AND l1.line_no = f.line_no
        WHERE l1.document_id IN (SELECT document_id FROM o) GROUP BY l1.document_id, l1.para_id
        UNION ALL SELECT DISTINCT document_id, para_id, text FROM paras WHERE text IS NULL AND document_id IN (SELECT document_id FROM o)""",
}
