"""Splitting oversized texts at natural boundaries by pointer doubling (problem 3).

Every legal cut of a text is a boundary; its successor is the farthest boundary at which the piece that starts `overlap`
before it may end. Squaring the successor table (1, 2, 4... cuts at once) yields all greedy cuts of all texts in
log2(pieces) joins on (text, position), whatever the length of a text; no key of these joins is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.slicing import sliced
from lexloom.session import discard, materialise
from lexloom.tables import load

LIMIT, OVERLAP = 2048, 256

# A natural boundary lies behind a line break, or behind the blanks that follow a sentence end (with closing quotes or brackets).
NATURAL = r"(?<=\n)(?!\n)|(?<=[.!?۔؟;][\"'”’)\]]{0,2}[ \t]{1,4})(?![ \t])|(?<=[۔؟])(?![ \t۔؟])"
WORD = r"(?<=\s)(?!\s)"


def _segments(texts: DataFrame, pattern: str, kind: int) -> DataFrame:
    """_key, pos (end of a segment, in code points), kind for every cut of `pattern`."""
    part = texts.select("_key", F.posexplode(F.split("text", pattern)).alias("_i", "_s"))
    up_to = Window.partitionBy("_key").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    return part.select("_key", F.sum(F.length("_s")).over(up_to).cast("int").alias("pos"), F.lit(kind).alias("kind"))


def _with_hard_cuts(bounds: DataFrame, step: int) -> DataFrame:
    """Boundaries plus, in every stretch longer than `step` without one, a hard cut each `step` characters."""
    nxt = F.lead("pos").over(Window.partitionBy("_key").orderBy("pos"))
    gaps = bounds.withColumn("_next", nxt).filter(F.col("_next") - F.col("pos") > step)
    hard = gaps.select("_key", F.explode(F.sequence(F.col("pos") + step, F.col("_next") - 1, F.lit(step))).alias("pos"), F.lit(3).alias("kind"))
    return bounds.unionByName(hard)


def boundaries(texts: DataFrame, limit: int, overlap: int) -> DataFrame:
    """_key, pos, kind: 1 natural (and the text's end), 2 word, 3 hard. A virtual boundary at `overlap` starts the first piece at 0.

    Word boundaries are added only inside stretches that hold no natural boundary within one step, hard cuts only where
    there is no word boundary either.
    """
    step = limit - overlap
    start = texts.select("_key", F.lit(overlap).alias("pos"), F.lit(1).alias("kind"))
    natural = _segments(texts, NATURAL, 1).filter(F.col("pos") > overlap).unionByName(start).dropDuplicates(["_key", "pos"])
    nxt = F.lead("pos").over(Window.partitionBy("_key").orderBy("pos"))
    bare = natural.withColumn("_next", nxt).filter(F.col("_next") - F.col("pos") > step).select("_key", F.col("pos").alias("_from"), "_next")
    long_texts = texts.join(bare.select("_key").distinct(), "_key", "left_semi")
    words = _segments(long_texts, WORD, 2)
    inside = words.join(bare, "_key").filter((F.col("pos") > F.col("_from")) & (F.col("pos") < F.col("_next"))).select("_key", "pos", "kind")
    return _with_hard_cuts(natural.unionByName(inside), step)


def successors(bounds: DataFrame, limit: int, overlap: int) -> DataFrame:
    """_key, pos, nxt: the farthest natural boundary in reach, else the farthest word boundary, else the hard cut; null at the end."""
    step = limit - overlap
    reach = Window.partitionBy("_key").orderBy("pos").rangeBetween(1, step)
    at = lambda k: F.max(F.when(F.col("kind") == k, F.col("pos"))).over(reach)
    return bounds.select("_key", "pos", F.coalesce(at(1), at(2), at(3)).alias("nxt"))


def greedy_cuts(successor: DataFrame, start: int) -> DataFrame:
    """_key, cut, step_no: the cuts reached from `start`, by doubling: step_no 0 is the start itself."""
    jump = materialise(successor.filter(F.col("nxt").isNotNull()), "jump1")
    reached = materialise(successor.filter(F.col("pos") == start).select("_key", F.col("pos").alias("cut"), F.lit(0).alias("step_no")), "cuts0")
    width = 1
    while True:
        ahead = reached.join(jump, (reached["_key"] == jump["_key"]) & (reached["cut"] == jump["pos"])).select(
            reached["_key"], jump["nxt"].alias("cut"), (F.col("step_no") + width).alias("step_no")
        )
        grown = materialise(reached.unionByName(ahead), f"cuts{width}")
        far = jump.alias("a").join(jump.alias("b"), F.expr("a._key = b._key AND a.nxt = b.pos")).select("a._key", "a.pos", "b.nxt")
        doubled = materialise(far, f"jump{2 * width}")
        discard(reached, jump)
        reached, jump, width = grown, doubled, 2 * width
        if jump.isEmpty():
            return reached


def split_texts(df: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """id, piece_no, char_start, char_end, text: the pieces of every text of df (id, text) longer than `limit` code points.

    Pieces are at most `limit` long, cover the text without a gap, and share exactly `overlap` characters with the next.
    A piece ends at the farthest line or sentence end in reach, where there is none at a word's end, else at the limit.
    Offsets count code points of text. Null and empty texts and texts within the limit give no piece; repeated rows
    (equal id and text) count once; rows equal in id only are split apart, each with its own piece numbers. A null id is
    kept. Other columns of df, whatever their names, are not read.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be from 0 to limit - 1")
    texts = df.select("id", "text").filter(F.length("text") > limit).distinct().withColumn("_key", F.sha1(F.concat_ws("\u0001", F.coalesce("id", F.lit("\u0002")), "text")))
    texts = materialise(texts, "oversized")
    cuts = greedy_cuts(successors(boundaries(texts, limit, overlap), limit, overlap), overlap)
    before = F.lag("cut").over(Window.partitionBy("_key").orderBy("step_no"))
    spans = cuts.withColumn("char_start", (before - overlap).cast("int")).filter(F.col("step_no") > 0)
    of = spans.groupBy("_key").agg(F.collect_list(F.struct("char_start", F.col("cut").alias("char_end"), (F.col("step_no") - 1).alias("piece_no"))).alias("spans"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, numbers, starts, ends, pieces in sliced(batches):
            made = {"id": ids, "piece_no": pa.array(numbers, pa.int32()), "char_start": pa.array(starts, pa.int32()), "char_end": pa.array(ends, pa.int32()), "text": pa.array(pieces, pa.string())}
            yield pa.RecordBatch.from_pydict(made)

    # the cuts of a text are as many as its length warrants: each text is sliced once
    return texts.join(of, "_key").select("id", "text", "spans").mapInArrow(run, f"id {kind}, piece_no int, char_start int, char_end int, text string")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(load(spark, d, "chunks")).select("id").distinct()


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(load(spark, d, "chunks"))


QUERIES = {"p3_found": p3_found, "p3_pieces": p3_pieces}

# Every position of every oversized text with the last natural and the last word boundary up to it; then one cut after another.
_PIECES = r"""
    WITH RECURSIVE t AS (SELECT DISTINCT id, text, length(text) AS n FROM chunks WHERE length(text) > 2048),
    k AS (SELECT row_number() OVER () AS k, * FROM t),
    p AS (SELECT k, n, unnest(range(1, n + 1)) AS p, unnest(list_transform(range(1, n + 1), lambda i: substr(text, greatest(1, i - 6), least(i, 7)))) AS b, unnest(string_split(substr(text, 2) || chr(1), '')) AS c FROM k),
    m AS (SELECT k, p, p = n OR (right(b, 1) = chr(10) AND c <> chr(10)) OR (regexp_matches(b, '[.!?۔؟;]["''”’)\]]{0,2}[ \t]{1,4}$') AND c NOT IN (' ', chr(9))) OR (right(b, 1) IN ('۔', '؟') AND c NOT IN (' ', chr(9), '۔', '؟')) AS nat,
      regexp_matches(right(b, 1), '[ \t\n\x0B\f\r]') AND NOT regexp_matches(c, '[ \t\n\x0B\f\r]') AS word FROM p),
    r AS (SELECT k, p, max(CASE WHEN nat THEN p END) OVER w AS nat, max(CASE WHEN word THEN p END) OVER w AS word FROM m WINDOW w AS (PARTITION BY k ORDER BY p)),
    g AS (SELECT k, 0 AS no, 0 AS a, coalesce(CASE WHEN r.nat > 256 THEN r.nat END, CASE WHEN r.word > 256 THEN r.word END, 2048) AS z FROM k JOIN r USING (k) WHERE r.p = 2048
      UNION ALL SELECT g.k, no + 1, z - 256, CASE WHEN n <= z + 1792 THEN n ELSE coalesce(CASE WHEN r.nat > z THEN r.nat END, CASE WHEN r.word > z THEN r.word END, z + 1792) END
      FROM g JOIN k ON g.k = k.k JOIN r ON r.k = g.k AND r.p = least(z + 1792, n) WHERE z < n)
    SELECT id, no::INT AS piece_no, a::INT AS char_start, z::INT AS char_end, substr(text, a + 1, z - a) AS text FROM g JOIN k USING (k)"""

SQL = {"p3_found": "SELECT DISTINCT id FROM chunks WHERE length(text) > 2048", "p3_pieces": _PIECES}
