"""Flattened documents with an offset map, and joins of spans to what they overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def flatten(paras: DataFrame) -> DataFrame:
    """document_id, para_id, char_start, char_end: each paragraph's half-open interval in the paragraphs joined by one blank.

    Paragraphs go by page, then by their number; blank ones are left out; repeated rows count once.
    """
    rows = paras.select("document_id", "para_id", "page", F.trim("text").alias("t")).filter("t != ''").distinct()
    order = F.regexp_extract("para_id", "_b([0-9]+)", 1).cast("int")
    w = Window.partitionBy("document_id").orderBy("page", "no", "para_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("no", order).withColumn("char_start", F.coalesce(F.sum(F.length("t") + 1).over(w), F.lit(0)))
    return rows.select("document_id", "para_id", "char_start", (F.col("char_start") + F.length("t")).alias("char_end"))


def spans_to_blocks(spans: DataFrame, blocks: DataFrame, cell: int = 4096) -> DataFrame:
    """id, page_first, page_last, block_ids (in order of their start) for each span: the blocks with start < end and end > start.

    spans: id, document_id, char_start, char_end; blocks: document_id, char_start, char_end, block_id, page. A range join made
    an equi-join: both sides are cut into cells of `cell` characters of a document, a pair counts in the first cell both touch.
    Empty or null spans give null pages and no block.
    """
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / cell), F.floor((b - 1) / cell)))
    s = spans.filter("char_end > char_start").select("id", "document_id", F.col("char_start").alias("s0"), F.col("char_end").alias("s1"))
    s = s.withColumn("cell", cells(F.col("s0"), F.col("s1")))
    b = blocks.filter("char_end > char_start").select("document_id", "block_id", "page", F.col("char_start").alias("b0"), F.col("char_end").alias("b1"))
    b = b.withColumn("cell", cells(F.col("b0"), F.col("b1")))
    met = s.join(b, ["document_id", "cell"]).filter((F.col("b0") < F.col("s1")) & (F.col("b1") > F.col("s0")))
    met = met.filter(F.col("cell") == F.greatest(F.floor(F.col("s0") / cell), F.floor(F.col("b0") / cell)))
    found = met.groupBy("id", "document_id").agg(
        F.min("page").alias("page_first"), F.max("page").alias("page_last"), F.transform(F.sort_array(F.collect_list(F.struct("b0", "block_id"))), lambda x: x["block_id"]).alias("block_ids")
    )
    return spans.select("id", "document_id").distinct().join(found, ["id", "document_id"], "left").withColumn("block_ids", F.coalesce("block_ids", F.array().cast("array<string>")))


def title_runs(statutes: DataFrame) -> DataFrame:
    """statute_id, title, act_year, needle: every contiguous run of words of a statute's haystacks, as one string.

    It turns 'the name is a contiguous run of a title' from a theta join into an equi-join; a title has a dozen words at most.
    """
    words = statutes.select("statute_id", "title", "act_year", F.explode("haystacks").alias("h")).filter("size(h) BETWEEN 1 AND 40")
    starts = words.select("*", F.explode(F.sequence(F.lit(1), F.size("h"))).alias("i"))
    runs = starts.select("*", F.explode(F.sequence(F.lit(1), F.size("h") - F.col("i") + 1)).alias("n"))
    return runs.select("statute_id", "title", "act_year", F.array_join(F.slice("h", F.col("i"), F.col("n")), " ").alias("needle")).distinct()


def link_titles(names: DataFrame, statutes: DataFrame) -> DataFrame:
    """name, statute_id: the held statute a printed name stands for. names: name, needle (its words), year (or null).

    A stated year must equal the title's or the title have none; of several the shortest title, then the smallest id.
    """
    met = names.join(title_runs(statutes), "needle").filter(F.col("year").isNull() | F.col("act_year").isNull() | (F.col("year") == F.col("act_year")))
    return met.groupBy("name").agg(F.min(F.struct(F.length("title").alias("l"), "statute_id"))["statute_id"].alias("statute_id"))
