"""Cutting judgments and statutes into retrievable chunks that know where they stand on the page."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.legal.acts import short_form, short_form_of_slug

# Where a judgment or a section may be cut, and the budgets.
STOPS = {
    "paragraph": r"(?:(?<=\s)|^)(\d{1,3})\.\s+(?=[A-Z“\"(])",
    "sentence": r"[.;:]\s+(?=[A-Z“\"(])",
    "subsection": r"(?:(?<=\s)|^)(?:\(\d{1,2}\)|\([a-z]{1,2}\))\s+",
}
BUDGET, CHARS_A_TOKEN = 512, 4
_STOPS = {k: regex.compile(p) for k, p in STOPS.items()}


def boundaries(text: str, kind: str) -> list[int]:
    """The offsets at which a paragraph number, a sentence end or a sub-section marker stands."""
    return [m.start() for m in _STOPS[kind].finditer(text)]


def pack(text: str, stops: list[int], budget: int = BUDGET) -> list[tuple[int, int]]:
    """Greedy pieces of at most budget tokens of four characters: each ends at the last stop in reach, else at the budget; a rest
    within the budget is one piece; blank pieces are dropped."""
    stops, out, at = sorted(set(stops)), [], 0
    reach = max(1, budget * CHARS_A_TOKEN)
    while at < len(text):
        end = len(text)
        if (end - at) // CHARS_A_TOKEN + 1 > budget:
            k = bisect.bisect_right(stops, at + reach) - 1
            end = stops[k] if k >= 0 and stops[k] > at + 1 else at + reach
        if text[at:end].strip():
            out.append((at, min(end, len(text))))
        at = end
    return out


def judgment_pieces(text: str, budget: int = BUDGET) -> list[tuple[int, int, str | None]]:
    """(start, end, paragraph number where the piece starts on one): cut at paragraph numbers, else at sentence ends."""
    numbered = {m.start(): m[1] for m in _STOPS["paragraph"].finditer(text)}
    return [(a, b, numbered.get(a)) for a, b in pack(text, list(numbered) or boundaries(text, "sentence"), budget)]


def section_pieces(text: str, budget: int = BUDGET) -> list[tuple[int, int]]:
    """(start, end): cut at sub-section markers, else at sentence ends."""
    return pack(text, boundaries(text, "subsection") or boundaries(text, "sentence"), budget)


_PIECES = "key string, piece int, char_start int, char_end int, text string, number string"


def _pieces(df: DataFrame, cut) -> DataFrame:
    """key, piece, char_start, char_end, text, number of the pieces of each text (key, text). One Arrow pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for n, (a, z, *number) in enumerate(cut(text or "")):
                    rows.append({"key": key, "piece": n, "char_start": a, "char_end": z, "text": text[a:z].strip(), "number": number[0] if number else None})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.string()), ("piece", pa.int32()), ("char_start", pa.int32()), ("char_end", pa.int32()), ("text", pa.string()), ("number", pa.string())]))

    return df.mapInArrow(run, _PIECES)


def chunk_judgments(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """id, document_id, chunk_order, text, prefix, citation, title, structure, char_start, char_end.

    docs: document_id, source, text, court, case_number, decided, neutral_citation, case_title. Prefix: court (else source),
    case number (else id) and date. Null texts give no chunk; document ids are taken as unique.
    """
    case = F.coalesce("case_number", "document_id")
    named = docs.select(
        "document_id", F.concat_ws(" — ", F.coalesce("court", "source"), case, F.when(F.col("decided") != "", F.col("decided"))).alias("prefix"), F.col("neutral_citation").alias("citation"),
        F.coalesce("case_title", case).alias("title"), case.alias("case"), F.coalesce("court", "source").alias("court"),
    )
    p = _pieces(docs.filter("text IS NOT NULL").select("document_id", "text"), lambda t: judgment_pieces(t, budget)).withColumnRenamed("key", "document_id")
    made = F.create_map(F.lit("kind"), F.lit("paragraph"), F.lit("number"), F.col("number"), F.lit("case_number"), F.col("case"), F.lit("court"), F.col("court"))
    return p.join(named, "document_id").select(F.format_string("%s#%04d", "document_id", "piece").alias("id"), "document_id", F.col("piece").alias("chunk_order"), "text", "prefix", "citation", "title", made.alias("structure"), "char_start", "char_end")


def chunk_statutes(docs: DataFrame, markers: DataFrame, budget: int = BUDGET) -> DataFrame:
    """The same columns for statutes: a section runs from its marker to the next and is cut when over the budget.

    docs: document_id, title, text; markers: document_id, at (offset), number, heading. Citation: NUMBER SHORT, or the long form.
    """
    ats = markers.filter("at >= 0").groupBy("document_id").agg(F.sort_array(F.collect_set("at")).alias("ats"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, marks in zip(*(c.to_pylist() for c in b.columns)):
                for at, until in zip(marks, [*marks[1:], len(text)]):
                    rows += [{"document_id": doc, "at": at, "piece": n, "char_start": at + x, "char_end": at + z, "piece_text": text[at + x : at + z].strip()} for n, (x, z) in enumerate(section_pieces(text[at:until], budget))]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("document_id", pa.string()), ("at", pa.int32()), ("piece", pa.int32()), ("char_start", pa.int32()), ("char_end", pa.int32()), ("piece_text", pa.string())]))

    # a text crosses to Python once, with the offsets of all its sections
    whole = docs.filter("text IS NOT NULL").select("document_id", "text").join(ats, "document_id")
    p = whole.mapInArrow(run, "document_id string, at int, piece int, char_start int, char_end int, piece_text string")
    act = F.coalesce("title", "document_id")
    short = F.coalesce(short_form(F.col("title")), short_form_of_slug(F.col("document_id")))
    own = markers.join(docs, "document_id").select("document_id", "at", "number", F.trim("heading").alias("heading"), act.alias("act"), short.alias("short"))
    order = F.row_number().over(Window.partitionBy("document_id").orderBy("at", "piece")) - 1
    prefix = F.concat(F.col("act"), F.lit(" — section "), "number", F.when(F.col("heading") != "", F.concat(F.lit(": "), "heading")).otherwise(""))
    citation = F.when(F.col("short").isNotNull(), F.concat_ws(" ", "number", "short")).otherwise(F.concat(F.lit("section "), "number", F.lit(" of "), "act"))
    made = F.create_map(F.lit("kind"), F.lit("section"), F.lit("number"), F.col("number"), F.lit("heading"), F.nullif("heading", F.lit("")))
    out = p.join(own, ["document_id", "at"]).withColumn("chunk_order", order)
    return out.select(F.format_string("%s#%04d", "document_id", "chunk_order").alias("id"), "document_id", "chunk_order", F.col("piece_text").alias("text"), prefix.alias("prefix"), citation.alias("citation"),
                      F.col("act").alias("title"), made.alias("structure"), "char_start", "char_end")
