"""Amendment notes of statutes, the events of a section, and where a section stood when a judgment was decided."""

from __future__ import annotations

from datetime import date

import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.legal.cases import full_year

# Kinds of amendment and their cues; how near to a section's start its own marker stands.
KIND_CUES = [("substituted", r"\bsubs(?:tituted)?\b"), ("inserted", r"\bins(?:erted)?\b"), ("added", r"\badded\b"), ("omitted", r"\bomitted\b|\bdeleted\b"), ("repealed", r"\brep(?:ealed)?\b\.?"), ("renumbered", r"\bre-?numbered\b")]
WHOLE = 6
_NOTE = regex.compile(r"(?:(?<=^)|(?<=[\s.;)\]]))([1-9l]\d?)\s?(?=[A-Z“\"'])")
_INSTRUMENT = regex.compile(r"\bby\s+(.+?)(?:,\s*ss?\.\s*[\d\-]+.*)?$", regex.I)
_YEARS = [regex.compile(r"\b(?:[IVXLC]+|\d{1,3})\b(?:\s*\([^)]{0,30}\))?\s+of\s+((?:18|19|20)\d{2}|\d{2})\b", regex.I), regex.compile(r"\b(?:Act|Ordinance|Order|A\.\s?O\.)\s*,?\s*((?:18|19|20)\d{2})\b", regex.I)]
_EFFECT = regex.compile(r"w\.?\s?e\.?\s?f\.?\s*(?:the\s+)?(\d{1,2})(?:st|nd|rd|th)?(?:\s+day\s+of)?[\s./-]+(\d{1,2}|[A-Za-z]+)[\s.,/-]+(\d{2,4})", regex.I)
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def split_notes(text: str) -> dict[str, str]:
    """The numbered notes of a page's footnotes; a number glued to a capital opens one; the first of a number counts."""
    text = " ".join(text.split())
    marks = list(_NOTE.finditer(text))
    notes: dict[str, str] = {}
    for m, until in zip(marks, [*[n.start() for n in marks[1:]], len(text)]):
        notes.setdefault(m[1].replace("l", "1"), text[m.end(1) : until].strip())
    return notes


def effective_date(note: str) -> str | None:
    if not (m := _EFFECT.search(note)):
        return None
    month = int(m[2]) if m[2].isdigit() else next((i for i, name in enumerate(_MONTHS, 1) if m[2].lower()[:3] == name), 0)
    try:
        return date(full_year(m[3]), month, int(m[1])).isoformat()
    except ValueError:
        return None


def read_notes(text: str) -> dict[str, dict]:
    """Number to kinds, instrument, year, effective and note of each amendment note; 'ibid' takes the instrument before it."""
    out: dict[str, dict] = {}
    last: dict | None = None
    for number, note in split_notes(text).items():
        named = _INSTRUMENT.search(note)
        year = next((m for m in (p.search(note) for p in _YEARS) if m), None)
        event = {"kinds": [k for k, cue in KIND_CUES if regex.search(cue, note, regex.I)], "instrument": named[1].strip(" .") if named else None, "year": full_year(year[1]) if year else None, "effective": effective_date(note), "note": note[:300]}
        if last and regex.search(r"\bibid\b", note, regex.I):
            event |= {k: last[k] for k in ("instrument", "year")}
        if event["kinds"]:
            out[number] = last = event
    return out


EVENTS = "array<struct<number:string,kinds:array<string>,instrument:string,year:int,effective:string,note:string>>"


def _notes_of(texts):
    return texts.map(lambda t: [{"number": n} | e for n, e in read_notes(t or "").items()])


def note_events(footnotes: DataFrame) -> DataFrame:
    """document_id, page, number, kinds, instrument, year, effective, note. footnotes: document_id, page, ord, text; the blocks of a
    page are read as one text, since numbers restart on every page."""
    whole = footnotes.groupBy("document_id", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), " ").alias("t"))
    return whole.select("document_id", "page", F.explode(F.pandas_udf(_notes_of, EVENTS)("t")).alias("e")).select("document_id", "page", "e.*")


def section_events(blocks: DataFrame, events: DataFrame) -> DataFrame:
    """document_id, section, page, marker, kinds, instrument, year, effective, whole_section: the notes marked in a section.

    blocks: document_id, section, page, ord, text, the section's blocks in order. A marker 'N[' meets the note of its number on its
    own page; a marker glued to the printed section number does too; a note marked several times counts once. An event at the
    section's start changes it whole.
    """
    w = Window.partitionBy("document_id", "section").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("before", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0)))
    marks = F.regexp_extract_all("text", F.lit(r"(?<![\w\d])(\d{1,2})\s?\["), F.lit(1))
    spread = placed.select("document_id", "section", "page", "ord", "before", "text", F.posexplode(marks).alias("k", "marker"))
    # the place of the k-th marker: what stands before it
    head = F.expr(r"regexp_extract(text, concat('^((?s:.*?(?<![\\w\\d])[0-9]{1,2}\\s?\\[){', k, '}(?s:.*?))(?<![\\w\\d])[0-9]{1,2}\\s?\\['), 1)")
    printed = spread.select("document_id", "section", "page", "marker", (F.col("before") + F.length(head) <= WHOLE).alias("whole_section"), "ord", "k")
    first = placed.filter(F.col("before") == 0)
    own = F.expr(r"regexp_extract(text, concat('^([0-9]{1,2}?)', section, '\\.'), 1)")
    glued = first.withColumn("marker", own).filter("marker != ''").select("document_id", "section", "page", "marker", F.lit(True).alias("whole_section"), F.lit(1 << 30).alias("ord"), F.lit(0).alias("k"))
    met = printed.unionByName(glued).join(events.withColumnRenamed("number", "marker"), ["document_id", "page", "marker"])
    one = met.withColumn("_n", F.row_number().over(Window.partitionBy("document_id", "section", "page", "marker").orderBy("ord", "k"))).filter("_n = 1")
    return one.select("document_id", "section", "page", "marker", "kinds", "instrument", "year", "effective", "whole_section")


def version_status(events: Column, repealed: Column, decided: Column) -> Column:
    """Of an array of events (kinds, year, whole_section): repealed, decision_year_unknown, not_yet_in_force, replaced_since,
    amended_since, undated_change or current_text_applies, in that order."""
    after = F.filter(events, lambda e: e["year"] > decided)
    only_new = lambda e: e["whole_section"] & (F.size(e["kinds"]) > 0) & F.forall(e["kinds"], lambda k: k.isin("inserted", "added"))
    replaced = lambda e: e["whole_section"] & F.exists(e["kinds"], lambda k: k.isin("substituted", "omitted"))
    return (
        F.when(repealed, "repealed").when(decided.isNull(), "decision_year_unknown").when(F.exists(after, only_new), "not_yet_in_force").when(F.exists(after, replaced), "replaced_since")
        .when(F.size(after) > 0, "amended_since").when(F.exists(events, lambda e: e["year"].isNull()), "undated_change").otherwise("current_text_applies")
    )


def concern_versions(concerns: DataFrame, judgments: DataFrame, sections: DataFrame) -> DataFrame:
    """judgment_id, statute_id, kind, section, decided, version_status. concerns: judgment_id, statute_id, kind, section; judgments:
    judgment_id, decided; sections: statute_id, section, repealed, events. Only sections and articles are looked up."""
    known = sections.select("statute_id", "section", "repealed", "events", F.lit(True).alias("_held"))
    j = concerns.join(judgments.select("judgment_id", "decided"), "judgment_id", "left").join(known, ["statute_id", "section"], "left")
    held = F.coalesce("_held", F.lit(False)) & F.col("kind").isin("section", "article")
    state = F.when(held, version_status(F.col("events"), F.col("repealed"), F.col("decided"))).otherwise("section_not_indexed")
    return j.select("judgment_id", "statute_id", "kind", "section", "decided", state.alias("version_status"))
