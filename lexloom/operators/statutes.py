"""The structure of statutes: markers, where the body begins, numbers read by their run, bodies, missing numbers, metadata.

Blocks are rows: document_id, page, ord (over the whole document), block_id, type, text, heading (whether the block is set like one).
Markers are rows: document_id, ord, kind, number, title.
"""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.operators.pages import amendment_footnote

# How markers are printed, and where a heading ends.
SECTION = r"^\s*(?:\d{1,3}\s*\[\s*)?[*†‡§]?\s*\[?\s*(\d[\dlIO]{0,3}[A-Z]{0,2})\.\s*(.*)$"
CHAPTER = r"^\s*(?i:CHAPTER)\s+([IVXLCDMivxlcdm]+|\d+[A-Za-z]?)\b(\s*$|\s+(?![a-z])[^\n]*)$"
PART = r"(?i)^\s*PART\s+([IVXLCDM]+|\d+[A-Z]?)\b\s*(.*)$"
ORDER = r"^\s*(?:\d{1,3}\s*\[\s*)?ORDER\s+([IVXLC]+[A-Z]{0,2})\s*\]?((?:\s+[A-Z][A-Z ,.'’&()\-]*)?)\s*$"
SCHEDULE = (
    r"(?i)^\s*[_\-—–]*\s*(?:\d{1,3}\s*\[\s*)?(?:THE\s+)?(?:FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH|SEVENTH|EIGHTH|NINTH|TENTH|\d+(?:ST|ND|RD|TH)?)?\s*SCHEDULE\b"
    r"(?:\s*[-—–]?\s*(?:[IVXLCDM]+|\d+))?\s*\]?(?:\s*[\[(]\s*See[^)\]]{0,60}[\])])?\s*[_\-—–]*\s*$"
)
DEFINITIONS = r"(?i)^\s*definitions?\b|^\s*interpretation\b"
HEADING_END = r"\s*\.?\s*(?:[—–]|_{2,}|-{2,})\s*|\s*\.\s*-\s*|\.\s+(?=[A-Z(]|\d+\[)"
FURNITURE = ("header", "footer", "footnote")
ENACTING = [r"(?im)^\s*\d{0,3}\s*(?:ACT|ORDINANCE|ORDER|REGULATION)\s+No\.?\s*[IVXLCDM\d]+\s+OF\s+\d{4}", r"(?m)^\s*\[\s*\d{1,2}(?:st|nd|rd|th)?\s+\w+,?\s+\d{4}\s*\]", r"(?im)^\s*An\s+(?:Act|Ordinance|Order|Regulation)\s+(?:further\s+)?to\b", r"(?m)^\s*(?:AND\s+)?WHEREAS\b"]
NUMBER = regex.compile(r"\d{1,3}[A-Z]{0,2}")
OCR_COST, GLUED_COST, DROP_COST, BACK_COST, LONGEST_TITLE, BODY_SHARE = 0.3, 0.6, 0.9, 1.0, 200, 0.5


def heading_title(value):
    """A section's heading without the body behind it."""
    return F.btrim(F.element_at(F.split(value, HEADING_END, 2), 1), F.lit(" .—–-:"))


def markers(blocks: DataFrame) -> DataFrame:
    """document_id, ord, kind, number, title: chapters, parts, orders, schedules, sections, definitions and schedule items in order.

    A schedule begins items once a section was seen (an earlier one is announced by the contents) and lasts to the end; orders
    count inside it. Furniture holds only chapters and parts; sections must be set like headings.
    """
    line = F.regexp_extract("text", r"^\s*\n*([^\n]*)", 1)
    b = blocks.select("document_id", "ord", "type", "heading", line.alias("line")).filter("line != ''")
    own = ~F.col("type").isin(*FURNITURE)
    is_order = F.col("line").rlike(ORDER) & own
    kind = F.when(F.col("line").rlike(CHAPTER), "chapter").when(F.col("line").rlike(PART), "part").when(own & F.col("line").rlike(SCHEDULE), "schedule").when(is_order, "order").when(own & F.col("heading") & F.col("line").rlike(SECTION), "section")
    m = b.select("*", kind.alias("kind")).filter("kind IS NOT NULL")
    so_far = Window.partitionBy("document_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max((F.col("kind") == "section").cast("int")).over(so_far), F.lit(0))
    m = m.withColumn("opens", (F.col("kind") == "schedule") & (seen == 1))
    m = m.withColumn("in_schedule", F.coalesce(F.max(F.col("opens").cast("int")).over(so_far), F.lit(0)) == 1).filter("kind != 'order' OR in_schedule")
    pattern = {"chapter": CHAPTER, "part": PART, "order": ORDER, "section": SECTION}
    part = lambda i: F.coalesce(*[F.when(F.col("kind") == k, F.regexp_extract("line", p, i)) for k, p in pattern.items()])
    title = F.when(F.col("kind") == "section", F.substring(heading_title(part(2)), 1, LONGEST_TITLE)).when(F.col("kind") == "schedule", F.trim("line")).otherwise(F.trim(part(2)))
    named = m.select("document_id", "ord", "kind", "in_schedule", part(1).alias("number"), title.alias("title"))
    final = F.when((F.col("kind") == "section") & F.col("in_schedule"), "schedule_item").when((F.col("kind") == "section") & F.col("title").rlike(DEFINITIONS), "definitions").otherwise(F.col("kind"))
    return named.select("document_id", "ord", final.alias("kind"), "number", "title")


def _is_section():
    return F.col("kind").isin("section", "definitions")


def body_starts(blocks: DataFrame, marks: DataFrame) -> DataFrame:
    """document_id, start: the last block with an enacting formula that leaves at least half of the section markers behind it; -1 for none."""
    test = F.lit(False)
    for p in ENACTING:
        test = test | F.col("text").rlike(p)
    anchors = blocks.filter(test).select("document_id", "ord", F.lit(0).alias("mark"))
    both = anchors.unionByName(marks.filter(_is_section()).select("document_id", "ord", F.lit(1).alias("mark")))
    after = F.sum("mark").over(Window.partitionBy("document_id").orderBy("ord").rangeBetween(1, Window.unboundedFollowing))
    every = F.sum("mark").over(Window.partitionBy("document_id"))
    found = both.select("document_id", "ord", "mark", F.coalesce(after, F.lit(0)).alias("after"), every.alias("all")).filter((F.col("mark") == 0) & (F.col("all") > 0) & (F.col("after") >= F.col("all") * BODY_SHARE))
    return blocks.select("document_id").distinct().join(found.groupBy("document_id").agg(F.max("ord").alias("start")), "document_id", "left").select("document_id", F.coalesce("start", F.lit(-1)).alias("start"))


def without_contents(marks: DataFrame, starts: DataFrame) -> DataFrame:
    """The markers, without those before the body that the body repeats (kind and number)."""
    m = marks.join(starts, "document_id").withColumn("before", F.col("ord") <= F.col("start"))
    again = F.max((~F.col("before")).cast("int")).over(Window.partitionBy("document_id", "kind", F.coalesce("number", F.lit(""))))
    return m.withColumn("again", again).filter(~F.col("before") | (F.col("again") == 0) | (F.col("start") < 0)).select(marks.columns)


def readings(printed: str) -> dict[str, float]:
    """The numbers a printed one can stand for and what taking each costs: l is always 1; I and O may be digits; one or two digits in
    front may be a footnote's marker."""
    forms = {"": 0.0}
    for ch in printed.replace("l", "1"):
        forms = {f + x: c + (OCR_COST if x != ch else 0.0) for f, c in forms.items() for x in ({"I": "I1", "O": "O0"}.get(ch, ch))}
    out: dict[str, float] = {}
    for form, cost in forms.items():
        digits = len(regex.match(r"\d*", form)[0])
        for cut in range(min(3, digits)):
            if NUMBER.fullmatch(form[cut:]):
                price = cost + (GLUED_COST if cut else 0.0)
                out[form[cut:]] = min(price, out.get(form[cut:], price))
    return dict(sorted(out.items(), key=lambda x: x[1]))


def cheapest_run(printed: list[str]) -> list[str | None]:
    """The readings that together cost least: a reading's own cost and one for each step back in the run; a number no reading fits
    as printed may be dropped."""
    lead = lambda s: int(regex.match(r"\d+", s)[0])
    paths: list[tuple[float, int, tuple]] = [(0.0, 0, ())]
    for p in printed:
        options: list[tuple[str | None, float]] = list(readings(p).items())
        if not NUMBER.fullmatch(p.replace("l", "1")):
            options.append((None, DROP_COST))
        grown = []
        for reading, own in options:
            cost, at, path = min(((c + own + (BACK_COST if reading is not None and lead(reading) < n else 0.0), n, path) for c, n, path in paths), key=lambda x: x[0])
            grown.append((cost, at if reading is None else lead(reading), (*path, reading)))
        paths = grown
    return list(min(paths, key=lambda x: x[0])[2])


def _read_run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("ord")
    printed = g["number"].tolist()
    plain = [p.replace("l", "1") for p in printed]
    chosen = cheapest_run(printed) if printed.count("1") <= 1 else [p if NUMBER.fullmatch(p) else None for p in plain]
    return pd.DataFrame({"document_id": key[0], "ord": g["ord"], "read": chosen})


def read_numbers(marks: DataFrame) -> DataFrame:
    """The markers with their section numbers as read by the run (number_printed keeps the printed form where it differs); numbers no
    reading fits are dropped. A compendium, whose run restarts, is read number by number. One statute's run is read as a whole."""
    run = marks.filter(_is_section()).select("document_id", "ord", "number").groupBy("document_id").applyInPandas(_read_run, "document_id string, ord int, read string")
    j = marks.join(run.withColumn("_run", F.lit(True)), ["document_id", "ord"], "left").filter("_run IS NULL OR read IS NOT NULL")
    number = F.when(F.col("_run"), F.col("read")).otherwise(F.col("number"))
    return j.select("document_id", "ord", "kind", number.alias("number"), "title", F.when(F.col("_run") & (F.col("read") != F.col("number")), F.col("number")).alias("number_printed"))


def _lead(c):
    return F.nullif(F.regexp_extract(c, r"^(\d+)", 1), F.lit("")).cast("int")


def without_back_references(marks: DataFrame) -> DataFrame:
    """The markers, without a section whose number is below the greatest before it and was seen already; compendia are left alone."""
    s = _is_section()
    w = Window.partitionBy("document_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    top = F.max(F.when(s, _lead(F.col("number")))).over(w)
    nth = F.row_number().over(Window.partitionBy("document_id", s, F.coalesce("number", F.lit(""))).orderBy("ord"))
    restarts = F.sum((s & (F.col("number") == "1")).cast("int")).over(Window.partitionBy("document_id"))
    m = marks.select("*", (s & (_lead(F.col("number")) < top) & (nth > 1) & (restarts <= 1)).alias("_back"))
    return m.filter(~F.coalesce("_back", F.lit(False))).drop("_back")


def missing_numbers(marks: DataFrame) -> DataFrame:
    """document_id, highest, missing (all of them), complete (null where the run restarts or holds no number)."""
    n = marks.filter(_is_section()).select("document_id", "number", _lead(F.col("number")).alias("n")).filter("n IS NOT NULL")
    g = n.groupBy("document_id").agg(F.max("n").alias("highest"), F.collect_set("n").alias("seen"), F.count_if(F.col("number") == "1").alias("restarts"))
    gone = F.array_sort(F.array_except(F.sequence(F.lit(1), "highest"), F.col("seen")))
    one = F.col("restarts") <= 1
    return g.select("document_id", "highest", F.when(one, gone).otherwise(F.array().cast("array<int>")).alias("missing"), F.when(one, F.size(gone) == 0).alias("complete"))


def recovered_sections(blocks: DataFrame, marks: DataFrame) -> DataFrame:
    """document_id, ord, kind, number, title: a missing number that stands alone in a block before one set like a heading with a
    capital title; of several the last."""
    gone = missing_numbers(marks).select("document_id", F.explode("missing").alias("n"))
    w = Window.partitionBy("document_id").orderBy("ord")
    title = heading_title(F.regexp_extract(F.lead("text").over(w), r"^\s*\n*([^\n]*)", 1))
    b = blocks.select("document_id", "ord", _lead(F.trim("text")).alias("n"), F.col("text").rlike(r"^\s*\d{1,3}\s*$").alias("bare"), F.lead("heading").over(w).alias("next"), F.substring(title, 1, LONGEST_TITLE).alias("title"))
    hit = b.filter("bare AND next AND title RLIKE '^\\\\p{Lu}'").join(gone, ["document_id", "n"])
    last = hit.groupBy("document_id", "n").agg(F.max(F.struct("ord", "title")).alias("x"))
    kind = F.when(F.col("x.title").rlike(DEFINITIONS), "definitions").otherwise("section")
    return last.select("document_id", "x.ord", kind.alias("kind"), F.col("n").cast("string").alias("number"), "x.title")


def section_bodies(blocks: DataFrame, marks: DataFrame) -> DataFrame:
    """document_id, number, heading, chapter, part, text, block_ids: what each section says, from its marker to the next boundary,
    without furniture and amendment notes; a chapter closes the part before it."""
    w = Window.partitionBy("document_id").orderBy("ord")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    m = marks.withColumn("until", F.lead("ord", 1, 1 << 30).over(w)).withColumn("chapter", F.last(F.when(F.col("kind") == "chapter", F.col("number")), ignorenulls=True).over(upto))
    # the part in force: the last part marker, unless a chapter came after it
    part = F.last(F.when(F.col("kind") == "part", F.col("number")).when(F.col("kind") == "chapter", ""), ignorenulls=True).over(upto)
    m = m.withColumn("part", F.nullif(part, F.lit(""))).filter(_is_section()).select("document_id", F.col("ord").alias("at"), "until", "number", "title", "chapter", "part")
    b = blocks.filter(~F.col("type").isin(*FURNITURE) & (F.trim("text") != "")).select("document_id", "ord", "block_id", "text")
    # the section a block lies in: the last marker at or before it (an as-of join by a window over both)
    rows = b.select("document_id", "ord", "block_id", "text", F.lit(None).cast("int").alias("at")).unionByName(marks.select("document_id", "ord", F.lit(None).cast("string").alias("block_id"), F.lit(None).cast("string").alias("text"), F.col("ord").alias("at")))
    inside = rows.withColumn("at", F.last("at", ignorenulls=True).over(Window.partitionBy("document_id").orderBy("ord", F.col("text").isNotNull()).rowsBetween(Window.unboundedPreceding, 0))).filter("text IS NOT NULL")
    j = inside.join(m, ["document_id", "at"]).filter((F.col("ord") == F.col("at")) | ~amendment_footnote(F.col("text")))
    parts = F.sort_array(F.collect_list(F.struct("ord", F.trim("text").alias("t"), "block_id")))
    g = j.groupBy("document_id", "at", "number", "title", "chapter", "part").agg(parts.alias("p"))
    text = F.trim(F.regexp_replace(F.array_join(F.transform("p", lambda x: x["t"]), " "), r"\s+", " "))
    bare = F.regexp_replace(text, r"^\s*(?:\d{1,3}\s*\[\s*)?[*†‡§]?\s*\[?\s*\d[\dlIO]{0,3}[A-Z]{0,2}\.\s*(?:(?:[—–]|_{2,}|-{2,})\s*)?", "")
    return g.select("document_id", "number", F.coalesce(F.nullif(heading_title(bare), F.lit("")), F.col("title")).alias("heading"), "chapter", "part", bare.alias("text"), F.transform("p", lambda x: x["block_id"]).alias("block_ids"))


def roman(value):
    """The number a Roman numeral stands for; null for anything else."""
    digits = F.split(F.reverse(F.upper(value)), "")
    worth = F.create_map(*[F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv])
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("top"))

    def step(a, ch):
        n = F.try_element_at(worth, ch)
        return F.struct(F.when(n < a["top"], a["total"] - n).otherwise(a["total"] + n).alias("total"), F.greatest(a["top"], n).alias("top"))

    return F.when(F.upper(value).rlike("^[IVXLCDM]+$"), F.aggregate(F.filter(digits, lambda c: c != ""), zero, step)["total"])


def statute_metadata(texts: DataFrame) -> DataFrame:
    """document_id, title, commencement, long_title, preamble, repealed, act_number, act_number_value, act_year of a statute's text."""
    got = lambda p, i=1: F.nullif(F.trim(F.regexp_replace(F.regexp_extract("text", p, i), r"\s+", " ")), F.lit(""))
    number = r"(?im)^\s*\d{0,3}\s*((?:ACT|ORDINANCE|ORDER|REGULATION)\s+No\.?\s*([IVXLCDM]+|\d+)\s+OF\s+(\d{4}))"
    value = F.coalesce(roman(got(number, 2)), F.when(got(number, 2).rlike("^[0-9]+$"), got(number, 2)).cast("int"))
    title = r"(?ims)^[ \t]*(THE\s+.{4,140}?(?:ACT|ORDINANCE|ORDER|REGULATION|CODE)(?:[ \t]*,?[ \t]*\d{4})?)[ \t]*\.?[ \t]*$"
    return texts.select(
        "document_id", F.when(F.regexp_count(F.regexp_extract("text", title, 1), F.lit("\n")) <= 1, got(title)).alias("title"), got(r"(?m)^\s*\[\s*(\d{1,2}(?:st|nd|rd|th)?\s+\w+,?\s+\d{4})\s*\]").alias("commencement"),
        got(r"(?im)^\s*(An\s+(?:Act|Ordinance|Order|Regulation)\s+(?:further\s+)?to\b.*)$").alias("long_title"), F.col("text").rlike(r"(?m)^\s*(?:AND\s+)?WHEREAS\b").alias("preamble"),
        F.col("text").rlike(r"(?im)^\s*THIS\s+LAW\s+HAS\s+BEEN\s+REPEALED").alias("repealed"), got(number).alias("act_number"), value.alias("act_number_value"), got(number, 3).cast("int").alias("act_year"),
    )
