"""Pages and their blocks: routing, typing, order, model output, located quotes, checks and scores.

Blocks are rows: document_id, page, ord, block_id, type, text, bbox (x0, y0, x1, y1) and what each function names further.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.text import area, loops, overlap_area, page_number_only, quality
from lexloom.legal.parties import ratio

# Private-use glyphs, fonts whose text can't be trusted, and the shares that tell.
PRIVATE = "[\\uE000-\\uF8FF]"
BAD_FONT = "(?i)nastaleeq|nastaliq|noori"
PRIVATE_BLOCK, PRIVATE_PAGE, SCANNED = 0.30, 0.5, 0.5
POLICY = ["local", "self_hosted", "third_party"]
# The patterns of sensitive content.
SENSITIVE = {
    "cnic": r"\b[0-9]{5}-?[0-9]{7}-?[0-9]\b", "phone": r"(?:^|[^0-9])(?:\+92[\s-]?|0)3[0-9]{2}[\s-]?[0-9]{7}\b",
    "medical": r"(?i)medico-?\s?legal|post-?\s?mortem|autopsy|forensic|میڈیکو\s*لیگل|پوسٹ\s*مارٹم|فرانزک", "victim": r"(?i)\bvictim|متاثرہ",
}


def sensitive(text) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(k)) for k, p in SENSITIVE.items()]))


def may_send(policy, ceiling) -> Column:
    """Whether a reader of one policy may see what a ceiling allows: local < self_hosted < third_party."""
    order = F.array(*map(F.lit, POLICY))
    return F.array_position(order, policy) <= F.array_position(order, ceiling)


def _private_share(text) -> Column:
    solid = F.length(F.regexp_replace(text, r"\s", ""))
    return F.when(solid > 0, F.regexp_count(text, F.lit(PRIVATE)) / solid).otherwise(0.0)


def profiles(pages: DataFrame) -> DataFrame:
    """document_id, page, text_chars, dominant_image, pua_ratio, sensitive of pages (document_id, page, text, dominant_image)."""
    t = F.coalesce("text", F.lit(""))
    return pages.select("document_id", "page", F.length(F.trim(t)).alias("text_chars"), "dominant_image", _private_share(t).alias("pua_ratio"), (F.size(sensitive(t)) > 0).alias("sensitive"))


def routed(profile: DataFrame, ceiling: str = "local", opted_in: bool = False) -> DataFrame:
    """document_id, page, route (native or ocr_cpu), reasons, max_policy: an image, no text or private glyphs send a page to OCR."""
    why = F.when(F.col("dominant_image"), "dominant_image").when(F.col("text_chars") == 0, "no_text_layer").when(F.col("pua_ratio") >= PRIVATE_PAGE, "private_use_text").otherwise("readable_text_layer")
    reasons = F.when(F.col("sensitive"), F.array(why, F.lit("sensitive_page"))).otherwise(F.array(why))
    most = F.when(F.col("sensitive") | F.lit(not opted_in), "local").otherwise(ceiling)
    return profile.select("document_id", "page", F.when(why == "readable_text_layer", "native").otherwise("ocr_cpu").alias("route"), reasons.alias("reasons"), most.alias("max_policy"))


def document_modes(pages: DataFrame) -> DataFrame:
    """document_id, mode, scan_pages, native_pages of pages (document_id, page, needs_ocr; null is an unreadable page)."""
    needs = F.coalesce("needs_ocr", F.lit(True))
    of = lambda test: F.sort_array(F.collect_list(F.when(test, F.col("page"))))
    g = pages.groupBy("document_id").agg(of(needs).alias("scan_pages"), of(~needs).alias("native_pages"))
    scans, n = F.size("scan_pages"), F.size("scan_pages") + F.size("native_pages")
    mode = F.when(scans == 0, "digital").when((F.size("native_pages") == 0) | (scans >= n * SCANNED), "scanned").otherwise("mixed_scanned_first")
    return g.select("document_id", mode.alias("mode"), "scan_pages", "native_pages")


def merged_engines(ocr: DataFrame, native: DataFrame, native_pages: DataFrame) -> DataFrame:
    """The blocks of each page of the OCR parse, taken from the native parse where the page has a text layer and that parse has it;
    document_order runs over the whole document. native_pages: document_id, page."""
    on = ["document_id", "page"]
    have = native.select(*on).distinct().join(native_pages, on, "left_semi").join(ocr.select(*on).distinct(), on, "left_semi")
    both = ocr.join(have, on, "left_anti").withColumn("engine", F.lit("ocr")).unionByName(native.join(have, on, "left_semi").withColumn("engine", F.lit("native")))
    return both.withColumn("document_order", F.row_number().over(Window.partitionBy("document_id").orderBy("page", "ord")) - 1)


# Layout classes of the model and block types.
CLASSES = {"Text": "text", "Title": "heading", "Section-header": "heading", "List-item": "list", "Table": "table", "Page-header": "header", "Page-footer": "footer", "Footnote": "footnote"}
_REGION = r"(?s)<x_(\d+(?:\.\d+)?)><y_(\d+(?:\.\d+)?)>(.*?)<x_(\d+(?:\.\d+)?)><y_(\d+(?:\.\d+)?)><class_([^>]+)>"


def regions(raw: DataFrame) -> DataFrame:
    """document_id, page, ord, type, layout_class, text, bbox: the complete regions of a model's tagged output (document_id, page, raw,
    width, height), boxes as fractions of the page; an unknown class reads as text."""
    part = lambda i: F.regexp_extract_all("raw", F.lit(_REGION), F.lit(i))
    z = raw.select("document_id", "page", "width", "height", F.posexplode(F.arrays_zip(*[part(i).alias(n) for i, n in enumerate(("x0", "y0", "t", "x1", "y1", "c"), 1)])).alias("ord", "r"))
    kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in CLASSES.items() for x in kv]), F.col("r.c")), F.lit("text"))
    box = F.array(*[F.col(f"r.{k}").cast("double") * F.col(s) for k, s in (("x0", "width"), ("y0", "height"), ("x1", "width"), ("y1", "height"))])
    return z.select("document_id", "page", "ord", kind.alias("type"), F.col("r.c").alias("layout_class"), F.col("r.t").alias("text"), box.alias("bbox"))


RECOVERED_CHARS, RECOVERED_QUALITY = 12, 0.7
MARKS = ("stamp", "handwriting", "signature")


def with_recovered(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """The blocks of a page with what a second look found (document_id, page, item, text, bbox, signature) put after the last body
    block that starts above it; marks stay last. Text too short or poor becomes a signature or an illegible block without text."""
    good = (F.length(F.trim("text")) >= RECOVERED_CHARS) & (quality("text") >= RECOVERED_QUALITY)
    kind = F.when(good, "text").when(F.col("signature"), "signature").otherwise("illegible")
    new = found.select("document_id", "page", kind.alias("type"), F.when(good, F.col("text")).otherwise("").alias("text"), "bbox", "item")
    body = blocks.filter(~F.col("type").isin(*MARKS))
    above = new.alias("n").join(body.alias("b"), F.expr("n.document_id = b.document_id AND n.page = b.page AND b.bbox[1] < n.bbox[1]"), "left")
    place = above.groupBy("n.document_id", "n.page", "n.item").agg(F.coalesce(F.max("b.ord"), F.lit(-1)).alias("after"))
    put = new.join(place, ["document_id", "page", "item"]).select("document_id", "page", "type", "text", "bbox", F.when(F.col("type") == "signature", 1).otherwise(0).alias("last"), "after", F.col("bbox")[1].alias("y"), (-F.col("item")).alias("turn"))
    own = blocks.select("document_id", "page", "type", "text", "bbox", F.col("type").isin(*MARKS).cast("int").alias("last"), F.col("ord").alias("after"), F.lit(float("-inf")).alias("y"), F.lit(0).alias("turn"))
    return own.unionByName(put).withColumn("ord", F.row_number().over(Window.partitionBy("document_id", "page").orderBy("last", "after", "y", "turn")) - 1).drop("last", "after", "y", "turn")


def checked_responses(tasks: DataFrame, items: DataFrame) -> DataFrame:
    """batch, problem (null where the response holds): every task's id exactly once, none unknown, right-to-left text in each.
    tasks: batch, id; items: batch, id, text."""
    per = items.groupBy("batch", "id").agg(F.count("*").alias("n"), F.min(F.coalesce(F.col("text"), F.lit("")).rlike("[֐-ࣿיִ-﷿ﹰ-ﻼ]").cast("int")).alias("read"))
    j = tasks.select("batch", "id", F.lit(1).alias("asked")).join(per, ["batch", "id"], "full")
    why = F.when(F.col("asked").isNull(), "unknown id").when(F.col("n").isNull(), "omitted id").when(F.col("n") > 1, "duplicated id").when(F.col("read") == 0, "no Urdu text")
    return j.groupBy("batch").agg(F.min(F.when(why.isNotNull(), F.concat_ws(": ", why, "id"))).alias("problem"))


AGREEMENT, PIXELS_A_CHAR, URDU_SHARE = 85, 200, 0.8


def plausible_urdu(text, pixels) -> Column:
    """Urdu letters for the most part, no longer than the crop can hold, not a loop."""
    letters, rtl = F.regexp_count(text, F.lit(r"\p{L}")), F.regexp_count(text, F.lit(r"[\p{IsArabic}&&\p{L}]"))
    return (letters > 0) & (rtl >= letters * URDU_SHARE) & (F.length(F.trim(text)) <= pixels / PIXELS_A_CHAR) & ~loops(text)


def two_readings(crops: DataFrame) -> DataFrame:
    """id, accepted, confidence of crops (id, first, second, width, height): both readings plausible and at least AGREEMENT alike."""
    alike = F.pandas_udf(lambda a, b: pd.Series([ratio(x or "", y or "") for x, y in zip(a, b)], dtype=float), "double")(F.trim("first"), F.trim("second"))
    px = F.col("width") * F.col("height")
    ok = F.coalesce(plausible_urdu(F.col("first"), px) & plausible_urdu(F.col("second"), px), F.lit(False))
    return crops.select("id", ok.alias("ok"), alike.alias("alike")).select("id", (F.col("ok") & (F.col("alike") >= AGREEMENT)).alias("accepted"), F.round(F.col("alike") / 100, 3).alias("confidence"))


def unreliable(text, fonts) -> Column:
    """Why a block's own text can't be trusted: private_use_glyphs, unreliable_font_encoding."""
    return F.array_compact(F.array(F.when(_private_share(text) >= PRIVATE_BLOCK, F.lit("private_use_glyphs")), F.when(F.exists(fonts, lambda f: f.rlike(BAD_FONT)), F.lit("unreliable_font_encoding"))))


def cell_positions(tables: DataFrame) -> DataFrame:
    """table_id, cell, row, column: places of cells by the lengths of the rows, where these account for all cells (table_id, cells, rows)."""
    spots = F.flatten(F.transform("rows", lambda r, i: F.transform(r, lambda c, j: F.struct(i.alias("row"), j.alias("column")))))
    z = tables.filter(F.size("cells") == F.size(F.flatten("rows"))).select("table_id", F.posexplode(F.arrays_zip(F.col("cells").alias("cell"), spots.alias("at"))).alias("k", "z"))
    return z.select("table_id", "k", "z.cell", "z.at.row", "z.at.column")


# How a court document opens.
COURT_HEADING = r"(?i)^\s*(?:in\s+the\s+)?(?:[A-Za-z.,'-]+\s+){0,4}?(?:high\s+court|supreme\s+court|sessions\s+judge|court\s+of|tribunal|judicial\s+department)\b"


def names_a_court(blocks: DataFrame) -> DataFrame:
    """document_id, court: whether one of the first four blocks of the first page opens with a court's name."""
    first = blocks.withColumn("_p", F.min("page").over(Window.partitionBy("document_id"))).filter("page = _p")
    top = first.withColumn("_n", F.row_number().over(Window.partitionBy("document_id").orderBy("ord"))).filter("_n <= 4")
    return top.groupBy("document_id").agg(F.max(F.coalesce(F.col("text").rlike(COURT_HEADING), F.lit(False))).alias("court"))


def is_heading_block(kind, spans) -> Column:
    """A heading by type, or bold or underlined within the first three spans that print (spans: text, bold, underline)."""
    seen = F.slice(F.filter(spans, lambda s: F.trim(s["text"]) != ""), 1, 3)
    return kind.isin("heading", "form_header") | F.exists(seen, lambda s: s["bold"] | s["underline"])


# Notes of amendment, lists, counsel rows, blue slips.
NOTE_WORDS = r"(?i)(?:subs|ins|added|omitted|rep|substituted|amended|deleted)\.?\s+by\b|see\s+Gazette\b|\bA\.\s?O\.,|\bw\.e\.f\."
NOTE_MARK, NOTE_OPENING, OBJECTS = r"^\s*[\d†‡*lI]{1,3}\s*[A-Za-z\[(]", r"^\s*\d{1,3}(?:\s+(?!\d)|(?=[A-Z][a-z]))", r"^\s*\d{1,3}\s+For\s+Statement\s+of\s+Objects\b"
LIST_NATIVE, LIST_SCANNED = r"^\s*(?:(?:\d+\s*[.)]\s+(?=[A-Z\"“‘(]))|(?:[A-Za-z]\s*[.)]\s+))", r"^\s*(?:(?:\d+|[A-Z])\s*[.)]|[-*])(?:\s+|$)"
BLUE_SLIP = r"(?i)\bBLUE[^A-Za-z0-9]{0,3}SLIP\b"
COVER_LABEL = (
    r"(?i)^\s*(?:dates?\s+of\s+hearing|(?:appellants?|petitioners?|respondents?(?:\s*\(?s\)?)?|plaintiffs?|defendants?|complainants?|state)(?:\s+(?:in|no\.?)\s*[\w .\-/]{0,40})?\s+by"
    r"|for\s+the\s+(?:appellants?|petitioners?|respondents?|applicants?|state|complainants?)(?:\s*\(\s*s\s*\))?)\s*[:.]\s*.*$"
)


def amendment_footnote(text) -> Column:
    """A marker opens the block and an amendment is named in its first 200 characters, or it is a note of objects."""
    return text.rlike(NOTE_OPENING) & (text.rlike(OBJECTS) | F.substring(text, 1, 200).rlike(NOTE_WORDS))


def is_cover_label(text) -> Column:
    return (F.length(text) > 0) & (F.length(text) <= 60) & text.rlike(COVER_LABEL)


def counsel_role(label) -> Column:
    """The party a counsel row is for: what follows 'for the', or stands before 'by'; null for other rows."""
    key = F.trim(F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z0-9 ]+", " "), r"\s+", " "))
    role = F.when(key.startswith("for the "), F.substring(key, F.lit(9), F.length(key))).when(key.endswith(" by"), F.substring(key, F.lit(1), F.length(key) - 3))
    return F.nullif(F.trim(role), F.lit(""))


def signature_key(text) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "#"), r"\s+", " "))


def repeated_bands(blocks: DataFrame) -> DataFrame:
    """document_id, band (top or bottom), key: texts, numbers masked, that stand in one band (16% of the page's height) on two pages.
    blocks also hold height."""
    b = blocks.select("document_id", "page", signature_key(F.col("text")).alias("key"), (F.col("bbox")[1] <= F.col("height") * 0.16).alias("top"), (F.col("bbox")[3] >= F.col("height") * 0.84).alias("bottom")).filter("length(key) >= 3")
    band = b.select("document_id", "page", "key", F.explode(F.array_compact(F.array(F.when(F.col("top"), F.lit("top")), F.when(F.col("bottom"), F.lit("bottom"))))).alias("band"))
    return band.groupBy("document_id", "band", "key").agg(F.countDistinct("page").alias("n")).filter("n > 1").drop("n")


def _in_bands(blocks: DataFrame) -> DataFrame:
    """blocks with top_key and bottom_key: whether their text is repeated in that band."""
    bands = repeated_bands(blocks)
    out = blocks.withColumn("_key", signature_key(F.col("text")))
    for band in ("top", "bottom"):
        keys = bands.filter(F.col("band") == band).select("document_id", F.col("key").alias("_key"), F.lit(True).alias(f"{band}_key"))
        out = out.join(keys, ["document_id", "_key"], "left").withColumn(f"{band}_key", F.coalesce(f"{band}_key", F.lit(False)))
    return out.drop("_key")


def typed_native(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """document_id, page, ord, kind, score of native text blocks (document_id, page, ord, text, bbox, size, visible_size, width, height,
    median_size): table text, header, footer, footnote, list, heading or text, the first that applies. tables: document_id, page, bbox."""
    covers = tables.groupBy("document_id", "page").agg(F.collect_list("bbox").alias("_tables"))
    b = _in_bands(blocks).join(covers, ["document_id", "page"], "left")
    box, t = F.col("bbox"), F.col("text")
    covered = F.exists(F.coalesce("_tables", F.array()), lambda o: overlap_area(box, o) >= area(box) * 0.20)
    number, centre = page_number_only("text"), F.abs((box[0] + box[2]) / 2 - F.col("width") / 2) < F.col("width") * 0.15
    small = (F.col("median_size") > 0) & (F.col("visible_size") > 0) & (F.col("visible_size") <= F.col("median_size") - 2) & (box[1] >= F.col("height") * 0.55)
    note = small & (t.rlike(NOTE_MARK) | F.substring(t, 1, 160).rlike(NOTE_WORDS))
    upper = (F.upper(t) == t) & t.rlike(r"\p{Lu}")
    big = (F.col("size") >= F.col("median_size") * 1.20) | ((F.col("size") >= F.col("median_size") * 1.05) & (upper | ((box[1] < F.col("height") * 0.25) & centre & (F.length(t) <= 60))))
    rules = [(covered & (area(box) > 0), "table_text_omitted", 0.99), (F.col("top_key"), "header", 0.96), (number & (box[1] <= F.col("height") * 0.10), "header", 0.82), (F.col("bottom_key"), "footer", 0.96), (number, "footer", 0.88),
             (note, "footnote", 0.90), (t.rlike(LIST_NATIVE), "list", 0.93), ((F.length(t) <= 100) & big, "heading", 0.89)]
    kind, score = F.when(F.lit(False), ""), F.when(F.lit(False), 0.0)
    for test, k, s in rules:
        kind, score = kind.when(test, k), score.when(test, s)
    return b.select("document_id", "page", "ord", kind.otherwise("text").alias("kind"), score.otherwise(0.88).alias("score"))


def typed_scanned(blocks: DataFrame) -> DataFrame:
    """document_id, page, ord, kind, blue_slip of OCR blocks (document_id, page, ord, text, bbox, width, height)."""
    b, box, t = _in_bands(blocks), F.col("bbox"), F.col("text")
    number, centre = page_number_only("text"), F.abs((box[0] + box[2]) / 2 - F.col("width") / 2) < F.col("width") * 0.16
    head = F.col("top_key") | ((box[1] <= F.col("height") * 0.10) & (F.upper(t).contains("JUDGMENT") | number))
    upper = (F.upper(t) == t) & t.rlike(r"\p{Lu}")
    kind = F.when(head, "header").when(F.col("bottom_key") | number, "footer").when(t.rlike(LIST_SCANNED), "list").when((F.length(t) <= 100) & centre & upper, "heading").otherwise("text")
    return b.select("document_id", "page", "ord", kind.alias("kind"), ((F.col("page") == 1) & t.rlike(BLUE_SLIP)).alias("blue_slip"))


def carried_footnotes(blocks: DataFrame) -> DataFrame:
    """document_id, page, ord, kind: small type low on the page that follows a footnote is one, until a block that is neither
    (blocks: ..., type, visible_size, median_size, height)."""
    low = (F.col("visible_size") > 0) & (F.col("visible_size") <= F.col("median_size") - 2) & (F.col("bbox")[1] >= F.col("height") * 0.55) & (F.col("median_size") > 0)
    w = Window.partitionBy("document_id", "page").orderBy("ord")
    # the last block that opens (a footnote) or ends (neither footnote nor small and low) a run
    state = F.when(F.col("type") == "footnote", 1).when(~low, 0)
    run = F.last(state, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    kind = F.when((run == 1) & low & F.col("type").isin("text", "list"), "footnote").otherwise(F.col("type"))
    return blocks.select("document_id", "page", "ord", kind.alias("kind"))


FURNITURE = ("header", "footer", "footnote", "table_text_omitted")


def reading_order(blocks: DataFrame) -> DataFrame:
    """document_id, page, block_id, ord: rows of 1.5 points from the top, left to right; two columns where each has three narrow
    blocks and runs over 40% of the page (blocks: document_id, page, block_id, type, bbox, width, height)."""
    page = Window.partitionBy("document_id", "page")
    w = F.col("bbox")[2] - F.col("bbox")[0]
    narrow = ~F.col("type").isin(*FURNITURE) & (w < F.col("width") * 0.70)
    x0, y0 = F.col("bbox")[0], F.col("bbox")[1]
    b = blocks.withColumn("_narrow", narrow)
    across = Window.partitionBy("document_id", "page", "_narrow").orderBy(x0, "block_id")
    gap = F.when(F.col("_narrow") & (x0 - F.lag(x0).over(across) > F.col("width") * 0.28), 1).otherwise(0)
    b = b.withColumn("_gap", gap)
    b = b.withColumn("_col", F.when(F.col("_narrow"), F.sum("_gap").over(across.rowsBetween(Window.unboundedPreceding, 0))))
    col = b.filter("_narrow").groupBy("document_id", "page", "_col").agg(F.count("*").alias("_n"), (F.max(F.col("bbox")[3]) - F.min(F.col("bbox")[1])).alias("_span"), F.median(F.col("bbox")[0]).alias("_centre"), F.max("height").alias("_h"))
    sound = (F.col("_n") >= 3) & ((F.col("_h") <= 0) | (F.col("_span") >= F.col("_h") * 0.40))
    cols = col.groupBy("document_id", "page").agg(((F.count("*") > 1) & F.min(sound)).alias("_two"), F.sort_array(F.collect_list(F.struct("_col", "_centre"))).alias("_cs"))
    j = b.join(cols, ["document_id", "page"], "left")
    own = F.array_min(F.transform("_cs", lambda c: F.struct(F.abs(c["_centre"] - x0).alias("d"), c["_col"].alias("c"))))["c"]
    placed = F.coalesce("_two", F.lit(False)) & ~F.col("type").isin(*FURNITURE) & (w < F.col("width") * 0.70)
    first = F.when(placed, F.col("width") + own * F.col("width") + y0).otherwise(F.rint(y0 / 1.5).cast("double"))
    return j.select("document_id", "page", "block_id", (F.row_number().over(page.orderBy(first, F.when(placed, own).otherwise(0), x0, "block_id")) - 1).alias("ord"))


def outside_tables(blocks: DataFrame, tables: DataFrame, share: float = 0.20) -> DataFrame:
    """The blocks of which less than `share` lies in a table of their page."""
    hit = F.expr("b.document_id = t.document_id AND b.page = t.page") & (overlap_area(F.col("b.bbox"), F.col("t.bbox")) >= area(F.col("b.bbox")) * share) & (area(F.col("b.bbox")) > 0)
    return blocks.alias("b").join(tables.alias("t"), hit, "left_anti")


def _greedy(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    used: tuple[set, set] = set(), set()
    out = []
    for iou, p, q in sorted(zip(g["iou"], g["p"], g["q"]), reverse=True):
        if p not in used[0] and q not in used[1]:
            used[0].add(p)
            used[1].add(q)
            out.append((*key, p, q, iou))
    return pd.DataFrame(out, columns=["document_id", "page", "p", "q", "iou"])


def matched_boxes(predicted: DataFrame, gold: DataFrame, least: float = 0.5) -> DataFrame:
    """document_id, page, p, q, iou: boxes of one page paired one to one, best overlap first (both: document_id, page, ord, bbox). A page
    holds some dozen boxes, so its pairs are few."""
    j = predicted.select("document_id", "page", F.col("ord").alias("p"), F.col("bbox").alias("a")).join(gold.select("document_id", "page", F.col("ord").alias("q"), F.col("bbox").alias("b")), ["document_id", "page"])
    common = overlap_area(F.col("a"), F.col("b"))
    pairs = j.select("document_id", "page", "p", "q", (common / (area(F.col("a")) + area(F.col("b")) - common)).alias("iou")).filter(F.col("iou") >= least)
    return pairs.groupBy("document_id", "page").applyInPandas(_greedy, "document_id string, page int, p int, q int, iou double")


GATE = {"f1": 0.90, "mean_iou": 0.85, "tau": 0.95}


def layout_scores(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """document_id, page, precision, recall, f1, mean_iou, tau of each page; tau is null under two pairs."""
    on = ["document_id", "page"]
    m = matched_boxes(predicted, gold)
    two = m.alias("x").join(m.alias("y"), F.expr("x.document_id = y.document_id AND x.page = y.page AND x.p < y.p"))
    tau = two.groupBy("x.document_id", "x.page").agg(F.avg(F.signum(F.col("y.q") - F.col("x.q"))).alias("tau"))
    n = lambda df, c: df.groupBy(*on).agg(F.count("*").alias(c))
    j = n(predicted, "np").join(n(gold, "ng"), on, "full").join(m.groupBy(*on).agg(F.count("*").alias("hits"), F.avg("iou").alias("mean_iou")), on, "left").join(tau, on, "left")
    p, r = (F.coalesce(F.col("hits") / F.col(c), F.lit(0.0)) for c in ("np", "ng"))
    return j.select(*on, p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"), "mean_iou", "tau")


def layout_gate(scores: DataFrame) -> DataFrame:
    """The means of what is defined, and whether all lie above the gate."""
    mean = scores.agg(*[F.avg(k).alias(k) for k in GATE])
    return mean.select("*", F.coalesce(F.forall(F.array(*[F.col(k) > v for k, v in GATE.items()]), lambda x: x), F.lit(False)).alias("passes_gate"))


def located(texts: DataFrame, quotes: DataFrame) -> DataFrame:
    """id, quote_no, char_start, char_end: every place a quote stands in its text, blanks apart (texts: id, text; quotes: id, quote_no, quote)."""

    def places(text: pd.Series, quote: pd.Series) -> pd.Series:
        import regex

        out = []
        for t, q in zip(text, quote):
            words = (q or "").split()
            out.append([{"a": m.start(), "b": m.end()} for m in regex.finditer(r"\s+".join(map(regex.escape, words)), t or "")] if words else [])
        return pd.Series(out)

    j = quotes.join(texts, "id").select("id", "quote_no", F.explode(F.pandas_udf(places, "array<struct<a:int,b:int>>")("text", "quote")).alias("p"))
    return j.select("id", "quote_no", F.col("p.a").alias("char_start"), F.col("p.b").alias("char_end"))


def plain_words(text) -> Column:
    """Lower case, straight quotes, words, percent and dollar signs only, single blanks: what quotes are compared by."""
    t = F.translate(F.lower(text), "’‘“”", "''\"\"")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}_%$']+", " "), r"\s+", " "))


def _best_part(a: str, b: str) -> float:
    """The best likeness of the shorter text to a window as long of the longer one (windows running over its ends included)."""
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if not s:
        return 0.0
    if s in t:
        return 100.0
    cut = [t[max(0, i) : i + len(s)] for i in range(1 - len(s), len(t))]
    return max(ratio(s, w) for w in cut)


def grounded(blocks: DataFrame, quotes: DataFrame, least: float = 92, shortest: int = 4) -> DataFrame:
    """quote_no, page, block_id, score: the block that holds a quote best, from `least` on, the first of equals (quotes: document_id, quote_no, quote)."""
    score = F.pandas_udf(lambda a, b: pd.Series([_best_part(x, y) for x, y in zip(a, b)], dtype=float), "double")
    q = quotes.select("document_id", "quote_no", plain_words(F.col("quote")).alias("q")).filter(F.length(F.regexp_replace("q", " ", "")) >= shortest)
    j = q.join(blocks.select("document_id", "page", "ord", "block_id", plain_words(F.col("text")).alias("t")), "document_id").withColumn("score", score("q", "t")).filter(F.col("score") >= least)
    w = Window.partitionBy("document_id", "quote_no").orderBy(F.desc("score"), "page", "ord")
    return j.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("quote_no", "page", "block_id", "score")


def confirmed(answers: DataFrame, blocks: DataFrame) -> DataFrame:
    """answer_no, status, why: not_found without value or quote, rejected where the quote isn't on a page or doesn't hold the value.
    answers: document_id, answer_no, value, quote."""
    found = grounded(blocks, answers.select("document_id", F.col("answer_no").alias("quote_no"), "quote")).select(F.col("quote_no").alias("answer_no"), F.lit(True).alias("_found"))
    j = answers.join(found, "answer_no", "left")
    blank = (F.coalesce("value", F.lit("")) == "") | (F.coalesce("quote", F.lit("")) == "")
    inside = plain_words(F.col("quote")).contains(plain_words(F.col("value")))
    why = F.when(blank, None).when(F.col("_found").isNull(), "quote_not_found").when(~inside, "value_not_in_quote")
    return j.select("answer_no", F.when(blank, "not_found").when(why.isNotNull(), "rejected").otherwise("confirmed").alias("status"), why.alias("why"))


def box_check(blocks: DataFrame) -> DataFrame:
    """document_id, score: the share of blocks with a box of some area on the page (2 points of slack)."""
    b, w, h = F.col("bbox"), F.col("width"), F.col("height")
    ok = F.coalesce((F.size(b) == 4) & (area(b) > 0) & (b[0] >= -2) & (b[1] >= -2) & (b[2] <= w + 2) & (b[3] <= h + 2), F.lit(False))
    return blocks.groupBy("document_id").agg(F.round(F.avg(F.when(F.size(b) == 4, ok).otherwise(F.lit(False)).cast("int")), 4).alias("score"))


def table_check(tables: DataFrame) -> DataFrame:
    """table_id, issues of tables (table_id, rows array<array<string>>, cell_boxes): ragged_rows, empty_cells (under 65% filled), missing_cell_bboxes."""
    sizes = F.transform("rows", lambda r: F.size(r))
    cells = F.flatten("rows")
    filled = F.size(F.filter(cells, lambda c: F.trim(c) != ""))
    issue = F.array_compact(F.array(F.when((F.size("rows") == 0) | (F.size(F.array_distinct(sizes)) != 1), F.lit("ragged_rows")), F.when((F.size(cells) == 0) | (filled < F.size(cells) * 0.65), F.lit("empty_cells")),
                                    F.when((F.col("cell_boxes") == 0) | (F.col("cell_boxes") < F.size(cells)), F.lit("missing_cell_bboxes"))))
    return tables.select("table_id", issue.alias("issues"))


def continuity_check(blocks: DataFrame) -> DataFrame:
    """document_id, score, duplicates: the share of text blocks whose offsets don't step back on their page, and the texts over 20
    characters that a page repeats (blocks: ..., char_start, char_end)."""
    t = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " "))
    b = blocks.select("document_id", "page", "ord", t.alias("t"), "char_start", "char_end").filter("t != ''")
    before = F.coalesce(F.max("char_end").over(Window.partitionBy("document_id", "page").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ok = F.col("char_start").isNull() | F.col("char_end").isNull() | ((F.col("char_start") >= before) & (F.col("char_end") >= F.col("char_start")))
    score = b.select("document_id", ok.alias("ok")).groupBy("document_id").agg(F.round(F.avg(F.col("ok").cast("int")), 4).alias("score"))
    again = b.filter("length(t) > 20").groupBy("document_id", "page", "t").agg(F.count("*").alias("n")).filter("n > 1").groupBy("document_id").agg(F.count("*").alias("duplicates"))
    return score.join(again, "document_id", "left").select("document_id", "score", F.coalesce("duplicates", F.lit(0)).cast("int").alias("duplicates"))


def metadata_check(rows: DataFrame) -> DataFrame:
    """document_id, score: the share of court, case_number, decision_date and parties present, times 0.75 if one has no source
    (rows: document_id, the four fields, sourced array<string>)."""
    fields = ("court", "case_number", "decision_date", "parties")
    have = F.array_compact(F.array(*[F.when(F.coalesce(F.col(f), F.lit("")) != "", F.lit(f)) for f in fields]))
    loose = F.size(F.array_except(have, F.col("sourced"))) > 0
    return rows.select("document_id", F.round(F.size(have) / 4 * F.when(loose, 0.75).otherwise(1.0), 4).alias("score"))


def order_check(blocks: DataFrame) -> DataFrame:
    """document_id, score: the share of pages whose orders are 0, 1, 2..., the document's own order being one more check (ord, document_order)."""
    page = blocks.groupBy("document_id", "page").agg((F.sort_array(F.collect_list("ord")) == F.sequence(F.lit(0), F.count("*").cast("int") - 1)).cast("int").alias("ok"))
    whole = blocks.groupBy("document_id").agg((F.sort_array(F.collect_list("document_order")) == F.sequence(F.lit(0), F.count("*").cast("int") - 1)).cast("int").alias("ok"))
    return page.select("document_id", "ok").unionByName(whole).groupBy("document_id").agg(F.round(F.avg("ok"), 4).alias("score"))


NUMBERED = r"^\s*(\d{1,4})[.)]\s+(?=[A-Z\"“‘(])"


def numbering_check(blocks: DataFrame) -> DataFrame:
    """document_id, score, gaps, regressions of numbered paragraphs under 100, by indent and type size; 1 starts again (blocks: ..., size)."""
    n = F.regexp_extract("text", NUMBERED, 1)
    b = blocks.filter(~F.col("type").isin("header", "footer", "table", "form_header") & (n != "")).select("document_id", "page", "ord", n.cast("int").alias("n"), F.round(F.col("bbox")[0] / 10).alias("indent"), F.round("size", 1).alias("size")).filter("n < 100")
    prev = F.lag("n").over(Window.partitionBy("document_id", "indent", "size").orderBy("page", "ord"))
    step = b.select("document_id", "n", prev.alias("prev")).filter("prev IS NOT NULL AND n != 1")
    return step.groupBy("document_id").agg(F.round(F.avg((F.col("n") == F.col("prev") + 1).cast("int")), 4).alias("score"), F.count_if(F.col("n") > F.col("prev") + 1).cast("int").alias("gaps"), F.count_if(F.col("n") <= F.col("prev")).cast("int").alias("regressions"))


# What annotators added to gold texts.
SCAFFOLD = r"(?m)^[ \t]*(?:Court|Case No|Parties):.*$"
ORDER_SHEET = r"(?i)order\s*/?\s*proceeding|signature of (?:the )?judge"


def gold_text(text) -> Column:
    """A gold text without scaffolding lines, table tags, private glyphs and doubled blanks."""
    t = F.regexp_replace(F.regexp_replace(text, SCAFFOLD, ""), r"\[/?TABLE\]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, PRIVATE, ""), r"\s+", " "))


def text_slice(gold, native, raw) -> Column:
    """urdu, scanned, table, regression or text_edit: the most basic cause first."""
    rtl = F.regexp_count(gold, F.lit("[؀-ۿ]"))
    return F.when((F.length(gold) > 0) & (rtl >= F.length(F.regexp_replace(gold, " ", "")) * 0.4), "urdu").when(F.length(native) < F.length(gold) * 0.1, "scanned").when(rtl > 5, "urdu").when(raw.contains("[TABLE]"), "table").when(native == gold, "regression").otherwise("text_edit")


def _word_errors(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b):
        x, y = (x or "").split(), (y or "").split()
        row = list(range(len(y) + 1))
        for i, u in enumerate(x, 1):
            prev, row[0] = row[0], i
            for j, v in enumerate(y, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (u != v))
        out.append(row[-1] / len(x) if x else float(bool(y)))
    return pd.Series(out)


def text_fidelity(pages: DataFrame) -> DataFrame:
    """slice, pages, cer_mean, cer_median, wer_mean, exact over pages (gold raw text, native, predicted)."""
    g = pages.select(gold_text(F.col("gold")).alias("g"), "native", F.col("predicted").alias("p"), F.col("gold").alias("raw"))
    none = (F.length("g") == 0) | (F.length("p") == 0)
    edge = F.when(F.col("g") == F.col("p"), 0.0).otherwise(1.0)
    rows = g.select(text_slice(F.col("g"), F.col("native"), F.col("raw")).alias("slice"), F.when(none, edge).otherwise(F.levenshtein("g", "p") / F.length("g")).alias("cer"), F.when(none, edge).otherwise(F.pandas_udf(_word_errors, "double")("g", "p")).alias("wer"))
    return rows.groupBy("slice").agg(F.count("*").cast("int").alias("pages"), F.round(F.avg("cer"), 4).alias("cer_mean"), F.round(F.median("cer"), 4).alias("cer_median"), F.round(F.avg("wer"), 4).alias("wer_mean"), F.count_if(F.col("cer") == 0).cast("int").alias("exact"))


def table_scores(pages: DataFrame) -> DataFrame:
    """kind, pages, detected, column_count_match, cell_recall_mean of gold tables (gold_cells, predicted_cells, gold_columns,
    predicted_columns, predicted_tables, form_headers); kind none counts false positives under detected."""
    gold, n = F.array_distinct("gold_cells"), F.size(F.array_distinct("gold_cells"))
    recall = F.when(n > 0, F.size(F.array_intersect(gold, F.col("predicted_cells"))) / n)
    kind = F.when(F.col("gold_columns") == 0, "none").when(F.array_join(gold, " ").rlike(ORDER_SHEET), "order_sheet").otherwise("cover")
    seen = F.when(F.col("gold_columns") == 0, F.col("predicted_tables") > 0).otherwise((F.col("predicted_tables") > 0) | (F.col("form_headers") > 0))
    rows = pages.select(kind.alias("kind"), seen.alias("seen"), (F.col("gold_columns") == F.col("predicted_columns")).alias("same"), recall.alias("recall"))
    return rows.groupBy("kind").agg(F.count("*").cast("int").alias("pages"), F.count_if("seen").cast("int").alias("detected"), F.count_if("same").cast("int").alias("column_count_match"), F.round(F.avg("recall"), 4).alias("cell_recall_mean"))


# Headings that OCR joins.
JOINED = {"JUDICIALDEPARTMENT": "JUDICIAL DEPARTMENT", "INTHE": "IN THE", "COURTOF": "COURT OF", "DATEOFHEARING": "DATE OF HEARING", "ORDEROFTHECOURT": "ORDER OF THE COURT"}


def corrected(text) -> Column:
    """Composed characters, ordinary blanks, no zero-width ones, and five joined headings set apart."""
    import unicodedata

    nfc = F.pandas_udf(lambda t: t.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore"), "string")
    t = F.trim(F.regexp_replace(F.regexp_replace(F.translate(nfc(F.coalesce(text, F.lit(""))), "\u00a0", " "), "\u200b", ""), "[ \\t\\r\\f\\x0B]+", " "))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in JOINED.items() for x in kv]), F.upper(F.regexp_replace(t, "[^A-Za-z]", ""))), t)


def fact_text(text, from_ocr) -> Column:
    """Bold and heading marks of OCR text taken out; the fraction of letters in Urdu decides its language elsewhere."""
    plain = F.regexp_replace(F.regexp_replace(text, r"(?s)\*\*(.+?)\*\*|__(.+?)__", "$1$2"), r"(?m)^#{1,6}\s+", "")
    return F.when(from_ocr, plain).otherwise(text)


def language_shares(text) -> Column:
    """(language, en, ur): the share of letters of each script, and the larger (English on a tie)."""
    ur, every = F.regexp_count(text, F.lit(r"[\p{L}&&[\u0600-\uFFFF]]")), F.regexp_count(text, F.lit(r"\p{L}"))
    return F.struct(F.when(ur > every - ur, "ur").otherwise("en").alias("language"), F.when(every > 0, F.round((every - ur) / every, 3)).alias("en"), F.when(every > 0, F.round(ur / every, 3)).alias("ur"))


def printed_number(*texts) -> Column:
    """The first page number printed, pattern by pattern, text by text."""
    out = [F.nullif(F.regexp_extract(F.trim(t), p, 1), F.lit("")) for t in texts for p in (r"(?i)\bpage\s+(\d{1,4})\b", r"(?i)page\s*(\d{1,4})\s*$", r"^\W*(\d{1,4})\W*$", r"^\s*(\d{1,3})\s+[A-Za-z]")]
    return F.coalesce(*out)
