"""Queries of the page and block operators over literal pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions.kinds import kind, segments
from lexloom.operators import pages as P
from lexloom.plans.cases import Cases
from lexloom.plans.legal import numbered
from lexloom.tables import load

C = Cases()
QUERIES, SQL = C.queries, C.sql
BOX = "array<double>"
_glyph = ""

_PAGES = ("document_id string, page int, text string, dominant_image boolean", [("d", 1, "Plain text", False), ("d", 2, "Plain text", True), ("d", 3, "  ", False), ("d", 4, _glyph + " abc", False), ("d", 5, "The victim, 35202-1234567-1", False), ("d", 6, None, False)])
C.many("src03_page_profile", {"pages": _PAGES}, lambda pages: P.profiles(pages).select("page", F.col("text_chars").cast("int").alias("text_chars"), "pua_ratio", "sensitive"), "page int, text_chars int, pua_ratio double, sensitive boolean",
       [(1, 10, 0.0, False), (2, 10, 0.0, False), (3, 0, 0.0, False), (4, 7, 0.5, False), (5, 27, 0.0, True), (6, 0, 0.0, False)])
C.many("src04_page_router", {"pages": _PAGES}, lambda pages: P.routed(P.profiles(pages), "third_party", True).select("page", "route", F.array_join("reasons", "+").alias("reasons"), "max_policy"), "page int, route string, reasons string, max_policy string",
       [(1, "native", "readable_text_layer", "third_party"), (2, "ocr_cpu", "dominant_image", "third_party"), (3, "ocr_cpu", "no_text_layer", "third_party"), (4, "ocr_cpu", "private_use_text", "third_party"), (5, "native", "readable_text_layer+sensitive_page", "local"), (6, "ocr_cpu", "no_text_layer", "third_party")])
C.many("src05_document_route", {"pages": ("document_id string, page int, needs_ocr boolean", [("a", 1, False), ("a", 2, False), ("b", 1, True), ("b", 2, False), ("c", 1, None), ("d", 1, True), ("d", 2, False), ("d", 3, False)])}, P.document_modes,
       "document_id string, mode string, scan_pages array<int>, native_pages array<int>", [("a", "digital", [], [1, 2]), ("b", "scanned", [1], [2]), ("c", "scanned", [1], []), ("d", "mixed_scanned_first", [1], [2, 3])])
_B = "document_id string, page int, ord int, text string"
C.many("src07_engine_merge", {"ocr": (_B, [("d", 1, 0, "ocr one"), ("d", 1, 1, "ocr two"), ("d", 2, 0, "ocr three"), ("d", 3, 0, "ocr four")]), "native": (_B, [("d", 1, 0, "native one"), ("d", 9, 0, "elsewhere")]), "native_pages": ("document_id string, page int", [("d", 1), ("d", 3), ("d", 9)])}, P.merged_engines,
       "document_id string, page int, ord int, text string, engine string, document_order int", [("d", 1, 0, "native one", "native", 0), ("d", 2, 0, "ocr three", "ocr", 1), ("d", 3, 0, "ocr four", "ocr", 2)])
C.many("src13_layout_model_output", {"raw": ("document_id string, page int, raw string, width double, height double", [("d", 1, "<x_0.1><y_0.2>The\ntitle<x_0.5><y_0.4><class_Title><x_0><y_0.5>p<x_1><y_1><class_Picture><x_0.1><y_0.1>cut off", 100.0, 200.0), ("d", 2, "nothing", 1.0, 1.0)])}, P.regions,
       f"document_id string, page int, ord int, type string, layout_class string, text string, bbox {BOX}", [("d", 1, 0, "heading", "Title", "The\ntitle", [10.0, 40.0, 50.0, 80.0]), ("d", 1, 1, "text", "Picture", "p", [0.0, 100.0, 100.0, 200.0])])
_T = f"document_id string, page int, ord int, type string, text string, bbox {BOX}"
C.many("src21_recovered_blocks", {"blocks": (_T, [("d", 1, 0, "text", "first", [0.0, 10.0, 9.0, 20.0]), ("d", 1, 1, "text", "second", [0.0, 50.0, 9.0, 60.0]), ("d", 1, 2, "stamp", "SEAL", [0.0, 5.0, 9.0, 9.0])]),
       "found": (f"document_id string, page int, item int, text string, bbox {BOX}, signature boolean", [("d", 1, 0, "a lost paragraph of words", [0.0, 30.0, 9.0, 40.0], False), ("d", 1, 1, "x", [0.0, 70.0, 9.0, 80.0], False), ("d", 1, 2, "", [0.0, 90.0, 9.0, 99.0], True)])},
       lambda blocks, found: P.with_recovered(blocks, found).select("type", "text", "ord"), "type string, text string, ord int", [("text", "first", 0), ("text", "a lost paragraph of words", 1), ("text", "second", 2), ("illegible", "", 3), ("signature", "", 4), ("stamp", "SEAL", 5)])
C.many("src18_response_contract", {"tasks": ("batch string, id string", [("a", "1"), ("a", "2"), ("b", "1"), ("c", "1"), ("d", "1"), ("e", "1")]), "items": ("batch string, id string, text string", [("a", "1", "اردو"), ("a", "2", "متن"), ("b", "1", "اردو"), ("b", "1", "اردو"), ("c", "1", "latin"), ("e", "1", "اردو"), ("e", "7", "اردو")])},
       P.checked_responses, "batch string, problem string", [("a", None), ("b", "duplicated id: 1"), ("c", "no Urdu text: 1"), ("d", "omitted id: 1"), ("e", "unknown id: 7")])
C.many("src19_two_readings", {"crops": ("id string, first string, second string, width int, height int", [("a", "یہ عدالت عالیہ", "یہ عدالت عالیہ", 200, 100), ("b", "یہ عدالت عالیہ", "کوئی اور متن", 200, 100), ("c", "latin words", "latin words", 200, 100), ("d", "یہ عدالت عالیہ", "یہ عدالت عالیہ", 10, 10), ("e", None, "یہ", 200, 100)])},
       lambda crops: P.two_readings(crops).select("id", "accepted"), "id string, accepted boolean", [("a", True), ("b", False), ("c", False), ("d", False), ("e", False)])

_REASON = [(_glyph + "abc", ["Times"], "private_use_glyphs"), ("اردو", ["Jameel Noori"], "unreliable_font_encoding"), ("plain", ["Arial"], ""), ("", [], "")]
C.add("prj09_unreliable_text", "case_no int, text string, fonts array<string>", numbered([r[:2] for r in _REASON]), lambda df: df.select("case_no", F.array_join(P.unreliable(F.col("text"), F.col("fonts")), "+").alias("reasons")), "case_no int, reasons string", numbered([r[2] for r in _REASON]))
_SENT = [("CNIC 35202-1234567-1 of", "cnic"), ("call 0300-1234567 or +92 300 1234567", "phone"), ("the post-mortem of the victim", "medical+victim"), ("فرانزک رپورٹ", "medical"), ("متاثرہ لڑکی", "victim"), ("no 10300-1234567", ""), (None, "")]
C.add("prj08_sensitive_patterns", "case_no int, text string", numbered([s[0] for s in _SENT]), lambda df: df.select("case_no", F.array_join(P.sensitive(F.coalesce("text", F.lit(""))), "+").alias("found")), "case_no int, found string", numbered([s[1] for s in _SENT]))
C.add("prj08_policy_reach", "policy string, ceiling string", [(a, b) for a in P.POLICY for b in P.POLICY], lambda df: df.select("policy", "ceiling", P.may_send(F.col("policy"), F.col("ceiling")).alias("may")), "policy string, ceiling string, may boolean",
      [("local", "local", True), ("local", "self_hosted", True), ("local", "third_party", True), ("self_hosted", "local", False), ("self_hosted", "self_hosted", True), ("self_hosted", "third_party", True), ("third_party", "local", False), ("third_party", "self_hosted", False), ("third_party", "third_party", True)])
C.add("prj12_cell_positions", "table_id string, cells array<string>, rows array<array<string>>", [("t", ["a", "b", "c"], [["a", "b"], ["c"]]), ("u", ["a"], [["a", "b"]])], lambda df: P.cell_positions(df).select("table_id", "cell", "row", "column"), "table_id string, cell string, row int, column int", [("t", "a", 0, 0), ("t", "b", 0, 1), ("t", "c", 1, 0)])
C.add("prj13_names_a_court", _B, [("a", 1, 0, "ORDER SHEET"), ("a", 1, 1, "IN THE LAHORE HIGH COURT, LAHORE"), ("b", 1, 0, "This licence is issued subject to what the High Court may say of it"), ("c", 1, 4, "JUDICIAL DEPARTMENT"), ("c", 1, 0, "a"), ("c", 1, 1, "b"), ("c", 1, 2, "c"), ("c", 1, 3, "d"), ("d", 2, 0, "Court of the Civil Judge"), ("e", 1, 0, None)],
      P.names_a_court, "document_id string, court boolean", [("a", True), ("b", False), ("c", False), ("d", True), ("e", False)])
_SP = "array<struct<text:string,bold:boolean,underline:boolean>>"
C.add("prj14_heading_block", f"case_no int, type string, spans {_SP}", [(0, "heading", []), (1, "text", [(" ", False, False), ("5.", True, False)]), (2, "text", [("a", False, False), ("b", False, False), ("c", False, False), ("d", True, False)]), (3, "text", [("x", False, True)])],
      lambda df: df.select("case_no", P.is_heading_block(F.col("type"), F.col("spans")).alias("heading")), "case_no int, heading boolean", [(0, True), (1, True), (2, False), (3, True)])
_NOTE = [("1Subs. by Act X of 1999, s. 2", True), ("12 For Statement of Objects and Reasons, see Gazette", True), ("3 The words omitted by Ord. 5", True), ("12. Power to make rules", False), ("1999 it was added by the Act", False), ("4 The Court may act", False)]
C.add("prj20_amendment_footnote", "case_no int, text string", numbered([n[0] for n in _NOTE]), lambda df: df.select("case_no", P.amendment_footnote(F.col("text")).alias("note")), "case_no int, note boolean", numbered([n[1] for n in _NOTE]))
_ROLE = [("For the Petitioner(s):", "petitioner s", True), ("Respondents by: Mr. A", None, True), ("State by", "state", False), ("Date of hearing: 1.1.2001", None, True), ("The state of affairs by which the appellants were led to file: this", None, False), (None, None, False)]
C.add("prj23_cover_label", "case_no int, text string", numbered([r[0] for r in _ROLE]), lambda df: df.select("case_no", P.counsel_role(F.col("text")).alias("role"), F.coalesce(P.is_cover_label(F.col("text")), F.lit(False)).alias("label")), "case_no int, role string, label boolean", numbered([r[1:] for r in _ROLE]))

_N = f"document_id string, page int, ord int, text string, bbox {BOX}, size double, visible_size double, width double, height double, median_size double"
_NB = [("d", p, 0, f"Case {p} of 2001", [50.0, 20.0, 150.0, 30.0], 10.0, 10.0, 600.0, 800.0, 12.0) for p in (1, 2)] + [("d", 1, 1, "- 1 -", [290.0, 780.0, 310.0, 790.0], 10.0, 10.0, 600.0, 800.0, 12.0), ("d", 1, 2, "IN THE HIGH COURT", [200.0, 100.0, 400.0, 120.0], 13.0, 13.0, 600.0, 800.0, 12.0),
      ("d", 1, 3, "1. The appellant", [50.0, 200.0, 550.0, 230.0], 12.0, 12.0, 600.0, 800.0, 12.0), ("d", 1, 4, "1Subs. by Act V of 1990", [50.0, 700.0, 300.0, 710.0], 8.0, 8.0, 600.0, 800.0, 12.0), ("d", 1, 5, "Ordinary words of the body", [50.0, 300.0, 550.0, 330.0], 12.0, 12.0, 600.0, 800.0, 12.0),
      ("d", 1, 6, "cell words", [60.0, 410.0, 100.0, 420.0], 12.0, 12.0, 600.0, 800.0, 12.0), ("d", 1, 7, "Large title", [50.0, 150.0, 200.0, 170.0], 15.0, 15.0, 600.0, 800.0, 12.0), ("d", 2, 1, "7", [290.0, 40.0, 300.0, 50.0], 10.0, 10.0, 600.0, 800.0, 12.0)]
C.many("prj21_block_typing", {"blocks": (_N, _NB), "tables": (f"document_id string, page int, bbox {BOX}", [("d", 1, [50.0, 400.0, 500.0, 500.0])])}, lambda blocks, tables: P.typed_native(blocks, tables), "document_id string, page int, ord int, kind string, score double",
       [("d", 1, 0, "header", 0.96), ("d", 2, 0, "header", 0.96), ("d", 1, 1, "footer", 0.88), ("d", 1, 2, "heading", 0.89), ("d", 1, 3, "list", 0.93), ("d", 1, 4, "footnote", 0.9), ("d", 1, 5, "text", 0.88), ("d", 1, 6, "table_text_omitted", 0.99), ("d", 1, 7, "heading", 0.89), ("d", 2, 1, "header", 0.82)])
_S = f"document_id string, page int, ord int, text string, bbox {BOX}, width double, height double"
C.add("prj22_scanned_typing", _S, [("d", 1, 0, "BLUE'SLIP", [250.0, 300.0, 350.0, 320.0], 600.0, 800.0), ("d", 2, 0, "BLUE SLIP", [50.0, 300.0, 90.0, 320.0], 600.0, 800.0), ("d", 2, 1, "Judgment Sheet", [50.0, 50.0, 90.0, 60.0], 600.0, 800.0), ("d", 2, 2, "12", [50.0, 700.0, 90.0, 710.0], 600.0, 800.0), ("d", 2, 3, "- item", [50.0, 400.0, 90.0, 410.0], 600.0, 800.0), ("d", 2, 4, "words", [50.0, 500.0, 90.0, 510.0], 600.0, 800.0)],
      P.typed_scanned, "document_id string, page int, ord int, kind string, blue_slip boolean", [("d", 1, 0, "heading", True), ("d", 2, 0, "text", False), ("d", 2, 1, "header", False), ("d", 2, 2, "footer", False), ("d", 2, 3, "list", False), ("d", 2, 4, "text", False)])
C.add("ag18_running_bands", f"document_id string, page int, text string, bbox {BOX}, height double", [("d", 1, "W.P. 5 of 2001", [0.0, 10.0, 9.0, 20.0], 800.0), ("d", 2, "W.P. 6 of 2002", [0.0, 120.0, 9.0, 130.0], 800.0), ("d", 1, "Foot", [0.0, 700.0, 9.0, 710.0], 800.0), ("d", 2, "Foot", [0.0, 10.0, 9.0, 20.0], 800.0), ("d", 1, "12", [0.0, 10.0, 9.0, 20.0], 800.0), ("d", 2, "13", [0.0, 10.0, 9.0, 20.0], 800.0)],
      P.repeated_bands, "document_id string, band string, key string", [("d", "top", "w.p. # of #")])
C.add("wn09_footnote_run", f"document_id string, page int, ord int, type string, bbox {BOX}, visible_size double, median_size double, height double", [("d", 1, 0, "text", [0.0, 100.0, 9.0, 110.0], 8.0, 12.0, 800.0), ("d", 1, 1, "footnote", [0.0, 600.0, 9.0, 610.0], 8.0, 12.0, 800.0), ("d", 1, 2, "text", [0.0, 620.0, 9.0, 630.0], 8.0, 12.0, 800.0), ("d", 1, 3, "list", [0.0, 640.0, 9.0, 650.0], 9.0, 12.0, 800.0), ("d", 1, 4, "text", [0.0, 660.0, 9.0, 670.0], 12.0, 12.0, 800.0), ("d", 1, 5, "text", [0.0, 680.0, 9.0, 690.0], 8.0, 12.0, 800.0)],
      P.carried_footnotes, "document_id string, page int, ord int, kind string", [("d", 1, 0, "text"), ("d", 1, 1, "footnote"), ("d", 1, 2, "footnote"), ("d", 1, 3, "footnote"), ("d", 1, 4, "text"), ("d", 1, 5, "text")])
_O = f"document_id string, page int, block_id string, type string, bbox {BOX}, width double, height double"
_TWO = [("d", 1, f"l{i}", "text", [50.0, 100.0 + 150 * i, 280.0, 200.0 + 150 * i], 600.0, 800.0) for i in range(3)] + [("d", 1, f"r{i}", "text", [320.0, 90.0 + 150 * i, 550.0, 190.0 + 150 * i], 600.0, 800.0) for i in range(3)] + [("d", 1, "t", "heading", [50.0, 20.0, 560.0, 40.0], 600.0, 800.0)]
_ROW = [("e", 1, "b", "text", [300.0, 100.2, 400.0, 110.0], 600.0, 800.0), ("e", 1, "a", "text", [50.0, 100.4, 150.0, 110.0], 600.0, 800.0), ("e", 1, "c", "text", [50.0, 120.0, 150.0, 130.0], 600.0, 800.0)]
C.add("wn11_reading_order", _O, _TWO + _ROW, P.reading_order, "document_id string, page int, block_id string, ord int", [("d", 1, "t", 0)] + [("d", 1, f"l{i}", 1 + i) for i in range(3)] + [("d", 1, f"r{i}", 4 + i) for i in range(3)] + [("e", 1, "a", 0), ("e", 1, "b", 1), ("e", 1, "c", 2)])
C.many("jn17_table_cover", {"blocks": (f"document_id string, page int, block_id string, bbox {BOX}", [("d", 1, "in", [10.0, 10.0, 20.0, 20.0]), ("d", 1, "edge", [0.0, 0.0, 10.0, 10.0]), ("d", 1, "half", [45.0, 10.0, 55.0, 20.0]), ("d", 2, "other", [10.0, 10.0, 20.0, 20.0])]), "tables": (f"document_id string, page int, bbox {BOX}", [("d", 1, [9.0, 9.0, 50.0, 50.0])])},
       lambda blocks, tables: P.outside_tables(blocks, tables).select("page", "block_id"), "page int, block_id string", [(1, "edge"), (2, "other")])
_M = f"document_id string, page int, ord int, bbox {BOX}"
_PRED = (_M, [("d", 1, 0, [0.0, 0.0, 10.0, 10.0]), ("d", 1, 1, [0.0, 20.0, 10.0, 30.0]), ("d", 1, 2, [0.0, 1.0, 10.0, 11.0]), ("d", 2, 0, [0.0, 0.0, 1.0, 1.0])])
_GOLD = (_M, [("d", 1, 0, [0.0, 20.0, 10.0, 30.0]), ("d", 1, 1, [0.0, 0.0, 10.0, 10.0]), ("d", 3, 0, [0.0, 0.0, 1.0, 1.0])])
C.many("jn18_box_matching", {"predicted": _PRED, "gold": _GOLD}, P.matched_boxes, "document_id string, page int, p int, q int, iou double", [("d", 1, 0, 1, 1.0), ("d", 1, 1, 0, 1.0)])
C.many("ag22_layout_scores", {"predicted": _PRED, "gold": _GOLD}, lambda predicted, gold: P.layout_scores(predicted, gold).select("page", F.round("precision", 4).alias("precision"), "recall", F.round("f1", 4).alias("f1"), "mean_iou", "tau"), "page int, precision double, recall double, f1 double, mean_iou double, tau double",
       [(1, 0.6667, 1.0, 0.8, 1.0, -1.0), (2, 0.0, 0.0, 0.0, None, None), (3, 0.0, 0.0, 0.0, None, None)])
C.add("ag22_layout_gate", "f1 double, mean_iou double, tau double", [(0.95, 0.9, 1.0), (0.93, None, None)], P.layout_gate, "f1 double, mean_iou double, tau double, passes_gate boolean", [(0.94, 0.9, 1.0, True)])
_Q = ("id string, quote_no int, quote string", [("t", 1, "two  three"), ("t", 2, "Two three"), ("t", 3, ""), ("t", 4, "one (a)")])
C.many("jn20_quote_grounding", {"texts": ("id string, text string", [("t", "one two\nthree, two three one (a)")]), "quotes": _Q}, P.located, "id string, quote_no int, char_start int, char_end int", [("t", 1, 4, 13), ("t", 1, 15, 24), ("t", 4, 25, 32)])
_BL = ("document_id string, page int, ord int, block_id string, text string", [("d", 1, 0, "a", "The appeal is allowed with costs."), ("d", 1, 1, "b", "It was decided on 3rd May, 2001 by the Court"), ("d", 2, 0, "c", "The appeal is allowed with costs.")])
C.many("jn20_fuzzy_grounding", {"blocks": _BL, "quotes": ("document_id string, quote_no int, quote string", [("d", 1, "appeal is ‘allowed’ with costs"), ("d", 2, "decided on 3rd May 2001"), ("d", 3, "something quite different here"), ("d", 4, "by"), ("d", 5, "appeal is allowcd with costs")])},
       lambda blocks, quotes: P.grounded(blocks, quotes).select("quote_no", "page", "block_id"), "quote_no int, page int, block_id string", [(2, 1, "b"), (5, 1, "a"), (1, 1, "a")])
C.many("jn21_evidence_check", {"answers": ("document_id string, answer_no int, value string, quote string", [("d", 1, "allowed", "The appeal is allowed"), ("d", 2, "dismissed", "The appeal is allowed"), ("d", 3, "x", "never printed anywhere at all"), ("d", 4, None, "The appeal"), ("d", 5, "y", "")]), "blocks": _BL}, P.confirmed,
       "answer_no int, status string, why string", [(1, "confirmed", None), (2, "rejected", "value_not_in_quote"), (3, "rejected", "quote_not_found"), (4, "not_found", None), (5, "not_found", None)])
C.add("ag20_bbox_validator", f"document_id string, bbox {BOX}, width double, height double", [("d", [0.0, 0.0, 9.0, 9.0], 10.0, 10.0), ("d", [0.0, 0.0, 13.0, 9.0], 10.0, 10.0), ("d", [5.0, 5.0, 5.0, 9.0], 10.0, 10.0), ("d", [1.0], 10.0, 10.0), ("e", [-1.0, 0.0, 11.0, 9.0], 10.0, 10.0)], P.box_check, "document_id string, score double", [("d", 0.25), ("e", 1.0)])
C.add("ag20_table_validator", "table_id string, rows array<array<string>>, cell_boxes int", [("a", [["1", "2"], ["3", "4"]], 4), ("b", [["1", "2"], ["3"]], 3), ("c", [["1", ""], ["", ""]], 0), ("d", [], 0)], lambda df: P.table_check(df).select("table_id", F.array_join("issues", "+").alias("issues")), "table_id string, issues string",
      [("a", ""), ("b", "ragged_rows"), ("c", "empty_cells+missing_cell_bboxes"), ("d", "ragged_rows+empty_cells+missing_cell_bboxes")])
C.add("ag20_continuity_validator", "document_id string, page int, ord int, text string, char_start int, char_end int", [("d", 1, 0, "A paragraph of some length", 0, 26), ("d", 1, 1, "a  paragraph of some LENGTH", 27, 54), ("d", 1, 2, "back", 10, 14), ("d", 1, 3, " ", 0, 1), ("d", 2, 0, "next page", None, None)], P.continuity_check, "document_id string, score double, duplicates int", [("d", 0.75, 1)])
C.add("ag20_metadata_validator", "document_id string, court string, case_number string, decision_date string, parties string, sourced array<string>", [("a", "c", "n", "d", "p", ["court", "case_number", "decision_date", "parties"]), ("b", "c", None, "", "p", ["court"]), ("c", None, None, None, None, [])], P.metadata_check, "document_id string, score double", [("a", 1.0), ("b", 0.375), ("c", 0.0)])
C.add("wn02_order_validator", "document_id string, page int, ord int, document_order int", [("a", 1, 0, 0), ("a", 1, 1, 1), ("a", 2, 0, 2), ("b", 1, 0, 0), ("b", 1, 2, 1), ("b", 2, 0, 3)], P.order_check, "document_id string, score double", [("a", 1.0), ("b", 0.3333)])
_NUM = f"document_id string, page int, ord int, type string, text string, bbox {BOX}, size double"
C.add("wn01_numbering_validator", _NUM, [("d", 1, i, "text", f"{n}. The", [50.0, 0.0, 1.0, 1.0], 12.0) for i, n in enumerate((1, 2, 4, 4, 1, 2))] + [("d", 1, 9, "text", "7. Quoted", [90.0, 0.0, 1.0, 1.0], 10.0), ("d", 1, 10, "header", "9. Head", [50.0, 0.0, 1.0, 1.0], 12.0), ("d", 1, 11, "text", "311. Section", [50.0, 0.0, 1.0, 1.0], 12.0)],
      P.numbering_check, "document_id string, score double, gaps int, regressions int", [("d", 0.5, 1, 1)])
_GT = [("Court: X\nCase No: 5\nThe  words\nhere", "The words here"), ("[TABLE]\na | b\n[/TABLE] end", "a | b end"), (_glyph + "x", "x")]
C.add("fn46_gold_text", "case_no int, text string", numbered([g[0] for g in _GT]), lambda df: df.select("case_no", P.gold_text(F.col("text")).alias("plain")), "case_no int, plain string", numbered([g[1] for g in _GT]))
C.add("ag14_text_fidelity", "gold string, native string, predicted string", [("the words here", "the words here", "the words here"), ("the words here", "the words here!", "the word here"), ("the words here", "", "thc words"), ("[TABLE]\na | b\n[/TABLE]", "a | b", "a | b"), ("یہ اردو متن ہے", "یہ اردو متن ہے", "")], P.text_fidelity,
      "slice string, pages int, cer_mean double, cer_median double, wer_mean double, exact int", [("regression", 1, 0.0, 0.0, 0.0, 1), ("text_edit", 1, 0.0714, 0.0714, 0.3333, 0), ("scanned", 1, 0.4286, 0.4286, 0.6667, 0), ("table", 1, 0.0, 0.0, 0.0, 1), ("urdu", 1, 1.0, 1.0, 1.0, 0)])
C.add("ag15_table_scoring", "gold_cells array<string>, predicted_cells array<string>, gold_columns int, predicted_columns int, predicted_tables int, form_headers int", [(["a", "b"], ["a"], 2, 2, 1, 0), (["c", "d"], ["c", "d"], 2, 3, 1, 0), (["Order / proceeding"], [], 3, 0, 0, 1), ([], ["x"], 0, 1, 1, 0), ([], [], 0, 0, 0, 0)], P.table_scores,
      "kind string, pages int, detected int, column_count_match int, cell_recall_mean double", [("cover", 2, 2, 1, 0.75), ("order_sheet", 1, 1, 0, 0.0), ("none", 2, 1, 1, None)])
_FIX = [("INTHE", "IN THE"), ("JUDICIAL DEPARTMENT", "JUDICIAL DEPARTMENT"), ("café  x​y", "café xy"), (None, ""), ("order of thecourt", "ORDER OF THE COURT")]
C.add("fn48_text_correction", "case_no int, text string", numbered([f[0] for f in _FIX]), lambda df: df.select("case_no", P.corrected(F.col("text")).alias("fixed")), "case_no int, fixed string", numbered([f[1] for f in _FIX]))
_FACT = [("**Bold** and __this__\n## Head", True, "Bold and this\nHead", "en"), ("**Bold**", False, "**Bold**", "en"), ("یہ متن a", True, "یہ متن a", "ur")]
C.add("fn44_facts_text", "case_no int, text string, ocr boolean", numbered([f[:2] for f in _FACT]), lambda df: df.select("case_no", P.fact_text(F.col("text"), F.col("ocr")).alias("plain"), P.language_shares(F.col("text"))["language"].alias("language")), "case_no int, plain string, language string", numbered([f[2:] for f in _FACT]))
_PN = [("Page 12 of 30", None, "12"), ("text", "- 7 -", "7"), ("5 The Court", "x", "5"), ("none", None, None)]
C.add("src35_printed_page_number", "case_no int, head string, foot string", numbered([p[:2] for p in _PN]), lambda df: df.select("case_no", P.printed_number(F.col("head"), F.coalesce("foot", F.lit(""))).alias("number")), "case_no int, number string", numbered([p[2] for p in _PN]))

_FILE = "document_id string, page int, text string"
C.add("wn12_page_segmentation", _FILE, [("f", 1, "JUDGMENT SHEET\nA versus B. The appeal is dismissed."), ("f", 2, "judgment continued"), ("f", 3, "AFFIDAVIT\nI, the deponent, do solemnly affirm"), ("f", 4, "nothing here"), ("g", 1, None)],
      lambda df: segments(df).select("document_id", "first_page", "last_page", "kind"), "document_id string, first_page int, last_page int, kind string", [("f", 1, 2, "judgment"), ("f", 3, 4, "affidavit"), ("g", 1, 1, "unknown")])
_KINDS = [("FIRST INFORMATION REPORT under section 154 at Police Station X", "fir", 1.0), ("JUDGMENT\nA versus B. The petition stands dismissed.", "judgment", 1.0), ("Dear Sir, our ref: 5. Yours faithfully", "letter", 1.0), ("x" * 500 + " judgment versus", "unknown", 0.0), ("AFFIDAVIT in the writ petition", "pleading", 0.5), ("", "unknown", 0.0)]
C.add("fn40_kind_cases", "case_no int, text string", numbered([k[0] for k in _KINDS]), lambda df: df.select("case_no", kind(F.col("text")).alias("k")).select("case_no", "k.kind", "k.confidence"), "case_no int, kind string, confidence double", numbered([k[1:] for k in _KINDS]))

# whole tables
C.table("ag18_paras_bands", lambda spark, d: P.repeated_bands(load(spark, d, "paras").filter("text IS NOT NULL").withColumn("height", F.lit(842.0))),
        """SELECT document_id, band, key FROM (SELECT DISTINCT document_id, page, trim(regexp_replace(regexp_replace(lower(text), '[0-9]+', '#', 'g'), '\\s+', ' ', 'g')) AS key,
          unnest(list_filter([CASE WHEN bbox[2] <= 842.0 * 0.16 THEN 'top' END, CASE WHEN bbox[4] >= 842.0 * 0.84 THEN 'bottom' END], lambda b: b IS NOT NULL)) AS band FROM paras WHERE text IS NOT NULL)
        WHERE length(key) >= 3 GROUP BY document_id, band, key HAVING count(DISTINCT page) > 1""")  # fmt: skip
