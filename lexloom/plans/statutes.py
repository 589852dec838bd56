"""Queries of statute structure over literal statutes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.operators import statutes as S
from lexloom.plans.cases import Cases
from lexloom.plans.legal import numbered

C = Cases()
QUERIES, SQL = C.queries, C.sql

_B = "document_id string, page int, ord int, block_id string, type string, text string, heading boolean"
_ACT = ("CONTENTS", "1. Short title", "2. Definitions", "SCHEDULE", "ACT No. XII OF 1990", "WHEREAS it is expedient", "1. Short title.— This Act may be called so.", "(2) It extends to all.", "CHAPTER I GENERAL", "2. Definitions.— In this Act words mean things.", "1Subs. by Act V of 1999, s. 2.",
        "PART I First", "3", "Establishment of the board.- There shall be one.", "4. Powers.—The board may act.", "THE FIRST SCHEDULE (See section 4)", "1. Item of the schedule", "ORDER IV PLEADINGS", "2. Another item", "CHAPTER II of this Act applies", "PAGE 9")
_HEADS = {1, 2, 6, 9, 13, 14, 16, 18}
_ROWS = [("d", 1 + i // 8, i, f"b{i}", "footer" if t == "PAGE 9" else "text", t, i in _HEADS) for i, t in enumerate(_ACT)]
_M = "document_id string, ord int, kind string, number string, title string"
_FOUND = [("d", 1, "section", "1", "Short title"), ("d", 2, "definitions", "2", "Definitions"), ("d", 3, "schedule", None, "SCHEDULE"), ("d", 6, "section", "1", "Short title"), ("d", 8, "chapter", "I", "GENERAL"), ("d", 9, "definitions", "2", "Definitions"), ("d", 11, "part", "I", "First"),
          ("d", 14, "section", "4", "Powers"), ("d", 15, "schedule", None, "THE FIRST SCHEDULE (See section 4)"), ("d", 16, "schedule_item", "1", "Item of the schedule"), ("d", 17, "order", "IV", "PLEADINGS"), ("d", 18, "schedule_item", "2", "Another item")]
# the first SCHEDULE of the contents comes after markers 1 and 2 of the contents, so it opens items too: contents are dropped first
_BODY = [r for i, r in enumerate(_ROWS) if i > 3]
C.add("wn07_structure_detection", _B, _BODY, S.markers, _M, [r for r in _FOUND if r[1] > 3])
C.many("wn06_body_start", {"blocks": (_B, _ROWS), "marks": (_M, [r for r in _FOUND if r[2] in ("section", "definitions")])}, S.body_starts, "document_id string, start int", [("d", 5)])
C.many("wn06_contents_dropped", {"marks": (_M, [r for r in _FOUND if r[2] in ("section", "definitions")] + [("d", 0, "section", "9", "Only in the contents")]), "starts": ("document_id string, start int", [("d", 5)])}, lambda marks, starts: S.without_contents(marks, starts).select("ord", "number"), "ord int, number string",
       [(0, "9"), (6, "1"), (9, "2"), (14, "4")])


def runs(*numbers: str) -> list[tuple]:
    return [("d", i, "section", n, "T") for i, n in enumerate(numbers)]


for _i, (_printed, _read) in enumerate([(("24", "125", "26"), ("24", "25", "26")), (("124", "125", "126"), ("124", "125", "126")), (("20", "2l", "22"), ("20", "21", "22")), (("9", "1O", "11"), ("9", "10", "11")), (("9", "1990", "10"), ("9", "10")), (("21I", "22"), ("21I", "22")), (("1", "2", "1", "2"), ("1", "2", "1", "2"))]):
    C.add(f"wn05_number_run_{_i}", _M, runs(*_printed), lambda df: S.read_numbers(df).select("ord", "number"), "ord int, number string", [(k, r) for k, r in zip([i for i in range(len(_printed)) if _printed[i] != "1990"], _read)])
C.add("wn04_back_references", _M, runs("125", "127", "126", "126", "128", "90") + [("e", 0, "section", "1", "x"), ("e", 1, "section", "5", "x"), ("e", 2, "section", "1", "x"), ("e", 3, "section", "5", "x"), ("d", 9, "chapter", "1", "c")], lambda df: S.without_back_references(df).select("document_id", "ord", "number"), "document_id string, ord int, number string",
      [("d", 0, "125"), ("d", 1, "127"), ("d", 2, "126"), ("d", 4, "128"), ("d", 5, "90"), ("d", 9, "1"), ("e", 0, "1"), ("e", 1, "5"), ("e", 2, "1"), ("e", 3, "5")])
C.add("jn23_section_sequence", _M, runs("1", "2", "2A", "5") + [("e", 0, "section", "1", "x"), ("e", 1, "section", "1", "x"), ("e", 2, "section", "3", "x"), ("f", 0, "definitions", "1", "x"), ("f", 1, "schedule_item", "9", "x")], S.missing_numbers, "document_id string, highest int, missing array<int>, complete boolean",
      [("d", 5, [3, 4], False), ("e", 3, [], None), ("f", 1, [], True)])
C.many("jn24_recovered_sections", {"blocks": (_B, _BODY), "marks": (_M, [r for r in _FOUND if r[1] > 3 and r[2] in ("section", "definitions")])}, S.recovered_sections, _M, [("d", 12, "section", "3", "Establishment of the board")])
C.many("wn08_section_bodies", {"blocks": (_B, _BODY), "marks": (_M, [r for r in _FOUND if r[1] > 3] + [("d", 12, "section", "3", "Establishment of the board")])}, lambda blocks, marks: S.section_bodies(blocks, marks).select("number", "heading", "chapter", "part", "text", "block_ids"),
       "number string, heading string, chapter string, part string, text string, block_ids array<string>",
       [("1", "Short title", None, None, "Short title.— This Act may be called so. (2) It extends to all.", ["b6", "b7"]), ("2", "Definitions", "I", None, "Definitions.— In this Act words mean things.", ["b9"]),
        ("3", "3 Establishment of the board", "I", "I", "3 Establishment of the board.- There shall be one.", ["b12", "b13"]), ("4", "Powers", "I", "I", "Powers.—The board may act.", ["b14"])])
_HEADINGS = [("Short title.— This Act", "Short title"), ("Powers. The board", "Powers"), ("Savings.-Nothing", "Savings"), ("Plain title", "Plain title"), ("Fees -- of court", "Fees")]
C.add("fn39_heading_title", "case_no int, text string", numbered([h[0] for h in _HEADINGS]), lambda df: df.select("case_no", S.heading_title(F.col("text")).alias("title")), "case_no int, title string", numbered([h[1] for h in _HEADINGS]))
C.add("fn38_statute_metadata", "document_id string, text string", [("a", "THE STAMP ACT, 1899\nACT No. II OF 1899\n[27th January, 1899]\nAn Act to consolidate the law\nWHEREAS it is"), ("b", "THIS LAW HAS BEEN REPEALED"), ("c", "no statute at all")], S.statute_metadata,
      "document_id string, title string, commencement string, long_title string, preamble boolean, repealed boolean, act_number string, act_number_value int, act_year int",
      [("a", "THE STAMP ACT, 1899", "27th January, 1899", "An Act to consolidate the law", True, False, "ACT No. II OF 1899", 2, 1899), ("b", None, None, None, False, True, None, None, None), ("c", None, None, None, False, False, None, None, None)])
