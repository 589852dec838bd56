"""Printed law report citations: their spans, identifiers, case names and parallel groups."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Series | name | jurisdiction | whether its pages run by court | spellings.
SERIES_TABLE = """
SCMR | Supreme Court Monthly Review | PK | | SCMR; S.C.M.R.
PLD | All Pakistan Legal Decisions | PK | court | PLD; P.L.D.
CLC | Civil Law Cases | PK | | CLC
YLR | Yearly Law Reporter | PK | | YLR
MLD | Monthly Law Digest | PK | | MLD
PTD | Pakistan Tax Decisions | PK | | PTD
PCrLJ | Pakistan Criminal Law Journal | PK | | PCrLJ; P.Cr.L.J.; PCr.LJ; P.Cr.LJ; PCr.L.J.
PLC(CS) | Pakistan Labour Cases (Civil Services) | PK | | PLC (C.S.); PLC (CS); PLC (C.S); PLC(CS); PLC C.S.
PLC | Pakistan Labour Cases | PK | | PLC
CLD | Corporate Law Decisions | PK | | CLD
PLJ | Pakistan Law Journal | PK | court | PLJ
NLR | National Law Reporter | PK | court | NLR
KLR | Karachi Law Reporter | PK | court | KLR
LHC | Lahore High Court neutral citation | PK | | LHC
PHC | Peshawar High Court neutral citation | PK | | PHC
SCC | Supreme Court Cases (India) | IN | | Supreme Court Cases; SCC
SCCONLINE | SCC OnLine (India) | IN | court | SCC Online; SCC OnLine
AIR | All India Reporter | IN | court | AIR
CRILJ | Criminal Law Journal (India) | IN | | CriLJ; Cri.L.J.
AC | Appeal Cases (England) | UK | | AC; A.C.
"""
# Court | its spellings inside a citation.
COURT_TABLE = """
SC | SC; S.C.; S C; Supreme Court; SC (Pak.); SC (Pak); SC(Pak); S.C. (Pak.)
Lahore | Lahore; Lah.; Lah; (W.P.) Lahore; W.P. Lahore
Karachi | Karachi; Kar.; Kar; (W.P.) Karachi; W.P. Karachi
Sindh | Sindh; Sind
Islamabad | Islamabad; Isl.; Isb
Peshawar | Peshawar; Pesh.; Pesh
Quetta | Quetta; Quet.
Baluchistan | Baluchistan; Balochistan; BJ
West Pakistan | West Pakistan; W.P.; (W.P.)
Tax Cases | Tax Cases (Kar.); Tax Cases; Trib
Cr.C. | Cr.C. (Lahore); Cr.C.
FSC | FSC; Federal Shariat Court; F.S.C.
FC | FC; Federal Court; F.C.
AJ&K | AJ&K; AJK; Azad J&K
Privy Council | Privy Council; PC; P.C.
Dacca | Dacca; Dhaka
Karachi High Court | Karachi High Court
Mad | Mad; Madras
All | All; Allahabad
P&H | P&H; Punjab and Haryana
Ker | Ker; Kerala
Del | Del; Delhi
Bom | Bom; Bombay
Cal | Cal; Calcutta
Patna | Patna
"""


def _rows(table: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split("|")] for line in table.strip().split("\n")]


def _marks(spelling: str, keep: str) -> str:
    return "".join(ch for ch in spelling.lower() if ch.isalnum() or ch in keep)


SERIES = {r[0]: {"name": r[1], "jurisdiction": r[2], "by_court": r[3] == "court", "spelt": [s.strip() for s in r[4].split(";")]} for r in _rows(SERIES_TABLE)}
SERIES_OF = {_marks(s, "()&"): key for key, row in reversed(SERIES.items()) for s in row["spelt"]}
COURT_OF = {_marks(s.strip(), "&"): r[0] for r in reversed(_rows(COURT_TABLE)) for s in r[1].split(";")}
NEUTRAL = ("LHC", "PHC")


def _any_of(spellings: list[str]) -> str:
    """One alternation: the letters, brackets and ampersands of each spelling, dots and blanks allowed between, longest first."""
    loose = {regex.escape(s[0]) + "".join(r"[.\s]*" + regex.escape(c) for c in s[1:]): len(s) for s in ("".join(c for c in x if c.isalnum() or c in "()&") for x in sorted(spellings, key=len))}
    return "(?:" + "|".join(sorted(loose, key=lambda p: -loose[p])) + ")"


_Y = r"(?:\[(?P<year>1[89]\d\d|20\d\d)\]|\((?P<year>1[89]\d\d|20\d\d)\)|(?P<year>1[89]\d\d|20\d\d))"
_COURT = rf"(?P<court>{_any_of([s.strip() for r in _rows(COURT_TABLE) for s in r[1].split(';')])})"
_BOXED = rf"(?:\[\s*{_COURT}\s*\]|\(\s*{_COURT}\s*\))"
_RUNS_BY_COURT = rf"(?P<series>{_any_of([s for r in SERIES.values() if r['by_court'] for s in r['spelt']])})"
_RUNS_ON = rf"(?P<series>{_any_of([s for r in SERIES.values() if not r['by_court'] for s in r['spelt']])})"
# series, year and court before the page, the court being part of the citation; else year, volume, series, note, with the court
# a mere annotation before or behind the page
_GRAMMAR = regex.compile(
    rf"(?<![\w/-])(?:{_RUNS_BY_COURT}\s*[.,]?\s*{_Y}|{_Y}\s*{_RUNS_BY_COURT})\s*(?:{_BOXED}|{_COURT})\s*[.,]?\s*(?P<page>\d{{1,5}})(?![\d/-])"
    rf"|(?<![\w/-]){_Y}\s*(?:(?P<volume>\d{{1,3}})\s+)?{_RUNS_ON}(?P<note>\s*[-(]?\s*(?:Notes?|N)\s*\)?)?(?:\s*{_BOXED})?\s*[.,]?\s*(?P<page>\d{{1,5}})(?![\d/])(?!-\d)"
    rf"(?:\s*(?:{_BOXED}|-\s*{_COURT}\b(?!\s+(?-i:[a-z]))))?",
    regex.I,
)


def citation_id(series: str, year: int, page: int, court: str | None = None, volume: int | None = None, note: bool = False) -> str:
    """SERIES YEAR COURT PAGE where the series numbers its pages by court, else YEAR [VOLUME] SERIES PAGE; -N for its notes."""
    key = series + "-N" * note
    if court and SERIES[series]["by_court"]:
        return f"{key} {year} {court} {page}"
    return " ".join(str(x) for x in (year, volume, key, page) if x)


def find_citations(text: str | None) -> list[dict]:
    """Each citation of a known series with its span, in reading order: start, end, id, series, jurisdiction, year, court, volume, page, text."""
    found = []
    for m in _GRAMMAR.finditer(text or ""):
        series = SERIES_OF.get(_marks(m["series"], "()&"))
        page = int(m["page"])
        if series is None or not page:
            continue
        note = bool(m["note"])
        court = COURT_OF.get(_marks(m["court"], "&")) if m["court"] else None
        volume = int(m["volume"]) if m["volume"] else None
        found.append({"start": m.start(), "end": m.end(), "id": citation_id(series, int(m["year"]), page, court, volume, note), "series": series + "-N" * note,
                      "jurisdiction": SERIES[series]["jurisdiction"], "year": int(m["year"]), "court": court, "volume": volume, "page": page, "text": " ".join(m[0].split())})
    return found


def parallel_groups(text: str, found: list[dict] | None = None) -> list[list[str]]:
    """The ids printed as one case (A = B), groups of two or more."""
    found = find_citations(text) if found is None else found
    groups: list[list[str]] = []
    for k, c in enumerate(found):
        joined = k > 0 and regex.fullmatch(r"\s*[(\[]?\s*=\s*[(\[]?\s*", text[found[k - 1]["end"] : c["start"]])
        if joined:
            groups[-1].append(c["id"])
        else:
            groups.append([c["id"]])
    return [g for g in groups if len(g) > 1]


# What introduces a case name, and abbreviations whose stop ends no sentence.
_INTRO = regex.compile(
    r"(?:placed\s+reliance\s+(?:up)?on|reliance\s+(?:up)?on|reported\s+as|reported\s+in|case\s+of|cases\s+of|titled|tilted|in\s+re|relied\s+(?:up)?on|"
    r"reliance\s+(?:is|was|can\s+be|may\s+be)\s+placed\s+(?:up)?on|reference\s+(?:is|was|can\s+be|may\s+be)\s+made\s+to|referred\s+to|see|vide|cited\s+as|"
    r"judgments?\s+(?:of|in)|precedents?\s+(?:of|in)|in\s+the\s+cases?\s+of|followed\s+in|held\s+in|including|namely|i\.e\.|e\.g\.|\bin\b)\s*[:,]?\s*", regex.I)  # fmt: skip
_ABBREVIATED = regex.compile(r"\b(?:mst|m/s|messrs|no|dr|mr|ms|st|co|ltd|pvt|govt)\.\s$", regex.I)
_VERSUS = regex.compile(r"\s+(?:v\.?|vs\.?|versus)\s+", regex.I)
_QUOTES = "\"'‘’“”�"
NAME_WINDOW = 260


def _side(value: str) -> str:
    value = value.strip().strip(_QUOTES).strip(" ,;:-(")
    return " ".join(regex.sub(r"^(?:and|&|also)\s+", "", value, flags=regex.I).strip(_QUOTES + " ").split())


def case_name(text: str, start: int, after: int = 0) -> dict[str, str] | None:
    """The two sides printed right before a citation at `start`, not before `after`, the end of the citation before it."""
    before = text[max(after, start - NAME_WINDOW) : start].rstrip(" ([" + _QUOTES).rpartition(")")[2]
    *_, split = [None, *_VERSUS.finditer(before)]
    if split is None:
        return None
    left = before[: split.start()]
    cuts = [m.end() for m in _INTRO.finditer(left)]
    for stop in (". ", "; ", ": "):
        at = left.rfind(stop)
        if at >= 0 and not _ABBREVIATED.search(left[: at + 2]):
            cuts.append(at + 2)
    sides = _side(left[max(cuts, default=0) :]), _side(before[split.end() :])
    return {"petitioner": sides[0], "respondent": sides[1]} if all(2 <= len(s) <= 160 for s in sides) else None


def named_citations(text: str) -> tuple[list[dict], list[list[str]]]:
    """The citations of a text with petitioner and respondent where a name is printed (shared in a parallel group, first name
    of a citation kept), and its parallel groups."""
    found = find_citations(text)
    groups = parallel_groups(text, found)
    names: dict[str, dict] = {}
    end = 0
    for c in found:
        name = case_name(text, c["start"], end)
        end = c["end"]
        if name:
            names.setdefault(c["id"], name)
    for g in groups:
        shared = next((names[i] for i in g if i in names), None)
        for i in g if shared else ():
            names.setdefault(i, shared)
    return [c | names.get(c["id"], {"petitioner": None, "respondent": None}) for c in found], groups


_OUT = pa.schema([("key", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("id", pa.string()), ("series", pa.string()), ("jurisdiction", pa.string()), ("year", pa.int32()), ("court", pa.string()),
                  ("volume", pa.int32()), ("page", pa.int32()), ("text", pa.string()), ("petitioner", pa.string()), ("respondent", pa.string()), ("parallel", pa.list_(pa.string()))])
MENTIONS = "key string, start int, end int, id string, series string, jurisdiction string, year int, court string, volume int, page int, text string, petitioner string, respondent string, parallel array<string>"


def citation_mentions(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per citation of each text: key (as string) and the columns MENTIONS. One Arrow pass without a shuffle.

    Texts without four digits and a capital never reach Python. Null texts give no row; repeated rows count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, groups = named_citations(" ".join(t.split()))
                of = {i: g for g in groups for i in g}
                rows += [{"key": k} | c | {"parallel": of.get(c["id"])} for c in found]
            yield pa.RecordBatch.from_pylist(rows, _OUT)

    likely = df.filter(F.col(text).rlike("(?:1[89]|20)[0-9]{2}") & F.col(text).rlike("[A-Z]"))
    return likely.select(F.col(key).cast("string"), text).mapInArrow(run, MENTIONS)
