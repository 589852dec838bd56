"""How a judgment treats the cases it cites, how it ends, and what it is an appeal from."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.legal.cases import case_numbers, full_year
from lexloom.legal.citations import find_citations, parallel_groups

# Labels by strength, cues, and the phrases that guard them.
STRENGTH = ["overruled", "not_good_law", "per_incuriam", "reversed", "doubted", "distinguished", "followed", "cited_by_counsel", "referred"]
NEGATIVE = STRENGTH[:4]
CUES = [
    ("not_good_law", r"\b(?:no\s+longer|not|ceased\s+to\s+be)\s+(?:a\s+)?good\s+law\b"),
    ("per_incuriam", r"\bper\s+incuriam\b"),
    ("overruled", r"\bover-?\s?ruled\b"),
    ("reversed", r"\b(?:set\s+aside|reversed)\s+(?:by|in)\s+(?:the\s+)?(?:august\s+|hon'?ble\s+)?(?:supreme\s+court|apex\s+court|appeal)\b"),
    ("doubted", r"\bdoubted\b|\bunable\s+to\s+(?:agree|subscribe)\s+(?:with|to)\s+(?:the\s+)?(?:view|ratio|dictum|observations?|law)\b"),
    ("distinguished", r"\bdistinguishable\b|\bdistinguished\b(?!\s+(?:counsel|jurist|judge|lawyer))|\b(?:judgments?|cases?|dicta|dictum|precedents?|authorit(?:y|ies)|case[-\s]law|rulings?|citations?)\b"
     r"[^.]{0,80}\b(?:(?:not|in)\s*applicable|not\s+attracted|of\s+no\s+(?:help|avail)|not\s+helpful|do(?:es)?\s+not\s+advance)\b|\bon\s+(?:a\s+)?different\s+(?:footing|facts)\b|"
     r"\bfacts\s+(?:and\s+circumstances\s+)?of\s+(?:the\s+)?(?:said|cited|referred|instant)?\s*cases?\s+(?:are|were)\s+(?:quite\s+|altogether\s+|entirely\s+)?(?:different|distinct)\b"),
]
PHRASES = {
    "argued": r"\b(?:contended|argued|urged|submitted|contends|argues|submits|canvassed|averred|asserts|asserted|contentions?|according\s+to\s+(?:the\s+)?learned)\b",
    "counsel": r"\b(?:counsel|A\.?S\.?C|advocates?|D\.?A\.?G|A\.?A\.?G|A\.?G|law\s+officers?|prosecutor|learned\s+[A-Z]\.?[A-Z]\.?[A-Z]?|petitioners?|appellants?|respondents?)\b"
    r"[^.]{0,160}\b(?:relied|placed\s+reliance|referred|cited|relies|reliance)\b|\b(?:relied|reliance)\b[^.]{0,80}\b(?:by|of)\s+(?:the\s+)?(?:learned\s+)?(?:counsel|A\.?S\.?C|advocates?)\b",
    "followed": r"\breliance\s+(?:is|can\s+be|may\s+be)\s+(?:also\s+)?(?:placed|made)\b|\b(?:we|i)\s+(?:also\s+)?(?:rely|relied|respectfully\s+follow|follow)\b|\bfortified\s+by\b|\b(?:are|am)\s+fortified\b|"
    r"\b(?:is|are|stands?)\s+(?:fully\s+|also\s+)?(?:supported|reinforced)\s+by\b|\bguided\s+by\b|\b(?:has|have|was|were|been)\s+(?:\w+ly\s+|further\s+|also\s+)*followed\s+(?:by|in)\b|"
    r"\bbinding\s+(?:on|upon)\s+(?:this|all|the\s+subordinate)\b|\bthe\s+law\s+(?:laid\s+down|enunciated|declared)\b|\b(?:we|i|this\s+court)\s+(?:have\s+|has\s+|also\s+)*placed\s+reliance\b|\bsupports?\s+(?:the|this|our)\b",
    "negated": r"\b(?:not|never|cannot|nor|hardly)\b[^.;]{0,25}$",
    "plea": r"\b(?:objections?|pleas?|contentions?|arguments?|submissions?)\b[^.]{0,140}\b(?:is|are|stands?|was|were|being)\s+(?:hereby\s+)?over-?\s?ruled",
    "doctrine": r"\b(?:term|doctrine|concept|principle|rule|meaning)\s+(?:of\s+)?[\"“']?per\s+incuriam|per\s+incuriam[\"”']?\s+(?:means|is\s+a|has\s+been\s+(?:defined|explained))",
    "quoted": r"[:]\s*-*\s*[\"“‘']|\bobserved\s+(?:as\s+follows|that)\b|\bheld\s+as\s+under\b",
    "passive": r"\b(?:is|was|were|are|been|be|being|stands?|stood|as|declared)\s+(?:\w+ly\s+|since\s+|also\s+|declared\s+|held\s+(?:to\s+be\s+)?|(?:as\s+)?(?:being\s+)?)*[\"“‘']?$",
    "modal": r"\b(?:can|could|may|might|would|should|cannot|must)\s+(?:not\s+)?(?:\w+ly\s+)?be\s+(?:\w+\s+)?$",
    "holding": r"\b(?:held|observed|wherein|in\s+which|ruled\s+that|laid\s+down|whereby)\b",
    "agent": r"\b(?:overruled|over-\s?ruled|declared|set\s+aside|reversed|abandoned|held|disapproved)\s+(?:by|in|vide)\b[^()]*[(\[]?\s*$",
    "by_it": r"over-?\s?ruled\s+(?:in|by|vide)\b",
}
_BREAK = r"(?<=[a-z\)]{3}[.?!])\s+(?=[A-Z\"“(])|(?<=\d\)\.)\s+(?=[A-Z])|(?<=\b(?:19|20)\d\d\.)\s+(?=The\s|[A-Z][a-z]+\s)|\s(?=\d{1,3}\.\s+[A-Z])"
BEFORE, AFTER = 450, 300
_P = {k: regex.compile(p, regex.I) for k, p in PHRASES.items()}
_CUES = [(k, regex.compile(p, regex.I)) for k, p in CUES]
_ENDS = regex.compile(_BREAK)


def sentence_around(text: str, start: int, end: int) -> tuple[int, int]:
    """The bounds of the sentence about a span: at most BEFORE characters before and AFTER behind it."""
    left, limit = max(0, start - BEFORE), min(len(text), end + AFTER)
    for m in _ENDS.finditer(text, left, start):
        left = m.end()
    close = _ENDS.search(text, end, limit)
    return left, close.start() if close else limit


def _said_of(text: str, label: str, cue: tuple[int, int], span: tuple[int, int], others: list[tuple[int, int]], left: int) -> bool:
    """Whether a cue speaks of the case cited at `span`: it is the subject of a passive behind it, a bare mark in brackets, or
    the first object of an active verb before it; never the case that does it."""
    lead = text[max(left, cue[0] - 45) : cue[0]]
    if cue[0] >= span[1]:
        gap = text[span[1] : cue[0]]
        if len(gap) > 250 or any(span[1] <= s < cue[0] for s, _ in others):
            return False
        if gap.strip() in ("(", "["):
            return True
        blocked = _P["modal"].search(lead) or _P["holding"].search(gap) or _P["agent"].search(text[max(left, span[0] - 150) : span[0]])
        return bool(_P["passive"].search(lead)) and not blocked
    active = label in ("overruled", "doubted") and not _P["by_it"].match(text, cue[0]) and not _P["passive"].search(lead) and not lead[-2:].strip().endswith(("(", "["))
    return active and cue[1] <= span[0] <= cue[1] + 150 and not any(cue[1] <= s < span[0] for s, _ in others)


def treatment(text: str, start: int, end: int, others: list[tuple[int, int]]) -> tuple[str, str | None]:
    """(label, cue) of one citation. others: the spans of other cases cited in the text."""
    left, right = sentence_around(text, start, end)
    quoted = _P["quoted"].search(text, end, right)  # what follows is the cited case's own words
    right = quoted.start() if quoted else right
    said = text[left:right]
    near = [o for o in others if left <= o[0] < right]
    if m := _P["argued"].search(said):
        return "cited_by_counsel", m[0]
    for label, pattern in _CUES:
        if (label == "overruled" and _P["plea"].search(said)) or (label == "per_incuriam" and _P["doctrine"].search(said)):
            continue
        for m in pattern.finditer(said):
            at = (left + m.start(), left + m.end())
            if label != "not_good_law" and _P["negated"].search(text[max(left, at[0] - 40) : at[0]]):
                continue
            if label == "distinguished" or _said_of(text, label, at, (start, end), near, left):
                return label, m[0]
    counsel = _P["counsel"].search(said)
    if counsel and not _P["followed"].search(said[: max(0, start - left)][-120:]):
        return "cited_by_counsel", counsel[0][:60]
    followed = _P["followed"].search(said)
    return ("followed", followed[0]) if followed else ("referred", None)


def treatments(text: str) -> list[dict]:
    """alias, start, treatment, cue of every citation of a text; parallel citations of one case are not others to each other."""
    found = find_citations(text)
    same = {i: set(g) for g in parallel_groups(text, found) for i in g}
    out = []
    for c in found:
        own = same.get(c["id"], {c["id"]})
        label, cue = treatment(text, c["start"], c["end"], [(o["start"], o["end"]) for o in found if o["id"] not in own])
        out.append({"alias": c["id"], "start": c["start"], "treatment": label, "cue": cue})
    return out


# The verbs of an order, strongest first, and what of a text is its end.
_MATTER = r"(?:appeals?|petitions?|revisions?|applications?|references?|reviews?|it|the\s+same)"
ORDERS = [
    ("remanded", r"\b(?:is|are|be|being|stands?|hereby)\s+(?:hereby\s+)?(?:remanded|remitted|sent\s+back)\b|\bremand(?:ed)?\s+(?:the\s+)?(?:case|matter|suit|appeal)\b"),
    ("partly_allowed", r"\b(?:partly|partially)\s+(?:allowed|accepted)\b"),
    ("allowed", _MATTER + r"[^.]{0,80}\b(?:is|are|stands?|being)\s+(?:hereby\s+|accordingly\s+)?(?:allowed|accepted)\b|\bimpugned\s+(?:judgments?|orders?|decrees?)[^.]{0,120}\b(?:is|are)\s+(?:hereby\s+)?set\s+aside\b|"
     r"\bleave\s+(?:to\s+appeal\s+)?(?:is\s+)?granted\b"),
    ("leave_refused", r"\bleave\s+(?:to\s+appeal\s+)?(?:is\s+)?(?:refused|declined)\b"),
    ("dismissed", _MATTER + r"[^.]{0,80}\b(?:is|are|stands?|being)\s+(?:hereby\s+|accordingly\s+)?dismissed\b"),
    ("disposed_of", r"(?<!C\.\s)(?<!C\.M\.\s)(?<!M\.\s)" + _MATTER + r"[^.]{0,80}\b(?:is|are|stands?|being)\s+(?:hereby\s+|also\s+|accordingly\s+)?disposed\s+of\b"),
]
SHARE, LEAST, MOST = 0.25, 2000, 6000


def outcome_of(closing):
    """The outcome of a closing part: the strongest verb in it; null where none is. A column function."""
    out = None
    for label, pattern in ORDERS:
        test = closing.rlike("(?i)" + pattern)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out


def last_cue(text: str | None) -> tuple[str, str] | None:
    """(outcome, its last printed cue) at the end of a text."""
    tail = (text or "")[-min(MOST, max(LEAST, int(len(text or "") * SHARE))) :]
    for label, pattern in ORDERS:
        cues = [m[0] for m in regex.finditer(pattern, tail, regex.I)]
        if cues:
            return label, cues[-1]
    return None


# Courts as recitals name them, in order.
RECITAL_COURTS = [
    ("lahore_high_court", r"lahore\s+high\s+court|high\s+court\s+of\s+lahore"), ("sindh_high_court", r"high\s+court\s+of\s+sindh|sindh\s+high\s+court"), ("peshawar_high_court", r"peshawar\s+high\s+court"),
    ("islamabad_high_court", r"islamabad\s+high\s+court"), ("balochistan_high_court", r"high\s+court\s+of\s+baluchistan|high\s+court\s+of\s+balochistan|bal[ou]chistan\s+high\s+court"),
    ("federal_shariat_court", r"federal\s+shariat\s+court"),
    ("subordinate_court", r"sessions\s+judge|district\s+judge|civil\s+judge|magistrate|anti[\s-]*terrorism\s+court|trial\s+court|family\s+court|rent\s+controller|special\s+judge|banking\s+court|accountability\s+court|judge\s+family|guardian\s+judge"),
    ("tribunal", r"tribunal"), ("same_court", r"this\s+court|learned\s+single\s+judge|single\s+bench|learned\s+bench"),
]
HEAD, HEAD_MANY, RECITAL = 6000, 2500, 450
_AGAINST = regex.compile(r"\b(?:against|from)\s*(?:the\s*)?(?:impugned\s+|consolidated\s+|common\s+)?(?:judgments?|orders?|decrees?)(?:\s*(?:/|and)\s*(?:judgments?|orders?|decrees?))*\b", regex.I)
_RECITAL_END = regex.compile(r"[)\]]|\b(?:Petitioner|Appellant|Respondent|Versus|VERSUS)\b")
_DATE = regex.compile(r"\b(\d{1,2})\s*[./-]\s*(\d{1,2})\s*[./-]\s*((?:19|20)\d{2}|\d{2})\b")
_IN_CASE = regex.compile(r"\bin\s+(?=[A-Za-z][A-Za-z.\s]{0,40}?\bnos?\b)", regex.I)


def recital_date(day: str, month: str, year: str) -> str | None:
    """An ISO date whose day and month lie in range (a 31 February is kept as printed)."""
    return f"{full_year(year):04d}-{int(month):02d}-{int(day):02d}" if 1 <= int(day) <= 31 and 1 <= int(month) <= 12 else None


def recitals(text: str, own_court: str) -> list[dict]:
    """The recitals of what a judgment is an appeal from, in its head: court_id, dates, cases, start, end, quote. One needs a
    date and a case; beyond HEAD_MANY characters only the first is one."""
    out: list[dict] = []
    for m in _AGAINST.finditer(text[:HEAD]):
        rest = text[m.end() : m.end() + RECITAL]
        stop = _RECITAL_END.search(rest)
        said = m[0] + rest[: stop.start() if stop else None]
        dates = [d for d in (recital_date(*x) for x in _DATE.findall(said)) if d]
        *_, case = [None, *_IN_CASE.finditer(said)]
        cases = case_numbers(said[case.end() :]) if case else []
        if not dates or not cases:
            continue
        if out and m.start() > HEAD_MANY:
            break
        court = next((c for c, p in RECITAL_COURTS if regex.search(p, said, regex.I)), "unknown")
        out.append({"court_id": own_court if court == "same_court" else court, "dates": dates, "cases": cases, "start": m.start(), "end": m.start() + len(said), "quote": " ".join(said.split())})
    return out


READINGS = "key string, alias string, start int, treatment string, cue string"


def read_treatments(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """READINGS of every citation of each text; texts that hold no year never reach Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("alias", pa.string()), ("start", pa.int32()), ("treatment", pa.string()), ("cue", pa.string())])
        for b in batches:
            rows = [{"key": k} | r for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in treatments(t)]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return df.filter(F.col(text).rlike("(?:1[89]|20)[0-9]{2}") & F.col(text).rlike("[A-Z]")).select(F.col(key).cast("string"), text).mapInArrow(run, READINGS)
