"""What kind a document is, by weighted cues, and where one document ends and the next begins in a file."""

from __future__ import annotations

from functools import cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, TITLE, BODY, LEAST, OPENING = 400, 3, 1, 3, 90
# Kind | cue | pattern, in the order that breaks ties.
CUES = [
    ("fir", "first_information_report", r"(?i)first\s+information\s+report"), ("fir", "fir_no", r"(?i)\bF\.?I\.?R\.?\s*(?:No|#)"), ("fir", "section_154", r"(?i)section\s+154"), ("fir", "police_station", r"(?i)police\s+station"),
    ("fir", "first_information_report_ur", r"ابتدائی\s+اطلاعی\s+رپورٹ"), ("fir", "police_station_ur", r"تھانہ"), ("fir", "case_no_ur", r"مقدمہ\s+نمبر"),
    ("judgment", "judgment", r"(?i)\bjudg(?:e)?ment\b"), ("judgment", "disposal", r"(?i)\b(?:is|are|stands?)\s+(?:hereby\s+)?(?:dismissed|allowed|disposed\s+of)\b"), ("judgment", "versus", r"(?i)\bversus\b"),
    ("order", "order_sheet", r"(?i)order\s+sheet"), ("order", "proceedings", r"(?i)order\s+or\s+other\s+proceedings"), ("order", "form_columns", r"(?i)date\s+of\s+order"), ("order", "adjourned", r"(?i)\badjourned\b"),
    ("order", "grant_of", r"(?i)\bgrant\s+of\b|\bdecision\s+(?:rejecting|on)\b|\bis\s+pleased\s+to\s+grant\b"),
    ("pleading", "petition_or_plaint", r"(?i)writ\s+petition|\bplaint\b|written\s+statement|\bmemorial\b|request\s+for\s+arbitration|post-?\s?hearing\s+brief|\bpetition\s+(?:under|for|no)\b"), ("pleading", "sheweth", r"(?i)respectfully\s+(?:sheweth|submitted)"),
    ("pleading", "prayer", r"(?i)\bprayer\b|it\s+is\s+(?:most\s+)?(?:respectfully\s+)?prayed"), ("pleading", "claimant_respondent", r"(?is)\bclaimants?\b.*\brespondents?\b|\brespondents?\b.*\bclaimants?\b"),
    ("affidavit", "affidavit", r"(?i)\baffidavit\b"), ("affidavit", "solemnly", r"(?i)solemnly\s+(?:affirm|swear|declare)"), ("affidavit", "deponent", r"(?i)\bdeponent\b"),
    ("witness_statement", "statement_of_witness", r"(?i)statement\s+of\s+(?:the\s+)?witness|\bwitness\s+statement\b"), ("witness_statement", "statement_of_truth", r"(?i)statement\s+of\s+truth"), ("witness_statement", "section_161", r"(?i)section\s+161|u/s\.?\s*161"), ("witness_statement", "prosecution_witness", r"\bP\.?W\.?-?\s?\d+"),
    ("medical_report", "medico_legal", r"(?i)medico-?\s?legal|\bMLC\b"), ("medical_report", "injuries", r"(?i)\binjur(?:y|ies)\b"), ("medical_report", "medical_officer", r"(?i)medical\s+officer"), ("medical_report", "post_mortem", r"(?i)post-?\s?mortem"),
    ("statute", "an_act_to", r"(?i)\bAn\s+Act\s+to\b"), ("statute", "be_it_enacted", r"(?i)be\s+it\s+enacted"), ("statute", "commencement", r"(?i)come\s+into\s+force|short\s+title"),
    ("contract", "agreement", r"(?i)\bagreement\b"), ("contract", "non_disclosure", r"(?i)non-?\s?disclosure"), ("contract", "hereinafter", r"(?i)hereinafter"), ("contract", "whereas", r"\bWHEREAS\b"), ("contract", "confidential_information", r"(?i)confidential\s+information"), ("contract", "addendum", r"(?i)\baddendum\b"),
    ("letter", "salutation", r"(?i)\bdear\s+(?:sirs?|madam|mr|ms|mrs)\b"), ("letter", "valediction", r"(?i)\byours\s+(?:faithfully|sincerely|truly)\b"), ("letter", "reference", r"(?i)\b(?:our\s+)?ref(?:erence)?\s*[:.]"),
    ("notice", "notification", r"(?i)\bnotification\b|\bnotice\s+of\b"), ("notice", "in_exercise", r"(?i)in\s+exercise\s+of\s+the\s+powers"), ("application", "application_for", r"(?i)\bapplication\s+for\b"), ("application", "applicant", r"(?i)\bthe\s+applicant\b"),
    ("minutes", "minutes_of", r"(?i)\bminutes\s+of\b|\bboard\s+minutes\b|\bcabinet\s+minutes\b"), ("minutes", "resolved", r"\bRESOLVED\b|(?i:\bresolved\s+that\b)"), ("minutes", "present", r"(?i)\bin\s+attendance\b|\bpresent\s*:"),
    ("ledger", "ledger", r"(?i)\bledger\b|\bschedule\s+of\s+(?:costs|payments)\b|\bcosts\s+schedule\b"), ("ledger", "debit_credit", r"(?is)\bdebit\b.*\bcredit\b|\bbalance\b"), ("ledger", "total", r"(?im)^\s*total\b"),
    ("report", "report_extract", r"(?i)\b(?:study|report)\s+extract\b|\bextract\s+(?:from|of)\b|feasibility\s+study"), ("report", "executive_summary", r"(?i)executive\s+summary|\bvaluation\b|discounted\s+cash\s+flow"),
    ("email", "from_to", r"(?im)^\s*from\s*:.*\n\s*(?:to|sent)\s*:"), ("email", "subject", r"(?im)^\s*subject\s*:"),
]
# The cues that open a document on a page of their own.
OPENERS = set("first_information_report order_sheet grant_of affidavit statement_of_witness medico_legal an_act_to agreement non_disclosure addendum salutation reference notification application_for minutes_of ledger report_extract from_to judgment".split())
KINDS = list(dict.fromkeys(k for k, _, _ in CUES))


@cache
def _compiled() -> list[tuple[str, str, regex.Pattern]]:
    return [(k, name, regex.compile(p)) for k, name, p in CUES]


def kind_of(text: str | None) -> tuple[str, float]:
    """(kind, confidence): a cue in the first HEAD characters counts TITLE, elsewhere BODY; unknown under LEAST."""
    text = text or ""
    points = dict.fromkeys(KINDS, 0)
    for kind, _, p in _compiled():
        points[kind] += TITLE if p.search(text, 0, HEAD) else BODY if p.search(text) else 0
    first, second, *_ = sorted(points.values(), reverse=True)
    if first < LEAST:
        return "unknown", 0.0
    return next(k for k in KINDS if points[k] == first), first / (first + second)


def _kinds(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([kind_of(t) for t in texts], columns=["kind", "confidence"])


def kind(text: Column) -> Column:
    """kind_of as a column: one Arrow pass in which each cue is sought once."""
    return F.pandas_udf(_kinds, "kind string, confidence double")(text)


def _segments(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    pages = g.sort_values("page")
    texts = pages["text"].fillna("").tolist()
    groups: list[list[int]] = []
    before: set[str] = set()
    for i, t in enumerate(texts):
        head = t.strip()[:OPENING]
        shows = {k for k, name, p in _compiled() if name in OPENERS and p.search(head)}
        if not groups or (shows - before and kind_of("\n".join(texts[k] for k in groups[-1]))[0] not in shows):
            groups.append([])
        groups[-1].append(i)
        before = shows
    numbers = pages["page"].tolist()
    rows = [(key[0], numbers[x[0]], numbers[x[-1]], *kind_of("\n".join(texts[k] for k in x))) for x in groups]
    return pd.DataFrame(rows, columns=["document_id", "first_page", "last_page", "kind", "confidence"])


def segments(pages: DataFrame) -> DataFrame:
    """document_id, first_page, last_page, kind, confidence: the documents of a file (document_id, page, text). A page begins one if its
    opening shows a title kind the page before did not, and the document so far isn't of that kind. One file is read as a whole."""
    return pages.select("document_id", "page", "text").groupBy("document_id").applyInPandas(_segments, "document_id string, first_page int, last_page int, kind string, confidence double")


def kind_sql(table: str, key: str) -> str:
    """The same rule in SQL over `table` (key, text)."""
    score = lambda k: " + ".join(f"CASE WHEN regexp_matches(head, '{p}') THEN 3 WHEN regexp_matches(text, '{p}') THEN 1 ELSE 0 END" for kk, _, p in CUES if kk == k)
    rows = " UNION ALL ".join(f"SELECT {key}, {score(k)} AS s, {i} AS i, '{k}' AS k FROM t" for i, k in enumerate(KINDS))
    return f"""WITH t AS (SELECT {key}, text, substr(text, 1, {HEAD}) AS head FROM {table} WHERE text IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY s DESC, i) AS n FROM ({rows}))
      SELECT a.{key}, CASE WHEN a.s >= {LEAST} THEN a.k ELSE 'unknown' END AS kind, CASE WHEN a.s >= {LEAST} THEN round(a.s / (a.s + b.s), 4) ELSE 0.0 END AS confidence FROM r a JOIN r b ON a.{key} = b.{key} AND a.n = 1 AND b.n = 2"""
