"""Case numbers and courts: every spelling of one case gives one key TYPE/NUMBER/YEAR."""

from __future__ import annotations

import regex

# Case type | its spellings without dots, blanks and a plural s.
TYPE_TABLE = """
WP | writpetition wp
CRL.A | criminalappeal crlappeal crla cra crappeal
CRL.P | criminalpetition crlp crlpla
CRL.MISC | criminalmiscellaneou criminalmisc crlmisc crlm
CRL.REV | criminalrevision crlrevision crlrev
C.R. | civilrevision cr
C.R.P. | civilreviewpetition crp
C.P. | civilpetition cp cpla civilpetitionforleavetoappeal
C.A. | civilappeal ca
RFA | regularfirstappeal rfa
RSA | regularsecondappeal rsa
FAO | firstappealfromorder fao
ICA | intracourtappeal ica
EFA | executionfirstappeal efa
S.A. | secondappeal sa
ITR | incometaxreference itr
C.M. | civilmiscellaneou cm
C.O. | civiloriginal co
SMC | suomotucase smc
CONST.P | constitutionpetition constp
M.R. | murderreference mr
CUSTOMS.REF | customsreferenceapplication specialcustomsreferenceapplication
SERVICE.APPEAL | servicesappeal serviceappeal
APPEAL | appeal
PETITION | petition
"""
_TYPE_OF = {s: kind.strip() for kind, _, spelt in (line.partition("|") for line in TYPE_TABLE.strip().split("\n")) for s in spelt.split()}
PIVOT, LONGEST_RANGE, TYPE_WORDS = 30, 100, 6
_NO = regex.compile(r"\bnos?\b\.?", regex.I)
_RUN = regex.compile(r"[A-Za-z][A-Za-z.()\s]{0,60}?(?=\s*$)")
_POLICE = regex.compile(r"\bF\.?\s*I\.?\s*R\b|\bcrime\b|\bkhewat\b|\bkhatauni\b|\bmutation\b", regex.I)
_LINK = regex.compile(r"(?:(?:and|with|in|&|also|respectively)\s+)+", regex.I)
_OF_YEAR = regex.compile(r"of\s*((?:19|20)\d{2}|\d{2})\b", regex.I)
_NUMBER = regex.compile(
    r"(?P<lo>\b\d{1,6})\s*to\s*(?P<hi>\d{1,6})\b(?:\s*/\s*(?P<ry>(?:19|20)\d{2}|\d{2})\b)?"
    r"|(?:\b(?P<registry>[A-Z])\s*-\s*)?(?P<n>\d{1,6})(?:\s*-\s*(?P<letter>[A-Za-z]{1,2})\b)?(?:\s*(?P<mark>[/-])\s*(?P<y>(?:19|20)\d{2}|\d{2})\b)?", regex.I)  # fmt: skip


def full_year(printed: str) -> int:
    y = int(printed)
    return y if y > 99 else y + (2000 if y <= PIVOT else 1900)


def _plain(words: str) -> str:
    return regex.sub("[^a-z]", "", words.lower())


def _known(words: str) -> str | None:
    w = _plain(words)
    return _TYPE_OF.get(w) or (_TYPE_OF.get(w[:-1]) if w.endswith("s") else None)


def case_type(words: str) -> str:
    """The type words before a number stand for; unknown ones keep their letters in capitals."""
    return _known(words) or _plain(words).upper() or "?"


def _words_before(text: str) -> tuple[int, str]:
    """Where the words before "No." begin, and those of them that are the type: the longest known end, else the last three."""
    m = _RUN.search(text)
    if m is None:
        return len(text), ""
    words = regex.sub(rf"^{_LINK.pattern}", "", m[0], flags=regex.I).split()
    ends = [" ".join(words[-k:]) for k in range(min(TYPE_WORDS, len(words)), 0, -1)]
    return m.start(), next((e for e in ends if _known(e)), " ".join(words[-3:]))


def _numbers(body: str) -> list[tuple[str, int | None]]:
    """(number, year) of each number one type is followed by."""
    closing = None
    for closing in _OF_YEAR.finditer(body):
        pass
    default = full_year(closing[1]) if closing else None
    body = body[: closing.start()] if closing else body
    out: list[tuple[str, int | None]] = []
    ranges: list[tuple[str, int | None]] = []
    for m in _NUMBER.finditer(body):
        if m["lo"]:
            if 0 < int(m["hi"]) - int(m["lo"]) <= LONGEST_RANGE:
                ranges += [(str(k), full_year(m["ry"]) if m["ry"] else default) for k in range(int(m["lo"]), int(m["hi"]) + 1)]
            continue
        number, year = str(int(m["n"])), default
        if m["y"] and m["mark"] == "-" and len(m["y"]) == 2 and default is not None and (out or ranges):
            out.append((number, default))  # 254424-25 names the next number too
            number = number[: -len(m["y"])] + m["y"]
        elif m["y"]:
            year = full_year(m["y"])
        out.append(("-".join(x for x in (m["registry"], number, (m["letter"] or "").upper()) if x), year))
    out = ranges + out
    ahead = None
    for k in range(len(out) - 1, -1, -1):  # a number without a year takes that of the next one with it
        ahead = out[k][1] if out[k][1] is not None else ahead
        out[k] = (out[k][0], ahead)
    return list(dict.fromkeys(out))


def case_numbers(text: str | None) -> list[str]:
    """The keys of the cases a string names, in order; police and land record numbers name none; '?' is an unknown year."""
    text = " ".join((text or "").split())
    marks = [(m, *_words_before(text[: m.start()])) for m in _NO.finditer(text)]
    cases: list[tuple[str, str, int | None]] = []
    for k, (m, _, words) in enumerate(marks):
        if regex.search("[A-Za-z]", words) and not _POLICE.search(words):
            until = marks[k + 1][1] if k + 1 < len(marks) else len(text)
            cases += [(case_type(words), n, y) for n, y in _numbers(text[m.end() : until])]
    last = _OF_YEAR.findall(text)
    keys = [f"{kind}/{n}/{y if y is not None else full_year(last[-1]) if last else '?'}" for kind, n, y in cases]
    return list(dict.fromkeys(keys))


def label_case(kind: str | None, number: str | None, year: str | None) -> str | None:
    """The key of a case named by the parts of a file name."""
    if not kind or not number:
        return None
    m = regex.fullmatch(r"(\d+)(?:-?([A-Za-z]{1,2}))?", number.strip())
    n = "-".join([str(int(m[1])), *([m[2].upper()] if m[2] else [])]) if m else number.strip()
    return f"{case_type(kind)}/{n}/{full_year(year) if year and year.isdigit() else '?'}"
