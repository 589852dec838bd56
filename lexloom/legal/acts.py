"""Short forms of acts, the printed forms of their provisions, and text without one provision's mentions."""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Short form | printed forms.
ACT_TABLE = """
PPC | PPC; P.P.C.; P.P.C; Pakistan Penal Code
CRPC | CrPC; Cr.P.C.; Cr.P.C; Cr.PC; Code of Criminal Procedure
CPC | CPC; C.P.C.; C.P.C; Code of Civil Procedure
QSO | QSO; Qanun-e-Shahadat Order; Qanun-e-Shahadat
CNSA | CNSA; Control of Narcotic Substances Act
ATA | ATA; Anti-Terrorism Act
NAO | NAO; National Accountability Ordinance
"""
FORMS = {f.strip(): k.strip() for k, _, forms in (line.partition("|") for line in ACT_TABLE.strip().split("\n")) for f in forms.split(";")}
_KEYS = {regex.sub("[^A-Z]", "", f.upper()): short for f, short in FORMS.items()}


def _lookup(key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in _KEYS.items() for x in kv]), key)


def short_form(title: Column) -> Column:
    """The conventional short form of a title: letters only, without a leading article and a closing year; null for other acts."""
    bare = F.regexp_replace(F.trim(title), r"(?i)^the\b|,?\s*\d{4}\s*$", "")
    return _lookup(F.upper(F.regexp_replace(bare, "[^A-Za-z]", "")))


def short_form_of_slug(slug: Column) -> Column:
    """The first whole token of a file name that is a short form."""
    tokens = F.filter(F.split(F.upper(slug), "[^A-Z]+"), lambda t: t != "")
    return F.try_element_at(F.filter(F.transform(tokens, _lookup), lambda s: s.isNotNull()), F.lit(1))


def forms_pattern() -> str:
    """An alternation of all printed forms, longest first, for Java and RE2 alike."""
    return "|".join(regex.sub(r"([.\-])", r"\\\1", f) for f in sorted(FORMS, key=lambda f: (-len(f), list(FORMS).index(f))))


_MENTION = rf"(?i:\b(?:sections?|s\.|u/s)\s*)([0-9]{{1,3}}(?:-?[A-Z])?)(?:\s*,?\s*(?:of\s+)?(?:the\s+)?({forms_pattern()}))?"


def provision_keys(text: Column) -> Column:
    """The keys 'NUMBER SHORT' of the provisions a text names with an act, in order."""
    numbers = F.regexp_extract_all(text, F.lit(_MENTION), F.lit(1))
    shorts = F.transform(F.regexp_extract_all(text, F.lit(_MENTION), F.lit(2)), lambda f: _lookup(F.upper(F.regexp_replace(f, "[^A-Za-z]", ""))))
    return F.filter(F.transform(F.arrays_zip(numbers.alias("n"), shorts.alias("s")), lambda z: F.concat_ws(" ", z["n"], z["s"])), lambda k: k.contains(" "))


def without_provision(text: Column, key: Column) -> Column:
    """The text without any mention of one provision ('NUMBER SHORT'), blanks squeezed."""
    number, short = F.substring_index(key, " ", 1), F.substring_index(key, " ", -1)
    forms = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(regex.sub(r"([.\-])", r"\\\1", f)).alias("f")) for f, s in sorted(FORMS.items(), key=lambda x: -len(x[0]))])
    own = F.array_join(F.transform(F.filter(forms, lambda f: f["s"] == short), lambda f: f["f"]), "|")
    pattern = F.concat(F.lit(r"(?i)\b(?:sections?|s\.|u/s)\s*"), number, F.lit(r"\s*,?\s*(?:of\s+)?(?:the\s+)?(?:"), own, F.lit(")"))
    return F.trim(F.regexp_replace(F.regexp_replace(text, pattern, " "), F.lit(r"\s+"), F.lit(" ")))
