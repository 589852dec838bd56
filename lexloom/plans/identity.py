"""Queries of judgment identity, sentence roles by rule, dates of recitals, years carried back."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.legal import provisions, treatment
from lexloom.operators import identity as I
from lexloom.plans.cases import Cases
from lexloom.plans.legal import numbered
from lexloom.tables import load

C = Cases()
QUERIES, SQL = C.queries, C.sql

_LHC, _SC = "lahore_high_court", "supreme_court_pakistan"
_DOCS = [
    ("lhc", "b", "h1", _LHC, None, "2023  lhc 5", None, None, None, None, "2023-02-01", "W.P. No. 7 of 2022", None), ("lhc", "a", "h1", _LHC, None, "2023 LHC 5", None, None, None, None, None, None, None), ("lhc", "c", "h2", _LHC, "2023 LHC 5", None, None, None, None, None, "2023-03-03", None, "2008 SCMR 598"),
    ("sc", "x", "h3", _SC, None, None, "Crl.A", "599", "2020", "05-06-2021", "2021-06-05", "Criminal Appeal No. 599 of 2020", "2008 SCMR 598"), ("sc", "y", "h4", None, None, None, None, None, None, None, None, "no number", None),
]


def jid(key: str) -> str:
    return "j_" + hashlib.sha1(key.encode()).hexdigest()[:16]


_N, _L, _D = "neutral/2023 LHC 5", f"{_SC}/CRL.A/599/2020/2021-06-05", "document/h4"
C.add("ag10_identity_ladder", I.DOCS, _DOCS, lambda df: I.identified(df).select("document_id", "stems", "key", "rung", "judgment_id"), "document_id string, stems array<string>, key string, rung string, judgment_id string",
      [("h1", ["a", "b"], _N, "neutral_citation", jid(_N)), ("h2", ["c"], _N, "neutral_citation", jid(_N)), ("h3", ["x"], _L, "court_label", jid(_L)), ("h4", ["y"], _D, "content_hash", jid(_D))])
C.add("ag10_judgments", I.DOCS, _DOCS, lambda df: I.judgments(I.identified(df)), "judgment_id string, key string, rung string, court_id string, document_ids array<string>, decision_date string",
      [(jid(_N), _N, "neutral_citation", _LHC, ["h1", "h2"], "2023-03-03"), (jid(_L), _L, "court_label", _SC, ["h3"], "2021-06-05"), (jid(_D), _D, "content_hash", "unknown_court", ["h4"], None)])
C.add("ag10_aliases", I.DOCS, _DOCS, lambda df: I.aliases(I.identified(df)), "alias_type string, alias string, judgment_id string",
      [("document", "h1", jid(_N)), ("document", "h2", jid(_N)), ("document", "h3", jid(_L)), ("document", "h4", jid(_D)), ("neutral", "2023 LHC 5", jid(_N)), ("reported", "2008 SCMR 598", jid(_N)), ("reported", "2008 SCMR 598", jid(_L)), ("case_number", f"{_SC}:CRL.A/599/2020", jid(_L))])
C.add("ag10_alias_conflicts", I.DOCS, _DOCS, lambda df: I.conflicts(I.aliases(I.identified(df))), "alias_type string, alias string, judgments array<string>", [("reported", "2008 SCMR 598", sorted([jid(_N), jid(_L)]))])


def role_column(sentence, statute):
    """The role a sentence gives a provision: the first of four cue sets; the constitution is a benchmark, not struck down, and
    procedure, evidence and the constitution can't be charged."""
    out = None
    for name, cue in provisions.ROLE_CUES:
        out = F.when(sentence.rlike("(?i)" + cue), F.lit(name)) if out is None else out.when(sentence.rlike("(?i)" + cue), F.lit(name))
    role = out.otherwise("mentioned")
    starts = lambda xs: F.coalesce(F.greatest(*[statute.startswith(x) for x in xs], F.lit(False)), F.lit(False))
    return F.when((role == "vires_challenged") & starts(provisions.UNCHARGED[-1:]), "benchmark").when((role == "charged_under") & starts(provisions.UNCHARGED), "mentioned").otherwise(role)


C.table("fn30_roles_by_rule", lambda spark, d: load(spark, d, "provision_mentions").filter("sentence IS NOT NULL").select("mention_id", role_column(F.col("sentence"), F.col("statute_id")).alias("role")).distinct(),
        "SELECT DISTINCT mention_id, CASE " + " ".join(f"WHEN regexp_matches(sentence, '(?i){p}') THEN '{n}'" for n, p in provisions.ROLE_CUES) + " ELSE 'mentioned' END AS role FROM provision_mentions WHERE sentence IS NOT NULL")
_ROLES = [("An appeal filed under section 5", None, "invoked"), ("registered under section 302", "5_ppc", "charged_under"), ("registered under section 5", "4_code_of_criminal_procedure_x", "mentioned"), ("declared ultra vires", "9_x", "vires_challenged"), ("ultra vires of Article 4", "1_constitution_of_the_islamic_republic_x", "benchmark"), ("the scope of section 5", None, "interpreted"), ("plain", None, "mentioned")]
C.add("fn30_role_cases", "case_no int, sentence string, statute string", numbered([r[:2] for r in _ROLES]), lambda df: df.select("case_no", role_column(F.col("sentence"), F.col("statute")).alias("role")), "case_no int, role string", numbered([(r[2],) for r in _ROLES]))
_DATES = [("24", "3", "2022", "2022-03-24"), ("31", "2", "99", "1999-02-31"), ("1", "13", "2001", None), ("5", "6", "30", "2030-06-05"), ("5", "6", "31", "1931-06-05")]
C.add("fn22_recital_dates", "case_no int, d string, m string, y string", numbered([x[:3] for x in _DATES]), lambda df: df.select("case_no", F.pandas_udf(lambda a, b, c: pd.Series([treatment.recital_date(*x) for x in zip(a, b, c)], dtype=object), "string")("d", "m", "y").alias("iso")), "case_no int, iso string", numbered([(x[3],) for x in _DATES]))
C.add("wn15_year_carried_back", "list_no int, pos int, number string, year int", [(0, 0, "281", None), (0, 1, "303", 2012), (0, 2, "7", None), (1, 0, "5", 2001), (1, 1, "6", None), (1, 2, "8", 2003)],
      lambda df: df.select("list_no", "number", F.first("year", ignorenulls=True).over(Window.partitionBy("list_no").orderBy("pos").rowsBetween(0, Window.unboundedFollowing)).alias("year")), "list_no int, number string, year int", [(0, "281", 2012), (0, "303", 2012), (0, "7", None), (1, "5", 2001), (1, "6", 2003), (1, "8", 2003)])
