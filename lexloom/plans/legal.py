"""Queries of the law's text kernels: citations, case numbers, parties, provisions, treatment, versions, chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.legal import acts, cases, citations, parties, provisions, treatment, versions
from lexloom.operators import chunking
from lexloom.plans.cases import Cases
from lexloom.tables import load

C = Cases()
QUERIES, SQL = C.queries, C.sql


def numbered(cases_: list) -> list[tuple]:
    return [(i, *(c if isinstance(c, tuple) else (c,))) for i, c in enumerate(cases_)]


def by_text(fn, ddl: str = "case_no int, answer string"):
    """An operator that gives each text's answer by a Python kernel over Arrow batches."""
    return lambda df: df.select("case_no", F.pandas_udf(lambda t: t.map(fn), ddl.split(" ", 3)[3])("text").alias("answer"))


# citations: text, ids as printed in order
_IDS = [
    ("relied upon (2008 SCMR 598), wherein", "2008 SCMR 598"), ("1968 P.Cr.L.J. 1077", "1968 PCrLJ 1077"), ("1968 PCrLJ 1077", "1968 PCrLJ 1077"), ("1968 PCr.LJ 1077", "1968 PCrLJ 1077"), ("1968 P Cr. L J 1077", "1968 PCrLJ 1077"),
    ("PLD 2015 SC 123", "PLD 2015 SC 123"), ("PLD 2015 Supreme Court 123", "PLD 2015 SC 123"), ("PLD 2015 S.C. 123", "PLD 2015 SC 123"), ("PLD 2015 SC (Pak.) 123", "PLD 2015 SC 123"), ("PLD 1998 Lah. 90", "PLD 1998 Lahore 90"),
    ("PLD 2013 SC1; PLD 2013 SC 501", "PLD 2013 SC 1; PLD 2013 SC 501"), ("appeals of 2018 AND 3 others", ""), ("Crl. Appeal No. 9 of 2014", ""), ("Dated 2019 at 5 p.m.", ""), ("Section 10 of the Ordinance, 2002", ""),
    ("order dated 22.11.2021 passed by 3 members", ""), ("2008 ZZZZ 598", ""), ("2008 SCMR 598/2009", ""), ("1200 SCMR 598", ""), ("2150 SCMR 598", ""),
    ("Uzma v. Vice-Chancellor (2022 SCMR 694), Yasin v. Chairman, PTC (2003 PLC (C.S.) 1105), Rai v. Pandey ((2015) 11 Supreme Court Cases 493), Kumar v. State [(2017) 4 Supreme Court Cases 357], "
     "Vasantha v. IIT (2013 SCC Online Mad 2171), Devi v. State (2016 SCC Online P&H 9912) and Mahesh v. State (2019 SCC Online Ker 19645). See Punjab v. Ali (2006 SCMR 678).",
     "2022 SCMR 694; 2003 PLC(CS) 1105; 2015 11 SCC 493; 2017 4 SCC 357; SCCONLINE 2013 Mad 2171; SCCONLINE 2016 P&H 9912; SCCONLINE 2019 Ker 19645; 2006 SCMR 678"),
    (None, ""), ("", ""),
]
_ids = by_text(lambda t: "; ".join(c["id"] for c in citations.find_citations(t)))
C.add("fn12_citation_extractor", "case_no int, text string", numbered([t for t, _ in _IDS]), _ids, "case_no int, answer string", numbered([a for _, a in _IDS]))

_COMPOSED = [
    ("2024 PLC (C.S.) 402", "2024 PLC(CS) 402"), ("2010 PLC 259", "2010 PLC 259"), ("2012 PLC CS 90", "2012 PLC(CS) 90"), ("(2015) 11 SCC 493", "2015 11 SCC 493"), ("(2015) 2 SCC 493", "2015 2 SCC 493"), ("PLD 2016 [Lahore] 383", "PLD 2016 Lahore 383"),
    ("1987 CLC [Karachi] 2185", "1987 CLC 2185"), ("1987 CLC (Karachi) 2185", "1987 CLC 2185"), ("1987 CLC 2185-Karachi", "1987 CLC 2185"), ("2018 YLR Note 114", "2018 YLR-N 114"), ("2018 YLR Notes 114", "2018 YLR-N 114"),
    ("2018 YLR-N 114", "2018 YLR-N 114"), ("2018 YLR (N) 114", "2018 YLR-N 114"), ("2018 YLR N 114", "2018 YLR-N 114"), ("2019 PLC (CS) Note 19", "2019 PLC(CS)-N 19"), ("PLD 1996Supreme Court 543", "PLD 1996 SC 543"),
]
C.add("fn13_citation_id", "case_no int, text string", numbered([t for t, _ in _COMPOSED]), _ids, "case_no int, answer string", numbered([a for _, a in _COMPOSED]))

C.add("fn15_citation_spans", "key string, text string", [("a", "Ali v. State (2008 SCMR 598) held"), ("b", "PLD 2013 SC1; PLD 2013 SC 501"), ("c", None), ("d", "no citation")],
      lambda df: citations.citation_mentions(df, "key").select("key", F.col("start").alias("char_start"), F.col("end").alias("char_end"), F.col("text").alias("printed"), "jurisdiction", "court"),
      "key string, char_start int, char_end int, printed string, jurisdiction string, court string",
      [("a", 14, 27, "2008 SCMR 598", "PK", None), ("b", 0, 12, "PLD 2013 SC1", "PK", "SC"), ("b", 14, 29, "PLD 2013 SC 501", "PK", "SC")])

C.add("fn16_case_name", "key string, text string",
      [("a", "reliance is placed on Income- Tax Officer and another v. M/s Chappal Builders (1993 PTD 1108 = 1993 SCMR 1108) and"), ("b", "as held in 2019 CLC 76 (2019 Lahore) and Saleem Khan v. Mst. Razia Bibi (2005 SCMR 911)."), ("c", "See PLD 1970 SC 39; 1972 SCMR 47 and 1981 SCMR 758.")],
      lambda df: citations.citation_mentions(df, "key").filter("petitioner IS NOT NULL").select("key", F.col("id").alias("citation"), "petitioner", "respondent"),
      "key string, citation string, petitioner string, respondent string",
      [("a", "1993 PTD 1108", "Income- Tax Officer and another", "M/s Chappal Builders"), ("a", "1993 SCMR 1108", "Income- Tax Officer and another", "M/s Chappal Builders"), ("b", "2005 SCMR 911", "Saleem Khan", "Mst. Razia Bibi")])

C.add("ag07_parallel_citations", "key string, text string", [("a", "(1993 PTD 1108 = 1993 SCMR 1108) and"), ("b", "Reference can be made to PLD 1970 SC 39; 1972 SCMR 47 and 1981 SCMR 758."), ("c", "2001 CLC 5 = 2001 MLD 6 = 2001 YLR 7; 2002 CLC 9")],
      lambda df: citations.citation_mentions(df, "key").filter("parallel IS NOT NULL").select("key", F.col("id").alias("citation"), F.array_join("parallel", " = ").alias("members")),
      "key string, citation string, members string",
      [("a", "1993 PTD 1108", "1993 PTD 1108 = 1993 SCMR 1108"), ("a", "1993 SCMR 1108", "1993 PTD 1108 = 1993 SCMR 1108")] + [("c", c, "2001 CLC 5 = 2001 MLD 6 = 2001 YLR 7") for c in ("2001 CLC 5", "2001 MLD 6", "2001 YLR 7")])

C.add("fn14_self_citation", "case_no int, text string, iso string, printed string", [(0, "2023 LHC 5924", "2023-05-06", None), (1, None, None, "decided on 3.2.1999, announced 2001"), (2, "no reporter", "20", "in 1776"), (3, "(2020 PHC 12)", None, None)],
      lambda df: df.select("case_no", F.pandas_udf(lambda t: t.map(lambda x: next((c["id"] for c in citations.find_citations(x)), None)), "string")("text").alias("own"),
                           F.coalesce(F.when(F.col("iso").rlike("^[0-9]{4}"), F.substring("iso", 1, 4)), F.try_element_at(F.regexp_extract_all("printed", F.lit(r"\b(1[89]\d{2}|20\d{2})\b"), F.lit(1)), F.lit(-1))).cast("int").alias("decided")),
      "case_no int, own string, decided int", [(0, "2023 LHC 5924", 2023), (1, None, 2001), (2, None, None), (3, "2020 PHC 12", None)])

C.add("prj19_citation_population", "alias string, series string, jurisdiction string, rung string, named boolean",
      [("a", "SCMR", "PK", "alias", True), ("b", "LHC", "PK", None, False), ("c", "SCC", "IN", None, True), ("d", "CLC", "PK", None, True), ("e", "CLC", "PK", None, False)],
      lambda df: df.filter((F.col("jurisdiction") == "PK") & ~F.col("series").isin(*citations.NEUTRAL)).select("alias", F.coalesce("rung", F.when(F.col("named"), "named").otherwise("unnamed")).alias("stratum")),
      "alias string, stratum string", [("a", "alias"), ("d", "named"), ("e", "unnamed")])

# case numbers
_NUMBERS = [
    ("Writ Petition No.2385/2006", "WP/2385/2006"), ("W.P.No.2385 of 2006", "WP/2385/2006"), ("WRIT PETITION NO. 2385/06", "WP/2385/2006"), ("Crl.Misc.No.5072-Bof2013", "CRL.MISC/5072-B/2013"), ("Crl. Appeal No.374-J of 2009", "CRL.A/374-J/2009"),
    ("ICA No.224-2013", "ICA/224/2013"), ("FAO No.195 of\n2012", "FAO/195/2012"), ("C.M. No.494-03", "C.M./494/2003"), ("Criminal Appeal No. 909", "CRL.A/909/?"), ("Criminal Appeals No. 599, 600 & 602 of 2020", "CRL.A/599/2020; CRL.A/600/2020; CRL.A/602/2020"),
    ("Civil Petitions No. 1054-K & 1055-K of 2023", "C.P./1054-K/2023; C.P./1055-K/2023"), ("WPs Nos. 10398/08, 17812/09 & 20670/2010 respectively", "WP/10398/2008; WP/17812/2009; WP/20670/2010"),
    ("Crl.A.No.130/2005 and M.R.No.213/2005", "CRL.A/130/2005; M.R./213/2005"), ("WP No. 246503, 254424- 25, 254408 of 2018", "WP/246503/2018; WP/254424/2018; WP/254425/2018; WP/254408/2018"), ("C. P. No. D-1306/2012", "C.P./D-1306/2012"),
    ("Crl.A.Nos.304, 305 & M.R.No.39 of 2014/Bwp.", "CRL.A/304/2014; CRL.A/305/2014; M.R./39/2014"), ("Cr. As. No. 281, 303/2012", "CRL.A/281/2012; CRL.A/303/2012"),
    ("Customs Reference Application Nos. 28724 to 28725/25", "CUSTOMS.REF/28724/2025; CUSTOMS.REF/28725/2025"), ("whereby Writ Petition No.17047/2015 of the", "WP/17047/2015"), ("case FIR No.1145/2013", ""),
    ("CIVIL APPEALS NO.1113 TO 1116 OF 2017", "C.A./1113/2017; C.A./1114/2017; C.A./1115/2017; C.A./1116/2017"), ("Tax Reference No. 5 of 2010", "TAXREFERENCE/5/2010"), (None, ""), ("no case here", ""),
]
C.add("fn19_case_number_parser", "case_no int, text string", numbered([t for t, _ in _NUMBERS]), by_text(lambda t: "; ".join(cases.case_numbers(t))), "case_no int, answer string", numbered([a for _, a in _NUMBERS]))
C.add("fn21_path_labels", "path string", [("a/SCP_Crl.P.L.A.467_2023_01-02-2024.pdf",), ("a/SCP_C.R.P.296_2020_.pdf",), ("b/2023LHC5924.pdf",), ("c/Criminal Appeal-31-2020 _ Citation Awaited/judgment.pdf",), ("c/Criminal Appeal-31-2020 _ Citation Awaited/order_05032021_1.pdf",), ("d/other.pdf",)],
      lambda df: path_labels(df), "path string, court_id string, case_key string, neutral string, decided string",
      [("a/SCP_Crl.P.L.A.467_2023_01-02-2024.pdf", "supreme_court_pakistan", "CRL.P/467/2023", None, "2024-02-01"), ("a/SCP_C.R.P.296_2020_.pdf", "supreme_court_pakistan", "C.R.P./296/2020", None, None), ("b/2023LHC5924.pdf", "lahore_high_court", None, "2023 LHC 5924", None),
       ("c/Criminal Appeal-31-2020 _ Citation Awaited/judgment.pdf", "islamabad_high_court", "CRL.A/31/2020", None, None), ("c/Criminal Appeal-31-2020 _ Citation Awaited/order_05032021_1.pdf", "islamabad_high_court", "CRL.A/31/2020", None, "2021-03-05"), ("d/other.pdf", None, None, None, None)])


def path_labels(df):
    """path, court_id, case_key, neutral, decided: what a file's or its folder's name states, by the three courts' patterns."""
    name, folder = F.element_at(F.split("path", "/"), -1), F.element_at(F.split("path", "/"), -2)
    sc, lhc, ihc, order = r"(?i)^SCP_(.+?)\.?(\d+(?:-[A-Za-z]+)?)_(\d{4})_(?:(\d{2})-(\d{2})-(\d{4}))?\.pdf$", r"(?i)^(\d{4})LHC(\d+)", r"^([A-Za-z][\w .&/'()-]*?)-(\d+)-(\d{4})(?:\s*_\s*(.+?))?\s*$", r"(?i)^order_(\d{2})(\d{2})(\d{4})_\d+\.pdf$"
    key = F.pandas_udf(lambda a, b, c: pd.Series([cases.label_case(*x) for x in zip(a, b, c)], dtype=object), "string")
    part = lambda col, p, i: F.nullif(F.regexp_extract(col, p, i), F.lit(""))
    kind, number, year = (F.coalesce(part(name, sc, i), part(folder, ihc, i)) for i in (1, 2, 3))
    court = F.when(name.rlike(sc), "supreme_court_pakistan").when(name.rlike(lhc), "lahore_high_court").when(folder.rlike(ihc), "islamabad_high_court")
    iso = lambda p, y, m, d: F.when(part(name, p, y).isNotNull(), F.concat_ws("-", part(name, p, y), part(name, p, m), part(name, p, d)))
    return df.select("path", court.alias("court_id"), key(kind, number, year).alias("case_key"), F.when(name.rlike(lhc), F.concat_ws(" ", part(name, lhc, 1), F.lit("LHC"), part(name, lhc, 2))).alias("neutral"), F.coalesce(iso(sc, 6, 5, 4), iso(order, 3, 2, 1)).alias("decided"))


# The courts of the registry in order, with their further spellings and codes.
COURTS = [("supreme_court_pakistan", "SUPREME COURT OF PAKISTAN", None, "SC"), ("federal_shariat_court", "FEDERAL SHARIAT COURT", None, "FSC"), ("lahore_high_court", "LAHORE HIGH COURT", None, "LHC"), ("islamabad_high_court", "ISLAMABAD HIGH COURT", None, "IHC"),
          ("sindh_high_court", "SINDH HIGH COURT", "HIGH COURT OF SINDH", "SHC"), ("peshawar_high_court", "PESHAWAR HIGH COURT", None, "PHC"), ("balochistan_high_court", "BALOCHISTAN HIGH COURT", None, "BHC")]


def court_of(printed):
    """The first court of the registry whose name, letters only, stands in what is printed."""
    plain, out = F.regexp_replace(F.lower(printed), "[^a-z]", ""), None
    for court, name, other, _ in COURTS:
        test = plain.contains("".join(c for c in name.lower() if c.isalpha()))
        test = test | plain.contains("".join(c for c in other.lower() if c.isalpha())) if other else test
        out = F.when(test, court) if out is None else out.when(test, court)
    return out


def court_name(printed):
    """What is printed, save where twelve letters run together: then the registry's name of the court."""
    whole = F.create_map(*[F.lit(x) for c in COURTS for x in c[:2]])
    return F.when(printed.rlike("[A-Za-z]{12,}"), F.coalesce(F.try_element_at(whole, F.coalesce(court_of(printed), F.lit(""))), printed)).otherwise(printed)


_COURTS = [("IN THE LAHORE HIGH COURT, LAHORE", "lahore_high_court", "IN THE LAHORE HIGH COURT, LAHORE"), ("INTHESUPREMECOURTOFPAKISTAN", "supreme_court_pakistan", "SUPREME COURT OF PAKISTAN"), ("High Court of Sindh at Karachi", "sindh_high_court", "High Court of Sindh at Karachi"), ("District Court", None, "District Court"), (None, None, None)]
C.add("fn20_court_lookup", "case_no int, printed string", numbered([c[0] for c in _COURTS]), lambda df: df.select("case_no", court_of(F.col("printed")).alias("court_id"), court_name(F.col("printed")).alias("name")), "case_no int, court_id string, name string", numbered([c[1:] for c in _COURTS]))

# parties
_PAIRS = [
    ("Muhammad Ajmal Khan", "x builders", "Khan Muhammad", "x builders", False), ("Muhammad Aslam", "The State", "Muhammad Aslam", "WAPDA", False), ("Commissioner Inland Revenue", "Packages Limited Lahore", "Commissioner Inland Revenue, Zone-II, RTO Lahore", "Packages Limited Lahore", True),
    ("Commissioner Inland Revenue", "Packages Limited Lahore", "Commissioner Inland Revenue, Zone-II", "Honda Atlas Cars", False), ("Bank of Punjab", "Ali Khan Sons", "Bank of Punjab through its President", "Ali Khan Sons", True), ("The State", "Federation of Pakistan", "The State", "Federation of Pakistan", False),
]
C.add("fn18_party_similarity", "case_no int, a string, b string, c string, d string", numbered([p[:4] for p in _PAIRS]),
      lambda df: df.select("case_no", (F.pandas_udf(lambda a, b, c, d: pd.Series([parties.name_likeness((w, x), (y, z))[0] for w, x, y, z in zip(a, b, c, d)]), "double")(*[T.party_key(x) for x in "abcd"]) >= parties.LEAST).alias("alike")),
      "case_no int, alike boolean", numbered([p[4] for p in _PAIRS]))
_HELD = ("judgment_id string, court_id string, year int, petitioner string, respondent string", [("j1", parties.SUPREME, 2007, "Ali Khan", "Bashir Ahmad"), ("j2", parties.SUPREME, 2010, "Zahid Mehmood", "Nasir Iqbal"), ("j3", parties.SUPREME, 2010, "Zahid Mehmood", "Nasir Iqbal"), ("j4", parties.LAHORE, 2007, "Ali Khan", "Bashir Ahmad")])
_CITED = ("alias string, petitioner string, respondent string, series string, court string, year int",
          [("2008 SCMR 1", "Ali Khan", "Bashir Ahmad", "SCMR", None, 2008), ("2005 SCMR 1", "Ali Khan", "Bashir Ahmad", "SCMR", None, 2005), ("2011 SCMR 5", "Zahid Mehmood", "Nasir Iqbal", "SCMR", None, 2011), ("PLD 2008 Karachi 1", "Ali Khan", "Bashir Ahmad", "PLD", "Karachi", 2008),
           ("PLD 2008 Lahore 1", "Ali Khan", "Bashir Ahmad", "PLD", "Lahore", 2008), ("2008 CLC 1", None, "Bashir Ahmad", "CLC", None, 2008)])
C.many("jn05_case_name_linkage", {"cited": _CITED, "held": _HELD}, lambda cited, held: parties.link_names(cited, held).select("alias", "judgment_id", "score", "runner_up", F.col("candidates").cast("int").alias("candidates")), "alias string, judgment_id string, score double, runner_up double, candidates int",
       [("2008 SCMR 1", "j1", 100.0, 0.0, 1), ("PLD 2008 Lahore 1", "j4", 100.0, 0.0, 1)])
C.many("jn06_candidate_search", {"cited": ("alias string, petitioner string, respondent string, series string, court string, year int", [("2012 SCMR 5", "Zahid Mehmood", "Nasir Iqbal", "SCMR", None, 2012)]), "held": _HELD}, parties.closest, "alias string, rank int, judgment_id string, score double",
       [("2012 SCMR 5", 1, "j2", 100.0), ("2012 SCMR 5", 2, "j3", 100.0), ("2012 SCMR 5", 3, "j1", 19.0)])

# acts
_SHORTS = [("THE PAKISTAN PENAL CODE", None, "PPC"), ("THE CODE OF CIVIL PROCEDURE, 1908", None, "CPC"), ("Cr.P.C.", None, "CRPC"), (None, "code_of_criminal_procedure_crpc_1898", "CRPC"), ("THE CONTRACT ACT, 1872", "contract_act", None), (None, "taxir_actx", None)]
C.add("fn07_act_short_form", "case_no int, title string, slug string", numbered([s[:2] for s in _SHORTS]), lambda df: df.select("case_no", F.coalesce(acts.short_form(F.col("title")), acts.short_form_of_slug(F.col("slug"))).alias("short")), "case_no int, short string", numbered([s[2] for s in _SHORTS]))
_KEYS = [("convicted under section 302 PPC and section 497 of the Cr.P.C. at", "302 PPC; 497 CRPC"), ("S. 9 CNSA and s. 12", "9 CNSA"), ("section 7 of the Anti-Terrorism Act", "7 ATA"), ("nothing", "")]
C.add("fn08_provision_pattern", "case_no int, text string", numbered([k[0] for k in _KEYS]), lambda df: df.select("case_no", F.array_join(acts.provision_keys(F.col("text")), "; ").alias("keys")), "case_no int, keys string", numbered([k[1] for k in _KEYS]))
_CUT = [("convicted under section 302 PPC and section 497 of the Cr.P.C. at", "302 PPC", "convicted under and section 497 of the Cr.P.C. at"), ("section 302  Pakistan Penal Code twice, u/s 302 P.P.C. again", "302 PPC", "twice, again"), ("no mention", "9 ATA", "no mention")]
C.add("fn09_without_provision", "case_no int, text string, key string", numbered([k[:2] for k in _CUT]), lambda df: df.select("case_no", acts.without_provision(F.col("text"), F.col("key")).alias("rest")), "case_no int, rest string", numbered([(k[2],) for k in _CUT]))

# provisions
_PPC, _CPC, _CRPC, _CNSA, _QSO = "5_ppc", "6_code_of_civil_procedure_cpc", "4_code_of_criminal_procedure_crpc", "893_cnsa", "945_qso"
_CONST, _CONTRACT, _STAMP = "1_constitution_of_the_islamic_republic_of_pakistan", "72_contract_act_1872", "151_stamp_act_1899"


def sample_code() -> provisions.Held:
    """A small code of eight instruments."""
    return provisions.Held(
        federal=[(_CONTRACT, [("contract", "act")], 1872, 17), (_STAMP, [("stamp", "act")], 1899, 14)], short={"PPC": _PPC, "CPC": _CPC, "CRPC": _CRPC, "CNSA": _CNSA, "QSO": _QSO}, constitution=_CONST,
        sections={_PPC: {"302", "324", "34", "337F"}, _CPC: {"12"}, _CRPC: {"497"}, _CNSA: {"9"}, _CONST: {"199"}, _CONTRACT: {"54", "3"}, _QSO: {"2", "3", "17"}, _STAMP: {"12"}},
        kinds={_PPC: "code", _CPC: "code", _CRPC: "code", _CNSA: "act", _CONST: "constitution", _CONTRACT: "act", _QSO: "order", _STAMP: "act"},
    )


_MENTIONS = [
    ("The FIR was registered under sections 302, 324 and 34 PPC at Police Station Saddar.", [(_PPC, "302", None, "abbreviation", "charged_under"), (_PPC, "324", None, "abbreviation", "charged_under"), (_PPC, "34", None, "abbreviation", "charged_under")]),
    ("He was convicted under section 337-F(i) PPC.", [(_PPC, "337F", "(i)", "abbreviation", "charged_under")]),
    ("Article 199(1)(a) of the Constitution applies. The petition under Article 199 was filed.", [(_CONST, "199", "(1)(a)", "constitution", "mentioned"), (_CONST, "199", None, "article_default", "invoked")]),
    ("Section 54 of the Contract Act, 1872 governs. Section 3 of the Act is relevant.", [(_CONTRACT, "54", None, "title", "mentioned"), (_CONTRACT, "3", None, "reference_back", "mentioned")]),
    ("Order XXXIX Rules 1 and 2 CPC deals with temporary injunctions.", [(_CPC, "O.XXXIX", "R.1,2", "abbreviation", "mentioned")]),
    ("The question is the scope of section 497(2) Cr.P.C. in such cases.", [(_CRPC, "497", "(2)", "abbreviation", "interpreted")]),
    ("Muhammad Sohara S.I recorded the statement under the Police Rules 1934.", []),
    ("The crime report named Sections 409, 467, 477-A, and 109 of the PPC.", [(_PPC, n, None, "abbreviation", "mentioned") for n in ("409", "467", "477A", "109")]),
    ("He relied on PPC section 302 for the purpose.", [(_PPC, "302", None, "named_before", "mentioned")]),
    ("Article 17 read with Article 3 of the Qanun-e-Shahadat Order applies.", [(_QSO, "17", None, "article_default_qso", "mentioned"), (_QSO, "3", None, "abbreviation", "mentioned")]),
    ("Article 102 of the Constitution of UAE provides otherwise.", [(None, "102", None, "unstated", "mentioned")]),
    ("Section 12 of the Stamp Act, 1899 was cited. The dispute is governed by the Punjab Rented Premises Act, 2009 (the Act). Section 12(a) of the Act requires a certified copy.", [(_STAMP, "12", None, "title", "mentioned"), (None, "12", "(a)", "reference_back", "mentioned")]),
    ("The perusal of section 6 of Ordinance 1984 shows that registration is required.", [(None, "6", None, "title", "mentioned")]),
]
C.add("fn29_provision_mentions", "key string, text string", [(str(i), t) for i, (t, _) in enumerate(_MENTIONS)], lambda df: provisions.read_mentions(df, "key", sample_code).select("key", "statute_id", "section", "pinpoint", "method", "role"),
      "key string, statute_id string, section string, pinpoint string, method string, role string", [(str(i), *m) for i, (_, ms) in enumerate(_MENTIONS) for m in ms])
_TITLE_CASES = [("Contract Act, 1872", _CONTRACT, None), ("Contract Act, 1913", None, "not_found_in_federal_code"), ("Punjab Pre-emption Act, 1913", None, "not_held_for_this_jurisdiction"), ("Ordinance 1984", None, "title_names_no_statute"), ("Customs Rules", None, "subordinate_legislation_not_in_the_code"), ("The Stamp Act", _STAMP, None)]
C.add("jn09_title_lookup", "case_no int, text string", numbered([t[0] for t in _TITLE_CASES]), lambda df: df.select("case_no", F.pandas_udf(lambda t: pd.DataFrame([sample_code().resolve(x)[:2] for x in t], columns=["statute_id", "reason"]), "statute_id string, reason string")("text").alias("r")).select("case_no", "r.*"),
      "case_no int, statute_id string, reason string", numbered([t[1:] for t in _TITLE_CASES]))
_LAND = [("Sindh Rented Premises Ordinance, 1979", "Sindh"), ("West Pakistan Land Revenue Act, 1967", "West Pakistan"), ("N.W.F.P. Tenancy Act", "Khyber Pakhtunkhwa"), ("Government of India Act, 1935", "Federal"), ("Indian Penal Code", "India"), ("Baluchistan Act", "Balochistan"), (None, "Federal")]
C.add("fn27_jurisdiction", "case_no int, title string", numbered([x[0] for x in _LAND]), lambda df: df.select("case_no", provisions.jurisdiction(F.col("title")).alias("jurisdiction")), "case_no int, jurisdiction string", numbered([x[1] for x in _LAND]))

# treatment: text, citation asked, label asked, whether that is its treatment
_TREATED = [
    ("The view taken in Ahmad v. Bashir (PLD 1990 SC 1) has since been overruled.", "PLD 1990 SC 1", "overruled", True), ("That view was overruled in Province of Punjab v. Ali (PLD 2010 SC 11).", "PLD 2010 SC 11", "overruled", False),
    ("Relying on PLD 2001 SC 5, the preliminary objection is overruled.", "PLD 2001 SC 5", "overruled", False), ("Counsel cited PLD 1990 SC 1 (overruled) and 2005 SCMR 911 in support.", "PLD 1990 SC 1", "overruled", True),
    ("Counsel cited PLD 1990 SC 1 (overruled) and 2005 SCMR 911 in support.", "2005 SCMR 911", "overruled", False), ("The judgment in 2005 SCMR 911 has not been overruled so far.", "2005 SCMR 911", "overruled", False),
    ("Learned counsel for the petitioner has relied upon 2005 SCMR 911 to argue otherwise.", "2005 SCMR 911", "cited_by_counsel", True), ("Reliance is placed on Muhammad Ali v. State (2005 SCMR 911).", "2005 SCMR 911", "followed", True),
    ("The cases 2005 SCMR 911 and PLD 1990 SC 1 are distinguishable on facts.", "2005 SCMR 911", "distinguished", True), ("The cases 2005 SCMR 911 and PLD 1990 SC 1 are distinguishable on facts.", "PLD 1990 SC 1", "distinguished", True),
    ("They had been declared by the five member bench of this court in the case of Gulshan Bibi vs. Muhammad Sadiq (PLD 2016 SC 769) as “not a good law.”", "PLD 2016 SC 769", "not_good_law", False),
    ("Ekram Khan v. Commissioner (2004 SCMR 183) overruled both the judgments rendered earlier.", "2004 SCMR 183", "overruled", False), ("Their Lordships overruled Subedar Abdul Rehman v. The State (1981 PCrLJ 61) which held otherwise.", "1981 PCrLJ 61", "overruled", True),
    ("A Bench decision in PLD 1979 SC 741 can be overruled by a larger Bench.", "PLD 1979 SC 741", "overruled", False), ("He placed reliance on Malik Gul Hassan v. Federation (2016 SCMR 1030).", "2016 SCMR 1030", "followed", False),
    ("The judgment in Pervez Musharraf v. Federation (PLD 2020 Lahore 285), which has subsequently been set aside by the Supreme Court, cannot be relied on.", "PLD 2020 Lahore 285", "reversed", True),
    ("Silk Bank v. Al-Khan (2017 CLD 496) and judgment dated 21.11.2011 in C.O.S. No. 210 of 2010. The case law relied upon by learned counsel for the defendants is distinguishable.", "2017 CLD 496", "distinguished", False),
    ("The dictum has been further followed by this Court in Falcon Ventures v. Banking Court (2004 CLD 726).", "2004 CLD 726", "followed", True),
]
C.add("fn32_treatment_classifier", "key string, text string, alias string, label string", [(str(i), *t[:3]) for i, t in enumerate(_TREATED)],
      lambda df: treatment.read_treatments(df, "key").join(df.select("key", "alias", "label"), ["key", "alias"]).select("key", "alias", "label", (F.col("treatment") == F.col("label")).alias("so")), "key string, alias string, label string, so boolean", [(str(i), *t[1:]) for i, t in enumerate(_TREATED)])
_ENDS = [("x " * 2000 + "For the foregoing reasons, this appeal is allowed and the impugned judgment is set aside.", "allowed"), ("x " * 2000 + "The petition is dismissed.", "dismissed"), ("x " * 2000 + "The appeal is allowed and the case is remanded to the trial court.", "remanded"),
         ("The petition is dismissed. " + "x " * 4000, None), ("leave to appeal is refused", "leave_refused"), ("C.M. application is disposed of", None), ("the petition is partly allowed", "partly_allowed"), (None, None)]
C.add("fn33_disposition_of_order", "case_no int, text string", numbered([e[0] for e in _ENDS]), lambda df: df.select("case_no", treatment.outcome_of(T.closing_window("text", treatment.SHARE, treatment.LEAST, treatment.MOST)).alias("outcome")), "case_no int, outcome string", numbered([(e[1],) for e in _ENDS]))

# appeals and the citator
_RECITED = [
    ("(Against the impugned judgment dated 24.03.2022 passed by the Lahore High Court, Lahore in W.P. No. 75382/2021) Ishfaq Ahmed … Petitioner Versus", [("lahore_high_court", "2022-03-24", "WP/75382/2021")]),
    ("Against the order dated 11.06.2024 passed by this Court in CPLA No. 304/2022) X", [("supreme_court_pakistan", "2024-06-11", "C.P./304/2022")]), ("against the judgments delivered in writ petitions, intra court appeals were not maintainable dated 12.01.2020", []),
]
_recited = "array<struct<court_id:string,dates:array<string>,cases:array<string>>>"
C.add("fn35_appeal_recitals", "case_no int, text string", numbered([r[0] for r in _RECITED]),
      lambda df: df.select("case_no", F.explode(F.pandas_udf(lambda t: t.map(lambda x: [{k: r[k] for k in ("court_id", "dates", "cases")} for r in treatment.recitals(x, "supreme_court_pakistan")]), _recited)("text")).alias("r")).select("case_no", "r.court_id", F.array_join("r.dates", "; ").alias("dates"), F.array_join("r.cases", "; ").alias("keys")),
      "case_no int, court_id string, dates string, keys string", [(i, *x) for i, (_, xs) in enumerate(_RECITED) for x in xs])


def appeal_states(recited, aliases, judgments):
    """from_judgment, lower_case, state, to_judgment. recited: from_judgment, court_id, case_key, dates; aliases: alias (COURT:CASE),
    judgment_id; judgments: judgment_id, court_id, decision_date. A case links only where case and date both agree, and to one."""
    known = aliases.join(judgments.select("judgment_id", "decision_date"), "judgment_id", "left").withColumnRenamed("judgment_id", "held")
    r = recited.withColumn("alias", F.concat_ws(":", "court_id", "case_key"))
    met = r.join(known, "alias", "left").filter("held IS NULL OR held != from_judgment")
    # the judgment itself is no candidate; a recital whose only candidate was itself keeps its row
    per = r.select("from_judgment", "court_id", "case_key", "dates").join(
        met.filter("held IS NOT NULL").groupBy("from_judgment", "court_id", "case_key").agg(F.collect_set("held").alias("all_of"), F.collect_set(F.when(F.array_contains("dates", F.col("decision_date")), F.col("held"))).alias("dated")), ["from_judgment", "court_id", "case_key"], "left")
    courts = judgments.select(F.col("court_id"), F.lit(True).alias("_court")).distinct()
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    state = F.when(F.col("_court").isNull(), "court_not_held").when(F.col("case_key").endswith("/?"), "no_year_in_case_number").when(n("all_of") == 0, "case_not_held").when(n("dated") == 1, "resolved").when(n("dated") > 1, "ambiguous").otherwise("case_held_date_differs")
    return per.join(courts, "court_id", "left").select("from_judgment", F.col("case_key").alias("lower_case"), state.alias("state"), F.when(state == "resolved", F.col("dated")[0]).alias("to_judgment"))


C.many("jn13_appeal_resolution", {
    "recited": ("from_judgment string, court_id string, case_key string, dates array<string>", [("js", "lahore_high_court", "WP/75382/2021", ["2022-03-24"]), ("js", "lahore_high_court", "WP/2/2021", ["2022-03-24"]), ("js", "lahore_high_court", "WP/3/?", ["2022-03-24"]), ("js", "tribunal", "WP/4/2001", ["2022-03-24"]),
                ("jt", "lahore_high_court", "WP/75382/2021", ["2020-01-01"]), ("jt", "lahore_high_court", "WP/9/2020", ["2020-05-05"]), ("jl", "lahore_high_court", "WP/75382/2021", ["2022-03-24"])]),
    "aliases": ("alias string, judgment_id string", [("lahore_high_court:WP/75382/2021", "jl"), ("lahore_high_court:WP/9/2020", "ja"), ("lahore_high_court:WP/9/2020", "jb")]),
    "judgments": ("judgment_id string, court_id string, decision_date string", [("jl", "lahore_high_court", "2022-03-24"), ("js", "supreme_court_pakistan", "2023-01-01"), ("ja", "lahore_high_court", "2020-05-05"), ("jb", "lahore_high_court", "2020-05-05")])}, appeal_states,
    "from_judgment string, lower_case string, state string, to_judgment string",
    [("js", "WP/75382/2021", "resolved", "jl"), ("js", "WP/2/2021", "case_not_held", None), ("js", "WP/3/?", "no_year_in_case_number", None), ("js", "WP/4/2001", "court_not_held", None), ("jt", "WP/75382/2021", "case_held_date_differs", None), ("jt", "WP/9/2020", "ambiguous", None), ("jl", "WP/75382/2021", "case_not_held", None)])


def treatment_edges(cites, readings):
    """from_judgment, alias, to_judgment, treatment, evidence (three at most): the strongest reading of each citation; not_read where none."""
    rank = F.array_position(F.array(*map(F.lit, treatment.STRENGTH)), F.col("treatment"))
    best = readings.groupBy("from_judgment", "alias").agg(F.min_by("treatment", rank).alias("best"))
    own = readings.join(best, ["from_judgment", "alias"]).filter("treatment = best").groupBy("from_judgment", "alias", "best").agg(F.slice(F.sort_array(F.collect_list("start")), 1, 3).alias("starts"))
    j = cites.join(own, ["from_judgment", "alias"], "left")
    return j.select("from_judgment", "alias", "to_judgment", F.coalesce("best", F.lit("not_read")).alias("treatment"), F.coalesce(F.size("starts"), F.lit(0)).alias("evidence"))


_CITES = ("from_judgment string, alias string, to_judgment string", [("a", "x1", "t1"), ("b", "x1", "t1"), ("c", "x2", "t2"), ("d", "x3", "t3"), ("e", "x9", None), ("f", "x4", "t4")])
_READ = ("from_judgment string, alias string, treatment string, start int", [("a", "x1", "referred", 1), ("a", "x1", "overruled", 2), ("a", "x1", "overruled", 3), ("a", "x1", "overruled", 4), ("a", "x1", "overruled", 5), ("b", "x1", "followed", 1), ("c", "x2", "doubted", 1), ("f", "x4", "followed", 8)])
C.many("jn14_treatment_join", {"cites": _CITES, "readings": _READ}, treatment_edges, "from_judgment string, alias string, to_judgment string, treatment string, evidence int",
       [("a", "x1", "t1", "overruled", 3), ("b", "x1", "t1", "followed", 1), ("c", "x2", "t2", "doubted", 1), ("d", "x3", "t3", "not_read", 0), ("e", "x9", None, "not_read", 0), ("f", "x4", "t4", "followed", 1)])


def construed_and_changed(concerns, statuses):
    """judgment_id, statute_id, section, role, version_status of provisions a judgment construed that have changed since."""
    roles = concerns.filter(F.col("role").isin("interpreted", "vires_challenged"))
    changed = statuses.filter(F.col("version_status").isin("replaced_since", "repealed"))
    return roles.join(changed, ["judgment_id", "statute_id", "section"]).select("judgment_id", "statute_id", "section", "role", "version_status")


_CONCERN = ("judgment_id string, statute_id string, section string, role string", [("t3", "s", "1", "interpreted"), ("t3", "s", "2", "mentioned"), ("t5", "s", "3", "vires_challenged")])
_STATUS = ("judgment_id string, statute_id string, section string, version_status string", [("t3", "s", "1", "replaced_since"), ("t3", "s", "2", "repealed"), ("t5", "s", "3", "amended_since")])
C.many("jn15_construed_and_changed", {"concerns": _CONCERN, "statuses": _STATUS}, construed_and_changed, "judgment_id string, statute_id string, section string, role string, version_status string", [("t3", "s", "1", "interpreted", "replaced_since")])


def citator(judgments, cites, readings, appeals, concerns, statuses):
    """judgment_id, status (negative, caution, positive, no_treatment_seen), citing: of each judgment, by the treatments of the
    judgments citing it, the results of appeals from it and changes of provisions it construed. appeals: to_judgment, outcome."""
    edges = treatment_edges(cites, readings).filter("to_judgment IS NOT NULL")
    flag = lambda *xs: F.max(F.col("treatment").isin(*xs).cast("int"))
    cited = edges.groupBy(F.col("to_judgment").alias("judgment_id")).agg(flag(*treatment.NEGATIVE).alias("bad"), flag("doubted").alias("doubt"), flag("followed").alias("good"), F.countDistinct("from_judgment").cast("int").alias("citing"))
    up = appeals.groupBy(F.col("to_judgment").alias("judgment_id")).agg(F.max((F.col("outcome") == "allowed").cast("int")).alias("gone"), F.max(F.col("outcome").isin("partly_allowed", "remanded").cast("int")).alias("bent"))
    moved = construed_and_changed(concerns, statuses).select("judgment_id", F.lit(1).alias("moved")).distinct()
    j = judgments.select("judgment_id").join(cited, "judgment_id", "left").join(up, "judgment_id", "left").join(moved, "judgment_id", "left").na.fill(0)
    status = F.when((F.col("bad") + F.col("gone")) > 0, "negative").when((F.col("doubt") + F.col("bent") + F.col("moved")) > 0, "caution").when(F.col("good") > 0, "positive").otherwise("no_treatment_seen")
    return j.select("judgment_id", status.alias("status"), "citing")


C.many("ag11_citator", {"judgments": ("judgment_id string", [("t1",), ("t2",), ("t3",), ("t4",), ("t5",), ("t6",), ("t7",)]), "cites": _CITES, "readings": _READ, "appeals": ("to_judgment string, outcome string", [("t6", "allowed"), ("t7", "remanded"), ("t4", "dismissed")]), "concerns": _CONCERN, "statuses": _STATUS},
       citator, "judgment_id string, status string, citing int", [("t1", "negative", 2), ("t2", "caution", 1), ("t3", "caution", 1), ("t4", "positive", 1), ("t5", "no_treatment_seen", 0), ("t6", "negative", 0), ("t7", "caution", 0)])

# versions
_NOTES = ("document_id string, page int, ord int, text string", [("d", 7, 1, "3Added by Act No. VIII of 1993, s.3, (w.e.f. 20-11-93, SRO). 4Subs. by the Law Reforms Ordinance, 1972 (XII of 1972), s. 2."), ("d", 7, 2, "5Proviso added ibid."), ("d", 8, 1, "1Ins. by Ord. LXXXV of 2002, s. 3.")])
C.many("fn36_amendment_notes", {"footnotes": _NOTES}, lambda footnotes: versions.note_events(footnotes).select("page", "number", F.array_join("kinds", "+").alias("kinds"), "instrument", "year", "effective"), "page int, number string, kinds string, instrument string, year int, effective string",
       [(7, "3", "added", "Act No. VIII of 1993", 1993, "1993-11-20"), (7, "4", "substituted", "the Law Reforms Ordinance, 1972 (XII of 1972)", 1972, None), (7, "5", "added", "the Law Reforms Ordinance, 1972 (XII of 1972)", 1972, None), (8, "1", "inserted", "Ord. LXXXV of 2002", 2002, None)])
C.many("jn11_marker_to_footnote", {"blocks": ("document_id string, section string, page int, ord int, text string", [("d", "489F", 8, 1, "1[489-F. Dishonestly issuing a cheque. Whoever"), ("d", "489F", 8, 2, "dishonestly 1[issues] a cheque]"), ("d", "5", 7, 1, "5. In this section 4[the Court] may 3[, with leave,] act."), ("d", "199", 7, 1, "5199. Repeal."), ("d", "6", 8, 1, "6. No 3[note] here.")]), "footnotes": _NOTES},
       lambda blocks, footnotes: versions.section_events(blocks, versions.note_events(footnotes)).select("section", "page", "marker", "year", "whole_section"), "section string, page int, marker string, year int, whole_section boolean",
       [("489F", 8, "1", 2002, True), ("5", 7, "4", 1972, False), ("5", 7, "3", 1993, False), ("199", 7, "5", 1972, True)])
_EV = "array<struct<kinds:array<string>,year:int,whole_section:boolean>>"
_STATES = [([(["inserted"], 2002, True)], False, 1999, "not_yet_in_force"), ([(["inserted"], 2002, True)], False, 2010, "current_text_applies"), ([(["substituted", "inserted", "omitted"], 2025, True)], False, 2019, "replaced_since"), ([(["substituted"], 2016, False)], False, 2014, "amended_since"), ([], True, 2014, "repealed"), ([], False, None, "decision_year_unknown"), ([(["added"], None, False)], False, 2000, "undated_change")]
C.add("fn37_version_states", f"case_no int, events {_EV}, repealed boolean, decided int", numbered([s[:3] for s in _STATES]), lambda df: df.select("case_no", versions.version_status(F.col("events"), F.col("repealed"), F.col("decided")).alias("state")), "case_no int, state string", numbered([s[3] for s in _STATES]))
C.many("jn12_concern_versions", {"concerns": ("judgment_id string, statute_id string, kind string, section string", [("j", "s", "section", "5"), ("j", "s", "section", "6"), ("k", "s", "article", "5"), ("j", "s", "order", "5")]), "judgments": ("judgment_id string, decided int", [("j", 1990), ("k", None)]),
       "sections": (f"statute_id string, section string, repealed boolean, events {_EV}", [("s", "5", False, [(["substituted"], 2001, True)])])}, versions.concern_versions, "judgment_id string, statute_id string, kind string, section string, decided int, version_status string",
       [("j", "s", "section", "5", 1990, "replaced_since"), ("j", "s", "section", "6", 1990, "section_not_indexed"), ("k", "s", "article", "5", None, "decision_year_unknown"), ("j", "s", "order", "5", 1990, "section_not_indexed")])

# chunks
_BOUND = [("1. The first. 2. The second (a) sub", "paragraph", "0; 14"), ("One. Two; Three: x. Four", "sentence", "3; 8; 18"), ("text (1) one (a) two (ab) three (abc) four", "subsection", "5; 13; 21"), ("", "sentence", "")]
C.add("fn03_boundaries", "case_no int, text string, kind string", numbered([b[:2] for b in _BOUND]), lambda df: df.select("case_no", F.pandas_udf(lambda t, k: pd.Series(["; ".join(map(str, chunking.boundaries(a, b))) for a, b in zip(t, k)], dtype=object), "string")("text", "kind").alias("offsets")), "case_no int, offsets string", numbered([b[2] for b in _BOUND]))
_PACKS = [("x" * 100, [], 10, "0-40; 40-80; 80-100"), ("x" * 100, [30, 38, 70], 10, "0-38; 38-70; 70-100"), ("x" * 39, [5], 10, "0-39"), ("x" * 40, [5], 10, "0-5; 5-40"), ("x" * 40 + " " * 41, [], 10, "0-40"), ("", [], 10, "")]
C.add("fn04_pack", "case_no int, text string, stops array<int>, budget int", numbered([p[:3] for p in _PACKS]), lambda df: df.select("case_no", F.pandas_udf(lambda t, s, b: pd.Series(["; ".join(f"{x}-{y}" for x, y in chunking.pack(*a)) for a in zip(t, map(list, s), b)], dtype=object), "string")("text", "stops", "budget").alias("pieces")), "case_no int, pieces string", numbered([p[3] for p in _PACKS]))
C.many("fn05_statute_chunks", {"docs": ("document_id string, title string, text string", [("d", "THE PAKISTAN PENAL CODE", "Head. 1. Short title. This is it. 2. Long (a) " + "y" * 30 + " (b) end of it"), ("act_x", None, "1. Only section")]), "markers": ("document_id string, at int, number string, heading string", [("d", 6, "1", "Short title"), ("d", 34, "2", " "), ("act_x", 0, "1", None)])},
       lambda docs, markers: chunking.chunk_statutes(docs, markers, 10).select("id", "text", "prefix", "citation", "char_start", "char_end"), "id string, text string, prefix string, citation string, char_start int, char_end int",
       [("d#0000", "1. Short title. This is it.", "THE PAKISTAN PENAL CODE — section 1: Short title", "1 PPC", 6, 34), ("d#0001", "2. Long", "THE PAKISTAN PENAL CODE — section 2", "2 PPC", 34, 42), ("d#0002", "(a) " + "y" * 30, "THE PAKISTAN PENAL CODE — section 2", "2 PPC", 42, 77), ("d#0003", "(b) end of it", "THE PAKISTAN PENAL CODE — section 2", "2 PPC", 77, 90),
        ("act_x#0000", "1. Only section", "act_x — section 1", "section 1 of act_x", 0, 15)])
C.many("fn06_judgment_chunks", {"docs": ("document_id string, source string, text string, court string, case_number string, decided string, neutral_citation string, case_title string", [("j", "lhc", "1. The plea was heard at length. 2. The order is upheld by us. 3. Costs follow.", None, "WP 1/2001", "2001-02-03", "2001 LHC 5", "A v. B"), ("k", "sc", "Short", "Supreme Court", None, "", None, None)])},
       lambda docs: chunking.chunk_judgments(docs, 10).select("id", "text", "prefix", "citation", "title", F.col("structure")["number"].alias("number")), "id string, text string, prefix string, citation string, title string, number string",
       [("j#0000", "1. The plea was heard at length.", "lhc — WP 1/2001 — 2001-02-03", "2001 LHC 5", "A v. B", "1"), ("j#0001", "2. The order is upheld by us.", "lhc — WP 1/2001 — 2001-02-03", "2001 LHC 5", "A v. B", "2"), ("j#0002", "3. Costs follow.", "lhc — WP 1/2001 — 2001-02-03", "2001 LHC 5", "A v. B", "3"), ("k#0000", "Short", "Supreme Court — k", None, "k", None)])

# comparators of labels and extracted values
_DATES = [("11-09-2025", "11.9.2025", True), ("2.6.2005", "02/06/2005", True), ("11-09-25", "11-09-2025", False), (None, "1.1.2001", False), ("12-09-2025", "11-09-2025", False)]


def same_date(a, b):
    parts = lambda c: F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1))
    x, y = parts(a), parts(b)
    ok = (F.size(x) == 3) & (F.size(y) == 3) & (F.length(F.try_element_at(x, F.lit(3))) == 4) & (F.length(F.try_element_at(y, F.lit(3))) == 4)
    as_ints = lambda v: F.transform(v, lambda p: p.cast("int"))
    return F.coalesce(F.when(ok, as_ints(x) == as_ints(y)), F.lit(False))


def same_name(a, b):
    x, y = (F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]", "") for c in (a, b))
    return (x != "") & (y != "") & (x.contains(y) | y.contains(x))


def same_case(number, year, printed):
    """The label's number and year both stand in what is printed, compared as numbers."""
    held = F.transform(F.regexp_extract_all(printed, F.lit(r"(\d+)"), F.lit(1)), lambda p: p.cast("bigint"))
    n = F.nullif(F.regexp_extract(number, r"(\d+)", 1), F.lit("")).cast("bigint")
    return F.coalesce(F.array_contains(held, n) & F.array_contains(held, year.cast("bigint")), F.lit(False))


C.add("prj24_same_date", "case_no int, a string, b string", numbered([x[:2] for x in _DATES]), lambda df: df.select("case_no", same_date(F.col("a"), F.col("b")).alias("same")), "case_no int, same boolean", numbered([x[2] for x in _DATES]))
_NAMES = [("Babar Sattar", "Mr. Justice Babar Sattar, J.", "8", 2026, "No.08-B of 2026", True, True), ("A. Khan", "B. Khan", "634", 2018, "Civil Appeal No. 634", False, False), (None, "X", "9", 2001, None, False, False)]
C.add("prj24_same_name_and_case", "case_no int, a string, b string, number string, year int, printed string", numbered([x[:5] for x in _NAMES]), lambda df: df.select("case_no", same_name(F.col("a"), F.col("b")).alias("name"), same_case(F.col("number"), F.col("year"), F.col("printed")).alias("case")), "case_no int, name boolean, case boolean", numbered([x[5:] for x in _NAMES]))


# whole tables
def held_statutes(spark, d):
    """The statutes of statute_index, a fixed table, as Held; read by the driver."""
    rows = load(spark, d, "statute_index").filter("title IS NOT NULL").select("statute_id", "title", "act_year", "haystacks", "jurisdiction").collect()
    own = [(r.statute_id, [provisions.title_words(" ".join(h)) for h in r.haystacks], r.act_year, len(r.title)) for r in rows if r.haystacks]
    return lambda: provisions.Held(federal=own, kinds={r.statute_id: provisions.kind_of_title(r.title) for r in rows})


C.table("fn29_documents", lambda spark, d: provisions.read_mentions(load(spark, d, "documents").filter("text IS NOT NULL"), "doc_id", held_statutes(spark, d)).select("key", "kind", "statute_id", "section", "method", "role", "start"))
C.table("fn06_doc_text", lambda spark, d: chunking.chunk_judgments(load(spark, d, "doc_text").dropDuplicates(["document_id"]).select("document_id", "source", "text", *[F.lit(None).cast("string").alias(c) for c in ("court", "case_number", "decided", "neutral_citation", "case_title")])).drop("structure"))
C.table("fn27_statutes", lambda spark, d: load(spark, d, "statute_index").select("statute_id", provisions.jurisdiction(F.col("title")).alias("stated")),
        "SELECT statute_id, CASE " + " ".join(f"WHEN regexp_matches(lower(coalesce(title, '')), '{p}') THEN '{n}'" for n, p in provisions.JURISDICTIONS) + " ELSE 'Federal' END AS stated FROM statute_index")
