"""The training-data operators on small tables, against brute force, round trips and true cases."""

import json
import os
import random
import string

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm import bpe, groups, lines, mixing, names, residue, scans, splitting, tokens, unify

TOK = bpe.TOKENIZER_DIR
have_tokenizer = pytest.mark.skipif(not os.path.isdir(TOK), reason="no tokenizer files")


@pytest.fixture(scope="module")
def model():
    return bpe.ByteBPE()


@have_tokenizer
@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aabbz ='.\n0१é‌پ🙂"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_tokens_are_those_of_the_library(text):
    from tokenizers import Tokenizer

    own = test_tokens_are_those_of_the_library
    if not hasattr(own, "pair"):
        t = Tokenizer.from_file(f"{TOK}/byte_bpe_50k.json")
        t.encode_special_tokens = True
        own.pair = (bpe.ByteBPE(), t)
    b, t = own.pair
    assert b.encode_batch([text])[0] == t.encode(text, add_special_tokens=False).ids


@have_tokenizer
def test_every_proposed_word_is_verified(model):
    words = ["".join(random.Random(i).choices("aeinrst", k=random.Random(i).randint(1, 14))) for i in range(3000)]
    model.words.clear()
    model.learn(set(words))
    assert all(model.words[w] == model.merge_exactly(w.encode()) for w in words)


def test_a_missing_dependency_leaves_out_one_module(monkeypatch):
    from lexloom.llm import registry

    real = registry.import_module

    def fails(name):
        if name.endswith("names"):
            raise ImportError("no such library", name="somelib")
        return real(name)

    monkeypatch.setattr(registry, "import_module", fails)
    with pytest.warns(UserWarning, match="names is left out"):
        left = registry.queries()
    assert "p2_found" not in left and "p1_found" not in left and "p7_found" in left


@have_tokenizer
def test_encode_null_empty_and_long(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "a" * 50_000, 1), (4, "<|endoftext|>", 1), (4, "<|endoftext|>", 1)], "doc_id bigint, text string, ids int")
    rows = tokens.encode(df, "doc_id").collect()
    got = {r.doc_id: r.ids for r in rows}
    assert len(rows) == 5 and got[1] == [] and got[2] == [] and len(got[3]) > 100 and len(got[4]) > 1
    assert tokens.encode(df.limit(0), "doc_id").count() == 0


def greedy(text, limit, overlap):
    """The cuts one at a time, over the boundaries of the text."""
    import re

    nat = re.compile(r"(?<=\n)(?!\n)|(?<=[.!?]) (?! )")
    natural = {m.start() if text[m.start() : m.start() + 1] != " " else m.end() for m in nat.finditer(text)} | {len(text)}
    word = {m.end() for m in re.finditer(r"\s(?!\s)", text)}
    start, out = 0, []
    while len(text) - start > limit:
        reach = range(start + overlap + 1, start + limit + 1)
        end = max((p for p in reach if p in natural), default=None) or max((p for p in reach if p in word), default=None) or start + limit
        out.append((start, end))
        start = end - overlap
    return out + [(start, len(text))]


def test_pieces_are_the_greedy_ones(spark):
    rng = random.Random(4)
    texts = []
    for i in range(25):
        parts = ["".join(rng.choices("abc de", k=rng.randint(3, 120))).strip() + rng.choice([". ", "\n", " ", ""]) for _ in range(rng.randint(4, 30))]
        texts.append((str(i), "".join(parts)))
    texts += [("solid", "x" * 777), ("none", None), ("empty", ""), ("fits", "y" * 100), ("solid", "x" * 777), (None, "z " * 90)]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in texts], "id string, text string, piece_no int, char_start int")
    got = {}
    for r in splitting.split_texts(df, 100, 20).collect():
        got.setdefault((r.id, r.char_start), r)
        assert len(r.text) <= 100
    by = {}
    for (i, _), r in got.items():
        by.setdefault(i, []).append(r)
    for i, t in dict(texts).items():
        if t is None or len(t) <= 100:
            assert i not in by
            continue
        rows = sorted(by[i], key=lambda r: r.piece_no)
        assert rows[0].char_start == 0 and rows[-1].char_end == len(t)
        assert all(b.char_start == a.char_end - 20 for a, b in zip(rows, rows[1:]))
        assert all(t[r.char_start : r.char_end] == r.text for r in rows)
        assert [(r.char_start, r.char_end) for r in rows] == greedy(t, 100, 20)


def test_components_against_union_find(spark):
    rng = random.Random(5)
    pairs = [(f"n{rng.randint(0, 150):03}", f"n{rng.randint(0, 150):03}") for _ in range(120)]
    pairs += [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("s", "s"), ("x", None), (None, "y")] + pairs[:5] + [(b, a) for a, b in pairs[:5]]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame([(a, b, 1) for a, b in pairs], "a string, b string, node int")
    got = {r.node: r.group_id for r in groups.components(df, "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert groups.components(df.limit(0), "a", "b").count() == 0


def test_a_star_beside_chains_with_nothing_broadcast(spark):
    """A hub with 20,000 leaves: its label is split from the others (over 100 rows), and no table of labels is broadcast."""
    star = spark.range(20_000).selectExpr("concat('z', id) AS a", "'hub' AS b")
    chains = spark.range(3_000).selectExpr("concat('c', lpad(id, 5, '0')) AS a", "concat('c', lpad(id + IF(id % 10 = 9, 0, 1), 5, '0')) AS b")
    got = groups.components(star.unionByName(chains), "a", "b", limit=0, hot=100)
    per = {r.group_id: r["count"] for r in got.groupBy("group_id").count().collect()}
    assert per["hub"] == 20_001 and len(per) == 301 and {v for k, v in per.items() if k != "hub"} == {10}
    assert not spark.conf.get("spark.checkpoint.dir").startswith("hdfs") and got.count() == got.select("node").distinct().count()


def test_repeated_lines_incrementally(spark, tmp_path):
    docs = [(f"d{i}", "s" if i < 10 else None if i == 10 else "t") for i in range(13)]
    paras = [(f"d{i}", "p1", f"Own line {string.ascii_letters[i]}\nPage {i} of SITE!" if i < 6 else "nothing here", 0) for i in range(13)] + [("d0", "p2", None, 0), ("d0", "p1", "Own line a\nPage 0 of SITE!", 0)]
    dd = spark.createDataFrame(docs, "document_id string, source string")
    pp = spark.createDataFrame(paras, "document_id string, para_id string, text string, line_no int")
    got = {(r.document_id, r.line_no) for r in lines.find_repeated_lines(pp, dd).collect()}
    assert got == {(f"d{i}", 2) for i in range(6)}
    clean = {(r.document_id): r.text for r in lines.cleaned_paragraphs(pp, lines.find_repeated_lines(pp, dd)).collect()}
    assert clean["d1"] == "Own line b"
    first = [f"d{i}" for i in range(4)]
    part = lambda df, ids: df.filter(df.document_id.isin(ids))
    rest = [d for d, _ in docs if d not in first]
    merge = lambda state, ids: state.merge(lines.document_lines(part(pp, ids), part(dd, ids)), part(dd, ids))
    a = merge(lines.LineState.empty(spark), first)
    a.save(f"{tmp_path}/state")
    b = merge(lines.LineState.open(spark, f"{tmp_path}/state"), rest)
    assert b.crossed.count() == 1 and b.crossed.first().now
    assert {r.document_id for r in b.documents_of(b.crossed).collect()} == {f"d{i}" for i in range(6)}
    rebuilt = {(r.document_id, r.para_id): r.text for r in b.rebuild(pp, dd).collect()}
    assert rebuilt["d1", "p1"] == "Own line b" and {d for d, _ in rebuilt} == {f"d{i}" for i in range(6)}
    again = merge(b, rest)
    total = lambda s: sorted(s._compacted("counts", s.table("counts")).collect())
    assert total(again) == total(b) and again.crossed.count() == 0
    # two documents change: the wording falls below five documents, is retracted, and the others are rebuilt with it
    changed = spark.createDataFrame([("d0", "p1", "Own line a", 0), ("d1", "p1", "Own line b", 0)], pp.schema)
    c = again.merge(lines.document_lines(changed, dd), part(dd, ["d0", "d1"]))
    assert c.crossed.count() == 1 and not c.crossed.first().now
    now = changed.unionByName(part(pp, [f"d{i}" for i in range(2, 13)]))
    kept = {r.document_id: r.text for r in c.rebuild(now, dd).collect()}
    assert set(kept) == {f"d{i}" for i in range(2, 6)} and kept["d2"] == "Own line c\nPage 2 of SITE!"
    c.save(f"{tmp_path}/again")
    opened = lines.LineState.open(spark, f"{tmp_path}/again")
    assert total(opened) == total(c) and opened.table("docs").count() == 12


@pytest.mark.parametrize(
    ("text", "want"),
    [("plain text", "plain text"), ("ｆｕｌｌ　１２", "full 12"), ("соurt", "court"), ("été", "été"), ("a​b c", "ab c"), ("ﬁne Ⅱ", "fine II"), ("كي ١٢", "کی ۱۲"), ("عـل", "عل"), ("ج‌د", "ج‌د"), ("Привет из Дельма", "Привет из Дельма"), ("“quote” — dash", "“quote” — dash"), ("", ""),
     ("cօurt jսdge", "court judge"), ("ꓚourt", "Court"), ("Ꭺppeal", "Appeal"), ("courτ", "court"), ("Ьank", "bank"), ("Іnvoice", "Invoice"), ("в суде", "в суде")],
)
def test_consistent_form(spark, text, want):
    letters = unify.alike(spark)
    assert letters.fold(text)[0] == want
    assert letters.fold(want)[0] == want


def test_prototypes_span_all_scripts(spark):
    letters = unify.alike(spark)
    assert len(letters.strict) > 500
    assert {letters.skeleton(w) for w in ("court", "cօurt", "cοurt", "соurt")} == {"court"}


def segments_of(spark, texts):
    """Documents of one or more passages each, and the segments that cut them."""
    docs, segs = [], []
    for (doc, blocks) in texts.items():
        whole, at = "", 0
        for block, t in blocks:
            segs.append((doc, block, at, at + len(t), 1))
            whole += t + " "
            at = len(whole)
        docs.append((doc, whole, "x"))
    return spark.createDataFrame(segs, "document_id string, block_id string, char_start int, char_end int, text int"), spark.createDataFrame(docs, "document_id string, text string, block_id string")


def test_words_of_lookalikes_need_a_latin_twin(spark):
    texts = {"a": [("1", "the саѕе here"), ("2", "a case there"), ("5", "")], "b": [("3", "слово сос слово"), ("4", "𝐜𝐨𝐮𝐫𝐭 🙂 ok")]}
    segs, docs = segments_of(spark, texts)
    bad = spark.createDataFrame([("a", "9", 5, 9999, 1), ("a", "8", None, 4, 1), (None, "7", 0, 1, 1), ("zz", "6", 0, 1, 1)], segs.schema)
    made = unify.unify(segs.unionByName(segs).unionByName(bad), docs.unionByName(docs))
    got = {r.block_id: r.unified for r in made.collect()}
    assert got == {"1": "the case here", "2": "a case there", "3": "слово сос слово", "4": "court 🙂 ok"} and made.count() == 4
    assert {r.block_id for r in unify.unify(segs, docs, texts=False).filter("text != unified").collect()} == {"1", "4"}
    assert unify.unify(segs.limit(0), docs).count() == 0


def test_groups_hold_plain_words_with_accents_too(spark):
    rows = [("caf\u00e9 cafe\u0301 caf\u00e9",), ("court c\u043eurt",), ("d\u00e9j\u00e0 vu",), (None,)]
    got = {(r.skeleton, r.n_forms, r.n_words) for r in unify.lookalike_groups(spark.createDataFrame(rows, "text string")).collect()}
    assert got == {("cafe\u0301", 2, 3), ("court", 2, 2)}


def test_residue_is_told_from_prose():
    rng = random.Random(6)
    nouns, verbs = ["lease", "order", "claim", "witness", "court", "record", "appeal"], ["held", "signed", "denied", "considered", "produced"]
    prose = [" ".join(f"The {rng.choice(nouns)} was {rng.choice(verbs)} before the {rng.choice(nouns)} of the {rng.choice(nouns)} in {rng.randint(1950, 2020)}." for _ in range(6)) for _ in range(300)]
    m = residue.fit(prose)

    def share(t):
        (rows,), (n,) = m.score([t])
        return sum(z - a for a, z, r, _ in rows if r > residue.THRESHOLD) / n if n else 0.0

    for bad in ["{{name}} against {{other_party}}, decided on {{date}}.", "404 Not Found. The requested page was not found on this server.", "Please enable JavaScript to view this page.", "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Petitioner: ______________\nRespondent: ______________"]:
        assert share(bad) > 0.8, bad
    assert all(share(p) == 0 for p in prose[:50])
    assert share("") == 0.0 and m.score([None])[1] == [0]
    # held-out seeds: each tenth of the lines of a kind is judged by a model that never saw it
    found = {}
    for kind, seeds in residue.seed_texts().items():
        hits = []
        for k in range(10):
            rest = [t for i, t in enumerate(seeds) if i % 10 != k]
            own = residue.fit(prose, residue.seed_texts() | {kind: rest})
            for rows, n in zip(*own.score([t for i, t in enumerate(seeds) if i % 10 == k])):
                hits.append(sum(z - a for a, z, r, _ in rows if r > residue.THRESHOLD) >= residue.COVERAGE * n)
        found[kind] = sum(hits) / len(hits)
    assert found["template"] > 0.95 and min(found.values()) > 0.7, found


def test_residue_counts_of_tables(spark):
    texts = ["one two three", None, "", "{{name}} of {{court}} " * 50, "one two three"]
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id bigint, text string, residue_share double").repartition(3)
    want = residue.count_grams(texts)
    assert all((a == b).all() for a, b in zip(residue.corpus_counts(df), want))
    got = {r.doc_id: r for r in residue.judge(df, residue.fit_on(df)).collect()}
    assert len(got) == 5 and got[1].residue_share == got[2].residue_share == 0.0 and got[1].kind is None
    assert residue.judge(df.limit(0), residue.fit_on(df.limit(0))).count() == 0


@have_tokenizer
def test_low_weights_fill_even_ranges(spark):
    """Texts without letters get the least weight: their keys are spread over ranges like any others, and the sums are exact."""
    rows = [(i, "odd" if i % 2 else "plain", "1 2 3 4 " if i % 2 else "words and more words " * 9) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("odd", 0.1, 1), ("plain", 0.9, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(docs, targets).collect()
    tokens_of = lambda s: sum(r.copies * r.n_tokens for r in mixed if r.source == s)
    assert abs(tokens_of("odd") / (tokens_of("odd") + tokens_of("plain")) - 0.1) < 0.001 and all(r.copies == 1 for r in mixed)


def test_budgets_respect_caps():
    cap = [("a", 0.5, 1, 100), ("b", 0.5, 2, 30), ("c", 0.0, 9, 50), ("d", 0.1, 1, 0)]
    assert mixing.budgets(cap) == {"a": 60.0, "b": 60.0}
    assert mixing.budgets(cap, 140) == {"b": 60.0, "a": 80.0}
    assert mixing.budgets(cap, 1000) == {"a": 100.0, "b": 60.0}
    assert mixing.budgets([]) == {}


@have_tokenizer
def test_mix_meets_targets_within_a_document(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["big"] * 4 + ["small", None]), " ".join(rng.choices(["court", "order", "lease"], k=rng.randint(1, 30)))) for i in range(400)] + [(1000, "big", None), (1001, "small", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("gone", 0.0, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(docs, targets)
    got = mixed.collect()
    assert all(1 <= r.copies <= (1 if r.source == "big" else 3) for r in got) and not {1000, 1001} & {r.doc_id for r in got}
    s = {r.source: r.actual_share for r in mixing.shares(mixed, targets).collect()}
    assert abs(s["big"] - 0.6) < 0.02 and abs(s["small"] - 0.4) < 0.02 and s["gone"] == 0.0


GLOSSARY = [("Bo", "Robert", "pet_name"), ("Engg.", "Engineering", "abbreviation"), ("Wks.", "Works", "abbreviation"), ("Ltd.", "Limited", "abbreviation"), ("Tex.", "Textile", "abbreviation"), ("Mls.", "Mills", "abbreviation")]


def test_name_variants(spark):
    rows = [
        (1, "Robert Middle Tugudhuri", "The State"), (2, "Mr. Bo Middle Tugudhuri and others", None), (3, "Tugudhuri, Robert Middle", "-"), (4, "R. Middle Tugudhrui", ""),
        (5, "Arnold Middle Tugudhuri", "State, Zone 2"), (6, "M/s Traxsamund Yeiber Engg. Wks. Ltd.", None), (7, "TRAXSAMUND YEIBER ENGINEERING WORKS", "x"),
        (8, "Traxsamund Yeiber Textile Mills", None), (9, "Traxsamnd Yeiber Engineering Works Limited through its Manager", None), (9, "Traxsamnd Yeiber Engineering Works Limited through its Manager", None),
    ]
    c = spark.createDataFrame(rows, "candidate_id bigint, petitioner string, respondent string")
    g = spark.createDataFrame(GLOSSARY, "short_form string, long_form string, form_kind string")
    generic = spark.createDataFrame([("state",)], "phrase string")
    got = {(r.candidate_a, r.candidate_b) for r in names.same_party_pairs(c, g, generic).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4), (6, 7), (6, 9), (7, 9)}
    assert names.same_party_pairs(c.limit(0), g, generic).count() == 0


def parties_of(spark, spelt):
    """The sets of spellings that resolve() puts together, single ones left out."""
    found = {}
    for r in names.resolve(spark.createDataFrame([(n,) for n in spelt], "name string"), GLOSSARY, []).collect():
        found.setdefault(r.party, set()).add(r.name)
    return sorted(sorted(v) for v in found.values() if len(v) > 1)


def test_a_tie_holds_when_one_of_the_two_has_merged(spark):
    spelt = ["Robert Middle Tugudhuri", "Ronald Middle Tugudhuri", "Ronald Middle Tugudhrui", "R. Middle Tugudhuri"]
    assert parties_of(spark, spelt) == [["Ronald Middle Tugudhrui", "Ronald Middle Tugudhuri"]]
    # the better match, unchanged, stays ahead of one that has merged
    assert parties_of(spark, spelt[1:]) == [sorted(spelt[1:])]


def test_names_of_one_four_and_five_words(spark):
    long = ["Muhammad Ali Raza Khan", "Muhamad Ali Raza Khan", "Khan, Muhammad Ali Raza", "Muhammad Ali Raza Tariq Khan"]
    assert parties_of(spark, [*long, "Muhammad Bano Raza Qadir"]) == [sorted(long[:2])] or sorted(long[:3]) in parties_of(spark, long)
    assert parties_of(spark, ["Muhammad Ali Raza Tariq Khan", "Muhammad Ali Raza Tariq Kahn", "MUHAMMAD ALI RAZA TARIQ KHAN"]) == [sorted(["Muhammad Ali Raza Tariq Khan", "Muhammad Ali Raza Tariq Kahn", "MUHAMMAD ALI RAZA TARIQ KHAN"])]
    assert parties_of(spark, ["Muhammad", "MUHAMMAD", "Mr. Muhammad", "Muhammad Khan", "Zahid"]) == [sorted(["Muhammad", "MUHAMMAD", "Mr. Muhammad"])]


def test_a_block_cut_by_third_slots_loses_no_match(spark):
    """900 people share given and family name; every match of the uncut block is found in the cut one too."""
    rng = random.Random(11)
    mids = sorted({"".join(rng.choices("abdegiklmnorstuz", k=7)).capitalize() for _ in range(300)})
    spelt = [f"Robert {m} Tugudhuri" for m in mids] + [f"Robert {m[:3] + m[4:]} Tugudhuri" for m in mids[:100]] + [f"Robert {m[1] + m[0].lower() + m[2:]} Tugudhuri" for m in mids[100:150]]
    spelt += [f"Robert {m[1:].capitalize()} Tugudhuri" for m in mids[150:200]] + ["Robert Tugudhuri", "Robert Q. Tugudhuri"]
    df = spark.createDataFrame([(n,) for n in sorted(set(spelt))], "name string")
    group = lambda hot: {frozenset(r.ns) for r in names.resolve(df, GLOSSARY, [], hot=hot).groupBy("party").agg(F.collect_set("name").alias("ns")).collect()}
    whole = group(10**9)
    assert group(20) == whole and max(map(len, whole)) < 10 and sum(len(g) > 1 for g in whole) >= 150


def test_a_task_keeps_no_more_words_than_it_may(monkeypatch):
    monkeypatch.setattr(names, "KNOWN", 10)
    g = names.Glossary([("Ind.", "Industries", "abbreviation")])
    found = [g.activity_of(w) for k in range(50) for w in (f"word{k}", "ind")]
    assert found == [None, "industries"] * 50 and len(g._known) <= 10


def test_keys_of_a_merged_party_are_rows_of_both_slots(spark):
    given, family = [f"ab{c}" for c in "cdefgh"], [f"xyz{c}" for c in "mnopq"]
    profile = {"kind": "person", "full": True, "slots": [given, [], family]}
    table = spark.createDataFrame([(1, True, json.dumps(profile))], "cid bigint, fresh boolean, profile string")
    keys = names.block_keys(table)
    less = len({w[:i] + w[i + 1 :] for w in family for i in range(4)} | set(family))
    # given exact and family nearly, the other way round, and both once more as the words of an organisation
    assert keys.count() == keys.distinct().count() == 2 * (6 * less + 5 * 6)
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 4 and {r.third for r in keys.collect()} == {1}


def test_two_own_words_join_their_organisation(spark):
    orgs = ["Creltadom Leiyak Engineering Works Limited", "CRELTADOM LEIYAK ENGG. WKS. LTD."]
    assert parties_of(spark, [*orgs, "Creltadom Leiyak", "Creltadom-Leiyak", "Robert Tugudhuri"]) == [sorted([*orgs, "Creltadom Leiyak", "Creltadom-Leiyak"])]
    # two organisations of these words, or an organisation and a person: neither
    assert parties_of(spark, [*orgs, "Creltadom Leiyak Textile Mills", "Creltadom Leiyak"]) == [sorted(orgs)]
    assert parties_of(spark, [*orgs, "Creltadom Middle Leiyak", "Creltadom Leiyak"]) == [sorted(orgs)]


def test_difference_and_numbers():
    assert scans.difference("cliarge", "charge") == ("h", "li")
    assert scans.difference("assessmcnt", "assessment") == ("e", "c")
    assert scans.number_of("l2") == {12} and scans.number_of("iv") == {4}
    assert scans.likeness("abcd", "abcd") == 1.0 and scans.likeness("", "a") == 0.0


def test_every_single_confusion_meets_its_word(spark):
    rng = random.Random(4)
    known = {"".join(rng.choices("handeclirumtosgwyb", k=rng.randint(3, 8))) for _ in range(400)} | {"handed", "entered", "rendered", "licensing"}
    bad = {(w[:i] + b + w[i + len(a) :], w) for w in known for a, b in scans.CONFUSED for i in range(len(w)) if w.startswith(a, i)}
    bad = {(t, w) for t, w in bad if t not in known}
    words = spark.createDataFrame([(t, 1) for t in {t for t, _ in bad}], "word string, n bigint")
    counts = spark.createDataFrame([(w, 100) for w in known], "word string, n bigint")
    got = {(r.word, r.other) for r in scans.candidates(words, counts).collect()}
    assert ("hancled", "handed") in bad and not bad - got
    asked = spark.createDataFrame([("2o2o", 1), ("h@nclecl", 1), ("h@ndcd", 1)], "word string, n bigint")
    assert {(r.word, r.other) for r in scans.candidates(asked, spark.createDataFrame([("zozo", 100), ("handed", 100)], "word string, n bigint")).collect()} == {("h@ndcd", "handed")}


def test_every_word_meets_those_that_share_a_qgram(spark):
    rng = random.Random(6)
    known = {"".join(rng.choices("abcde", k=rng.randint(3, 12))) for _ in range(250)} | {"judgment"}
    asked = {"".join(rng.choices("abcde", k=rng.randint(3, 12))) for _ in range(120)} | {"judgmemt", "iudqment"}
    grams = lambda w: {f"^{w}$"[i : i + 3] for i in range(len(w))}
    want = {(w, c) for w in asked for c in known if w != c and grams(w) & grams(c) and abs(len(w) - len(c)) < 2 and scans.distance(w, c) <= 2}
    table = lambda ws, n: spark.createDataFrame([(w, n) for w in sorted(ws)], "word string, n bigint")
    got = {(r.word, r.other) for r in scans.candidates(table(asked, 1), table(known, 100)).collect()}
    assert {("judgmemt", "judgment"), ("iudqment", "judgment")} <= want and not want - got


def digital_documents(n, seed):
    """Documents without furniture: an opening that names case and parties, then paragraphs of running words and numbers."""
    rng = random.Random(seed)
    words = ["appearance", "of", "the", "assessment", "respondent", "in", "judgment", "property", "was", "held", "by", "landlord", "considered", "and", "objection", "without", "because", "witness", "statement", "No.", "1999", "Act,"]
    names = ["Nanosh", "Tasaguz", "Hejaru", "Dujiboni", "Lorein", "Veivaabon", "Rivi", "Trozut"]
    out = []
    for d in range(n):
        head = f"W.P. No. {rng.randint(2, 9999)} of {rng.randint(1950, 2020)}. {' '.join(rng.sample(names, 2))} v. {' '.join(rng.sample(names, 2))}. "
        paras = [("p1_b0", 1, head + " ".join(rng.choices(words, k=30)))] + [(f"p{1 + k // 3}_b{k}", 1 + k // 3, f"{k}. " + " ".join(rng.choices(words, k=rng.randint(30, 120)))) for k in range(1, 9)]
        out.append(scans.Document(paras))
    return out


def test_line_models_on_held_out_plants():
    """Fitted on planted documents of one half, judged on planted ones of the other, of which they know nothing."""
    page, head = scans.fit_lines(digital_documents(120, 1))
    reader, rng = scans.LineReader(page, head), random.Random(5)
    hit = {k: [0, 0, 0] for k in ("number", "head")}
    for doc in digital_documents(80, 2):
        made, labels = scans.plant(doc, rng)
        (read,) = reader.read_all([made])
        for kind, at in (("number", 2), ("head", 3)):
            want = {made.paras[k][0] for (k, _), v in labels.items() if v == kind}
            got = {r[0] for r in read if r[at]}
            if kind == "number":  # a number may also stand inside a head's line
                got &= want | {r[0] for r in read if r[at] and not r[3]}
            hit[kind] = [x + y for x, y in zip(hit[kind], (len(want & got), len(want), len(got)))]
    for kind, (both, want, got) in hit.items():
        assert both / want > 0.95 and both / got > 0.93, (kind, hit)


def test_distance_is_the_edit_distance():
    assert [scans.distance(a, b) for a, b in (("abc", "abc"), ("abc", "abd"), ("abc", ""), ("kitten", "sitting"), ("a" * 100, "a" * 90 + "b"))] == [0, 1, 3, 3, 10]


def test_scan_defects(spark):
    rng = random.Random(8)
    words = ["appearance", "assessment", "respondent", "judgment", "property", "landlord", "considered", "objection", "without", "because", "witness", "statement"]
    rows = []
    for d in range(60):
        body = rng.choices(words, k=60)
        first = f"W.P. No. {d + 100} of 1999. Nanosh Tasaguz v. Hejaru Dujiboni. " + " ".join(body[:12])
        lines_ = [" ".join(body[i : i + 6]) for i in range(12, 60, 6)]
        lines_[0] = lines_[0] + " appear-"
        lines_[1] = "ance " + lines_[1]
        rows.append((f"d{d}", "p1_b1", 1, first))
        rows.append((f"d{d}", "p1_b2", 1, "\n".join(lines_) + ("\nthe assessmcnt" if d == 3 else "") + "."))
        rows.append((f"d{d}", "p1_b3", 1, "- 1 -"))
        rows.append((f"d{d}", "p2_b4", 2, f"W.P. No. {d + 100} of 1999"))
        rows.append((f"d{d}", "p2_b5", 2, " ".join(rng.choices(words, k=8)) + ", and\n" + " ".join(rng.choices(words, k=8)) + "."))
    rows += [("digital", "p1_b1", 1, "One paragraph. 1"), ("d0", "p9", 9, None), ("d1", "p1_b3", 1, "- 1 -")]
    df = spark.createDataFrame(rows, "document_id string, para_id string, page int, text string")
    got = {(r.document_id, r.para_id, r.defect) for r in scans.find_defects(df).collect()}
    want = set()
    for d in range(60):
        want |= {(f"d{d}", "p1_b2", "split_word"), (f"d{d}", "p1_b3", "page_number"), (f"d{d}", "p2_b4", "running_head")}
    want.add(("d3", "p1_b2", "misread"))
    assert got == want
    text = {(r.document_id, r.para_id): r.text for r in scans.repaired_paragraphs(df).collect()}
    assert "appearance" in text["d3", "p1_b2"] and "assessment." in text["d3", "p1_b2"] and text["d3", "p1_b3"].strip() == ""
    assert scans.find_defects(df.limit(0)).count() == 0


def test_boost_learns_a_rule():
    from lexloom.llm.boost import BoostedTrees

    x = pd.DataFrame({"a": range(200), "b": [i % 7 for i in range(200)]}).to_numpy(float)
    y = ((x[:, 0] > 80) & (x[:, 1] > 2)).astype(float)
    p = BoostedTrees().fit(x, y).probability(x)
    assert ((p > 0.5) == (y > 0)).mean() > 0.98
    assert BoostedTrees().fit(x, y * 0).probability(x).max() < 0.01
