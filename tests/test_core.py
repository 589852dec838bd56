"""Core operators on small tables, against plain Python."""

import datetime
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import hotkeys, index, retrieval, spans
from lexloom.sources import files
from lexloom.streaming.ingest import ingest, stream_table

SMALL = "/root/testdata/sf0.001"


def test_number_rows_counts_each_key_without_gaps(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i, "x") for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, other string").repartition(5)
    out = hotkeys.number_rows(df, ["k"]).collect()
    want = Counter(r[0] for r in rows)
    got = {}
    for r in out:
        got.setdefault(r.k, []).append(r.row_no)
    assert {k: len(v) for k, v in got.items()} == dict(want)
    assert all(sorted(v) == list(range(len(v))) for v in got.values())
    assert {r.v for r in out} == set(range(500))


def test_number_rows_follows_an_order(spark):
    rows = [("a" if i % 3 else "b", (i * 37) % 101, "x") for i in range(101)]
    out = hotkeys.number_rows(spark.createDataFrame(rows, "k string, v int, s string").repartition(4), ["k"], ["v"]).collect()
    for key in "ab":
        have = sorted((r.row_no, r.v) for r in out if r.k == key)
        assert [v for _, v in have] == sorted(v for k, v, _ in rows if k == key)


def test_number_rows_refuses_clashing_names(spark):
    with pytest.raises(ValueError):
        hotkeys.number_rows(spark.createDataFrame([(1, 2)], "k int, row_no int"), ["k"])


def test_key_counts_empty_nulls_and_chunks(spark):
    df = spark.createDataFrame([("a",)] * 7 + [(None,)] * 2 + [("b",)], "k string")
    got = {r.k: (r.n_rows, r.n_chunks, r.largest_chunk) for r in hotkeys.key_counts(df, "k", size=3).collect()}
    assert got == {"a": (7, 3, 3), None: (2, 1, 2), "b": (1, 1, 1)}
    assert hotkeys.key_counts(df.limit(0), "k").count() == 0
    assert {r.key_value for r in hotkeys.heavy_keys(df, "k", 0.1).collect()} == {"a", "b"}
    assert {r.key_value for r in hotkeys.heavy_keys(df, "k", 0.2).collect()} == {"a"}


def test_gap_profile_merges_chunk_boundaries(spark):
    t0 = datetime.datetime(2024, 1, 1)
    rng = random.Random(2)
    rows = [("h", i, t0 + datetime.timedelta(seconds=rng.randint(0, 10**6))) for i in range(60)] + [("n", 61, None), ("s", 62, t0)]
    df = spark.createDataFrame(rows, "k string, i int, t timestamp").repartition(3)
    got = {r.key_value: (r.n_rows, r.longest_gap_us) for r in hotkeys.gap_profile(df, "k", "t", "i", size=7).collect()}
    ts = sorted(r[2] for r in rows if r[0] == "h")
    gap = max((b - a) for a, b in zip(ts, ts[1:]))
    assert got == {"h": (60, int(gap.total_seconds()) * 10**6), "n": (1, 0), "s": (1, 0)}


def test_flatten_and_spans(spark):
    paras = spark.createDataFrame([("d", "p1_b2", 1, "three"), ("d", "p1_b1", 1, " one "), ("d", "p1_b1", 1, " one "), ("d", "p2_b10", 2, "ten"), ("d", "p2_b9", 2, None)], "document_id string, para_id string, page int, text string")
    got = {r.para_id: (r.char_start, r.char_end) for r in spans.flatten(paras).collect()}
    assert got == {"p1_b1": (0, 3), "p1_b2": (4, 9), "p2_b10": (10, 13)}
    blocks = spark.createDataFrame([("d", 0, 3, "a", 1), ("d", 4, 9000, "b", 1), ("d", 9001, 9003, "c", 2)], "document_id string, char_start int, char_end int, block_id string, page int")
    asked = spark.createDataFrame([("x", "d", 2, 9002), ("y", "d", 3, 4), ("z", "d", None, None)], "id string, document_id string, char_start int, char_end int")
    got = {r.id: (r.page_first, r.page_last, r.block_ids) for r in spans.spans_to_blocks(asked, blocks).collect()}
    assert got == {"x": (1, 2, ["a", "b", "c"]), "y": (None, None, []), "z": (None, None, [])}


def test_title_links_prefer_the_shortest_title_and_the_year(spark):
    st = spark.createDataFrame([("1", "The Mills Act", 1950, [["the", "mills", "act", "1950"]]), ("2", "The Flour Mills Act", 1960, [["the", "flour", "mills", "act"]])], "statute_id string, title string, act_year int, haystacks array<array<string>>")
    names = spark.createDataFrame([("a", "mills act", None), ("b", "mills act", 1960), ("c", "rice act", None)], "name string, needle string, year int")
    assert {r.name: r.statute_id for r in spans.link_titles(names, st).collect()} == {"a": "1", "b": "2"}


def test_bm25_fusion_and_recall(spark, tmp_path):
    docs = spark.createDataFrame([("1", "red fox red"), ("2", "blue fox"), ("3", ""), ("4", None)], "id string, text string")
    q = spark.createDataFrame([(1, "red"), (2, "fox"), (3, "none")], "query_id int, text string")
    hits = retrieval.ranked(index.TextIndex.build(docs, "id", "text", f"{tmp_path}/index").scores(q), "id", 10)
    rows = {(r.query_id, r.id): r.rank for r in hits.collect()}
    assert rows == {(1, "1"): 1, (2, "2"): 1, (2, "1"): 2}
    assert index.TextIndex.open(spark, f"{tmp_path}/index", "id").whole.first().n_docs == 4
    f = retrieval.fuse([("a", hits.select("query_id", "id", "rank")), ("b", hits.select("query_id", "id", "rank"))], "id")
    gold = spark.createDataFrame([(1, "k", "1"), (2, "k", "1")], "query_id int, kind string, id string")
    m = retrieval.recall_mrr(f, gold, "id").first()
    assert (m.mrr, m.recall_1, m.recall_5) == (0.75, 0.5, 1.0)


def test_bm25_top_moves_only_the_best_of_each_task(spark, tmp_path):
    """The best of small segments are those of all scores, ties by key, and few other pairs leave the tasks."""
    rng = random.Random(4)
    docs = [(f"d{i:04d}", " ".join(rng.choice(("of", "the", "land", "court", f"{rng.randint(0, 40)}w")) for _ in range(rng.randint(0, 12)))) for i in range(900)] + [("e", None)]
    asked = [(i, f"of the {rng.randint(0, 40)}w court") for i in range(40)] + [(98, "of of the"), (99, "unknown")]
    q = spark.createDataFrame(asked, "query_id int, text string")
    built = index.TextIndex.build(spark.createDataFrame(docs, "id string, text string").repartition(3), "id", "text", f"{tmp_path}/index", size=64)
    every = retrieval.ranked(built.scores(q).withColumn("score", F.round("score", 6)), "id", 10)
    top = built.top(q, 10, block=15)
    kept = top.count()
    best = retrieval.ranked(top, "id", 10)
    assert {(r.query_id, r.id, r.rank) for r in best.collect()} == {(r.query_id, r.id, r.rank) for r in every.collect()} and best.count() == 410
    assert kept <= 41 * 10 * spark.sparkContext.defaultParallelism < built.scores(q).count()
    tf = Counter(t for _, t in docs if t for t in set(t.split()))
    assert {(r.term, r.df) for r in built.terms.collect()} == set(tf.items())
    assert built.whole.first().n_docs == 901


def test_title_words_are_numbered_once_for_all_queries(spark, tmp_path):
    from lexloom.plans import relations

    spark.createDataFrame([(50 * k, "Harun Bodil" if k < 40 else "Zahid") for k in range(41)], "candidate_id bigint, petitioner string").write.parquet(f"{tmp_path}/candidates.parquet")
    spark.createDataFrame([(f"c{k:03d}", "Harun v. Harun") for k in range(150)] + [("d", "zahid")], "id string, title string").write.parquet(f"{tmp_path}/chunks.parquet")
    got = relations._exact(spark, str(tmp_path))
    assert relations._title_words(spark, str(tmp_path)).count() == 151
    assert Counter(r.query_id for r in got.collect()) == {**{50 * k: 100 for k in range(40)}, 2000: 1}
    assert {(r.id, r["rank"]) for r in got.filter("query_id = 0").collect()} == {(f"c{k:03d}", k + 1) for k in range(100)}


def test_text_functions(spark):
    df = spark.createDataFrame([("The Act, 12b x",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(T.tokens("t")).collect()] == [["the", "act", "12b", "x"], [], None]
    dates = spark.createDataFrame([("3 May 1999",), ("May 3, 1999",), ("03.05.1999",), ("1999-05-03",), ("31.02.1999",), ("soon",), (None,)], "t string")
    assert [r[0] for r in dates.select(T.to_iso("t")).collect()] == ["1999-05-03"] * 4 + [None] * 3
    q = spark.createDataFrame([("plain words",), ("?!;;:",), ("",), (None,)], "t string")
    assert [r[0] for r in q.select(T.quality("t")).collect()] == [0.9, 0.4, 0.0, 0.0]


def plain_quality(text):
    words = (text or "").lower().split()
    if not words:
        return 0.0
    run = any(words[i] == words[i + 1] == words[i + 2] == words[i + 3] for i in range(len(words) - 3))
    often = max(Counter(zip(words, words[1:], words[2:])).values(), default=0) >= 4
    solid = "".join(words)
    mostly = sum(x.isalnum() for x in solid) < 0.5 * len(solid)
    return max(0.0, round(0.9 - 0.5 * mostly - 0.3 * ("\ufffd" in text) - 0.4 * (run or often), 4))


def test_quality_takes_loops_off(spark):
    rng = random.Random(3)
    hand = {"no no No NO": 0.5, "no no no": 0.9, "no no no nobody": 0.9, "a b c. a b c. a b c. a b c.": 0.5, "a b c x a b c y a b c z": 0.9, "x " * 6: 0.5, "?! " * 4: 0.0, "so so\u00a0so\u2003so": 0.5, "\u00a0": 0.0}
    texts = [*hand, *(" ".join(rng.choices("abcd", k=rng.randint(0, 60))) for _ in range(300)), "w " + " ".join(f"w{i}" for i in range(5000)) + " end of it" * 4]
    got = {r.t: r.q for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.quality("t").alias("q")).collect()}
    assert {t: got[t] for t in hand} == hand
    assert got == {t: plain_quality(t) for t in texts}


def test_party_key_drops_noise_and_stopwords(spark):
    want = {
        "The Federation of Pakistan through Secretary": "federation pakistan", "M/s. Alpha Mills (Pvt.) Ltd. and 2 others": "alpha mills", "Syed Nasir & others": "nasir",
        "Mst. Hina and another": "hina", "Ali (since deceased) LRs": "ali", "Beta Private Limited etc.": "beta", "": "",
    }
    got = {r.t: r.k for r in spark.createDataFrame([(t,) for t in want], "t string").select("t", T.party_key("t").alias("k")).collect()}
    assert got == want


def test_sources(spark, tmp_path):
    names = files.output_names(spark.createDataFrame([("/x/a/one.pdf",), ("/x/b/one.pdf",), ("/x/b/two.pdf",)], "path string"))
    got = {r.path: r.output for r in names.collect()}
    assert got["/x/b/two.pdf"] == "two" and got["/x/a/one.pdf"].startswith("a_one_") and len(set(got.values())) == 3
    (tmp_path / "log.jsonl").write_text('{"page_number": 1, "raw": "a"}\nbroken\n{"page_number": 1, "raw": "b"}\n')
    assert [(r.page_number, r.raw) for r in files.raw_log(spark, str(tmp_path / "log.jsonl")).collect()] == [(1, "b")]
    folder = tmp_path / "parsed"
    folder.mkdir()
    (folder / "d1.json").write_text(json.dumps({"document": "x"}))
    (folder / "manifest.json").write_text("{}")
    (folder / "bad.json").write_text("{")
    assert [(r.stem, r.document) for r in files.parsed_folder(spark, str(folder), "document string").collect()] == [("d1", "x")]
    with pytest.raises(ValueError):
        files.check_output("/data/in/out", ["/data/in"])
    mail = tmp_path / "m.eml"
    mail.write_bytes(b"From: a@x\nTo: b@x, c@x\nSubject: S\nDate: today\n\nBody\n")
    r = files.email_records(spark, str(tmp_path)).first()
    assert (r["from"], r["to"], r.subject, r.body_text.strip()) == ("a@x", ["b@x", "c@x"], "S", "Body")


def test_ingest_adds_nothing_twice(spark, tmp_path):
    src, out, log = (str(tmp_path / x) for x in ("src", "out", "log"))
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "i int, s string").write.parquet(src)
    for _ in range(2):
        ingest(stream_table(spark, src, "i int, s string"), lambda b: b.withColumn("u", F.upper("s")), out, log, ["i"])
    spark.createDataFrame([(2, "b"), (3, "c")], "i int, s string").write.mode("append").parquet(src)
    ingest(stream_table(spark, src, "i int, s string"), lambda b: b.withColumn("u", F.upper("s")), out, log, ["i"])
    assert sorted((r.i, r.u) for r in spark.read.parquet(out).collect()) == [(1, "A"), (2, "B"), (3, "C")]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not there")
def test_every_core_query_agrees_with_its_sql(spark):
    import duckdb

    from lexloom.plans import registry
    from lexloom.tables import TABLES
    from tools.compare import norm

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    bad = []
    for name, f in registry.queries().items():
        got = f(spark, SMALL).toPandas()
        sql = registry.oracle_sql().get(name)
        if sql and norm(got) != norm(con.execute(sql).df()):
            bad.append(name)
    assert not bad


def test_scopes_delete_what_they_do_not_keep(spark):
    from lexloom.session import _LEFT, Scope, lookup, materialise, sweep

    before = set(_LEFT)
    with Scope() as scope:
        lost = materialise(spark.range(3), "lost")
        kept = scope.keep(materialise(spark.range(4), "kept", n=F.count(F.lit(1)), most=F.max("id")))
    assert kept.counts == {"n": 4, "most": 3} and kept.count() == 4
    assert lost._lexloom_path not in _LEFT and {kept._lexloom_path} == _LEFT - before
    rows = spark.range(1000).selectExpr("IF(id % 2 = 0, 'hot', concat('k', id)) AS key", "id")
    table = rows.select("key").distinct().withColumn("v", F.length("key"))
    joined = lookup(rows, table, "key", 501, hot=100, limit=0)
    assert joined.count() == 1000 and joined.filter("key = 'hot'").count() == 500
    assert lookup(rows, table.filter("key = 'hot'"), "key", 1, "left", hot=100, limit=0).filter("v IS NULL").count() == 500
    assert sweep(spark) >= 1 and not _LEFT


def test_dense_search_in_blocks_against_brute_force(spark):
    rng = random.Random(3)
    vecs = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(200)] + [(900, None), (901, [0.0] * 5)]
    v = spark.createDataFrame(vecs, "vec_id bigint, embedding array<double>").repartition(5)
    q = v.filter("vec_id % 7 = 0").withColumnRenamed("vec_id", "query_id")
    norm = lambda x: sum(t * t for t in x) ** 0.5 or 1.0
    cos = lambda a, b: round(sum(s * t for s, t in zip(a, b)) / norm(a) / norm(b), 9)
    full = {i: x for i, x in vecs if x}
    want = {a: [b for _, b in sorted((-cos(full[a], full[b]), b) for b in full if cos(full[a], full[b]) > 0)[:4]] for a in full if a % 7 == 0}
    got = {}
    for r in sorted(retrieval.dense_top(q, v, 4, block=9).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {a: b for a, b in want.items() if b}
    assert retrieval.dense_top(q.limit(0), v, 4).count() == 0


def test_closure_against_union_find(spark):
    from lexloom.operators.closure import closure

    rng = random.Random(9)
    pairs = [(f"n{rng.randint(0, 90):02}", f"n{rng.randint(0, 90):02}") for _ in range(70)] + [(f"c{i:02}", f"c{i + 1:02}") for i in range(40)] + [("s", "s"), (None, "x")]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a and b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame(pairs, "a string, b string")
    assert {r.value: r.root for r in closure(df, "a", "b").collect()} == {x: find(x) for x in root}
    assert closure(df.limit(0), "a", "b").count() == 0
