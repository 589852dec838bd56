"""Consolidating pairwise matches into groups by deterministic Borůvka hooking (problem 6).

A round: every component hooks onto its smallest neighbour (its smallest outgoing edge in the order of (lower, higher)
label, so that hooks close no cycle longer than two), the hooks' trees collapse by pointer doubling, edges are relabelled,
freed of loops and deduplicated. Components at least halve each round. Every table is written to the shared folder, so a lost
executor costs only the running step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.session import Scope, discard, lookup, materialise
from lexloom.tables import load


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("lo").alias("c"), F.col("hi").alias("other")).unionByName(edges.select(F.col("hi").alias("c"), F.col("lo").alias("other")))


def _hooks(edges: DataFrame, limit: int, hot: int) -> DataFrame:
    """c, up: each component and the root it hangs on; of two that chose each other the smaller is a root."""
    best = materialise(_both_ways(edges).groupBy("c").agg(F.min("other").alias("up")), "best", n=F.count(F.lit(1)))
    n = best.counts["n"]
    # a star's centre is what all its leaves choose: the join on `up` is one on a hot key
    peer = best.select(F.col("c").alias("up"), F.col("up").alias("p_up"))
    rooted = lookup(best, peer, "up", n, hot=hot, limit=limit).select("c", F.when((F.col("p_up") == F.col("c")) & (F.col("c") < F.col("up")), F.col("c")).otherwise(F.col("up")).alias("up"))
    up = materialise(rooted, "hooks")
    discard(best)
    while True:
        top = up.select(F.col("c").alias("up"), F.col("up").alias("t_up"))
        climbed = lookup(up, top, "up", n, hot=hot, limit=limit).select("c", F.col("t_up").alias("up"), (F.col("up") != F.col("t_up")).alias("moved"))
        nxt = materialise(climbed, "doubled", moved=F.count_if(F.expr("moved")))
        discard(up)
        up = nxt.select("c", "up")
        up._lexloom_path, up.counts = nxt._lexloom_path, {"n": n}
        if not nxt.counts["moved"]:
            return up


def components(pairs: DataFrame, a: str, b: str, limit: int = 200_000, hot: int = 100_000) -> DataFrame:
    """node, group_id: every distinct value of a row with both ends, and the smallest value (byte order) linked to it.

    Rows with a null end are left out, self matches make a group of one, repeated and reversed pairs count once, an empty
    table gives an empty table. Further columns, of whatever name, are not read. Labels are broadcast while there are at most
    `limit` of them; beyond, labels that hold over `hot` rows are split from the rest (session.lookup).
    """
    with Scope() as scope:
        ends = pairs.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
        both = materialise(ends.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct(), "pairs", n=F.count_if(F.expr("lo != hi")))
        nodes = materialise(both.select(F.explode(F.array("lo", "hi")).alias("node")).distinct().select("node", F.col("node").alias("label")), "nodes")
        edges, left = both.filter("lo != hi"), both.counts["n"]
        while left:
            up = _hooks(edges, limit, hot)
            n = up.counts["n"]
            to = lambda key, root: up.select(F.col("c").alias(key), F.col("up").alias(root))  # noqa: E731, B023
            moved = lookup(nodes, to("label", "root"), "label", n, "left", hot, limit).select("node", F.coalesce("root", "label").alias("label"))
            moved = materialise(moved, "nodes")
            both_up = lookup(lookup(edges, to("lo", "lo_up"), "lo", n, "inner", hot, limit), to("hi", "hi_up"), "hi", n, "inner", hot, limit)
            fewer = both_up.filter("lo_up != hi_up").select(F.least("lo_up", "hi_up").alias("lo"), F.greatest("lo_up", "hi_up").alias("hi")).distinct()
            fewer = materialise(fewer, "edges", n=F.count(F.lit(1)))
            discard(nodes, edges, up)
            nodes, edges, left = moved, fewer, fewer.counts["n"]
        names = materialise(nodes.groupBy("label").agg(F.min("node").alias("group_id")), "names", n=F.count(F.lit(1)))
        return scope.keep(materialise(lookup(nodes, names, "label", names.counts["n"], "inner", hot, limit).select("node", "group_id"), "groups"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return components(load(spark, d, "cite_pairs"), "citation_a", "citation_b").select(F.col("node").alias("citation"), F.col("group_id").alias("group_citation"))


def p6_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct chunk id with its citation and the citation of its whole group; a citation in no pair is its own group."""
    groups = p6_found(spark, d)
    chunks = load(spark, d, "chunks").select("id", "citation").distinct()
    return chunks.join(groups, "citation", "left").select("id", "citation", F.coalesce("group_citation", "citation").alias("group_citation"))


_GROUPS = """
    WITH RECURSIVE e AS (SELECT citation_a AS x, citation_b AS y FROM cite_pairs WHERE citation_a IS NOT NULL AND citation_b IS NOT NULL
      UNION SELECT citation_b, citation_a FROM cite_pairs WHERE citation_a IS NOT NULL AND citation_b IS NOT NULL),
    r AS (SELECT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
    g AS (SELECT x AS citation, min(y) AS group_citation FROM r GROUP BY x)"""

QUERIES = {"p6_found": p6_found, "p6_chunks": p6_chunks}
SQL = {
    "p6_found": _GROUPS + " SELECT citation, group_citation FROM g",
    "p6_chunks": _GROUPS + """ SELECT c.id, c.citation, coalesce(g.group_citation, c.citation) AS group_citation
        FROM (SELECT DISTINCT id, citation FROM chunks) c LEFT JOIN g ON c.citation = g.citation""",
}
