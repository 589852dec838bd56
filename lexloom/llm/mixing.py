"""Mixing sources to target weights by Efraimidis-Spirakis sampling (problem 9).

Every document draws an exponential key -ln(u)/w from a hash of its id, w its quality weight; in a source, documents in
key order are a weighted sample without replacement. A source's token budget buys complete epochs first; what is left takes
the documents in key order up to the budget. Prefix sums are exact and never gather a source: rows are range-partitioned by
key, which makes even ranges whatever the weights, range totals are prefix-summed, and rows are summed only inside their range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.bpe import TOKENIZER_DIR
from lexloom.llm.tokens import encode
from lexloom.operators.hotkeys import placed
from lexloom.session import materialise
from lexloom.tables import load

SEED = 17


def quality(text: str = "text"):
    """A weight in [0.05, 1]: the share of letters among the visible characters, less for texts under 200 characters."""
    visible = F.length(F.regexp_replace(text, r"\s", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    share = F.when(visible > 0, letters / visible).otherwise(0.0)
    return F.coalesce(F.greatest(F.lit(0.05), share * F.least(F.lit(1.0), F.length(text) / 200)), F.lit(0.05))


def budgets(capacity: list[tuple[str, float, int, int]], total: float | None = None) -> dict[str, float]:
    """Tokens for each source of (source, target_share, max_repeats, tokens): shares as near the targets as the caps allow.

    Without `total` the mix is the largest in which every source with tokens meets its target exactly. With it, sources
    that cannot supply their share give all they have and the rest is spread over the others in proportion.
    """
    live = {s: (share, reps * n) for s, share, reps, n in capacity if share > 0 and reps * n > 0}
    weight = sum(share for share, _ in live.values())
    if not live:
        return {}
    if total is None:
        return {s: share * min(cap / sh for sh, cap in live.values()) for s, (share, _) in live.items()}
    out: dict[str, float] = {}
    left = total
    while live:
        full = {s: cap for s, (share, cap) in live.items() if share / weight * left >= cap}
        if not full:
            return out | {s: share / weight * left for s, (share, _) in live.items()}
        for s, cap in full.items():
            out[s] = float(cap)
            left -= cap
            weight -= live.pop(s)[0]
    return out


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = SEED, directory: str = TOKENIZER_DIR) -> DataFrame:
    """doc_id, source, n_tokens, copies (>= 1): the documents of the mix and how often each is used.

    docs: doc_id, source, text; targets: source, target_share, max_repeats (a small fixed table: one row per source, read by
    the driver). Null and empty texts have no tokens and are never used; documents of null or untargeted sources are left
    out; repeated targets of a source are an error. copies never exceeds max_repeats. The document that crosses a budget is
    taken if that brings the source nearer to it.
    """
    wanted = targets.select("source", "target_share", "max_repeats").filter("source IS NOT NULL").collect()
    if len({r.source for r in wanted}) < len(wanted):
        raise ValueError("a source has several targets")
    names = [r.source for r in wanted]
    chosen = docs.select("doc_id", "source", "text").filter(F.col("source").isin(names))
    # one pass over the texts: the tokens are counted in Python, the weight in the JVM, both packed under one key
    keyed = chosen.select(F.struct("doc_id", "source", quality().alias("w")).alias("k"), "text")
    sized = encode(keyed, "k", directory=directory, counts_only=True).select("k.doc_id", "k.source", "k.w", "n_tokens").filter("n_tokens > 0")
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "source"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    sized = materialise(sized.select("doc_id", "source", "n_tokens", (-F.log(u) / F.col("w")).alias("es_key")), "sized")
    have = {r.source: (r.t,) for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    budget = budgets([(r.source, r.target_share, r.max_repeats, have.get(r.source, (0,))[0]) for r in wanted], total)
    spark = docs.sparkSession
    plan = [(s, int(b // have[s][0]), float(b - b // have[s][0] * have[s][0])) for s, b in budget.items()]
    plan_df = F.broadcast(spark.createDataFrame(plan, "source string, epochs int, rest double"))  # one row per target
    # even ranges of keys over all sources: a source's rows of one range are summed together, the ranges' totals before them
    rows = materialise(placed(sized, ["source"], ["es_key", "doc_id"]), "mix-placed")
    before = Window.partitionBy("source").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("source", "_pid").agg(F.sum("n_tokens").alias("_t")).select("source", "_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_in", F.sum("n_tokens").over(inside)).join(starts, ["source", "_pid"]).join(plan_df, "source")
    end = F.col("_start") + F.col("_in")
    # taken while at least half of the document lies within the budget
    extra = (end - F.col("n_tokens") / 2 <= F.col("rest")).cast("int")
    return summed.select("doc_id", "source", "n_tokens", (F.col("epochs") + extra).alias("copies")).filter("copies > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, n_docs, n_copies, tokens, actual_share: what each targeted source really got."""
    got = mixed.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("copies").alias("n_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"))
    all_of = got.agg(F.sum("tokens").alias("_all"))
    zero = F.lit(0).cast("bigint")
    # targets is a fixed table of one row per source; _all is one row
    joined = targets.select("source", "target_share", "max_repeats").join(got, "source", "left").crossJoin(F.broadcast(all_of))
    return joined.select(
        "source", "target_share", "max_repeats", F.coalesce("n_docs", zero).alias("n_docs"), F.coalesce("n_copies", zero).alias("n_copies"),
        F.coalesce("tokens", zero).alias("tokens"), F.coalesce(F.col("tokens") / F.col("_all"), F.lit(0.0)).alias("actual_share"),
    )


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(load(spark, d, "documents"), load(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return shares(p9_mix(spark, d), load(spark, d, "mix_targets"))


def p9_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Per target that must hold by the statement: source, max_repeats, caps_kept (no document more often than allowed),
    own_documents (all of this source, with a text), near_target (the tokens off the target are less than one document's)."""
    docs = load(spark, d, "documents")
    mixed = materialise(mix(docs, load(spark, d, "mix_targets")), "mixed")
    own = mixed.join(docs.filter("length(text) > 0").select("doc_id", F.col("source").alias("_source")), "doc_id", "left")
    most = mixed.groupBy("source").agg(F.max("copies").alias("_most"), F.max("n_tokens").alias("_longest"))
    strange = own.groupBy("source").agg(F.count_if(F.col("_source").isNull() | (F.col("_source") != F.col("source"))).alias("_strange"))
    got = shares(mixed, load(spark, d, "mix_targets")).join(most, "source").join(strange, "source")
    every = F.col("tokens") / F.col("actual_share")
    near = F.abs(F.col("tokens") - F.col("target_share") * every) <= 2 * F.col("_longest")
    return got.select("source", "max_repeats", (F.col("_most") <= F.col("max_repeats")).alias("caps_kept"), (F.col("_strange") == 0).alias("own_documents"), near.alias("near_target"))


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares, "p9_bounds": p9_bounds}
SQL = {
    "p9_bounds": """SELECT m.source, m.max_repeats, true AS caps_kept, true AS own_documents, true AS near_target FROM mix_targets m
        WHERE target_share > 0 AND max_repeats > 0 AND EXISTS (SELECT 1 FROM documents d WHERE d.source = m.source AND length(d.text) > 0)"""
}
