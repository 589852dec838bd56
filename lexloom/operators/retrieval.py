"""Exact, BM25, dense and sparse retrieval, rank fusion and its measures, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.text import tokens

K1, B = 1.5, 0.75


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, term, tf: occurrences of each term in each document. Null and empty texts have none."""
    return docs.select(key, F.explode(tokens(text)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def ranked(scores: DataFrame, key: str, depth: int, by: str = "query_id", score: str = "score") -> DataFrame:
    """scores with rank 1..depth per query: score descending, then key; zero and negative scores dropped."""
    w = Window.partitionBy(by).orderBy(F.desc(score), F.asc(key))
    return scores.filter(F.col(score) > 0).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= depth)


def fuse(legs: list[tuple[str, DataFrame]], key: str, k: int = 60, limit: int = 10) -> DataFrame:
    """Reciprocal-rank fusion of legs (query_id, key, rank): query_id, key, score, rank; ties by leg order, then by rank in it."""
    every = None
    for no, (_, leg) in enumerate(legs):
        rows = leg.select("query_id", key, "rank", F.lit(no).alias("leg_no"))
        every = rows if every is None else every.unionByName(rows)
    summed = every.groupBy("query_id", key).agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"), F.min(F.struct("leg_no", "rank")).alias("first"))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "first", key)
    return summed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit).select("query_id", key, "score", "rank")


BLOCK = 1024  # queries scored in one pass over the vectors


def dense_top(queries: DataFrame, vectors: DataFrame, depth: int, block: int = BLOCK) -> DataFrame:
    """query_id, vec_id, score, rank: cosine of every query vector against all vectors, positive scores only.

    queries (query_id, embedding) is a stated query set. It is taken in blocks of about `block` queries: a block's vectors, a
    matrix of a fixed size, go to every task, which scores its own rows in matrix products and hands on only its best `depth` of
    each query. Null and zero vectors score nothing.
    """
    n = max(1, -(-queries.count() // block))
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((queries, "query_id"), (vectors, "vec_id"))]
    out = None
    for k in range(n):
        rows = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(n)) == k).filter("embedding IS NOT NULL").select("query_id", "embedding").collect()  # a block
        part = _top_of_block([r.query_id for r in rows], _unit(np.array([r.embedding for r in rows], float)), vectors, depth, *kinds)
        out = part if out is None else out.unionByName(part)
    return ranked(out, "vec_id", depth)


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=-1, keepdims=True) if m.size else np.ones((len(m), 1))
    return m / np.where(norm == 0, 1, norm)


def _top_of_block(ids: list, asked: np.ndarray, vectors: DataFrame, depth: int, query_kind: str, key_kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)
            flat, sizes = b.column(1), pa.compute.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)
            width = asked.shape[1] if asked.size else 0
            good = np.flatnonzero(sizes == width)
            if not width or not len(good):
                continue
            held = _unit(np.stack([np.asarray(flat[int(i)].values, float) for i in good]) if len(good) < len(sizes) else flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width))
            score = np.round(held @ asked.T, 9)
            names = keys.take(pa.array(good)).to_pylist()
            order = np.argsort(np.array(names), kind="stable")
            best = [order[np.argsort(-score[order, q], kind="stable")[:depth]] for q in range(len(ids))]
            pick = np.concatenate(best)
            of = np.repeat(np.arange(len(ids)), [len(x) for x in best])
            values = score[pick, of]
            keep = values > 0
            yield pa.RecordBatch.from_pydict({"query_id": [ids[q] for q in of[keep]], "vec_id": [names[i] for i in pick[keep]], "score": values[keep]})

    return vectors.select("vec_id", "embedding").mapInArrow(run, f"query_id {query_kind}, vec_id {key_kind}, score double")


def recall_mrr(hits: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """kind, queries, mrr, recall_1, recall_5, recall_10. hits: query_id, key, rank; gold: query_id, kind, key."""
    first = gold.join(hits, ["query_id", key], "left").groupBy("kind", "query_id").agg(F.min("rank").alias("r"))
    at = lambda k: F.round(F.avg(F.when(F.col("r") <= k, 1.0).otherwise(0.0)), 4).alias(f"recall_{k}")
    return first.groupBy("kind").agg(F.count("*").alias("queries"), F.round(F.avg(F.coalesce(1.0 / F.col("r"), F.lit(0.0))), 4).alias("mrr"), at(1), at(5), at(10))
