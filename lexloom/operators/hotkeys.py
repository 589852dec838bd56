"""Per-key processing that a few huge keys cannot delay: exact offset chunking.

Rows are numbered exactly within their key without ever bringing a key together:

1. count the keys of each input partition (a narrow table: partitions x keys present),
2. prefix-sum the counts into the first number of each (key, partition),
3. number the rows: offset of (key, partition) + place within it,
4. rows number//size is a chunk: all chunks of a key but its last hold exactly `size` rows,
5. each chunk is reduced on its own and the ordered chunk states are merged per key.

Input partitions are never reshuffled by key, so a key holding a third of all rows is spread over the
same partitions as before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.session import Scope, broadcast_if_small, materialise

_POS = (1 << 33) - 1


def placed(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """df with _pid (input partition) and _pos (place in it, rows of one key adjacent and in `order`).

    With `order` the input is first range-partitioned by it, so that partition order is value order. Range bounds come
    from a sample that a second run of the plan may draw differently, hence the table is written once and read back;
    without `order` too, since a shuffle below may hand its rows over in another order when it is read again.
    """
    if order:
        df = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    sort = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    mid = F.monotonically_increasing_id()
    return df.sortWithinPartitions(*sort).select("*", F.shiftright(mid, 33).alias("_pid"), mid.bitwiseAND(F.lit(_POS)).alias("_pos"))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """df (or its `columns`) with row_no: 0, 1, 2... within the key, in `order` (input order where none is given).

    Null keys form a key of their own. An empty table gives an empty table. Repeated rows are numbered apart; rows equal
    in `order` are numbered in an arbitrary order. Columns named _pid, _pos, _start or row_no in df are an error.
    """
    taken = {"_pid", "_pos", "_start", "row_no"} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} clash with the operator's own")
    rows = materialise(placed(df.select(*(columns or df.columns)), keys, order), "placed")
    counts = rows.groupBy(*keys, "_pid").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(
        counts.select(*keys, "_pid", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start")), "offsets"
    )
    small = broadcast_if_small(offsets, offsets.count())
    on = [rows["_pid"] == small["_pid"], *[rows[k].eqNullSafe(small[k]) for k in keys]]
    joined = rows.join(small, on)
    return joined.select(*[rows[c] for c in rows.columns if not c.startswith("_p")], (rows["_pos"] + small["_start"]).alias("row_no"))


def chunk_states(df: DataFrame, keys: Sequence[str], size: int, states: Sequence[Column], order: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key and chunk of `size` consecutive rows: keys, chunk_no, n_rows and the given aggregates."""
    numbered = number_rows(df, keys, order, columns)
    return numbered.groupBy(*keys, F.floor(F.col("row_no") / size).alias("chunk_no")).agg(F.count("*").alias("n_rows"), *states)


def key_counts(df: DataFrame, key: str, size: int = 100_000) -> DataFrame:
    """key, n_rows, n_chunks, largest_chunk: exact rows per key, through balanced chunks. Null is a key."""
    chunks = chunk_states(df, [key], size, [], columns=[key])
    return chunks.groupBy(key).agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_chunks"), F.max("n_rows").alias("largest_chunk"))


def heavy_keys(df: DataFrame, key: str, share: float = 0.05, size: int = 100_000) -> DataFrame:
    """key_value, n_rows: the non-null keys with at least `share` of all rows (null keys count in the total only)."""
    with Scope() as scope:
        counts = scope.keep(materialise(key_counts(df, key, size), "counts"))
    total = counts.agg(F.sum("n_rows").alias("_total"))
    return (
        counts.filter(F.col(key).isNotNull())
        .crossJoin(F.broadcast(total))  # one row
        .filter(F.col("n_rows") >= F.col("_total") * share)
        .select(F.col(key).cast("string").alias("key_value"), "n_rows")
    )


def gap_profile(df: DataFrame, key: str, time: str, tie: str, size: int = 100_000) -> DataFrame:
    """Per key: n_rows, first and last time, the longest gap between consecutive times in microseconds.

    The gap needs neighbours: each chunk keeps its own longest gap and its ordered boundary (first, last); merging the
    chunks of a key in order adds the gaps between chunks. Rows without a time take no part in the gaps but are counted;
    a key with fewer than two times has gap 0.
    """
    with Scope() as scope:
        return scope.keep(materialise(_gap_profile(df, key, time, tie, size), "gaps"))


def _gap_profile(df: DataFrame, key: str, time: str, tie: str, size: int) -> DataFrame:
    ordered = number_rows(df, [key], [time, tie], columns=[key, time, tie])
    timed = ordered.select(F.col(key).alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), "row_no")
    chunk = timed.withColumn("chunk_no", F.floor(F.col("row_no") / size))
    inner = Window.partitionBy("k", "chunk_no").orderBy("row_no")
    states = (
        chunk.withColumn("gap", F.col("t") - F.lag("t").over(inner))
        .groupBy("k", "chunk_no")
        .agg(F.count("*").alias("n_rows"), F.max("gap").alias("gap"), F.min("t").alias("t0"), F.max("t").alias("t1"))
    )
    # chunks without any time are passed over: the last time before a chunk is the greatest of the earlier ones
    merged = states.withColumn("prev", F.max("t1").over(Window.partitionBy("k").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)))
    return merged.groupBy(F.col("k").alias("key_value")).agg(
        F.sum("n_rows").alias("n_rows"), F.min("t0").alias("first_us"), F.max("t1").alias("last_us"),
        F.coalesce(F.max(F.greatest("gap", F.col("t0") - F.col("prev"))), F.lit(0)).alias("longest_gap_us"),
    )
