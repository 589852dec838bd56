"""Session construction and the written tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "lexloom", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the session comes from the launcher."""
    n = cores or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where it is unset (local runs)."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not named:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="lexloom-")
        spark.conf.set(CHECKPOINT_KEY, named)
    return named


_SCOPES: list[list[str]] = []
_LEFT: set[str] = set()


class Scope:
    """Tables written inside `with Scope() as s` are deleted when it is left, but those passed to s.keep."""

    def __enter__(self) -> Scope:
        self._paths: list[str] = []
        self._kept: set[str] = set()
        _SCOPES.append(self._paths)
        self._spark: SparkSession | None = None
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self._kept.add(getattr(df, "_lexloom_path", ""))
        return df

    def __exit__(self, *_: object) -> None:
        _SCOPES.remove(self._paths)
        spark = SparkSession.getActiveSession()
        for path in self._paths:
            if path in self._kept:
                if _SCOPES:
                    _SCOPES[-1].append(path)
            elif spark is not None:
                _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    _LEFT.discard(path)


def materialise(df: DataFrame, name: str, **counts: Column) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: an exact copy that survives lost executors.

    counts: aggregates taken while it is written, given as the attribute `counts` of what is returned.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexloom-{name}-{uuid.uuid4().hex}"
    seen = Observation() if counts else None
    (df.observe(seen, *[c.alias(k) for k, c in counts.items()]) if seen else df).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._lexloom_path = path  # type: ignore[attr-defined]
    back.counts = seen.get if seen else {}  # type: ignore[attr-defined]
    _LEFT.add(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return back


def discard(*frames: DataFrame) -> None:
    """Delete tables made by materialise that no later plan reads."""
    for df in frames:
        if path := getattr(df, "_lexloom_path", None):
            _delete(df.sparkSession, path)


def sweep(spark: SparkSession) -> int:
    """Delete every table materialise has written that is still there: for callers whose results are stored. Returns how many."""
    paths = sorted(_LEFT)
    for path in paths:
        _delete(spark, path)
    return len(paths)


BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, rows: int, limit: int = 200_000, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint only when its counted rows are within limit and the optimiser's size of it, taken from the
    files it reads, within most_bytes; otherwise the join shuffles."""
    if rows > limit or int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > most_bytes:
        return df
    return F.broadcast(df)


def lookup(rows: DataFrame, table: DataFrame, key: str, n: int, how: str = "inner", hot: int = 100_000, limit: int = 200_000) -> DataFrame:
    """rows joined to table (n rows, unique by key; the key's name is the same in both) where few keys may hold most rows.

    A small table is broadcast. Else keys with over `hot` rows, of which there are at most (rows / hot), are counted out and
    only their lines of the table are broadcast; all other rows are joined by a shuffle on the key.
    """
    if n <= limit:
        return rows.join(F.broadcast(table), key, how)
    heavy = materialise(rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot).select(key), "hot-keys")
    if heavy.isEmpty():
        return rows.join(table, key, how)
    known = F.broadcast(heavy)
    hot_table = F.broadcast(table.join(known, key, "left_semi"))
    return rows.join(known, key, "left_semi").join(hot_table, key, how).unionByName(rows.join(known, key, "left_anti").join(table, key, how))
