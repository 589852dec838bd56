"""Encoding a corpus with a public tokenizer (problem 8)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lexloom.llm.bpe import TOKENIZER_DIR, ByteBPE, read_file
from lexloom.tables import load

_MODELS: dict[tuple[str, str], ByteBPE] = {}


def model(directory: str, name: str, content: bytes | None = None) -> ByteBPE:
    """One vocabulary per Python worker, made from the file's bytes where they were sent."""
    if (directory, name) not in _MODELS:
        _MODELS[directory, name] = ByteBPE(directory, name, content=content)
    return _MODELS[directory, name]


def _batches(ids: pa.Array, texts: pa.Array, max_chars: int = 1_000_000) -> Iterator[tuple[int, list]]:
    """Slices of bounded text size, so that a batch of very long texts doesn't pile up tokens."""
    start, size, held = 0, 0, []
    for i, t in enumerate(texts):
        s = t.as_py()
        held.append(s)
        size += len(s or "")
        if size >= max_chars:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def encode(df: DataFrame, key: str, text: str = "text", directory: str = TOKENIZER_DIR, name: str = "byte_bpe_50k.json", counts_only: bool = False) -> DataFrame:
    """key, ids (array<int>), or key, n_tokens (bigint) with counts_only: the tokens of each text, without special tokens.

    Null and empty texts give an empty list (0 tokens). One row out per row in, repeated rows and null keys included;
    special tokens written out in a text are ordinary text; further columns are not read. One pass without a shuffle.
    """
    kind = df.schema[key].dataType.simpleString()
    # the driver reads the vocabulary (a file of fixed size) and sends it along: workers need no such folder
    sent = df.sparkSession.sparkContext.broadcast(read_file(directory, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(directory, name, sent.value)
        for b in batches:
            for start, texts in _batches(b.column(0), b.column(1)):
                keys, ids = b.column(0).slice(start, len(texts)), bpe.encode_batch(texts)
                if counts_only:
                    value = pa.array([len(x) for x in ids], pa.int64())
                else:
                    value = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, value], names=["k", "v"])

    made = df.select(df[key].alias("k"), df[text].alias("t")).mapInArrow(run, f"k {kind}, v {'bigint' if counts_only else 'array<int>'}")
    return made.toDF(key, "n_tokens" if counts_only else "ids")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode(load(spark, d, "documents"), "doc_id")


QUERIES = {"p8_ids": p8_ids}
SQL: dict[str, str] = {}
