"""Cutting spans out of texts: each text crosses to Python once and is sliced there, however many spans it has."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 4_000_000  # characters of slices a batch holds before it is handed on


def with_spans(texts: DataFrame, spans: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """key, text, spans: each distinct (key, text) with the list of its distinct spans (char_start, char_end, *names).

    The text is shuffled once, by its key; the spans of a text are a list no longer than the text warrants. Spans that are
    null, negative or reversed are left out, texts without a span too.
    """
    whole = texts.select(key, "text").filter(f"{key} IS NOT NULL AND text IS NOT NULL").repartition(F.col(key)).distinct()
    kept = spans.filter("char_start >= 0 AND char_end > char_start").select(key, F.struct("char_start", "char_end", *names).alias("s"))
    return whole.join(kept.groupBy(key).agg(F.collect_set("s").alias("spans")), key)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list, list]]:
    """(keys, names, starts, ends, slices) of rows (key, text, spans) in lots of bounded size; spans beyond the text are left out.

    spans: structs of char_start, char_end and one name.
    """
    lot, size = ([], [], [], [], []), 0
    for b in batches:
        for row in range(b.num_rows):
            key, text, spans = b.column(0)[row].as_py(), b.column(1)[row].as_py(), b.column(2)[row].values.flatten()
            n = len(text)
            for at, end, name in zip(*(s.to_pylist() for s in spans)):
                if end <= n:
                    for held, value in zip(lot, (key, name, at, end, text[at:end])):
                        held.append(value)
                    size += end - at
            if size >= MOST:
                yield lot
                lot, size = ([], [], [], [], []), 0
    if lot[0]:
        yield lot
