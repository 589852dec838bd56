"""What can be plugged in: readers of pages, enrichers of records, embedders of texts, readers of crops; and facts with evidence."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators.pages import may_send

BLOCKS = "document_id string, page int, ord int, block_id string, type string, text string, bbox array<double>"


class Engine(Protocol):
    """Reads the pages of files. policy says where its work is done: local, self_hosted or third_party."""

    name: str
    policy: str

    def parse(self, content: bytes, document_id: str) -> Iterator[dict]:
        """Rows of BLOCKS of one file."""


class Enricher(Protocol):
    """Adds to or corrects records, never removes."""

    def __call__(self, records: DataFrame) -> DataFrame: ...


class Embedder(Protocol):
    dimension: int

    def encode(self, texts: Sequence[str]) -> list[list[float]]: ...


Reader = Callable[[str], str]  # a model call: prompt to answer; made on a worker by a factory named in the plan


def parse_files(files: DataFrame, engines: Sequence[Engine], ceiling: str = "local") -> DataFrame:
    """BLOCKS and engine, error: each file (path, content) read by the first engine whose policy the ceiling allows and that doesn't
    fail; failures of all become a row with the errors, never an exception."""
    allowed = [e for e in engines if ["local", "self_hosted", "third_party"].index(e.policy) <= ["local", "self_hosted", "third_party"].index(ceiling)]
    columns = [c.split()[0] for c in BLOCKS.split(", ")] + ["engine", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                errors = []
                for e in allowed:
                    try:
                        rows += [r | {"engine": e.name, "error": None} for r in e.parse(bytes(content), path)]
                        break
                    except Exception as x:
                        errors.append(f"{e.name}: {x}")
                else:
                    rows.append({"document_id": path, "error": "; ".join(errors) or "no engine allowed"})
            yield pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in columns})

    return files.select("path", "content").mapInPandas(run, f"{BLOCKS}, engine string, error string")


def enriched(records: DataFrame, enrichers: Sequence[Enricher]) -> DataFrame:
    """The records through every enricher in order."""
    return reduce(lambda df, e: df.transform(e), enrichers, records)


def embedded(df: DataFrame, key: str, text: str, make: Callable[[], Embedder]) -> DataFrame:
    """key, vector: the texts through an embedder made once per task."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = make()
        for b in batches:
            yield pd.DataFrame({key: b[key], "vector": e.encode(b[text].fillna("").tolist())})

    return df.select(key, text).mapInPandas(run, f"{key} {kind}, vector array<double>")


@dataclass
class HashEmbedder:
    """Counts of crc32(token) mod dimension, to unit length: a stand-in without a model."""

    dimension: int = 256

    def encode(self, texts: Sequence[str]) -> list[list[float]]:
        import re
        import zlib

        out = []
        for t in texts:
            v = [0.0] * self.dimension
            for w in re.findall("[A-Za-z]+|[0-9]+[A-Za-z]*", t):
                v[zlib.crc32(w.lower().encode()) % self.dimension] += 1
            norm = sum(x * x for x in v) ** 0.5 or 1.0
            out.append([x / norm for x in v])
        return out


EVIDENCE = "document_id string, page int, bboxes array<array<double>>, block_ids array<string>, quote string"


def fact(value: Column, method: str, extractor: str, version: str, confidence: Column, evidence: Column) -> Column:
    """A fact with what it rests on: value, method, extractor, version, confidence, evidence, review (unreviewed)."""
    parts = [value.alias("value"), F.lit(method).alias("method"), F.lit(extractor).alias("extractor"), F.lit(version).alias("extractor_version"), confidence.alias("confidence"), evidence.alias("evidence"), F.lit("unreviewed").alias("review")]
    return F.struct(*parts)


__all__ = ["BLOCKS", "EVIDENCE", "Embedder", "Engine", "Enricher", "HashEmbedder", "Reader", "embedded", "enriched", "fact", "may_send", "parse_files"]
