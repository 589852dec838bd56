"""Sources and sinks: parsed folders, raw logs, whole-text sidecars, distinct output names, deterministic exports, manifests."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Files of a parsed folder that are no documents.
BOOKKEEPING = ("manifest.json", "pipeline.json", "doc_types.json")


def parsed_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The documents of a folder of JSON files, with `stem`; bookkeeping files and unreadable JSON are left out."""
    df = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").schema(schema + ", _bad string").json(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return df.withColumn("_name", name).filter(F.col("_bad").isNull() & ~F.col("_name").isin(*BOOKKEEPING)).withColumn("stem", F.regexp_replace("_name", r"\.json$", "")).drop("_bad", "_name")


def input_files(spark: SparkSession, path: str, pattern: str = "*.pdf", recursive: bool = True) -> DataFrame:
    """path, length, modificationTime of files; the bytes are never read, since the column is pruned."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(path).select("path", "length", "modificationTime")


def output_names(files: DataFrame) -> DataFrame:
    """path, stem, output: the stem where it is the only one of the run, else parent and stem with a hash of the path."""
    parts = F.split("path", "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    parent = F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit(""))
    rows = files.select("path", stem.alias("stem"), parent.alias("parent"))
    n = F.count("*").over(Window.partitionBy("stem"))
    long = F.concat_ws("_", F.substring(F.concat_ws("_", "parent", "stem"), 1, 110), F.substring(F.sha1("path"), 1, 8))
    return rows.withColumn("n", n).select("path", "stem", F.when(F.col("n") == 1, F.col("stem")).otherwise(long).alias("output"))


def raw_log(spark: SparkSession, path: str) -> DataFrame:
    """page_number, raw of JSONL logs: unreadable lines are skipped, of several records of a page the last line of the last file
    (by name) wins, however the files are split."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start")).alias("block"), F.monotonically_increasing_id().alias("line"), F.from_json("value", "page_number int, raw string").alias("r"))
    return lines.filter("r.page_number IS NOT NULL").groupBy(F.col("r.page_number").alias("page_number")).agg(F.max_by("r.raw", F.struct("file", "block", "line")).alias("raw"))


def sidecar_titles(spark: SparkSession, path: str) -> DataFrame:
    """file, title: the first line of each text file's first 20 that names an instrument."""
    df = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.slice(F.split("value", "\n"), 1, 20).alias("lines"))
    hit = F.filter("lines", lambda x: F.upper(x).rlike(r"\b(ACT|ORDINANCE|CODE|RULES|REGULATION)\b"))
    return df.select("file", F.trim(F.try_element_at(hit, F.lit(1))).alias("title"))


def email_records(spark: SparkSession, path: str) -> DataFrame:
    """Headers verbatim, the addressees split at commas, the plain body and the attachments of .eml files."""
    ddl = "`from` string, `to` array<string>, cc array<string>, date string, subject string, body_text string, attachments array<struct<name:string,content_type:string>>"

    def run(batches):
        import email
        from email import policy

        import pandas as pd

        people = lambda v: [x.strip() for x in str(v or "").split(",") if x.strip()]
        for b in batches:
            rows = []
            for content in b["content"]:
                m = email.message_from_bytes(content, policy=policy.default)
                body = m.get_body(preferencelist=("plain",))
                files = [{"name": a.get_filename() or "", "content_type": a.get_content_type()} for a in m.iter_attachments()]
                rows.append({"from": m["from"], "to": people(m["to"]), "cc": people(m["cc"]), "date": m["date"], "subject": m["subject"], "body_text": body.get_content() if body else None, "attachments": files})
            yield pd.DataFrame(rows, columns=["from", "to", "cc", "date", "subject", "body_text", "attachments"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").load(path).select("content").mapInPandas(run, ddl)


def check_output(out: str, inputs: list[str]) -> str:
    """out, unless it is or lies inside an input folder."""
    clean = lambda p: posixpath.normpath(p).rstrip("/") + "/"
    if any(clean(out).startswith(clean(i)) for i in inputs):
        raise ValueError(f"{out} lies inside an input folder")
    return out


def export_jsonl(df: DataFrame, path: str, keys: list[str]) -> None:
    """One ordered JSONL export for small artifacts; the commit protocol makes it atomic. Tables stay Parquet."""
    df.orderBy(*keys).coalesce(1).write.mode("overwrite").json(path)


def manifest(results: DataFrame) -> DataFrame:
    """status, documents, failures, pages of a run's result table (status, error, pages)."""
    return results.groupBy("status").agg(F.count("*").alias("documents"), F.count("error").alias("failures"), F.sum("pages").alias("pages"))
