"""Which judgment each document is: identity by a ladder, typed aliases, conflicts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.legal.cases import case_numbers, label_case

DOCS = "corpus string, stem string, document_id string, court_id string, neutral string, label_neutral string, case_type string, case_number string, year string, label_date string, decision_date string, printed_case string, header string"


def _spaced(c):
    return F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))


def identified(docs: DataFrame) -> DataFrame:
    """docs (columns DOCS; document_id is the content's hash) with stems, key, rung and judgment_id, one row per document: the first
    stem of a corpus stands for copies. The key is the neutral citation, else court, case and date of the label, else the hash."""
    w = Window.partitionBy("document_id")
    first = docs.withColumn("stems", F.transform(F.sort_array(F.collect_list(F.struct("corpus", "stem")).over(w)), lambda x: x["stem"])).withColumn("_n", F.row_number().over(w.orderBy("corpus", "stem"))).filter("_n = 1").drop("_n")
    case = F.pandas_udf(lambda a, b, c: pd.Series([label_case(*x) for x in zip(a, b, c)], dtype=object), "string")("case_type", "case_number", "year")
    d = first.withColumn("label_case", case)
    neutral = _spaced(F.coalesce(F.nullif("label_neutral", F.lit("")), F.nullif("neutral", F.lit(""))))
    day = F.split("label_date", "-")
    labelled = F.when(F.col("label_case").isNotNull() & F.col("label_date").isNotNull(), F.concat_ws("/", F.coalesce("court_id", F.lit("unknown_court")), "label_case", F.concat_ws("-", day[2], day[1], day[0])))
    key = F.coalesce(F.concat(F.lit("neutral/"), neutral), labelled, F.concat(F.lit("document/"), "document_id"))
    rung = F.when(neutral.isNotNull(), "neutral_citation").when(labelled.isNotNull(), "court_label").otherwise("content_hash")
    return d.withColumn("key", key).withColumn("rung", rung).withColumn("judgment_id", F.concat(F.lit("j_"), F.substring(F.sha1("key"), 1, 16)))


def judgments(known: DataFrame) -> DataFrame:
    """judgment_id, key, rung, court_id, document_ids, decision_date (the first stated, by corpus and stem) of identified()."""
    place = F.struct("corpus", F.col("stems")[0])
    dated = F.min_by(F.when(F.col("decision_date").isNotNull(), F.col("decision_date")), F.when(F.col("decision_date").isNotNull(), place))
    g = known.groupBy("judgment_id").agg(F.first("key").alias("key"), F.min_by("rung", place).alias("rung"), F.min_by(F.coalesce("court_id", F.lit("unknown_court")), place).alias("court_id"), F.transform(F.sort_array(F.collect_list(F.struct(place.alias("p"), "document_id"))), lambda x: x["document_id"]).alias("document_ids"), dated.alias("decision_date"))
    return g


def aliases(known: DataFrame) -> DataFrame:
    """alias_type (document, neutral, case_number, reported), alias, judgment_id, each once."""
    parsed = F.pandas_udf(lambda t: t.map(lambda x: case_numbers(x)), "array<string>")("printed_case")
    court = F.coalesce("court_id", F.lit("unknown_court"))
    keys = F.array_distinct(F.array_compact(F.concat(F.array("label_case"), parsed)))
    kind = lambda name, value: F.array(F.struct(F.lit(name).alias("t"), value.alias("a")))
    none = F.array().cast("array<struct<t:string,a:string>>")
    rows = F.concat(
        kind("document", F.col("document_id")), F.when(F.col("label_neutral") != "", kind("neutral", _spaced(F.col("label_neutral")))).otherwise(none),
        F.transform(keys, lambda k: F.struct(F.lit("case_number").alias("t"), F.concat_ws(":", court, k).alias("a"))), F.when(F.col("header").isNotNull(), kind("reported", F.col("header"))).otherwise(none),
    )
    return known.select("judgment_id", F.explode(rows).alias("r")).select(F.col("r.t").alias("alias_type"), F.col("r.a").alias("alias"), "judgment_id").distinct()


def conflicts(known_aliases: DataFrame) -> DataFrame:
    """alias_type, alias, judgments: reported and neutral aliases that several judgments hold."""
    g = known_aliases.filter(F.col("alias_type").isin("reported", "neutral")).groupBy("alias_type", "alias").agg(F.sort_array(F.collect_set("judgment_id")).alias("judgments"))
    return g.filter(F.size("judgments") > 1)
