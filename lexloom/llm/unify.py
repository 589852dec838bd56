"""One consistent form for text that looks the same (problem 7), by confusables skeletons.

skeleton(word): decompose, replace each character by the prototype it looks like, decompose again. Words with equal
skeletons look alike; the consistent form of a group is its Latin spelling. The prototypes are those of the public confusables
table of all scripts, which the ICU library that Spark ships holds; Latin letters stand for themselves. A word mixing Latin
letters with look-alikes is folded at once; a word made of look-alikes only is folded when its skeleton is also the skeleton
of a Latin word of the corpus and no neighbour is truly in another script. Each text is sliced once, in one Arrow pass.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.slicing import sliced, with_spans
from lexloom.session import broadcast_if_small, discard, materialise
from lexloom.tables import load

# Look-alikes the table leaves to themselves.
EXTRA = {"κ": "k", "χ": "x"}
# Arabic letters and digits and the ones Urdu uses in their place.
URDU = dict(zip("كڪيىهە٠١٢٣٤٥٦٧٨٩", "ککییہہ۰۱۲۳۴۵۶۷۸۹", strict=True))

_URDU_TABLE = str.maketrans(URDU)
_ORNAMENT = regex.compile(r"[ـً-ْٖ-ٰٟۖ-ۭ]")
_INVISIBLE = regex.compile(r"[\p{Cf}͏ᅟᅠ឴឵ㅤ︀-️ﾠ]")
_JOINER = regex.compile(r"(?<=[\p{Arabic}--[\p{P}\p{N}]])‌(?=[\p{Arabic}--[\p{P}\p{N}]])", regex.V1)
_WORD = regex.compile(r"[\p{L}\p{M}]+")
_LATIN, _OTHER = regex.compile(r"\p{Latin}"), regex.compile(r"[\p{L}--[\p{Latin}\p{Arabic}\p{Common}]]", regex.V1)
_NOT_LATIN = regex.compile(r"[^\p{Latin}\p{M}]")
_ORDINARY = regex.compile(r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Zs}！-～￠-￦]")
_KEEP = frozenset("ªº")
HOLD = ""  # stands for a joiner that is kept, while invisible characters are removed

# A text of these characters only is in the consistent form: ASCII, accented Latin letters as one character each, marks of
# typography, Urdu's own letters, digits and stops.
PLAIN = (
    r"^[\t\n\r\x20-\x7E¡-¬®-ıĴ-ľŁ-ňŊ-žȘ-țḀ-ẙẠ-ỹ"
    r"‐‒-―‘-‟†-•…€"
    r"،؛؟ء-غفقل-نوٹپچڈڑژکگںھہ-ۃیے-۔۰-۹]*$"
)
_PLAIN, _CONTROL = re.compile(PLAIN), re.compile(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")


def _ordinary(ch: str) -> str:
    if ch in _KEEP:
        return ch
    out = unicodedata.normalize("NFKC", ch)
    return " " if unicodedata.category(ch) == "Zs" else out


class Alike:
    """The letters of other scripts drawn like Latin ones, and those Latin letters: `strict` where the prototype is a plain
    Latin letter, `loose` with those whose prototype is a small capital or another variant of one."""

    def __init__(self, prototypes: dict[str, str]):
        self.strict, self.loose = dict(EXTRA), dict(EXTRA)
        for c, p in prototypes.items():
            p = "m" if p == "rn" else p
            if len(p) != 1:
                continue
            if p.isascii():
                latin = "I" if p == "l" and unicodedata.category(c) == "Lu" else p
                self.strict.setdefault(c, latin)
                self.loose.setdefault(c, latin)
            elif (name := unicodedata.name(p, "")).startswith("LATIN LETTER SMALL CAPITAL ") and len(name) == 28:
                self.loose.setdefault(c, name[-1].lower())
            elif p == "ĸ":
                self.loose.setdefault(c, "k")

    def skeleton(self, word: str) -> str:
        """Decompose, replace by prototypes, decompose again; case is kept."""
        first = unicodedata.normalize("NFKD", _INVISIBLE.sub("", word))
        return unicodedata.normalize("NFKD", "".join(self.strict.get(c, c) for c in first))

    def latin(self, word: str) -> str:
        return unicodedata.normalize("NFC", "".join(self.loose.get(c, c) for c in unicodedata.normalize("NFD", word)))

    def fold(self, text: str) -> tuple[str, list[str]]:
        """The consistent form, and the words of look-alikes only that need a Latin twin in the corpus (still unfolded in it)."""
        t = _JOINER.sub(HOLD, text)
        t = _INVISIBLE.sub("", t)
        t = _ORDINARY.sub(lambda m: _ordinary(m[0]), t).replace("‑", "-")
        t = _ORNAMENT.sub("", t).translate(_URDU_TABLE)
        t = unicodedata.normalize("NFC", t.replace(HOLD, "\u200c"))
        if not _OTHER.search(t):
            return t, []
        words = list(_WORD.finditer(t))
        kinds = []
        for m in words:
            w = m[0]
            if not _OTHER.search(w):
                kinds.append("plain")
            elif _LATIN.search(w):
                kinds.append("mixed" if any(c in self.loose for c in w) else "other")
            else:
                kinds.append("other" if _NOT_LATIN.search(self.skeleton(w)) else "alike")
        out, at, open_words = [], 0, []
        for i, m in enumerate(words):
            if kinds[i] == "mixed":
                out += [t[at : m.start()], self.latin(m[0])]
                at = m.end()
            elif kinds[i] == "alike" and "other" not in kinds[max(0, i - 1) : i] + kinds[i + 1 : i + 2]:
                open_words.append(m[0])
        out.append(t[at:])
        return "".join(out), open_words


def prototypes(spark: SparkSession) -> dict[str, str]:
    """Each letter of the scripts other than Latin, Arabic and the ideographic ones, and its prototype: one call of ICU."""
    pool = [c for c in map(chr, range(0x250, 0x20000)) if unicodedata.category(c)[0] == "L" and not regex.match(r"[\p{Latin}\p{Arabic}\p{Han}\p{Hangul}]", c)]
    checker = getattr(spark._jvm.com.ibm.icu.text, "SpoofChecker$Builder")().build()
    return {c: p for c, p in zip(pool, checker.getSkeleton("\n".join(pool)).split("\n"), strict=True) if p != c}


def alike(spark: SparkSession) -> Alike:
    return Alike(prototypes(spark))


_FOLDED = "document_id string, block_id string, text string, unified string, open_words array<string>"


def _folded(rows: DataFrame, letters: Alike, texts: bool) -> DataFrame:
    """document_id, block_id, text, unified, open_words of rows (document_id, text, spans); with `texts` off text and
    unified are null where they are equal (to find deviations, nothing else need be written)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, blocks, _, _, cuts in sliced(batches):
            made, opened, kept = [], [], []
            for t in cuts:
                form, words = (t, []) if t.isascii() and _CONTROL.search(t) is None or _PLAIN.match(t) else letters.fold(t)
                same = not texts and form == t and not words
                kept.append(None if same else t)
                made.append(None if same else form)
                opened.append(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.string()), pa.array(blocks, pa.string()), pa.array(kept, pa.string()), pa.array(made, pa.string()), pa.array(opened, pa.list_(pa.string()))],
                names=["document_id", "block_id", "text", "unified", "open_words"],
            )

    return rows.mapInArrow(run, _FOLDED)


def unify(segments: DataFrame, docs: DataFrame, texts: bool = True) -> DataFrame:
    """document_id, block_id, text, unified: every passage with its consistent form (equal to text where it has it already).

    segments: document_id, block_id, char_start, char_end; docs: document_id, text. Offsets null, negative, reversed or beyond
    the text give no row, nor do empty passages, null texts and null document ids; repeated rows count once. With `texts`
    off, passages that are in the consistent form have null text and unified. Further columns are not read.
    """
    spark = docs.sparkSession
    letters = alike(spark)
    folded = materialise(_folded(with_spans(docs, segments, "document_id", ["block_id"]), letters, texts), "folded")
    asked = folded.filter("size(open_words) > 0").select(F.explode("open_words").alias("word")).distinct()
    asked = materialise(asked.withColumn("skeleton", F.pandas_udf(lambda w: w.map(letters.skeleton), "string")("word")), "alike-words")
    n = asked.count()
    if not n:
        discard(asked)
        return folded.drop("open_words")
    wanted = broadcast_if_small(asked.select(F.lower("skeleton").alias("w")).distinct(), n)
    latin = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{IsLatin}]+"))).alias("w"))
    seen = materialise(latin.join(wanted, "w", "left_semi").distinct(), "latin-twins")
    twins = asked.join(seen, F.lower("skeleton") == seen["w"], "left_semi").select("word", "skeleton")
    hit = folded.filter("size(open_words) > 0").select("document_id", "block_id", "text", F.explode("open_words").alias("word")).join(broadcast_if_small(twins, n), "word")
    per = hit.groupBy("document_id", "block_id", "text").agg(F.map_from_entries(F.collect_set(F.struct("word", "skeleton"))).alias("words"))
    open_rows = folded.filter("size(open_words) > 0").join(per, ["document_id", "block_id", "text"], "left")
    closed = open_rows.withColumn("unified", F.when(F.col("words").isNull(), F.col("unified")).otherwise(F.pandas_udf(_close, "string")("unified", "words")))
    done = folded.filter("size(open_words) = 0").select("document_id", "block_id", "text", "unified")
    return done.unionByName(closed.select("document_id", "block_id", "text", "unified"))


def _close(folded: pd.Series, words: pd.Series) -> pd.Series:
    """folded with each listed word of look-alikes put into Latin letters."""

    def one(t: str, latin: dict) -> str:
        return _WORD.sub(lambda m: unicodedata.normalize("NFC", latin.get(m[0], m[0])), t)

    return pd.Series([one(t, dict(w)) if w is not None and len(w) else t for t, w in zip(folded, words)], dtype=object)


def lookalike_groups(passages: DataFrame) -> DataFrame:
    """skeleton, n_forms, n_words: the groups of words with equal skeletons of which some form isn't plain, over all words.

    passages: text; null texts hold no words, empty groups don't arise, repeated rows count each.
    """
    letters = alike(passages.sparkSession)
    split = F.explode(F.split("text", r"[^\p{L}\p{M}\p{Cf}]+")).alias("word")
    words = passages.filter("text IS NOT NULL").select(split).filter("word != ''").groupBy("word").agg(F.count("*").alias("n"))
    words = materialise(words, "words")
    odd = ~F.col("word").rlike(PLAIN)
    skeleton = F.pandas_udf(lambda w: w.map(letters.skeleton), "string")
    ascii_only = F.col("word").rlike(r"^\p{ASCII}*$")  # such a word is its own skeleton
    named = words.filter(~ascii_only).withColumn("skeleton", skeleton("word")).unionByName(words.filter(ascii_only).withColumn("skeleton", F.col("word")))
    return named.groupBy("skeleton").agg(F.count("*").alias("n_forms"), F.sum("n").alias("n_words"), F.max(odd.cast("int")).alias("_odd")).filter("_odd = 1 AND n_forms > 1").drop("_odd")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    made = unify(load(spark, d, "segments"), load(spark, d, "doc_text"), texts=False)
    return made.filter("text != unified").select("document_id", "block_id").distinct()


def p7_text(spark: SparkSession, d: str) -> DataFrame:
    made = unify(load(spark, d, "segments"), load(spark, d, "doc_text"))
    return made.select("document_id", "block_id", F.col("unified").alias("text")).distinct()


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    return lookalike_groups(unify(load(spark, d, "segments"), load(spark, d, "doc_text")))


QUERIES = {"p7_found": p7_found, "p7_text": p7_text, "p7_groups": p7_groups}
SQL: dict[str, str] = {}
