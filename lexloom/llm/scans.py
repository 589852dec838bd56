"""Noise in text from scanned pages (problem 5): broken words, misread characters, running heads, page numbers.

1. Words of the whole corpus are counted (JVM).
2. Documents stream through workers in reading order. Line classifiers (boosted trees on a line's pattern, place, and likeness
   to the document's own head) name page numbers and running heads; the rest of a scanned paragraph is its own text. They are
   fitted on pages made for it: paragraphs without furniture are broken into lines, and heads and numbers, some of them misread,
   are planted among them; what was planted is the label.
3. A line pair with a mark between is a broken word or a hyphenated one: boosted trees on the corpus counts of both readings.
4. Every distinct word of scanned paragraphs retrieves correction candidates from the counted words by an inverted join
   on character q-grams; boosted trees, fitted on words damaged on purpose, rank them.
Models are fitted on the driver on bounded samples (SAMPLE_DOCS documents, SAMPLE_WORDS words).
"""

from __future__ import annotations

import math
import pickle
import random
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.boost import BoostedTrees
from lexloom.session import broadcast_if_small, materialise
from lexloom.tables import load

SAMPLE_DOCS, SAMPLE_WORDS = 600, 1500
TRUSTED = 5  # times a word must stand in the corpus to serve as a correction
COMMONER = 4  # times a correction must be as frequent as the word it replaces
# What is printed, and what recognition makes of it.
CONFUSED = [("e", "c"), ("c", "e"), ("o", "0"), ("t", "f"), ("a", "@"), ("s", "5"), ("l", "1"), ("i", "!"), ("i", "l"), ("n", "ri"), ("d", "cl"), ("h", "li"), ("u", "ii"),
            ("m", "rn"), ("g", "9"), ("b", "6"), ("w", "vv"), ("y", "v"), ("in", "m"), ("1", "l"), ("0", "o"), ("rn", "m"), ("cl", "d"), ("l", "i"), ("n", "r"), ("z", "2"), ("b", "8")]
_CONFUSED = set(CONFUSED)

NUM = r"([\dlOoI]{1,4}|[ivxlc]{1,6}|[IVXLC]{1,6})"
PAGE_STYLES = [
    rf"{NUM}", rf"[-–—~]\s?{NUM}\s?[-–—~]", rf"\(\s?{NUM}\s?\)", rf"\[\s?{NUM}\s?\]", rf"{NUM}\s?[|/]\s?[\dlOI]+", rf"P ?a ?[gq9] ?[ec] ?[|:]?\s*{NUM}",
    rf"Pa[gq9][ec] {NUM} [o0c]f [\dlOI]+", rf"p(?:[gq9]\.?|\.) ?{NUM}", rf"{NUM} [o0c]f [\dlOI]+", rf"[|*•.]\s?{NUM}\s?[|*•.]", rf"(?:Page|page|PAGE) (?:No\.?|no\.?)? ?{NUM}",
]
_PAGE = [regex.compile(rf"^\W{{0,2}}?{s}\W{{0,2}}?$", regex.I) for s in PAGE_STYLES]
_CASE = r"(?:[\p{L}\d!@][\w.!@]*\.?\s){1,3}N[o0]\.?\s?[\w/.@!-]+\s[o0c]f\s\w{4}"
_CASE_LINE = regex.compile(rf"^{_CASE}\W*$", regex.I)
_VERSUS = regex.compile(r"\s(?:v\.|vs\.?|[vy][ec][rn]{1,2}[s5][uiv!]{1,2}[s5]|w\.)\s", regex.I)
_STATUTE = regex.compile(r"^(?:the\s)?[\w\s()'!@-]{4,80}\s(?:\w{3,12}),\s\w{4}\W*$", regex.I)
_HEAD = regex.compile(rf"({_CASE})\.\s+(.{{3,60}}?\s(?:v\.|vs\.?|versus)\s.{{3,60}}?)\.(?:\s|$)", regex.I)
_HEAD_STATUTE = regex.compile(r"(?:^|\s)((?:The\s)[\w\s()'-]{4,80},\s\w{4})\.(?:\s|$)")
_BREAK = regex.compile(r"([\p{Latin}\p{M}@!01569]+)([-¬­])$")
_LEAD = regex.compile(r"^([\p{Ll}\p{M}][\p{Latin}\p{M}@!01569]*)")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def number_of(token: str) -> set[int]:
    """The values a printed page number can stand for: digits (look-alikes read as digits) or Roman."""
    out, low = set(), token.lower()
    digits = low.translate(str.maketrans("loi", "101"))
    if digits.isdigit():
        out.add(int(digits))
    if low and all(c in _ROMAN for c in low):
        v = [_ROMAN[c] for c in low]
        out.add(sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0])))
    return out


_NO_LETTER, _DIGITS, _STOPPED, _GAP, _WORDY = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\d+"), regex.compile(r"\w+\."), regex.compile(r"\s{2,}|\t|\s[|]\s|\s—\s"), regex.compile(r"[\p{L}\d@!]{4,}")


def letters(s: str) -> str:
    return _NO_LETTER.sub("", s.lower())


def likeness(a: str, b: str) -> float:
    """1 - edit distance / longer length."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    if abs(len(a) - len(b)) > 0.4 * n:
        return 0.0
    return 1 - distance(a, b) / n


def distance(a: str, b: str) -> int:
    """The edit distance, a column of the table at a time in the bits of two numbers."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, d = full, 0, len(a)
    for ch in b:
        same = at.get(ch, 0)
        flat = (((same & up) + up) ^ up) | same | down
        more, less = down | (full & ~(flat | up)), up & flat
        d += bool(more & last) - bool(less & last)
        more = (more << 1 | 1) & full
        up, down = (less << 1 & full) | (full & ~(flat | more)), more & flat
    return d


def order_of(para_id: str | None) -> tuple:
    nums = _DIGITS.findall(para_id or "")
    return tuple(int(x) for x in nums) or (10**9,)


_REJOIN = regex.compile(r"(\p{L})[-¬­]\s(?=\p{Ll})")
_INSIDE = regex.compile(r"[\p{Ll},¬­-]\n\p{Ll}")


def is_scanned(paras: list[tuple[str, int, str]]) -> bool:
    """Whether lines are broken inside sentences: a line ends in a letter, comma or mark and the next begins in lower case."""
    return any("\n" in t and _INSIDE.search(t) for _, _, t in paras)


class Document:
    """The paragraphs of one document in reading order, with the features of its lines."""

    def __init__(self, paras: list[tuple[str, int, str]]):
        self.paras = sorted(paras, key=lambda p: (p[1] if p[1] is not None else 10**9, order_of(p[0]), p[0] or ""))
        self.lines = [(k, i, line, t.count("\n") + 1) for k, (_, _, t) in enumerate(self.paras) for i, line in enumerate(t.split("\n"))]
        flat = " ".join(t.replace("\n", " ") for _, p, t in self.paras if p in (None, 0, 1))
        flat = _REJOIN.sub(r"\1", flat)
        self.case = self.title = ""
        if m := _HEAD.search(flat):
            self.case, self.title = m[1], m[2]
        elif m := _HEAD_STATUTE.search(flat):
            self.title = m[1]
        self.seen: dict[str, set] = {}
        for k, _, line, _ in self.lines:
            if key := letters(line):
                self.seen.setdefault(key, set()).add(self.paras[k][1])

    def scanned(self) -> bool:
        return is_scanned(self.paras)

    def page_features(self, k: int, i: int, text: str, n: int) -> list[float]:
        style, value = -1, 0.0
        page = self.paras[k][1]
        s = text.strip()
        if len(s) <= 26 and not _STOPPED.fullmatch(s):  # a number with a stop opens a paragraph
            for j, r in enumerate(_PAGE):
                if m := r.match(s):
                    style = j
                    value = float(page in set().union(*(number_of(g) for g in m.groups() if g)))
                    if value:
                        break
        return [style, value, float(n == 1), float(i == 0), float(i == n - 1), len(s)]

    def head_features(self, k: int, i: int, text: str, n: int) -> tuple[list[float], str]:
        """The features of a line as a running head, and the part of it that may be a page number."""
        parts = [p for p in _GAP.split(text.strip()) if p]
        number = ""
        page = self.paras[k][1]
        for at in (-1, 0):
            if len(parts) > 1 and any(m and page in set().union(*(number_of(g) for g in m.groups() if g)) for m in (r.match(parts[at]) for r in _PAGE)):
                number = parts.pop(at)
                break
        case = title = statute = 0.0
        like, names = 0.0, 0.0
        rest = " ".join(parts)
        for p in parts:
            c = float(bool(_CASE_LINE.match(p)))
            v = float(bool(_VERSUS.search(p)) and not p.rstrip().endswith((".", ",", ";")))
            case, title, statute = max(case, c), max(title, v), max(statute, float(bool(_STATUTE.match(p)) and not c))
            words = _WORDY.findall(p)
            names = max(names, float(bool(words)) * float(sum(w[:1].isupper() or w[:1].isdigit() for w in words) / max(1, len(words)) > 0.79))
        if case or title or statute or rest.isupper():
            whole = letters(rest)
            for known in (self.case, self.title, self.case + self.title, self.title + self.case):
                like = max(like, likeness(whole, letters(known)))
        pages = len(self.seen.get(letters(text), ()))
        first_own = float(all(self.page_features(k, j, line, n)[1] for j, line in enumerate(self.paras[k][2].split("\n", i)[:i])) if i else True)
        return [case, title, statute, like, float(pages), float((page or 1) > 1), first_own, float(n == 1), float(i == n - 1), names, float(rest.endswith(".")), len(text)], number


_MAYBE_HEAD = regex.compile(r"N[o0]\.?\s?[\w/.@!-]+\s[o0c]f\s|\s(?:v\.|vs\.?|[vy][ec][rn]{1,2}[s5][uiv!]{1,2}[s5]|w\.)\s|,\s\w{4}\W*$", regex.I)


def may_be_number(text: str) -> bool:
    """Whether a line is short enough to be a printed page number (PAGE_STYLES match no longer one)."""
    return 0 < len(text.strip()) <= 26


def may_be_head(text: str) -> bool:
    """Whether a line holds what every pattern of a running head needs, or is in capitals."""
    return bool(text.strip()) and (text.isupper() or _MAYBE_HEAD.search(text) is not None)


NUMBER_FORMS = ["{n}", "- {n} -", "P a g e | {n}", "pg. {n}", "({n})", "[{n}]", "Page {n}", "Page {n} of {m}", "{n} of {m}", "p. {n}", "-{n}-", "{n}/{m}", "Page No. {n}", "| {n} |"]
REST = 6  # own lines in which the rest of a word broken at a line's end is sought


def _bodies(doc: Document) -> list[tuple[str, int, str]]:
    """Paragraphs that hold no furniture: all of a digital document; of a scanned one the inner lines of longer paragraphs, and the
    opening paragraph."""
    if not doc.scanned():
        return doc.paras
    inner = [(p, page, "\n".join(t.split("\n")[3:-2])) for p, page, t in doc.paras if t.count("\n") > 5]
    return doc.paras[:1] + inner


def plant(doc: Document, rng: random.Random) -> tuple[Document, dict[tuple[int, int], str]] | None:
    """A document like a scanned one, made from the paragraphs of `doc`, and what stands on each planted line: (paragraph, line) to
    'number' or 'head'. Pages are dealt anew, so that every document has several."""
    bodies = _bodies(doc)
    words = [w for _, _, t in bodies for w in t.split()]
    if len(words) < 40:
        return None
    lines, at = [], 0
    while at < len(words):
        n = rng.randint(7, 13)
        line = " ".join(words[at : at + n])
        if rng.random() < 0.1 and len(words[min(len(words), at + n) - 1]) > 6:  # a word broken over the line
            line, rest = line[:-3] + rng.choice("-¬"), line[-3:]
            if at + n < len(words):
                words[at + n] = rest + words[at + n]
        lines.append(line)
        at += n
    paras, labels = [], {}
    form, roman, top = rng.choice(NUMBER_FORMS), rng.random() < 0.1, rng.random() < 0.5
    both = [f"{doc.case}    {doc.title}", f"{doc.case} — {doc.title}"] if doc.case and doc.title else []
    heads = [h for h in (doc.case, doc.title, *both, doc.title.upper(), doc.case.upper()) if h]
    head, with_number = (rng.choice(heads) if heads else ""), rng.random() < 0.3
    page, per = 1, max(3, len(lines) // rng.randint(2, 5))
    for start in range(0, len(lines), per):
        body = lines[start : start + per]
        number = form.format(n=("i ii iii iv v vi vii viii ix x".split() + [str(page)] * 99)[page - 1] if roman else page, m=-(-len(lines) // per))
        number = "".join({"1": "l", "0": "O"}.get(c, c) if rng.random() < 0.15 else c for c in number)
        said = head
        if said and rng.random() < 0.4:
            w = rng.choice(said.split())
            said = said.replace(w, damage(w, rng) or w, 1)
        above: list[tuple[str, str]] = []
        if said and page > 1 and rng.random() < 0.85:
            above.append((rng.choice(("{a}    {b}", "{a}    {b}", "{b}    {a}", "{a} | {b}", "{a} — {b}")).format(a=said, b=number) if with_number else said, "head"))
        if top and not (with_number and above) and rng.random() < 0.85:
            above.insert(rng.randint(0, len(above)), (number, "number"))
        alone = rng.random() < 0.5
        for text, kind in above if alone else []:
            labels[len(paras), 0] = kind
            paras.append((f"p{page}_b{len(paras)}", page, text))
        below = [] if top or rng.random() < 0.15 else [(number, "number")]
        cut = rng.randint(1, len(body))
        first = ([] if alone else [t for t, _ in above]) + body[:cut]
        for i, (_, kind) in enumerate([] if alone else above):
            labels[len(paras), i] = kind
        paras.append((f"p{page}_b{len(paras)}", page, "\n".join(first)))
        if rng.random() < 0.2:  # a number that is no page's
            paras.append((f"p{page}_b{len(paras)}", page, rng.choice(("{n}", "- {n} -", "({n})", "[{n}]")).format(n=page + rng.randint(1, 60), m=9)))
        rest = body[cut:] + [t for t, _ in below if rng.random() < 0.5]
        if below and rest[-1:] == [below[0][0]]:
            labels[len(paras), len(rest) - 1] = "number"
            below = []
        if rest:
            paras.append((f"p{page}_b{len(paras)}", page, "\n".join(rest)))
        for text, kind in below:
            labels[len(paras), 0] = kind
            paras.append((f"p{page}_b{len(paras)}", page, text))
        page += 1
    made = Document(paras)
    # of some documents the opening could not be read: their heads are known by pattern and place alone
    made.case, made.title = ("", "") if rng.random() < 0.2 else (doc.case, doc.title)
    return made, labels


def fit_lines(docs: list[Document], seed: int = 9) -> tuple[BoostedTrees, BoostedTrees]:
    """(page numbers, running heads), fitted on planted documents; digital ones serve as bodies while there are some thirty."""
    rng = random.Random(seed)
    digital = [d for d in docs if not d.scanned()]
    px, py, hx, hy = [], [], [], []
    for doc in digital if len(digital) >= 30 else docs:
        for made, labels in filter(None, (plant(doc, rng) for _ in range(2))):
            for line in made.lines:
                kind = labels.get((line[0], line[1]))
                if may_be_number(line[2]):
                    f = made.page_features(*line)
                    if f[0] >= 0:
                        px.append(f)
                        py.append(float(kind == "number"))
                if may_be_head(line[2]):
                    hx.append(made.head_features(*line)[0])
                    hy.append(float(kind == "head"))
    return (BoostedTrees().fit(np.array(px).reshape(len(px), 6), np.array(py)), BoostedTrees().fit(np.array(hx).reshape(len(hx), 12), np.array(hy)))


class LineReader:
    """Applies the line models to a document."""

    def __init__(self, page: BoostedTrees, head: BoostedTrees):
        self.page, self.head = page, head

    def read_all(self, docs: list[Document]) -> list[list[tuple[str, str, bool, bool, list[tuple[str, str, str]]]]]:
        """`read` of several documents, whose lines are judged together."""
        numbers = [[x for x in d.lines if may_be_number(x[2])] for d in docs]
        heads = [[x for x in d.lines if may_be_head(x[2])] for d in docs]
        pf = [d.page_features(*x) for d, xs in zip(docs, numbers) for x in xs]
        hf = [d.head_features(*x) for d, xs in zip(docs, heads) for x in xs]
        is_number = iter(zip(pf, self.page.probability(pf)))
        is_head = iter(zip(hf, self.head.probability([h for h, _ in hf])))
        return [self.read(d, [(x, *next(is_number)) for x in ns], [(x, *next(is_head)) for x in hs]) for d, ns, hs in zip(docs, numbers, heads)]

    def read(self, doc: Document, numbers: list, heads: list) -> list[tuple[str, str, bool, bool, list[tuple[str, str, str]]]]:
        """Of a scanned document, for each paragraph: para_id, own text, has a page number, has a running head, its breaks.

        numbers, heads: its lines that may be such, with features and probability. Own text has its furniture taken out and lines
        joined: a break inside a word is kept as U+0001 and mark, to be closed once it is decided; U+0002 stands before the mark of
        a word that goes on elsewhere, U+0003 before its rest. Breaks: left part, mark, right part ('' where the text ends)."""
        n = len(doc.paras)
        number, head, gone = [False] * n, [False] * n, set()
        for x, (_, num), q in heads:
            if q > 0.5:
                head[x[0]] = True
                number[x[0]] |= bool(num)
                gone.add((x[0], x[1]))
        for x, f, q in numbers:
            if q > 0.5 and f[0] >= 0 and (x[0], x[1]) not in gone:
                number[x[0]] = True
                gone.add((x[0], x[1]))
        own = [[line for i, line in enumerate(t.split("\n")) if (k, i) not in gone] for k, (_, _, t) in enumerate(doc.paras)]
        order = [(k, i) for k in range(n) for i in range(len(own[k]))]
        out, breaks = [], [[] for _ in range(n)]
        ahead: dict[tuple[int, int], str] = {}
        tails: set[tuple[int, int]] = set()
        for at, (k, i) in enumerate(order):
            if m := _BREAK.search(own[k][i].rstrip()):
                right = ""
                for kk, ii in order[at + 1 : at + 1 + REST]:
                    if r := _LEAD.match(own[kk][ii]):
                        right = r[1]
                        ahead[k, i] = "same" if kk == k and ii == i + 1 else "later"
                        if ahead[k, i] == "later":
                            tails.add((kk, ii))
                        break
                breaks[k].append((m[1], m[2], right))
        for k, (pid, _, _) in enumerate(doc.paras):
            text = ""
            for i, line in enumerate(own[k]):
                line = line.rstrip()
                if (k, i) in tails:  # the rest of a word that began in an earlier paragraph
                    line = "\x03" + line
                if ahead.get((k, i)) == "same":
                    text += line[:-1] + "\x01" + line[-1]
                elif (k, i) in ahead or (i + 1 == len(own[k]) and _BREAK.search(line)):
                    text += line[:-1] + "\x02" + line[-1] + (" " if i + 1 < len(own[k]) else "")
                else:
                    text += line + (" " if i + 1 < len(own[k]) else "")
            out.append((pid, text, number[k], head[k], breaks[k]))
        return out


LOT = 64  # documents whose lines are judged together
OWN = "document_id string, para_id string, own string, page_number boolean, running_head boolean, breaks array<struct<l:string,mark:string,r:string>>"


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Document]]:
    """The scanned documents of rows sorted by document_id; a document may run over batches."""
    key, held = None, []
    for b in batches:
        for d, p, page, t in zip(*(c.to_pylist() for c in b.columns)):
            if d != key:
                if held and is_scanned(held):
                    yield key, Document(held)
                key, held = d, []
            held.append((p, page, t))
    if held and is_scanned(held):
        yield key, Document(held)


def clean_rows(paras: DataFrame) -> DataFrame:
    return paras.select("document_id", "para_id", "page", "text").filter("document_id IS NOT NULL AND text IS NOT NULL").distinct()


def read_paragraphs(paras: DataFrame, models: tuple[BoostedTrees, BoostedTrees]) -> DataFrame:
    """The paragraphs of scanned documents as LineReader.read gives them (columns OWN)."""
    packed = pickle.dumps(models)
    schema = pa.schema([("document_id", pa.string()), ("para_id", pa.string()), ("own", pa.string()), ("page_number", pa.bool_()), ("running_head", pa.bool_()),
                        ("breaks", pa.list_(pa.struct([("l", pa.string()), ("mark", pa.string()), ("r", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, docs = LineReader(*pickle.loads(packed)), _documents(batches)
        while lot := list(islice(docs, LOT)):
            rows = []
            for (key, _), read in zip(lot, reader.read_all([d for _, d in lot])):
                for pid, own, number, head, breaks in read:
                    rows.append({"document_id": key, "para_id": pid, "own": own, "page_number": number, "running_head": head, "breaks": [{"l": a, "mark": m, "r": b} for a, m, b in breaks]})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return paras.repartition("document_id").sortWithinPartitions("document_id").mapInArrow(run, OWN)


def fit_reader(paras: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[BoostedTrees, BoostedTrees]:
    ids = paras.select("document_id").distinct().orderBy(F.xxhash64("document_id"), "document_id").limit(sample_docs)
    docs: dict[str, list] = {}
    for r in paras.join(F.broadcast(ids), "document_id").collect():  # a bounded number of documents
        docs.setdefault(r.document_id, []).append((r.para_id, r.page, r.text))
    return fit_lines([Document(docs[k]) for k in sorted(docs)])


TOKEN_SPLIT = r"[^\p{L}\p{M}0-9!@'-]+"


def _bare(w):
    return F.btrim(w, F.lit("-'!"))


def word_counts(paras: DataFrame) -> DataFrame:
    """word (lower case), n: over all text, without the words at line breaks that a mark cuts."""
    cut = F.col("text").contains("-\n") | F.col("text").contains("¬\n") | F.col("text").contains("­\n")
    text = F.when(cut, F.regexp_replace("text", r"\S+[-¬­]\n\S+", " ")).otherwise(F.col("text"))
    words = paras.select(F.explode(F.split(F.lower(text), TOKEN_SPLIT)).alias("w")).select(_bare(F.col("w")).alias("word"))
    return words.filter("word != ''").groupBy("word").agg(F.count("*").alias("n"))


def break_features(rows: pd.DataFrame) -> np.ndarray:
    lg = lambda c: np.log1p(rows[c].fillna(0).to_numpy(float))
    return np.stack([lg("n_join"), lg("n_hyph"), lg("n_l"), lg("n_r"), lg("n_join") - lg("n_hyph"), rows["mark"].isin(["¬", "­"]).to_numpy(float),
                     rows["l"].str.len().to_numpy(float), rows["r"].str.len().to_numpy(float)], axis=1)


def fit_breaks(known: dict[str, int], bound: int = SAMPLE_WORDS, seed: int = 3) -> BoostedTrees:
    """Fitted on counted words: plain words cut at random places are broken words, hyphenated ones cut at their hyphen aren't."""
    rng = random.Random(seed)
    plain = sorted(w for w in known if w.isalpha() and len(w) >= 5)
    hyph = sorted(w for w in known if w.count("-") == 1 and all(p.isalpha() for p in w.split("-")))
    rows, y = [], []
    for w in rng.sample(plain, min(bound, len(plain))):
        at = rng.randint(2, len(w) - 2)
        a, b, unseen = w[:at], w[at:], rng.random() < 0.15  # some words stand nowhere else
        rows.append((a, rng.choice("--¬"), b, 0 if unseen else known[w], known.get(f"{a}-{b}", 0), known.get(a, 0), known.get(b, 0)))
        y.append(1)
    for w in hyph[:bound] * max(1, min(20, len(plain) // max(1, 2 * len(hyph)))):
        a, b = w.split("-")
        rows.append((a, "-", b, known.get(a + b, 0), known[w], known.get(a, 0), known.get(b, 0)))
        y.append(0)
    frame = pd.DataFrame(rows, columns=["l", "mark", "r", "n_join", "n_hyph", "n_l", "n_r"])
    return BoostedTrees().fit(break_features(frame), np.array(y)) if len(frame) else BoostedTrees()


def decide_breaks(breaks: DataFrame, counts: DataFrame, model: BoostedTrees) -> DataFrame:
    """l, mark, r, broken for each distinct break. A mark with nothing behind it, or a mark no word is written with, is a broken word."""
    d = breaks.select("l", "mark", "r").distinct()
    low = d.select("*", F.lower(F.concat("l", "r")).alias("wj"), F.lower(F.concat_ws("-", "l", "r")).alias("wh"), F.lower("l").alias("wl"), F.lower("r").alias("wr"))
    for col, name in (("wj", "n_join"), ("wh", "n_hyph"), ("wl", "n_l"), ("wr", "n_r")):
        low = low.join(counts.select(F.col("word").alias(col), F.col("n").alias(name)), col, "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                p = model.probability(break_features(b)) > 0.5
                yield b[["l", "mark", "r"]].assign(broken=p | (b["mark"] != "-").to_numpy() | (b["r"] == "").to_numpy())

    return low.select("l", "mark", "r", "n_join", "n_hyph", "n_l", "n_r").mapInPandas(run, "l string, mark string, r string, broken boolean")


def difference(word: str, other: str) -> tuple[str, str]:
    """What of `other` (as printed) stands as what in `word` (as read), after their common start and end."""
    i, n = 0, min(len(word), len(other))
    while i < n and word[i] == other[i]:
        i += 1
    j = 0
    while j < n - i and word[-1 - j] == other[-1 - j]:
        j += 1
    a, b = other[i : len(other) - j], word[i : len(word) - j]
    if not a or not b:  # one letter more or less: take a neighbour along, so that it can be a known confusion
        if i > 0 and (word[i - 1] + a, word[i - 1] + b) in _CONFUSED:
            return word[i - 1] + a, word[i - 1] + b
        if j > 0 and (a + word[-j], b + word[-j]) in _CONFUSED:
            return a + word[-j], b + word[-j]
    return a, b


_SYMBOL = regex.compile(r"[0-9!@]")


def pair_features(words: list[str], n: list[float], others: list[str], m: list[float]) -> np.ndarray:
    rows = []
    for w, a, c, b in zip(words, n, others, m):
        x, y = difference(w, c)
        # two damages of known kinds, far apart, are judged by the symbols alone
        known = float((x, y) in _CONFUSED)
        sym = float(bool(_SYMBOL.search(w)) and bool(regex.search(r"\p{L}", w)))
        rows.append([known, sym, len(x), len(y), math.log1p(b), math.log1p(a), math.log1p(b) - math.log1p(a), len(w)])
    return np.array(rows, float).reshape(len(rows), 8)


def damage(word: str, rng: random.Random) -> str | None:
    spots = [(i, a, b) for a, b in CONFUSED[:21] for i in range(len(word)) if word.startswith(a, i)]
    if not spots:
        return None
    i, a, b = rng.choice(spots)
    return word[:i] + b + word[i + len(a) :]


def fit_ranker(known: dict[str, int], bound: int = SAMPLE_WORDS, seed: int = 5) -> BoostedTrees:
    """Fitted on counted words damaged on purpose against sound words with their nearest neighbours."""
    rng = random.Random(seed)
    words = sorted(w for w in known if w.isalpha() and len(w) >= 3)
    trusted = [w for w in words if known[w] >= TRUSTED]
    near: dict[tuple[str, str], list[str]] = {}
    for w in trusted:
        for i in range(len(w)):
            near.setdefault((w[:i], w[i + 1 :]), []).append(w)
    pairs, y = [], []
    for w in rng.sample(trusted, min(bound, len(trusted))):
        if (t := damage(w, rng)) and t not in known:
            pairs.append((t, 1 if rng.random() < 0.7 else max(1, known[w] // 500), w, known[w]))
            y.append(1)
    for w in rng.sample(words, min(bound, len(words))):
        others = {c for i in range(len(w)) for c in near.get((w[:i], w[i + 1 :]), ()) if c != w}
        for c in sorted(others)[:6]:
            # a rare word one known confusion from a frequent one may itself be a misreading: no label
            if known[c] < COMMONER * known[w] or (difference(w, c) in _CONFUSED and known[c] >= 20 * known[w]):
                continue
            pairs.append((w, known[w], c, known[c]))
            y.append(0)
    if not pairs:
        return BoostedTrees()
    a, b, c, d = map(list, zip(*pairs))
    return BoostedTrees(rounds=40).fit(pair_features(a, b, c, d), np.array(y))


GRAM, EDITS = 3, 2
RAREST = GRAM * EDITS + 1  # an edit spoils GRAM q-grams at most, so of so many one is left


def _grams(word):
    """The distinct character q-grams of a padded word."""
    padded = F.concat(F.lit("^"), word, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - GRAM + 1)), lambda i: padded.substr(i, F.lit(GRAM))))


def _undone(word):
    """The words that one known confusion, at any place, turns into `word`."""
    at = F.sequence(F.lit(1), F.length(word))
    back = lambda a, b: F.transform(F.filter(at, lambda i: word.substr(i, F.lit(len(b))) == b), lambda i: F.concat(word.substr(F.lit(1), i - 1), F.lit(a), word.substr(i + len(b), F.length(word))))
    return F.array_distinct(F.flatten(F.array(*[back(a, b) for a, b in CONFUSED])))


def candidates(words: DataFrame, counts: DataFrame) -> DataFrame:
    """word, n, other, m: counted words, COMMONER times as frequent, that `word` may be a misreading of.

    Every word meets every counted word that shares any q-gram with it, within EDITS edits and one character of length: the inverted
    join looks up its RAREST rarest q-grams (all of a shorter word), of which such words share one. It also meets what one undone
    confusion gives, at any place, and, if it holds a sign and is no number, what two give.
    """
    vocabulary = counts.filter((F.col("n") >= TRUSTED) & F.col("word").rlike(r"^[a-z]+(?:[-'][a-z]+)*$") & (F.length("word") >= 3)).select(F.col("word").alias("other"), F.col("n").alias("m"))
    posting = materialise(vocabulary.select(F.explode(_grams(F.col("other"))).alias("g"), "other", "m"), "postings")
    signed = words.select("word", "n").filter(F.col("word").rlike("[0-9!@]") & F.col("word").rlike(r"\p{L}"))
    once = words.select("word", "n", F.explode(_undone(F.col("word"))).alias("other"))
    # a number with letters in it is read as one, not as a word damaged twice
    twice = signed.filter(~F.col("word").rlike(r"^[\dlo]+$")).select("word", "n", F.explode(F.array_distinct(F.flatten(F.transform(_undone(F.col("word")), _undone)))).alias("other"))
    met = once.unionByName(twice).join(vocabulary, "other").select("word", "n", "other", "m")
    often = F.broadcast(posting.groupBy("g").agg(F.count("*").alias("df")))  # as many rows as there are q-grams of letters
    grams = words.select("word", "n", F.explode(_grams(F.col("word"))).alias("g")).join(often, "g", "left")
    rarest = Window.partitionBy("word").orderBy(F.coalesce("df", F.lit(0)), "g")
    rare = grams.withColumn("_k", F.row_number().over(rarest)).filter(F.col("_k") <= RAREST).filter("df IS NOT NULL")
    near = rare.join(posting, "g").select("word", "n", "other", "m")
    apart = (F.col("word") != F.col("other")) & (F.abs(F.length("word") - F.length("other")) <= 1) & (F.col("m") >= COMMONER * F.col("n"))
    return met.unionByName(near).filter(apart).filter(F.levenshtein("word", "other", EDITS) >= 0).distinct()


def misread_words(words: DataFrame, counts: DataFrame, ranker: BoostedTrees) -> DataFrame:
    """word, correction: the misread ones of `words` (word, n). Numbers with letters in them, words with signs in them and words
    two frequent words make together count as misread; where no candidate is likely, the correction is null."""
    low = words.select("word", "n")
    numeral = low.filter(F.col("word").rlike(r"^(?=.*\d)(?=.*[lo])[\dlo]+$") | F.col("word").rlike(r"^[lo]$"))
    numeral = numeral.select("word", F.translate("word", "lo", "10").alias("correction"))
    wordlike = low.filter((F.length("word") >= 3) & F.col("word").rlike("[a-z]{2}|[a-z].?[a-z]") & ~F.col("word").rlike(r"\d.*[a-z].*\d.*\d|\d\d\d"))
    met = candidates(wordlike, counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = pair_features(b["word"].tolist(), b["n"].tolist(), b["other"].tolist(), b["m"].tolist())
                p = ranker.probability(x)
                yield b[["word", "other"]].assign(p=p)[p > 0.5]

    ranked = met.mapInPandas(run, "word string, other string, p double").groupBy("word").agg(F.max_by("other", F.struct("p", "other")).alias("correction"))
    # signs inside letters: misread even where nothing near is known (names)
    signed = wordlike.filter(F.col("word").rlike(r"^@[a-z]{2,}$|^[a-z'-]+[0159!@]+[a-z'-]*$|^[0159!@]+[a-z]{2,}[a-z'-]*$|^[a-z'-]+[0159!@][a-z'-]+[0159!@][a-z'-]*$") & ~F.col("word").rlike(r"^\d+(st|nd|rd|th)$|-\d+$|^[a-z]{1,2}-?\d+$"))
    frequent = counts.filter((F.col("n") >= 30) & F.col("word").rlike("^[a-z]{2,}$"))
    total = F.length("word")
    cuts = low.filter(F.col("word").rlike("^[a-z]{5,}$")).select("word", "n", F.explode(F.sequence(F.lit(2), total - 2)).alias("i"))
    cuts = cuts.select("word", "n", F.expr("substring(word, 1, i)").alias("a"), F.expr("substring(word, i + 1)").alias("b"))
    a, b = frequent.select(F.col("word").alias("a"), F.col("n").alias("na")), frequent.select(F.col("word").alias("b"), F.col("n").alias("nb"))
    glued = cuts.join(a, "a").join(b, "b").filter(F.least("na", "nb") >= 30 * F.col("n")).groupBy("word").agg(F.max_by(F.concat_ws(" ", "a", "b"), F.struct(F.least("na", "nb"), "a")).alias("correction"))
    rest = signed.select("word", F.lit(None).cast("string").alias("correction"))
    every = numeral.unionByName(ranked).unionByName(glued).unionByName(rest)
    return every.groupBy("word").agg(F.max("correction").alias("correction"))


SPACED = r"(?<![^\s(“\"'])(?:[A-Za-z01!@5] ){2,}[A-Za-z01!@5](?![^\s.,;:)”\"'])"


class ScanRepair:
    """The fitted and decided parts over one table of paragraphs."""

    def __init__(self, paras: DataFrame):
        rows = materialise(clean_rows(paras), "paras")
        self.counts = materialise(word_counts(rows), "word-counts")
        read = read_paragraphs(rows, fit_reader(rows))
        # without codes and seals (signs inside), and without parts of words that lie in two paragraphs
        own = F.regexp_replace("own", "\\S*[=|+]\\S*|[\\p{L}\\p{M}]+\u0002.|\u0003[\\p{L}\\p{M}]+", " ")
        own = F.regexp_replace(own, "\u0001.", "")
        words = F.array_distinct(F.transform(F.split(F.regexp_replace(F.lower(own), SPACED, " "), TOKEN_SPLIT), _bare))
        self.read = materialise(read.withColumn("words", F.filter(words, lambda w: w != "")), "own-text")
        # a bounded sample of the counted words, the same at every run
        pool = self.counts.filter((F.col("n") >= 3) & F.col("word").rlike("^[a-z]+(-[a-z]+)?$")).orderBy(F.xxhash64("word")).limit(6 * SAMPLE_WORDS)
        frequent = self.counts.filter(F.col("word").rlike("^[a-z]+(-[a-z]+)?$")).orderBy(F.desc("n"), "word").limit(2 * SAMPLE_WORDS)
        known = {r.word: r.n for r in pool.unionByName(frequent).distinct().collect()}
        brk = self.read.select("document_id", "para_id", F.explode("breaks").alias("b")).select("document_id", "para_id", "b.*")
        self.decided = materialise(decide_breaks(brk, self.counts, fit_breaks(known)), "breaks")
        self.breaks = brk.join(self.decided, ["l", "mark", "r"])
        self.tokens = self.read.select("document_id", "para_id", F.explode("words").alias("word"))
        # a word written over a break may be a hyphenated one
        joined = self.decided.filter("NOT broken").select(F.lower(F.concat("l", "r")).alias("word")).distinct()
        distinct = self.tokens.select("word").distinct().join(joined, "word", "left_anti")
        spelt = materialise(distinct.join(self.counts, "word", "left").select("word", F.coalesce("n", F.lit(1)).alias("n")), "spelt")
        self.misread = materialise(misread_words(spelt, self.counts, fit_ranker(known)), "misread")

    def found(self) -> DataFrame:
        key = ["document_id", "para_id"]
        n = self.misread.count()
        wrong = self.tokens.join(broadcast_if_small(self.misread.select("word"), n), "word", "left_semi").select(*key)
        spaced = self.read.filter(F.col("own").rlike(SPACED)).select(*key)
        parts = [
            self.breaks.filter("broken").select(*key, F.lit("split_word").alias("defect")),
            wrong.unionByName(spaced).withColumn("defect", F.lit("misread")),
            self.read.filter("running_head").select(*key, F.lit("running_head").alias("defect")),
            self.read.filter("page_number").select(*key, F.lit("page_number").alias("defect")),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.distinct()


def find_defects(paras: DataFrame) -> DataFrame:
    """document_id, para_id, defect: one row per paragraph of a scanned document and defect it holds.

    Null texts and ids give nothing, repeated rows count once, an empty table gives an empty table; a document whose lines
    never break inside a sentence isn't scanned and gives nothing. Further columns are not read.
    """
    return ScanRepair(paras).found()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return find_defects(load(spark, d, "paras"))


def _repair(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in rows:
        out = []
        for own, kept, fixes in zip(b["own"], b["kept"], b["fixes"]):
            kept = {k for k in kept} if kept is not None else set()
            fix = {f["word"]: f["correction"] for f in fixes} if fixes is not None else {}
            text = regex.sub(r"([\p{L}\p{M}@!0-9]*)\x01(.)([\p{L}\p{M}@!0-9]*)", lambda m: m[1] + (m[2] if f"{m[1]}-{m[3]}" in kept else "") + m[3], own)
            text = regex.sub(SPACED, lambda m: m[0].replace(" ", ""), text.replace("\x02", "").replace("\x03", ""))

            def put(m, fix=fix):
                c = fix.get(m[0].lower().strip("-'!"))
                if c is None:
                    return m[0]
                if any(x.isdigit() for x in c):
                    return c
                return c.upper() if m[0].isupper() and len(m[0]) > 1 else c[:1].upper() + c[1:] if m[0][:1].isupper() else c

            out.append(regex.sub(r"[\p{L}\p{M}0-9!@'-]+", put, text) if fix else text)
        yield b[["document_id", "para_id"]].assign(text=pd.Series(out, index=b.index, dtype=object))


def repaired_paragraphs(paras: DataFrame) -> DataFrame:
    """document_id, para_id, text: the paragraphs of scanned documents as continuous text, without furniture.

    Broken words are closed, misread words replaced by their best candidate where there is one; a paragraph of furniture only
    comes out as ''. The part of a word that goes on in another paragraph keeps its mark. Other documents give no row.
    """
    r = ScanRepair(paras)
    key = ["document_id", "para_id"]
    kept = r.breaks.filter("NOT broken").groupBy(*key).agg(F.collect_set(F.concat_ws("-", "l", "r")).alias("kept"))
    fixes = r.tokens.join(r.misread.filter("correction IS NOT NULL"), "word").groupBy(*key).agg(F.collect_set(F.struct("word", "correction")).alias("fixes"))
    rows = r.read.select(*key, "own").join(kept, key, "left").join(fixes, key, "left")
    return rows.mapInPandas(_repair, "document_id string, para_id string, text string")


def p5_text(spark: SparkSession, d: str) -> DataFrame:
    return repaired_paragraphs(load(spark, d, "paras"))


QUERIES = {"p5_found": p5_found, "p5_text": p5_text}
SQL: dict[str, str] = {}
