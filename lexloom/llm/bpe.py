"""Byte-level BPE by speculation and verification.

A word's true tokens are the only token sequence in which every adjacent pair is compatible: merging the two tokens' bytes
by the rules gives exactly these two tokens. So the longest-match split of a word is proposed, all adjacent pairs of all
proposed words are tested at once on arrays, and only words with an incompatible pair are merged exactly.

Pair test. A token is built by merges; its rightmost part x at some time borders the leftmost part y of the next token, until
a merge of rank r(x) or r(y) swallows one of them. The merge (x, y) would have happened first, breaking the boundary, if its
rank is below r(x), or not above r(y) (equal ranks are merged from the left). The parts are unwound latest merge first, for
all pairs together.
"""

from __future__ import annotations

import heapq
import json
import os

import numpy as np
import regex

TOKENIZER_DIR = "/opt/tokenizers"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FOREVER = 1 << 40


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes in the JSON vocabulary: printable Latin-1 stands for itself, the rest is moved to 256 and up."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(moved)}


def read_file(directory: str, name: str) -> bytes:
    with open(os.path.join(directory, name), "rb") as f:
        return f.read()


class ByteBPE:
    """A vocabulary of token bytes, its merges, and the cache of words already encoded."""

    def __init__(self, directory: str = TOKENIZER_DIR, name: str = "byte_bpe_50k.json", cache_words: int = 200_000, content: bytes | None = None):
        """content: the vocabulary file's bytes, where it isn't to be read from the directory."""
        model = json.loads(content if content is not None else read_file(directory, name))["model"]
        alphabet = _byte_alphabet()
        as_bytes = lambda s: bytes(alphabet[c] for c in s)
        vocab = {s: i for s, i in model["vocab"].items() if all(c in alphabet for c in s)}
        self.ids: dict[bytes, int] = {as_bytes(s): i for s, i in vocab.items()}
        self.longest = max(map(len, self.ids))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        n = max(self.ids.values()) + 1
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.rank = np.full(n, -1, np.int64)  # -1: a single byte
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        keys, ranks = [], []
        for r, (a, b) in enumerate(merges):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            self.left[t], self.right[t], self.rank[t] = x, y, r
            self.pair[x, y] = (r, t)
            keys.append(x * n + y)
            ranks.append(r)
        order = np.argsort(keys)
        self.n, self.keys, self.ranks = n, np.asarray(keys, np.int64)[order], np.asarray(ranks, np.int64)[order]
        self.words: dict[str, list[int]] = {}
        self.cache_words = cache_words
        self.split = regex.compile(PATTERN).findall
        self.firsts = self._prefix_lengths()

    def _prefix_lengths(self) -> dict[bytes, list[int]]:
        """The lengths of tokens by their first two bytes, longest first."""
        found: dict[bytes, set[int]] = {}
        for t in self.ids:
            if len(t) > 1:
                found.setdefault(t[:2], set()).add(len(t))
        return {k: sorted(v, reverse=True) for k, v in found.items()}

    def propose(self, word: bytes) -> list[int]:
        """Longest match from the left."""
        ids, firsts, out, i, n = self.ids, self.firsts, [], 0, len(word)
        while i < n:
            for size in firsts.get(word[i : i + 2], ()):
                if i + size <= n and (t := ids.get(word[i : i + size])) is not None:
                    break
            else:
                size, t = 1, ids[word[i : i + 1]]
            out.append(t)
            i += size
        return out

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For arrays of adjacent tokens: True where the rules leave the boundary between them."""
        x, y = x.copy(), y.copy()
        rx = np.full(len(x), FOREVER)  # rank of the merge that swallows x, y
        ry = rx.copy()
        good, live = np.ones(len(x), bool), np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            key = a * self.n + b
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], FOREVER)
            broken = (rank < rx[live]) & (rank <= ry[live]) & (rank < FOREVER)
            good[live[broken]] = False
            made_a, made_b = self.rank[a], self.rank[b]
            go = ~broken & ((made_a >= 0) | (made_b >= 0))
            live, made_a, made_b = live[go], made_a[go], made_b[go]
            # undo the later merge; of equal ranks the one further right happened later
            undo_a = made_a > made_b
            ia, ib = live[undo_a], live[~undo_a]
            rx[ia] = made_a[undo_a]
            x[ia] = self.right[x[ia]]
            ry[ib] = made_b[~undo_a]
            y[ib] = self.left[y[ib]]
        return good

    def merge_exactly(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost of equal ranks first, over a linked list and a heap."""
        ids = [self.ids[word[i : i + 1]] for i in range(len(word))]
        n = len(ids)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := self.pair.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, t = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], nxt[i] = t, False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if m := self.pair.get((t, ids[nxt[i]])):
                    heapq.heappush(heap, (m[0], i, t, ids[nxt[i]], m[1]))
            if prv[i] >= 0 and (m := self.pair.get((ids[prv[i]], t))):
                heapq.heappush(heap, (m[0], prv[i], ids[prv[i]], t, m[1]))
        return [t for t, ok in zip(ids, alive) if ok]

    def learn(self, words: set[str]) -> None:
        """Encode new words into the cache: propose, verify all adjacent pairs at once, merge only what fails."""
        words = list(words)
        raw = [w.encode("utf-8", "replace") for w in words]
        proposed = [self.propose(b) for b in raw]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = owner[1:] == owner[:-1]
        pairs, back = np.unique(flat[:-1][inner] * self.n + flat[1:][inner], return_inverse=True)
        good = self.compatible(pairs // self.n, pairs % self.n)
        failed = set(owner[1:][inner][~good[back]].tolist()) if len(pairs) else set()
        for i, w in enumerate(words):
            self.words[w] = self.merge_exactly(raw[i]) if i in failed else proposed[i]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text; null and empty texts give an empty list. The cache only saves time."""
        if len(self.words) > self.cache_words:
            self.words.clear()
        out = []
        for text in texts:
            parts = self.split(text) if text else []
            if new := set(parts).difference(self.words):
                self.learn(new)
            known = self.words
            ids: list[int] = []
            for p in parts:
                ids += known[p]
            out.append(ids)
            if len(self.words) > 2 * self.cache_words:
                self.words.clear()
        return out
