"""BPE encoding and decoding by a tokenization automaton.

The automaton accepts exactly the token sequences that BPE produces. It starts with one state and a loop for every
base symbol. Merges are then applied in order, each by a gadget: merging a, b into ab
  - gives every state that has an arc a, whose end has an arc b, an arc ab;
  - makes the state after ab a copy of the state after b as it is then;
  - takes the arc b away from the state after a (for a = b, the arc aa, too: the leftmost pair merges first).
A state is therefore known by the token it is reached with, and its arcs by the gadgets of the two tokens. They are
kept in that form (two parts and a step for every token) and expanded into the transition table on first use, as
the full table has a cell for each two tokens. An encoder follows the automaton over a pre-split word: it takes the
longest arc that leaves the state, and where a path ends early, the next shorter one. Each position has one path.
Decoding emits the arc labels.

The vocabulary file is a parameter; its contents go to the executors as a broadcast (its size is fixed by the
vocabulary). Words that a worker has seen are kept, up to ``KEPT_WORDS``.

Edge cases: a null text is encoded as the empty text, which has no tokens. Long texts and words are taken whole; the
time is in proportion to the text. Special strings in a text become their special token, as in the library. Rows
are judged one by one; extra columns play no part. Characters of later Unicode versions than the library's are split
as the library splits them; a few of them that have a lower case or a combining class may still be normalised differently.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare_texts

KEPT_WORDS = 250_000
ARC_BITS = 19
#: Longer words (in bytes) are encoded one by one.
LONG_WORD = 512
#: Added to the symbol that ends a word, where the vocabulary marks word ends; a symbol that no token has.
LAST, NO_SYMBOL = 256, 512
#: White space as the tokenizer's patterns understand it (Unicode's White_Space).
WS = r"\t-\r \x85\xa0  -     　"

#: Letters and numbers that Unicode 16 added; the library knows them, unicodedata doesn't.
UNICODE_16 = regex.compile(
    "[\u1c89\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65\U00010d6f-\U00010d85\U00010ec2-\U00010ec4"
    "\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3\U00011bc0-\U00011be0"
    "\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff\U0001e5d0-\U0001e5ed\U0001e5f0\U0001e5f1-\U0001e5fa"
    "\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139\U00016d70-\U00016d79\U0001ccf0-\U0001ccf9]")


def byte_symbols() -> list[str]:
    """The printable symbol that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@functools.cache
def _newer() -> re.Pattern:
    """Letters and numbers of a later Unicode version than that of the tokenizers library."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn" and not UNICODE_16.match(c)]
    starts = [c for c, before in zip(found, [-9, *found]) if c != before + 1]
    ends = [c for c, after in zip(found, [*found[1:], -9]) if c != after - 1]
    # ranges: the search tries every member of a class at every character
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]") if found else re.compile(r"(?!)")


def split_words(pattern: regex.Pattern, text: str) -> list[str]:
    """The pattern's matches, where characters that the library doesn't know yet are neither letters nor numbers."""
    if text.isascii() or not _newer().search(text):
        return pattern.findall(text)
    return [text[m.start() : m.end()] for m in pattern.finditer(_newer().sub("\ue000", text))]


class MergeAutomaton:
    """States and arcs by merge gadgets; tokens are numbered by the vocabulary, the first state is START."""

    START = -1

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.label = {i: t for t, i in vocab.items()}
        self.suffix = suffix
        self.step: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        made = {vocab[a + b] for a, b in merges}
        self.ids = {t: i for t, i in vocab.items() if i not in made}
        for step, (a, b) in enumerate(merges, 1):
            if self._gadget(step, vocab[a], vocab[b], vocab[a + b]):
                self.ids[a + b] = vocab[a + b]
        self._symbol_table()

    def _symbol_table(self) -> None:
        """The transitions that read a token symbol by symbol, also as sorted arrays; node 0 is the beginning of a token.

        ``shorter`` leads from a token to the next shorter one that it begins with.
        """
        number = {symbol: i for i, symbol in enumerate(byte_symbols())}
        edges: dict[int, int] = {}
        token_at, size, before = [-1], np.zeros(max(self.label) + 1, dtype=np.int64), [0]
        for t, i in self.ids.items():
            whole = bool(self.suffix) and len(t) > len(self.suffix) and t.endswith(self.suffix)
            body = t[: -len(self.suffix)] if whole else t
            if not body or any(c not in number for c in body):
                continue
            node = 0
            for k, c in enumerate(body):
                edge = node << 10 | number[c] | (LAST if whole and k == len(body) - 1 else 0)
                if edge not in edges:
                    edges[edge] = len(token_at)
                    token_at.append(-1)
                    before.append(node)
                node = edges[edge]
            token_at[node] = i
            size[i] = len(body)
        shorter, longest = np.full(len(size), -1, dtype=np.int64), [-1] * len(token_at)
        for node in range(1, len(token_at)):  # a node is numbered after the one before it
            longest[node] = token_at[node] if token_at[node] >= 0 else longest[before[node]]
            if token_at[node] >= 0:
                shorter[token_at[node]] = longest[before[node]]
        self.edges, self.longest, self.size, self.shorter = edges, np.array(longest, dtype=np.int64), size, shorter
        self.edge_keys = np.array(sorted(edges), dtype=np.int64)
        self.edge_ends = np.array([edges[k] for k in self.edge_keys.tolist()], dtype=np.int64)
        self.arc_keys = np.full(1 << ARC_BITS, -1, dtype=np.int64)
        self.arc_flags = np.zeros(1 << ARC_BITS, dtype=bool)
        self.arc_count = 0

    def _gadget(self, step: int, a: int, b: int, ab: int) -> bool:
        """Merge a, b into ab. Without an arc b after a there is nothing to merge."""
        if not self._arc(a, b, step):
            return False
        self.merged[a, b] = step
        self.parts[ab] = (a, b)
        self.step[ab] = step
        return True

    def arc(self, state: int, token: int) -> bool:
        """Whether the finished automaton has an arc for the token from the state after ``state``."""
        return self._arc(state, token, len(self.merged) + 2)

    def arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The same for many pairs, from the transition table; cells not yet expanded are filled in."""
        keys = (states + 1) << 20 | tokens
        out = np.zeros(len(keys), dtype=bool)
        left, slot = np.arange(len(keys)), (keys * 0x9E3779B1 >> 7) & (len(self.arc_keys) - 1)
        fresh = []
        while len(left):
            there = self.arc_keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.arc_flags[slot[hit]]
            if (none := there < 0).any():
                fresh.append(left[none])
            go = ~hit & ~none
            left, slot = left[go], (slot[go] + 1) & (len(self.arc_keys) - 1)
        if fresh:
            rows = np.concatenate(fresh)
            new, first = np.unique(keys[rows], return_inverse=True)
            if self.arc_count + len(new) > len(self.arc_keys) // 2:
                self.arc_keys[:] = -1
                self.arc_count = 0
            found = np.array([self.arc((k >> 20) - 1, k & 0xFFFFF) for k in new.tolist()], dtype=bool)
            out[rows] = found[first]
            if len(new) <= len(self.arc_keys) // 2:
                self.arc_count += len(new)
                for k, f in zip(new.tolist(), found.tolist()):
                    at = (k * 0x9E3779B1 >> 7) & (len(self.arc_keys) - 1)
                    while self.arc_keys[at] >= 0:
                        at = (at + 1) & (len(self.arc_keys) - 1)
                    self.arc_keys[at], self.arc_flags[at] = k, f
        return out

    def _arc(self, state: int, token: int, now: int) -> bool:
        """The same before step ``now``, by going back through the gadgets that made the two tokens."""
        while True:
            if self.merged.get((state, token), now) < now:
                return False
            born_state, born_token = self.step.get(state, 0), self.step.get(token, 0)
            if born_token == born_state == 0:
                return True
            if born_token > born_state:
                a, b = self.parts[token]
                if a == b == state:
                    return False
                token, now = a, born_token
            elif born_state > born_token:
                state, now = self.parts[state][1], born_state
            else:  # the same token twice
                token, state, now = self.parts[token][0], self.parts[state][1], born_state

    def walk(self, words: list[bytes]) -> Iterator[list[int]]:
        """Token numbers of words (not empty).

        There is one path to every position, so the path to the end is found by taking the longest arc first and
        going back to the next shorter one where a path ends early; no position is come to twice. Words of usual
        length follow the tables together, long ones alone.
        """
        at = 0
        while at < len(words):
            if len(words[at]) > LONG_WORD:
                yield self._walk_one(words[at])
                at += 1
                continue
            end, held = at, 0
            while end < len(words) and len(words[end]) <= LONG_WORD and held < 1 << 19:
                held += len(words[end]) + 1
                end += 1
            yield from self._walk(words[at:end])
            at = end

    def _walk(self, words: list[bytes]) -> Iterator[list[int]]:
        """last: the token that the path to a position ends with (its state); a symbol that no token has ends a word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8).astype(np.int64)
        symbols[ends] = NO_SYMBOL
        if self.suffix:
            symbols[ends - 1] += LAST
        last = np.full(len(symbols), self.START, dtype=np.int64)
        at, goal = ends - sizes, ends
        while len(at):
            token, row, node, place = np.full(len(at), -1, dtype=np.int64), np.arange(len(at)), np.zeros(len(at), dtype=np.int64), at
            while len(row):
                edge = node << 10 | symbols[place]
                found = np.minimum(np.searchsorted(self.edge_keys, edge), len(self.edge_keys) - 1)
                go = self.edge_keys[found] == edge
                row, node, place = row[go], self.edge_ends[found[go]], place[go] + 1
                token[row] = self.longest[node]
            row = np.arange(len(at))
            while len(row):
                if (none := token[row] < 0).any():  # no arc is left here: back to where the last token begins
                    back = row[none]
                    gone = last[at[back]]
                    at[back] -= self.size[gone]
                    token[back] = self.shorter[gone]
                    row_now = row[~none]
                else:
                    back, row_now = row[:0], row
                bad = row_now[~self.arcs(last[at[row_now]], token[row_now])]
                token[bad] = self.shorter[token[bad]]
                row = np.concatenate([back, bad])
            at = at + self.size[token]
            last[at] = token
            more = at < goal
            at, goal = at[more], goal[more]
        # back from the ends: every token is noted where it begins
        begins, place, start = np.full(len(symbols), -1, dtype=np.int64), ends, ends - sizes
        while len(place):
            token = last[place]
            place = place - self.size[token]
            begins[place] = token
            more = place > start
            place, start = place[more], start[more]
        there = np.flatnonzero(begins >= 0)
        ids, cuts = begins[there].tolist(), np.searchsorted(there, ends).tolist()
        return (ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts))

    def _walk_one(self, word: bytes) -> list[int]:
        symbols = np.frombuffer(word, dtype=np.uint8).astype(np.int64)
        if self.suffix:
            symbols[-1] += LAST
        path, ids, at, state = symbols.tolist(), [], 0, self.START
        while at < len(path):
            node, end = 0, at
            while end < len(path) and (next_node := self.edges.get(node << 10 | path[end])) is not None:
                node, end = next_node, end + 1
            token = int(self.longest[node])
            while token < 0 or not self._arc(state, token, len(self.merged) + 2):
                if token < 0:  # no arc is left here
                    token = ids.pop()
                    at -= int(self.size[token])
                    state = ids[-1] if ids else self.START
                token = int(self.shorter[token])
            ids.append(token)
            at += int(self.size[token])
            state = token
        return ids


class Encoder:
    """A vocabulary file's normaliser, splitter and special strings around the automaton."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        bpe = model["model"]
        self.suffix = bpe.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in bpe["merges"]]
        self.automaton = MergeAutomaton(bpe["vocab"], merges, self.suffix)
        self.number = {i: str(i) for i in self.automaton.label}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # fixed values: the normaliser and the splitting pattern of the vocabulary file, white space written out
        pattern = next(p["pattern"]["Regex"] for p in model["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", WS))
        self.space = regex.compile(f"[{WS}]+")
        self.odd = regex.compile("[\x1c-\x1f]")
        self.known: dict[str, str] = {}
        self.labels: dict[str, str] = {}

    def runs(self, text: str) -> list[str]:
        """The runs without white space of a text after NFC and lower case character by character (no final sigma)."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # split() also takes the four separators x1c-x1f for white space, the file's pattern doesn't
        return [c for c in self.space.split(text) if c] if self.odd.search(text) else text.split()

    def _learn(self, chunks: set[str]) -> None:
        """Encode runs without white space; the splitting pattern never crosses white space.

        Ids and labels are kept as joined strings, of words and of runs of several words alike (a word by itself is
        one word again); the garbage collector doesn't look through strings.
        """
        known, labels = self.known, self.labels
        label, number = self.automaton.label.__getitem__, self.number.__getitem__
        several = {c: split_words(self.words, c) for c in chunks if not c.isalpha()}  # letters alone are one word
        new = list({w for p in several.values() for w in p if w not in known}.union(chunks.difference(several)))
        for w, ids in zip(new, self.automaton.walk([w.encode("utf-8", "replace") for w in new])):
            known[w] = " ".join(map(number, ids))
            labels[w] = " ".join(map(label, ids))
        for c, p in several.items():
            if c not in known:
                known[c] = " ".join([known[w] for w in p])
                labels[c] = " ".join([labels[w] for w in p])

    def _parts(self, texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[str, str]]:
        """Per text its ids and its labels, each joined by spaces; the runs of several texts are learned together."""
        names, numbers = {t: t for t in self.special}, {t: str(i) for t, i in self.special.items()}
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end] or "") <= size):
                held += len(texts[end] or "")
                end += 1
            split = []
            for text in texts[at:end]:
                text = text or ""
                pieces = self.split_special.split(text) if any(s in text for s in self.special) else [text]
                split.append([[piece] if k % 2 else self.runs(piece) for k, piece in enumerate(pieces)])
            runs = set().union(*(runs for pieces in split for runs in pieces[::2]))
            new = runs.difference(self.known)
            if len(self.known) + len(new) > KEPT_WORDS:
                # what is known is dropped to make room: then all of the group's runs are new
                self.known.clear()
                self.labels.clear()
                new = runs
            self._learn(new)
            for pieces in split:
                if len(pieces) == 1:
                    yield " ".join(map(self.known.__getitem__, pieces[0])), " ".join(map(self.labels.__getitem__, pieces[0]))
                else:
                    yield tuple(" ".join([(special if k % 2 else kept)[c] for k, runs in enumerate(pieces) for c in runs])
                                for kept, special in ((self.known, numbers), (self.labels, names)))
            at = end

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [[int(i) for i in ids.split()] for ids, _ in self._parts(texts)]

    def decode(self, ids: list[int]) -> str:
        """Arc labels of the tokens, joined as the library joins them when the file has no decoder."""
        names = {i: t for t, i in self.special.items()}
        return " ".join(names[i] if i in names else self.automaton.label[i] for i in ids)

    def digests(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Number of tokens, digests of the ids and of the decoded text."""
        return [(ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(labels.encode()).hexdigest())
                for ids, labels in self._parts(texts)]


_ENCODERS: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One encoder per worker process and vocabulary, kept for the worker's next tasks."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def _broadcast(documents: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return prepare_texts(documents.sparkSession).sparkContext.broadcast(f.read())


def encoded(documents: DataFrame, path: str, name: str = "ids") -> DataFrame:
    """The documents with a column of token ids."""
    spec = _broadcast(documents, path)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(spec.value)
        for batch in batches:
            yield pd.Series(encoder.encode([t if isinstance(t, str) else None for t in batch]))

    return documents.withColumn(name, ids(F.col("text")))


def decoded(rows: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the text of their token ids; null ids are no tokens."""
    spec = _broadcast(rows, path)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(spec.value)
        for batch in batches:
            yield pd.Series([encoder.decode([int(i) for i in x]) if x is not None else "" for x in batch])

    return rows.withColumn(name, text(F.col(ids)))


def digests(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row."""
    spec = _broadcast(documents, path)

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(spec.value)
        for batch in batches:
            yield pd.DataFrame(encoder.digests([t if isinstance(t, str) else None for t in batch]), columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("d"))
    return rows.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
