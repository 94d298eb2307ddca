"""Benchmark decontamination with a generalised suffix automaton (operator 8).

The words of the benchmark items build a suffix automaton.  Training tokens stream through it; the
longest match that ends at each token tells which item windows of ``min_words`` words end there, and the
automaton's state tells of which items.  An item shorter than that is a window as a whole.  Tokens in any
window's occurrence are hit.

Items are dealt by hash to shards of about SHARD_WORDS words.  A task a shard builds the automaton, packs
it into arrays of whole numbers (about 50 bytes a word) and writes it to the shared folder; the driver
passes these bytes on, one shard at a time, and each shard is one pass over the documents.

Every document is streamed.  Before the automaton, stretches that cannot hold a window are passed over:
a window is a run of word pairs that all occur in items, which numpy decides for a document at once.

Null texts have no words; null ids are carried (a null item_id is reported as the word null); repeated
rows are judged alike; an empty benchmark hits nothing; an empty table gives an empty result; columns of
any name are carried.
"""
from __future__ import annotations

import pickle
import re
import uuid
from array import array
from bisect import bisect_left
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SLICE, id_text, map_batches, sha, utf8, written

#: Every byte that is no word byte becomes a blank; capitals become small letters.
TO_WORDS = bytes(LOWER[b] if b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Benchmark words in one automaton; more are cut into shards, each a pass over the documents.
SHARD_WORDS = 200_000


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton over word numbers, made for matches of ``min_words``.

    While it is built, transitions are a dictionary a state; then all is packed into arrays: the
    transitions of state s are ``symbol[at[s]:at[s + 1]]``, in order, and ``target`` beside them."""

    def __init__(self, items: list[tuple[str, list[bytes]]], min_words: int):
        self.min_words = min_words
        self.code: dict[bytes, int] = {}
        coded = [(i, [self.code.setdefault(w, len(self.code)) for w in ws]) for i, ws in items if ws]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, ws in coded:
            last = 0
            for c in ws:
                last = self._extend(last, c)
        n = len(self.next)
        self.names = sorted({i for i, _ in coded})
        number = {name: i for i, name in enumerate(self.names)}
        holds: list = [()] * n  # items that hold a state's strings
        short: list = [()] * n  # short items that are this state's longest string
        for item, ws in coded:
            item, state, new = number[item], 0, set()
            for c in ws:
                state = self.next[state][c]
                up = state
                while up > 0 and up not in new:
                    new.add(up)
                    up = self.link[up]
            for s in new:
                if not holds[s] or holds[s][-1] != item:
                    holds[s] = (*holds[s], item)
            if len(ws) < min_words and item not in short[state]:
                short[state] = (*short[state], item)
        order = sorted(range(1, n), key=self.length.__getitem__)
        window = [0] * n  # ancestor (or self) that holds the strings of min_words words
        short_up = [0] * n  # nearest proper ancestor with a short item
        for s in order:
            up = self.link[s]
            window[s] = s if self.length[up] < min_words <= self.length[s] else window[up] if self.length[s] >= min_words else 0
            short_up[s] = up if up > 0 and short[up] else short_up[up] if up > 0 else 0
        self.least = min([len(ws) for _, ws in coded if len(ws) < min_words] or [min_words])
        width = max(1, len(self.code))
        self.pairs = np.unique(np.array([a * width + b for _, ws in coded for a, b in zip(ws, ws[1:])] or [-1], dtype=np.int64))
        # items are asked for at windows only
        self.holds = {s: holds[s] for s in {w for w in window if w}}
        self.short = {s: x for s, x in enumerate(short) if x}
        self.window, self.short_up, self.link, self.length = (array("i", x) for x in (window, short_up, self.link, self.length))
        self.at, self.symbol, self.target = array("i", [0]), array("i"), array("i")
        for s in range(n):
            for c in sorted(self.next[s]):
                self.symbol.append(c)
                self.target.append(self.next[s][c])
            self.next[s] = None
            self.at.append(len(self.symbol))
        del self.next

    def size(self) -> int:
        """Bytes of the arrays, which grow with the words."""
        return self.pairs.nbytes + sum(4 * len(x) for x in (self.window, self.short_up, self.link, self.length, self.at, self.symbol, self.target))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def stretches(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of known words, start and end, that may hold a window."""
        n = len(codes)
        if self.least == 1:
            ok, need = codes >= 0, 1
        else:
            key = codes[:-1] * max(1, len(self.code)) + codes[1:]
            place = np.searchsorted(self.pairs, key)
            ok = (codes[:-1] >= 0) & (codes[1:] >= 0) & (self.pairs[np.minimum(place, len(self.pairs) - 1)] == key)
            need = self.least - 1
        edge = np.flatnonzero(np.diff(np.concatenate([[0], ok.view(np.int8), [0]])))
        s, e = edge[::2], edge[1::2]
        long = e - s >= need
        return list(zip(s[long].tolist(), (e[long] + (self.least > 1)).tolist())) if n else []

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit stretches of word positions (start, end; sorted, apart) and the items that occur."""
        n = len(words)
        codes = np.fromiter(map(self.code.get, words, repeat(-1)), dtype=np.int64, count=n)
        link, length, k, begin, symbol, target, short = self.link, self.length, self.min_words, self.at, self.symbol, self.target, self.short
        hits: list[list[int]] = []
        states, items = set(), set()

        def hit(start, end):
            while hits and hits[-1][1] >= start:
                start = min(start, hits.pop()[0])
            hits.append([start, end])

        for s, e in self.stretches(codes):
            state = size = 0
            for at, c in enumerate(codes[s:e].tolist(), s):
                while True:
                    low, high = begin[state], begin[state + 1]
                    place = low if high - low == 1 and symbol[low] == c else bisect_left(symbol, c, low, high)
                    if place < high and symbol[place] == c:
                        state = target[place]
                        size += 1
                        break
                    if not state:
                        size = -1
                        break
                    state = link[state]
                    size = length[state]
                if size < 0:
                    size = 0
                    continue
                if size >= k:
                    states.add(self.window[state])
                    hit(at + 1 - k, at + 1)
                up = state if state in short and size >= length[state] else self.short_up[state]
                while up:
                    items.update(short[up])
                    hit(at + 1 - length[up], at + 1)
                    up = self.short_up[up]
        for state in states:
            items.update(self.holds[state])
        return [(a, b) for a, b in hits], {self.names[i] for i in items}


#: The automaton that this worker used last, by name of its shard.
_last: dict = {}


def unpacked(name: str, data: bytes) -> Automaton:
    if name not in _last:
        _last.clear()
        automaton = Automaton.__new__(Automaton)
        vars(automaton).update(pickle.loads(data))
        _last[name] = automaton
    return _last[name]


def automata(benchmark: DataFrame, min_words: int, id_col: str = "item_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, automaton): packed automata of about ``shard_words`` words each (an item is never cut), built by
    a task a shard and written to the shared folder."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batch):
        return {"n": [len(words_of(t)) for t in utf8(batch)]}

    total = map_batches(items.select("text"), count, "n long").agg(F.sum("n")).first()[0] or 0
    shards = -(-total // shard_words)

    def build(table):
        names, texts = table["item"].to_pylist(), table["text"].cast(pa.binary()).to_pylist()
        order = sorted(range(len(names)), key=lambda i: (names[i], texts[i]))
        made = Automaton([(names[i], words_of(texts[i])) for i in order], min_words)
        return pa.table({"shard": table["shard"].slice(0, 1), "automaton": pa.array([pickle.dumps(vars(made), protocol=5)], pa.binary())})

    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(max(1, shards))).cast("int"))
    return written(dealt.where(F.lit(shards > 0)).groupBy("shard").applyInArrow(build, "shard int, automaton binary"))


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(hits):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def marked(docs: DataFrame, shards: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with two more columns, at the end: hit stretches (start, end, start, end, ...) and items; a
    pass for each shard.

    A worker holds one automaton at a time, so passes after the first start from written rows."""
    sc = docs.sparkSession.sparkContext
    place = docs.columns.index(text_col)
    width = len(docs.columns)
    taken = {c.lower() for c in docs.columns}
    hits_col, items_col = (next(n for n in ("_" * i + base for i in range(2, 99)) if n not in taken) for base in ("hits", "items"))
    out = docs.withColumn(hits_col, F.array().cast("array<int>")).withColumn(items_col, F.array().cast("array<string>"))

    def passing(name, shard):
        def run(batches):
            automaton = unpacked(name, shard.value)
            for whole in batches:
                for at in range(0, whole.num_rows, SLICE):
                    part = whole.slice(at, SLICE)
                    hits, items = part.column(width).to_pylist(), part.column(width + 1).to_pylist()
                    for i, raw in enumerate(part.column(place).cast(pa.binary()).to_pylist()):
                        found, names = automaton.match(words_of(raw or b""))
                        hits[i] = hits[i] + [x for h in found for x in h]
                        items[i] = sorted({*items[i], *names})
                    part = part.set_column(width, part.schema.field(width), pa.array(hits, part.column(width).type))
                    yield part.set_column(width + 1, part.schema.field(width + 1), pa.array(items, part.column(width + 1).type))

        return run

    numbers = sorted(r["shard"] for r in shards.select("shard").collect())
    for n, number in enumerate(numbers):
        data = bytes(shards.where(F.col("shard") == number).first()["automaton"])  # one shard's arrays
        out = (written(out) if n else out).mapInArrow(passing(uuid.uuid4().hex, sc.broadcast(data)), out.schema)
    return out


def spans(hits: list[int]) -> list[tuple[int, int]]:
    return merged(list(zip(hits[::2], hits[1::2])))


def contamination(docs: DataFrame, benchmark: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, hit words, occurring items and whether any word is hit."""
    found = marked(id_text(docs, id_col, text_col), automata(benchmark, min_words), "text")

    def run(batch):
        cols = {n: [] for n in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")}
        for raw, hits, items in zip(utf8(batch), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            n = sum(e - s for s, e in spans(hits))
            cols["n_words"].append(len(words_of(raw)))
            cols["n_hit"].append(n)
            cols["n_items"].append(len(items))
            cols["items_sha256"].append(sha(",".join(items)))
            cols["contaminated"].append(n > 0)
        return cols | {"doc_id": batch.column(0)}

    return map_batches(found, run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cleaned(text: str, hits: list[tuple[int, int]]) -> str:
    """The text without the characters from each hit stretch's first word to its last."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for s, e in hits:
        out.append(text[at: spans[s][0]])
        at = spans[e - 1][1]
    return "".join(out) + text[at:]


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, min_words: int = 10, max_coverage: float = 0.5,
                     text_col: str = "text") -> DataFrame:
    """``docs`` (all its columns) without benchmark passages: hit stretches leave the text, and documents
    of whose words more than ``max_coverage`` are hit go.  A null text stays null."""
    place, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                texts, keep = part.column(place).to_pylist(), []
                for i, hits in enumerate(part.column(width).to_pylist()):
                    cut = spans(hits)
                    keep.append(not cut or sum(e - s for s, e in cut) <= max_coverage * len(words_of(texts[i].encode())))
                    if cut and keep[-1]:
                        texts[i] = cleaned(texts[i], cut)
                part = part.set_column(place, part.schema.field(place), pa.array(texts, part.column(place).type))
                yield part.select(range(width)).filter(pa.array(keep))

    return marked(docs, automata(benchmark, min_words), text_col).mapInArrow(run, docs.schema)
