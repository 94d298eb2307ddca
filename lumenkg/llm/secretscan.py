"""Secrets by a randomness test battery (operator 4).

Base patterns (assignments, access keys, long hex) run on every text.  Beside them each unbroken
token of 20 or more key characters gets its encoding inferred from its alphabet (hex, base32, base62,
base64) and three tests of randomness under it: chi-squared uniformity over the alphabet, runs about
the alphabet's middle, and serial correlation of neighbours.  Fisher's method joins the three.

The p-value is for "put together from words": the probability of the token under the corpus's own
letter pairs, over its probability when drawn evenly from its encoding, over the battery's p-value.  By
Markov's inequality the first ratio is at most p with probability p for tokens made of words, in every
encoding; the battery only makes it larger, so a token that looks less random has less evidence.
Benjamini-Hochberg is applied within classes of token length (short tokens carry little evidence and
must not borrow it from long ones), over all tokens of the corpus.

The corpus-wide parts are a table of 27 x 26 letter pair counts and a histogram of at most LENGTHS x
BINS counts; the table and the histogram's limits, one a length class, go through the driver.
Null text counts as empty; a null doc_id, repeated rows and an empty table pass through.
"""
from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, SLICE, Spans, id_text, map_batches, sha, utf8, written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")

ENCODINGS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Upper ends of the length classes, and the number of p-value bins (one a power of ten to the -1/4).
LENGTHS = (24, 32, 40, 48, 64, 96, 128, 256)
BINS = 400
#: Most breaks between words, by character, in text that is not random.
WORD_BREAKS = 0.22
#: Kinds of pieces between breaks: small letters, capitals, a capital before small letters, digits, signs.
PIECES = 5
#: Count that every letter pair has beside the corpus's, so that few texts do not settle the pairs; and
#: the share of letters that follow no pair.
PAIR_PRIOR, ANY_LETTER = 50, 0.1
#: Letters' numbers by byte; every other byte is 0.
LETTER = bytes(LOWER[b] - 96 if chr(b).isalpha() and b < 0x80 else 0 for b in range(256))


def infer_encoding(token: str) -> str | None:
    """The smallest alphabet that holds every character; letters or digits alone are not an encoding."""
    seen = set(token.rstrip("="))
    if not any(c.isdigit() for c in seen) or not any(c.isalpha() for c in seen):
        return None
    return next((name for name, chars in ENCODINGS.items() if seen <= set(chars)), None)


def normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, df: int) -> float:
    """P(chi-squared with df degrees > x), by the Wilson-Hilferty cube root."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


@lru_cache(maxsize=1024)
def cell_shares(k: int, cells: int) -> list[float]:
    """The part of an alphabet of ``k`` characters that is folded into each cell."""
    return [sum(1 for v in range(k) if v * cells // k == c) / k for c in range(cells)]


def battery(token: str, encoding: str) -> float:
    """p-value of the token under "drawn evenly from its alphabet": uniformity, runs, serial correlation."""
    place = {c: i for i, c in enumerate(ENCODINGS[encoding])}
    x = [place[c] for c in token.rstrip("=")]
    n, k = len(x), len(place)
    # Few characters a cell: the alphabet is folded into cells of five expected characters at least.
    cells = max(2, min(k, n // 5))
    counts = [0] * cells
    for v in x:
        counts[v * cells // k] += 1
    share = cell_shares(k, cells)
    uniform = chi2_tail(sum((o - n * s) ** 2 / (n * s) for o, s in zip(counts, share)), cells - 1)
    up = [2 * v >= k for v in x]
    a = sum(up)
    b = n - a
    if a and b:
        runs = 1 + sum(p != q for p, q in zip(up, up[1:]))
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        runs_p = 0.5 ** (n - 1)
    m = sum(x) / n
    spread = sum((v - m) ** 2 for v in x)
    serial = sum((p - m) * (q - m) for p, q in zip(x, x[1:])) / spread if spread else 1.0
    serial_p = normal_tail((serial + 1 / n) * math.sqrt(n))
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (uniform, runs_p, serial_p))
    half = fisher / 2
    return math.exp(-half) * (1 + half + half * half / 2)  # chi-squared tail with 6 degrees


def letter_pairs(raw: bytes) -> np.ndarray:
    """Counts of (letter before or 0, letter), 27 x 27, over the words too short to be candidates."""
    words = b" ".join(w for w in raw.split() if len(w) < 20)
    x = np.frombuffer((b" " + words).translate(LETTER), np.uint8).astype(np.int64)
    return np.bincount(x[:-1] * 27 + x[1:], minlength=729)


def letter_logs(counts) -> list[list[float]]:
    """ln P(letter | letter before or 0) for words, from the counts of :func:`letter_pairs`."""
    held = np.asarray(counts, dtype=float).reshape(27, 27)[:, 1:] + PAIR_PRIOR
    share = held / held.sum(axis=1, keepdims=True)
    return np.log((1 - ANY_LETTER) * share + ANY_LETTER / 26).tolist()


def unlike_prose(token: str, encoding: str, logs: list[list[float]]) -> float:
    """log10 of a bound on the p-value of the token under "put together from words".

    A break is a change between small letters, capitals, digits and signs, but for a lone capital before
    small letters.  Words break in at most ``WORD_BREAKS`` of all places; the rate most favourable to them
    counts, a piece's letters follow the corpus's pairs, and its digits and signs are drawn evenly."""
    chars = token.rstrip("=")
    kind = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-" for c in chars)
    places = len(kind) - 1
    starts = {m.start() for m in re.finditer(r"(?<![A])A?a+|A+|0+|-+|a+", kind)}
    breaks = len(starts) - 1
    rate = min(WORD_BREAKS, breaks / places)
    words = (places - breaks) * math.log(1 - rate) + (breaks * math.log(rate / PIECES) if breaks else 0)
    before = 0
    for at, (c, k) in enumerate(zip(chars.lower(), kind)):
        if k in "aA":
            here = ord(c) - 96
            words += logs[0 if at in starts else before][here - 1]
            before = here
        else:
            words -= math.log(10 if k == "0" else 4)
    even = -len(chars) * math.log(len(ENCODINGS[encoding]))
    # drawn from one of the encodings, each as likely
    return min(0.0, (words - even + math.log(len(ENCODINGS))) / math.log(10))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted; failing matches are dropped without another try."""
    low = text.lower()
    out = []
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base, logs: list[list[float]], alpha: float = 1e-4):
    """(start, end, length class, p-value bin, random) of every token with an encoding; ``random``
    holds where the battery does not reject randomness and no base span is touched."""
    out, taken = [], Spans((s, e) for s, _, e in base)
    for m in TOKEN.finditer(text):
        if encoding := infer_encoding(m[0]):
            n = m.end() - m.start()
            length = next((i for i, most in enumerate(LENGTHS) if n <= most), len(LENGTHS))
            even = battery(m[0], encoding)
            p = unlike_prose(m[0], encoding, logs) - math.log10(max(even, 1e-300))
            place = min(BINS - 1, int(-4 * min(0.0, p)))
            out.append((m.start(), m.end(), length, place, even >= alpha and not taken.touch(m.start(), m.end())))
    return out


def spelled(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.01,
                 alpha: float = 1e-4) -> DataFrame:
    """One row per document: base counts, ``base_sha256`` of the base spans and ``spans`` with the tokens
    added at false-discovery rate ``fdr`` (by start, then kind)."""
    texts = id_text(docs, id_col, text_col)

    def pairs(batches):
        total = np.zeros(729, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for raw in utf8(batch.slice(at, SLICE)):
                    total += letter_pairs(raw)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["pair", "n"])

    counts = np.zeros(729, dtype=np.int64)
    for r in texts.select("text").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 729 rows at most
        counts[r["pair"]] = r["n"]
    logs = letter_logs(counts)

    def run(batch):
        cols = {n: [] for n in ("base", "tokens")}
        for text in batch.column(1).to_pylist():
            base = base_spans(text)
            cols["base"].append([{"s": s, "k": k, "e": e} for s, k, e in base])
            cols["tokens"].append([dict(zip(("s", "e", "len", "bin", "free"), c)) for c in candidates(text, base, logs, alpha)])
        return cols | {"doc_id": batch.column(0)}

    found = written(map_batches(texts, run,
                                "doc_id long, base array<struct<s:int,k:int,e:int>>, tokens array<struct<s:int,e:int,len:int,bin:int,free:boolean>>"))
    counts = found.select(F.explode("tokens").alias("t")).groupBy(F.col("t.len").alias("len"), F.col("t.bin").alias("bin")).agg(F.count("*").alias("n"))
    # Benjamini-Hochberg on binned p-values: the largest p with p * m / rank <= fdr, a bin counting at its upper end.
    by = Window.partitionBy("len")
    ranked = counts.withColumn("rank", F.sum("n").over(by.orderBy(F.desc("bin")))).withColumn("m", F.sum("n").over(by))
    passing = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 4) * F.col("m") <= fdr * F.col("rank"))
    limits = {r["len"]: r["least"] for r in passing.groupBy("len").agg(F.min("bin").alias("least")).collect()}  # nine rows at most

    def finish(batch):
        cols = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added")}
        for base, tokens in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            base = [(b["s"], b["k"], b["e"]) for b in base]
            extra = [t for t in tokens if t["free"] and t["bin"] >= limits.get(t["len"], BINS)]
            for k, kind in enumerate(KINDS[:3]):
                cols[f"n_{kind}"].append(sum(b[1] == k for b in base))
            cols["base_sha256"].append(sha(spelled(base)))
            cols["spans"].append(spelled(sorted(base + [(t["s"], 3, t["e"]) for t in extra])))
            cols["n_added"].append(len(extra))
        return cols | {"doc_id": batch.column(0)}

    return map_batches(found, finish,
                       "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long")
