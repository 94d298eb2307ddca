"""Token counts by offset-mapped attribution (operator 7).

Each document is encoded once, as a whole.  Token byte lengths give every token's span; an interval
join (sorted ends against sorted section starts) finds the first and last section it touches.  A token
that crosses a border is allocated by an explicit rule:

* ``start``    to the section of its first byte (the default),
* ``end``      to the section of its last byte,
* ``majority`` to the section with most of its bytes, the earlier on a tie.

Sections tile the text: by default the lines, each with its line break.  Offsets are UTF-8 bytes, so a
token that ends inside a character has a place too.

The tokenizer is a rank file read on the driver from a path that is a parameter, and sent in a
broadcast of that file's size.  Null text counts as empty (no section, no token); a null doc_id,
repeated rows and an empty table pass through; other columns are not read.
"""
from __future__ import annotations

import base64
import re

import numpy as np
import tiktoken
from pyspark.sql import DataFrame

from .common import id_text, map_batches, sha, utf8

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Cut of a text before merging, as this vocabulary was made with (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LINES = rb"[^\n]*\n|[^\n]+"
RULES = ("start", "end", "majority")

_built: dict = {}


def encoder(ranks: dict[bytes, int], pattern: str):
    """The encoding and the byte length of each id; built once in a worker for a table of ranks, which is
    held, so that no other one can take its place."""
    key = (id(ranks), pattern)
    if key not in _built:
        size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            size[i] = len(token)
        _built[key] = ranks, tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size
    return _built[key][1:]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def attribute(sizes: np.ndarray, starts: np.ndarray, total: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens by section, and crossing tokens by section.

    ``sizes``: bytes of each token in order; ``starts``: first byte of each section, from 0 on, of a text
    of ``total`` bytes that both tile."""
    n = len(starts)
    if not len(sizes) or not n:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    crossing = first != last
    owner = first
    if rule == "end":
        owner = last
    elif rule == "majority" and crossing.any():
        owner = first.copy()
        stops = np.append(starts[1:], total)
        for t in np.flatnonzero(crossing):
            part = np.arange(first[t], last[t] + 1)
            held = np.minimum(stops[part], ends[t]) - np.maximum(starts[part], begins[t])
            owner[t] = part[np.argmax(held)]
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def section_tokens(docs: DataFrame, rule: str = "start", sections: bytes = LINES, ranks_path: str = RANKS, pattern: str = PATTERN,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: arrays with each section's first byte, tokens and crossing tokens.

    ``sections`` is a bytes pattern whose matches tile any text."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    bc = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batch):
        encoding, size = encoder(bc.value, pattern)
        cut = re.compile(sections)
        cols = {n: [] for n in ("starts", "tokens", "crossing")}
        for raw, text in zip(utf8(batch), batch.column(1).to_pylist()):
            sizes = size[np.array(encoding.encode_ordinary(text), dtype=np.int64)]
            starts = np.array([m.start() for m in cut.finditer(raw)], dtype=np.int64)
            tokens, crossing = attribute(sizes, starts, len(raw), rule)
            cols["starts"].append(starts)
            cols["tokens"].append(tokens)
            cols["crossing"].append(crossing)
        return cols | {"doc_id": batch.column(0)}

    return map_batches(id_text(docs, id_col, text_col), run, "doc_id long, starts array<long>, tokens array<long>, crossing array<long>")


def token_digest(sections: DataFrame) -> DataFrame:
    """Per document: sections, tokens, crossing tokens, most tokens in a section, and the hash of the
    sections' counts joined by commas."""
    def run(batch):
        cols = {n: [] for n in ("n_sections", "n_tokens", "n_crossing", "most", "tokens_sha256")}
        for tokens, crossing in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            cols["n_sections"].append(len(tokens))
            cols["n_tokens"].append(sum(tokens))
            cols["n_crossing"].append(sum(crossing))
            cols["most"].append(max(tokens, default=0))
            cols["tokens_sha256"].append(sha(",".join(map(str, tokens))))
        return cols | {"doc_id": batch.column(0)}

    return map_batches(sections.select("doc_id", "tokens", "crossing"), run,
                       "doc_id long, n_sections long, n_tokens long, n_crossing long, most long, tokens_sha256 string")
