"""Date parsing (T1) and publication date from text."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import col, py_strip, PY_WS_CLASS


def parse_date(s) -> Column:
    """First of the fixed formats that parses the stripped string, else null.

    ``strptime`` treats a blank in the format as "one or more whitespace"
    and ignores case; the string is stripped and inner whitespace runs are
    collapsed to one blank so the Spark patterns see the same input.
    """
    s = col(s)
    norm = F.regexp_replace(py_strip(s), "(?U)" + PY_WS_CLASS + "+", " ")

    def tries(x):  # a format is only tried on strings of its shape: failed parses are costly
        return F.coalesce(*[F.when(x.rlike(shape), F.try_to_timestamp(x, F.lit(fmt)))
                            for fmt, shape in zip(vocab.DATE_FORMATS_SPARK, vocab.DATE_FORMAT_SHAPES)])

    # as an array's element the normal form is computed once, not for every format again
    parsed = F.get(F.transform(F.array(norm), tries), 0)
    return F.when(s.isNotNull() & (F.length(s) > 0), parsed)


def publication_date_from_text(text) -> Column:
    """The first pattern that *matches* decides, even when its parse fails."""
    text = col(text)
    out = None
    for p in vocab.PUBLISHED_DATE_PATTERNS:
        jp = "(?U)" + p
        branch = parse_date(F.regexp_extract(text, jp, 1))
        out = F.when(text.rlike(jp), branch) if out is None else out.when(text.rlike(jp), branch)
    return out
