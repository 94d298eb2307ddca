"""Fetched web pages -> text and page metadata.

HTML cannot be parsed by Spark's built-in functions, so one
UDF parses each page once with the standard library's
``html.parser`` tokenizer and returns a struct; every later step (text,
DOI, journal, PMCID, PMID, title) is a plain Column expression over that
struct.  Only the ``html`` column crosses into Python.
"""
from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab
from ..functions.text import col, pmcid_from_url, truthy

PAGE_STRUCT = T.StructType([
    T.StructField("title", T.StringType()),          # text of the first <title>
    T.StructField("text", T.StringType()),           # main text (P6)
    T.StructField("meta", T.MapType(T.StringType(), T.StringType())),  # first <meta name=..> content
    T.StructField("canonical", T.ArrayType(T.StringType())),  # <link rel=canonical> hrefs
    T.StructField("hrefs", T.ArrayType(T.StringType())),      # <a href> in order
    T.StructField("journal_sel", T.StringType()),    # first journal selector hit, stripped
    T.StructField("doi_in_text", T.StringType()),    # first DOI-looking token of the page text
])

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def classes(self):
        return (self.attrs.get("class") or "").split()

    def text(self) -> str:
        """Concatenated strings of the subtree in document order; strings
        inside script/style/template/rt/rp are not text."""
        return "".join(_visible_strings(self))

    def iter(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if not isinstance(c, str))


class _Tree(HTMLParser):
    """Minimal tree builder: void tags close at once, an end tag closes the
    nearest open element of that name, unmatched end tags are ignored,
    comments and doctypes are dropped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            self.cur.children.append(data[6:])


_SIMPLE = re.compile(r'^(?P<tag>[a-zA-Z][a-zA-Z0-9]*)?(?P<rest>(?:[.#][\w-]+|\[[\w-]+="[^"]*"\])*)$')
_PART = re.compile(r'([.#])([\w-]+)|\[([\w-]+)="([^"]*)"\]')


def _compile(selector: str):
    steps = []
    for simple in selector.split():
        m = _SIMPLE.match(simple)
        tag, classes, ids, attrs = m.group("tag"), [], [], []
        for dot, name, an, av in _PART.findall(m.group("rest")):
            if dot == ".":
                classes.append(name)
            elif dot == "#":
                ids.append(name)
            else:
                attrs.append((an, av))
        steps.append((tag, classes, ids, attrs))
    return steps


def _match_simple(node, step) -> bool:
    tag, classes, ids, attrs = step
    if tag and node.tag != tag:
        return False
    if classes and not set(classes) <= set(node.classes()):
        return False
    if ids and any(node.attrs.get("id") != i for i in ids):
        return False
    return all(node.attrs.get(k) == v for k, v in attrs)


def _match(node, steps) -> bool:
    if not _match_simple(node, steps[-1]):
        return False
    i, anc = len(steps) - 2, node.parent
    while i >= 0 and anc is not None:
        if anc.tag != "[document]" and _match_simple(anc, steps[i]):
            i -= 1
        anc = anc.parent
    return i < 0


_COMPILED = {s: _compile(s) for s in vocab.ABSTRACT_SELECTORS + vocab.CONTENT_SELECTORS + vocab.JOURNAL_SELECTORS}
_DOI_RE = re.compile(vocab.DOI_TEXT_PATTERN)


def _first_matches(root, selectors) -> dict:
    """selector -> its first node in document order, found in one walk."""
    found = {}
    for n in root.iter():
        if n is root:
            continue
        for sel in selectors:
            if sel not in found and _match(n, _COMPILED[sel]):
                found[sel] = n
    return found


def parse_page(html: str | None, max_chars: int | None = None) -> dict | None:
    """Parse one page; pure Python helper used inside the UDF.

    ``max_chars`` cuts the main content (``vocab.PAGE_TEXT_CHARS`` is the
    opt-in value of the source); by default it is whole."""
    if html is None:
        return None
    tree = _Tree()
    try:
        tree.feed(html)
        tree.close()
    except Exception:  # malformed input: behave like an empty page
        return {"title": None, "text": "", "meta": {}, "canonical": [], "hrefs": [],
                "journal_sel": None, "doi_in_text": None}
    root = tree.root
    title = meta = None
    meta, canonical, hrefs = {}, [], []
    for n in root.iter():
        if n is root:
            continue
        if n.tag == "title" and title is None:
            title = n.text()
        elif n.tag == "meta" and "name" in n.attrs and n.attrs["name"] not in meta:
            meta[n.attrs["name"]] = n.attrs.get("content")
        elif n.tag == "link" and "canonical" in (n.attrs.get("rel") or "").split():
            canonical.append(n.attrs.get("href", ""))
        elif n.tag == "a" and "href" in n.attrs:
            hrefs.append(n.attrs["href"])
    journal_sel = None
    at = _first_matches(root, vocab.JOURNAL_SELECTORS)
    for sel in vocab.JOURNAL_SELECTORS:
        if sel in at:
            journal_sel = at[sel].text().strip()
            break
    full_text = root.text()
    m = _DOI_RE.search(full_text)
    doi_in_text = m.group() if m else None

    # Remove boilerplate subtrees, then abstract + main content
    nodes = list(root.iter())
    for n in nodes:
        if n.tag in vocab.REMOVED_TAGS and n.parent is not None:
            n.parent.children = [c for c in n.parent.children if c is not n]
            n.parent = None
    main = ""
    at = _first_matches(root, vocab.ABSTRACT_SELECTORS + vocab.CONTENT_SELECTORS)
    for sel in vocab.ABSTRACT_SELECTORS:
        if sel in at:
            main += f"Abstract: {at[sel].text().strip()}\n\n"
            break
    for sel in vocab.CONTENT_SELECTORS:
        if sel in at:
            content = at[sel].text().strip()
            if len(content) > vocab.CONTENT_MIN_CHARS:
                main += content[:max_chars]
                break
    if not main.strip():
        body = next((n for n in root.iter() if n.tag == "body"), None)
        if body is not None:
            main = body.text()[:max_chars]
    for n in nodes:  # without the way up the tree is freed at once, not by a later collection
        n.parent = None
    return {"title": title, "text": main.strip(), "meta": meta, "canonical": canonical,
            "hrefs": hrefs, "journal_sel": journal_sel, "doi_in_text": doi_in_text}


_HIDDEN = frozenset(("script", "style", "template", "rt", "rp"))


def _visible_strings(root, skip=_HIDDEN):
    stack = [root]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            yield n
            continue
        if n.tag in skip:
            continue
        stack.extend(reversed(n.children))


#: Pages, and bytes of HTML, of a slice of an Arrow column (for callers that have pages in Arrow batches).
SLICE_PAGES, SLICE_BYTES = 64, 1 << 20


def _slices(html: pa.Array):
    """``html`` in slices of at most ``SLICE_PAGES`` pages and, but for a single page, ``SLICE_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(html), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= SLICE_PAGES or held + n > SLICE_BYTES):
            yield html.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield html.slice(start)


def parse_pages_udf(max_chars: int | None = None):
    """Nondeterministic on purpose: it is an evaluation barrier, so filters on
    the parsed fields are not pushed below the UDF (which would parse twice).

    Rows go to the worker in Spark's small batches of plain UDFs (100 rows by default), not in Arrow batches (10,000):
    a worker holds few pages, however large they are and whatever the table's size."""
    def _parse(html):
        return parse_page(html, max_chars) or dict.fromkeys(PAGE_STRUCT.names)

    return F.udf(_parse, PAGE_STRUCT, useArrow=False).asNondeterministic()


def parse_pages(pages: DataFrame, html_col: str = "html", status_col: str | None = None,
                out_col: str = "page", max_chars: int | None = None, partitions: int | None = None) -> DataFrame:
    """S2 + P6: keep HTTP-200 pages (when a status column is given) and add
    the parsed ``page`` struct; the raw html column is dropped.  ``max_chars``
    cuts the text; ``partitions`` spreads pages stored in few files."""
    if status_col is not None:
        pages = pages.filter(F.col(status_col) == 200)
    if partitions:
        pages = pages.repartition(partitions)
    return pages.withColumn(out_col, parse_pages_udf(max_chars)(F.col(html_col))).drop(html_col)


# -- Column accessors over the parsed struct (P2-P5) -------------------------

def doi_from_page(page="page") -> Column:
    p = col(page)
    return F.when(F.map_contains_key(p["meta"], "citation_doi"), F.element_at(p["meta"], F.lit("citation_doi"))) \
        .otherwise(p["doi_in_text"])


def journal_from_page(page="page") -> Column:
    p = col(page)
    return F.when(F.map_contains_key(p["meta"], "citation_journal_title"),
                  F.element_at(p["meta"], F.lit("citation_journal_title"))).otherwise(p["journal_sel"])


def pmcid_from_page(page="page", compat: bool = False) -> Column:
    """PMCID from the first canonical link that carries one.

    ``compat=True`` also reproduces the legacy rule that prefixes the
    ``citation_pmid`` meta content with "PMC" (a PMID, not a PMCID).
    """
    p = col(page)
    from_links = F.get(F.filter(F.transform(p["canonical"], lambda h: pmcid_from_url(h)), lambda x: x.isNotNull()), 0)
    if not compat:
        return from_links
    legacy = F.concat(F.lit("PMC"), F.coalesce(F.element_at(p["meta"], F.lit("citation_pmid")), F.lit("")))
    return F.when(F.map_contains_key(p["meta"], "citation_pmid"), legacy).otherwise(from_links)


def pmid_from_page(page="page") -> Column:
    p = col(page)
    first = F.get(F.filter(p["hrefs"], lambda h: F.lower(h).contains("pubmed") & h.rlike(r"(?U)pubmed/\d+")), 0)
    from_links = F.regexp_extract(first, r"(?U)pubmed/(\d+)", 1)
    return F.when(F.map_contains_key(p["meta"], "citation_pmid"), F.element_at(p["meta"], F.lit("citation_pmid"))) \
        .otherwise(F.when(first.isNotNull(), from_links))
