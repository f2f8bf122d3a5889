"""Text to pages, lines, typed blocks and their nesting, without moving a text.

A document is one row, so everything is worked out where it is read: Arrow batches of texts are cut into pages and lines,
rules are applied to all lines of a batch at once, and blocks, spans and nesting are array arithmetic. Nothing is shuffled.

Page breaks are form feeds and lines that hold only the break marker. A page loses line ends at both ends, blank pages
are dropped and the rest number from 1. Lines end at line feeds. Offsets count within the page, ends are inclusive.
A document without text has no pages.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.textvec import chunks

# What marks pages, headings and terms.
PAGE_BREAK = r"\f|^[ \t\n\r\f\v]*--- PAGE BREAK ---[ \t\n\r\f\v]*$"
PLAIN_HEADING = r"(?i)^(Section|Clause|Article|Definitions?)\b[:\s].*"
NUMBERED = r"^\d+(?:\.\d+)+\s+\S+"
TERM = r"^(?:\d+[.)]|[-*+])\s+\S+"
TERM_MARK = r"^(?:\d+[.)]|[-*+])\s+"
MARKDOWN = r"^(?P<h>#{1,6})\s+(?P<t>.*)$"
TITLE_CHARS = 80

_BREAK = re.compile(PAGE_BREAK, re.M)
_BLANK = " \t\n\r\f\v\xa0"


class _Batch:
    """Pages, lines and blocks of some texts; a null format counts as plain text."""

    def __init__(self, texts: list[str | None], formats: list[str | None]):
        page_of, pages, at = [], [], []
        for i, t in enumerate(texts):
            own = [p for p in (x.strip("\n") for x in _BREAK.split(t)) if p.strip(_BLANK)] if t else []
            pages += own
            page_of += [i] * len(own)
            at += range(1, len(own) + 1)
        self.pages, self.doc, self.page_number = pages, np.array(page_of, np.int64), np.array(at, np.int32)
        self.markdown = np.array([f == "markdown" for f in formats], np.bool_)[self.doc] if len(pages) else np.zeros(0, np.bool_)

    def lines(self) -> None:
        n = np.array([p.count("\n") + 1 for p in self.pages], np.int64)
        self.line = pa.array("\n".join(self.pages).split("\n") if self.pages else [], pa.string())
        self.page = np.repeat(np.arange(len(n)), n)
        first = np.cumsum(n) - n
        self.line_no = (np.arange(len(self.page)) - first[self.page]).astype(np.int32)
        self.size = pc.utf8_length(self.line).to_numpy().astype(np.int64)
        ends = np.cumsum(self.size + 1)
        begin = ends - self.size - 1
        self.start = begin - begin[first][self.page] if len(self.page) else begin

    def types(self) -> None:
        self.lines()
        s = self.stripped = pc.utf8_trim(self.line, _BLANK)
        has = lambda pattern: pc.match_substring_regex(s, pattern).to_numpy(zero_copy_only=False)
        self.blank = pc.equal(s, "").to_numpy(zero_copy_only=False)
        dark = np.flatnonzero(~self.blank)
        first = np.zeros(len(self.page), np.bool_)
        first[dark[np.concatenate([[True], self.page[dark][1:] != self.page[dark][:-1]])] if len(dark) else dark] = True
        words = pc.count_substring_regex(s, rf"{X.WS}+").to_numpy() + 1
        md = self.markdown[self.page] & has(MARKDOWN)
        numbered = has(NUMBERED)
        caps = (words <= 8) & has(r"\p{L}") & pc.equal(pc.utf8_upper(s), s).to_numpy(zero_copy_only=False)
        titled = first & (words <= 6) & ~has(r"[.!?]$")
        heading = has(PLAIN_HEADING) | numbered | caps | titled
        dots = pc.count_substring(s, ".").to_numpy()
        level = np.where(titled | (caps & first), 1, np.where(numbered, np.maximum(2, dots + 2), 2))
        parts = pc.extract_regex(s, MARKDOWN)
        hashes = pc.fill_null(pc.utf8_length(pc.struct_field(parts, "h")), 0).to_numpy()
        self.level = np.where(md, hashes, np.where(heading, level, 0)) * ~self.blank
        term = has(TERM)
        self.kind = np.where(self.blank, 0, np.where(self.level > 2, 2, np.where(self.level > 0, 1, np.where(term, 3, 4))))
        md_title = pc.utf8_trim(pc.fill_null(pc.struct_field(parts, "t"), ""), _BLANK)
        md_title = pc.if_else(pc.equal(md_title, ""), pc.utf8_trim(pc.replace_substring_regex(s, "^#+", ""), _BLANK), md_title)
        said = pc.if_else(pa.array(self.kind == 3), pc.utf8_trim(pc.replace_substring_regex(s, TERM_MARK, ""), _BLANK), pc.utf8_rtrim(pc.utf8_slice_codeunits(s, 0, TITLE_CHARS), _BLANK))
        said = pc.if_else(pa.array(heading), pc.utf8_trim(pc.replace_substring_regex(s, ":+$", ""), _BLANK), said)
        self.title = pc.if_else(pa.array(md), md_title, said)

    def blocks(self) -> None:
        """Consecutive paragraph lines become one block; its parent is the nearest earlier heading of a smaller level."""
        self.types()
        para = self.kind == 4
        goes_on = np.zeros(len(para), np.bool_)
        goes_on[1:] = para[1:] & para[:-1] & (self.page[1:] == self.page[:-1])
        dark = np.flatnonzero(~self.blank)
        head = self.head = np.flatnonzero(~self.blank & ~goes_on)
        last = np.concatenate([dark[np.searchsorted(dark, head[1:]) - 1], dark[-1:]]) if len(head) else head
        lead = self.size - pc.utf8_length(pc.utf8_ltrim(self.line, _BLANK)).to_numpy()
        whole = pc.utf8_length(self.stripped).to_numpy()
        self.b_page, self.b_start, self.b_end = self.page[head], (self.start + lead)[head], (self.start + lead + whole - 1)[last]
        self.b_lines = np.diff(np.append(np.searchsorted(dark, head), len(dark)))
        opening = np.searchsorted(self.b_page, self.b_page)
        at = np.arange(len(head))
        self.b_seq = (at - opening).astype(np.int32)
        level = self.level[head]
        parent = np.full(len(head), -1, np.int64)
        for k in np.unique(level):  # one pass a level that occurs; level 0 is no heading and stands below all of them
            above = (level > 0) & ((level < k) if k else True)
            near = np.maximum.accumulate(np.where(above, at, -1)) if len(at) else at
            parent = np.where(level == k, np.concatenate([[-1], near[:-1]]), parent)
        self.b_parent = np.where(parent >= opening, parent - opening, -1).astype(np.int32)


_KINDS = pa.array(["BLANK", "SECTION", "SUBSECTION", "TERM", "PARAGRAPH"])


def _mapped(documents: DataFrame, key: str, text: str, fmt: str, schema: str, emit: Callable[[_Batch], list[pa.Array | np.ndarray]]) -> DataFrame:
    """``emit`` gives for each batch the row's document and then the columns of ``schema`` behind key and source_format."""
    kind = dict(documents.dtypes)[key]
    f = F.col(fmt).cast("string") if fmt in documents.columns else F.lit("text")
    names = ["_k", "source_format", *(c.strip().split()[0] for c in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_t"):
                b = _Batch(part.column("_t").to_pylist(), part.column("_f").to_pylist())
                doc, *cols = emit(b)
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays([part.column("_k").take(at), part.column("_f").take(at), *(c if isinstance(c, pa.Array) else c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in cols)], names)

    out = documents.select(F.col(key).alias("_k"), F.col(text).alias("_t"), f.alias("_f")).mapInArrow(run, f"_k {kind}, source_format string, {schema}")
    return out.withColumnRenamed("_k", key)


def pages(documents: DataFrame, key: str = "doc_id", text: str = "text", fmt: str = "source_format") -> DataFrame:
    """(key, source_format, page_number, page_text)."""
    return _mapped(documents, key, text, fmt, "page_number int, page_text string", lambda b: [b.doc, b.page_number, pa.array(b.pages, pa.string())])


def lines(documents: DataFrame, key: str = "doc_id", text: str = "text", fmt: str = "source_format") -> DataFrame:
    """(key, source_format, page_number, line_no, line, start): each line with its offset in the page."""

    def emit(b: _Batch) -> list:
        b.lines()
        return [b.doc[b.page], b.page_number[b.page], b.line_no, b.line, b.start]

    return _mapped(documents, key, text, fmt, "page_number int, line_no int, line string, start long", emit)


def typed_lines(documents: DataFrame, key: str = "doc_id", text: str = "text", fmt: str = "source_format") -> DataFrame:
    """Lines with node_type, level and title; both are null where the line is BLANK, the level where it is no heading."""

    def emit(b: _Batch) -> list:
        b.types()
        title = pc.if_else(pa.array(b.blank), pa.scalar(None, pa.string()), b.title)
        return [b.doc[b.page], b.page_number[b.page], b.line_no, b.line, b.start, _KINDS.take(pa.array(b.kind)), pa.array(b.level.astype(np.int32), mask=b.level == 0), title]

    return _mapped(documents, key, text, fmt, "page_number int, line_no int, line string, start long, node_type string, level int, title string", emit)


def blocks(documents: DataFrame, key: str = "doc_id", text: str = "text", fmt: str = "source_format", texts: bool = False) -> DataFrame:
    """(key, page_number, seq, node_type, level, title, start, end, n_lines, parent_seq[, said]): consecutive paragraph lines are one block.

    parent_seq is null at the page; for headings it is the nearest earlier heading of a smaller level, for others the last
    heading. With ``texts`` said is the block's own text.
    """

    def emit(b: _Batch) -> list:
        b.blocks()
        level = b.level[b.head].astype(np.int32)
        out = [b.doc[b.b_page], b.page_number[b.b_page], b.b_seq, _KINDS.take(pa.array(b.kind[b.head])), pa.array(level, mask=level == 0), b.title.take(pa.array(b.head)), b.b_start, b.b_end, b.b_lines, pa.array(b.b_parent, mask=b.b_parent < 0)]
        if texts:
            out.append(pa.array([b.pages[p][s : e + 1] for p, s, e in zip(b.b_page.tolist(), b.b_start.tolist(), b.b_end.tolist())], pa.string()))
        return out

    cols = "page_number int, seq int, node_type string, level int, title string, start long, end long, n_lines long, parent_seq int"
    return _mapped(documents, key, text, fmt, cols + (", said string" if texts else ""), emit)


def page_index(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Nodes of the page index: a root per document, a PAGE per page, and the nested blocks with their spans.

    (node_id, parent_id, key, page_number, seq, node_type, title, start_char, end_char). Pages are children of the root;
    blocks without a heading above them are children of their page.
    """

    def emit(b: _Batch) -> list:
        b.blocks()
        roots, n = np.unique(b.doc), len(b.pages)
        none = lambda k: np.full(k, -1, np.int64)
        joined = lambda *parts: np.concatenate(parts)
        level = joined(np.zeros(len(roots)), np.ones(n), np.full(len(b.head), 2)).astype(np.int32)
        number = joined(none(len(roots)), b.page_number, b.page_number[b.b_page])
        title = pa.concat_arrays([pa.nulls(len(roots) + n, pa.string()), b.title.take(pa.array(b.head))])
        kind = pa.concat_arrays([pa.array(["DOCUMENT_ROOT"] * len(roots) + ["PAGE"] * n, pa.string()), _KINDS.take(pa.array(b.kind[b.head]))])
        size = np.array([len(p) for p in b.pages], np.int64)
        some = lambda x: pa.array(x.astype(np.int32), mask=x < 0)
        doc = joined(roots, b.doc, b.doc[b.b_page])
        return [doc, level, some(number), some(joined(none(len(roots) + n), b.b_seq)), some(joined(none(len(roots) + n), b.b_parent)), kind, title, some(joined(none(len(roots)), np.zeros(n, np.int64), b.b_start)), some(joined(none(len(roots)), size - 1, b.b_end))]

    rows = _mapped(documents, key, "text", "source_format", "_at int, page_number int, seq int, _up int, node_type string, title string, start_char int, end_char int", emit)
    k = F.col(key).cast("string")
    page = F.concat(k, F.lit("|p"), F.col("page_number").cast("string"))
    block = lambda c: F.concat(page, F.lit("_b"), F.col(c).cast("string"))
    at = lambda root, mid, leaf: F.when(F.col("_at") == 0, root).when(F.col("_at") == 1, mid).otherwise(leaf)
    return rows.select(
        at(k, page, block("seq")).alias("node_id"), at(F.lit(None).cast("string"), k, F.coalesce(block("_up"), page)).alias("parent_id"), key, "page_number", "seq", "node_type",
        at(k, F.concat(F.lit("Page "), F.col("page_number").cast("string")), F.col("title")).alias("title"), "start_char", "end_char",
    )


def strict_page(blocks_: list[str], text: str) -> list[tuple]:
    """Ground a page's blocks one after another from a running cursor, as the strict mode asks: (tier, start, end, text).

    The span proposed for a block begins at the cursor and is as long as its text; it stays if it holds the text apart
    from white space, or if one holds the other; else the occurrence nearest to the cursor counts. A block that
    nothing matches has no span and leaves the cursor where it is.
    """
    from .grounding import ground_one

    out, cursor = [], 0
    for b in blocks_:
        found = ground_one(text, cursor, cursor + len(b) - 1, b)
        out.append(found)
        if found[2] is not None:
            cursor = found[2] + 1
    return out


def strict_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", fmt: str = "source_format") -> DataFrame:
    """(key, page_number, seq, tier, start_char, end_char): the blocks of every page grounded in strict mode."""

    def emit(b: _Batch) -> list:
        b.blocks()
        found: list[tuple] = []
        edge = np.searchsorted(b.b_page, np.arange(len(b.pages) + 1)).tolist()
        start, end = b.b_start.tolist(), b.b_end.tolist()
        for p, (i, j) in enumerate(zip(edge[:-1], edge[1:])):
            found += strict_page([b.pages[p][start[x] : end[x] + 1] for x in range(i, j)], b.pages[p])
        tier, s, e = ([f[x] for f in found] for x in range(3))
        return [b.doc[b.b_page], b.page_number[b.b_page], b.b_seq, pa.array(tier, pa.string()), pa.array(s, pa.int32()), pa.array(e, pa.int32())]

    return _mapped(documents, key, text, fmt, "page_number int, seq int, tier string, start_char int, end_char int", emit).drop("source_format")


def fallback_tree(units: DataFrame) -> DataFrame:
    """Without a parser: a root, a PAGE per page and a TEXT_FLOW per text unit, titled by the start of its first line."""
    first = F.substring(F.split(X.strip(F.coalesce("text", F.lit(""))), "\n")[0], 1, TITLE_CHARS)
    text = units.where(F.col("modality").isin("text", "ocr_text"))
    page_id = F.concat("collection_id", F.lit("|p"), F.col("page_number").cast("string"))
    leaf = text.select(F.col("unit_id").alias("node_id"), page_id.alias("parent_id"), F.lit("TEXT_FLOW").alias("node_type"), first.alias("title"), F.lit(2).alias("level_from_root"))
    page = text.select("collection_id", "page_number").distinct().select(page_id.alias("node_id"), F.col("collection_id").alias("parent_id"), F.lit("PAGE").alias("node_type"), F.concat(F.lit("Page "), F.col("page_number").cast("string")).alias("title"), F.lit(1).alias("level_from_root"))
    root = text.select("collection_id").distinct().select(F.col("collection_id").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit("DOCUMENT_ROOT").alias("node_type"), F.col("collection_id").alias("title"), F.lit(0).alias("level_from_root"))
    return root.unionByName(page).unionByName(leaf)
