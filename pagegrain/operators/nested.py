"""Deeply nested records as flat linked tables.

``json_objects`` reads JSON text by structural indexing over whole batches: bitmaps of quotes, brackets and delimiters,
string masks and nesting depth by prefix sums, brackets paired by sorting on depth. The same bitmaps tell complete JSON
from broken JSON, so no text is parsed twice. Out comes one row per object that carries a number, linked to the object
around it. JSON inside JSON strings is unpacked and indexed in turn.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textvec import chunks

#: Members that hold text boxes, members that hold other objects, and members that only wrap a page.
TEXT_FIELDS = ("boxes_2d", "text_boxes", "ocr_text_clusters")
OBJECT_FIELDS = ("non_text_objects", "children", "parts")
WRAPPERS = ("response", "result", "page", "data")
ID_FIELDS = ("id", "cluster_number")
TEXT_MEMBERS = ("label", "text", "description")

_FENCE = re.compile(r"^\s*```[\w-]*\s*\n?(.*?)\n?\s*```\s*$", re.S)
_NUM = r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
_FIRST = rf"(?P<v>{_NUM})"
_FOUR = r"[^-\d]+".join(rf"(?P<{c}>{_NUM})" for c in "abcd")
_PRIMITIVE = rf"^(?:-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?|true|false|null|NaN|-?Infinity)$"


def _set(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(chars))


_WS, _OPEN, _CLOSE, _MARKS = _set(b" \t\r\n"), _set(b"{["), _set(b"}]"), _set(b"{}[]:,")
_ESCAPED, _HEX = _set(b'"\\/bfnrtu'), _set(b"0123456789abcdefABCDEF")

FIELDS = "kind string, record_id long, object_id long, parent_object_id long, text string, y_min double, x_min double, y_max double, x_max double"
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.float64()] * 4]


def _bare(text: str) -> str:
    """The text without a code fence around it."""
    m = _FENCE.match(text) if "```" in text else None
    return m[1] if m else text


class _Index:
    """Structural index of texts laid end to end; ``ok`` tells which of them are complete JSON.

    A container is a pair of brackets. open, close, level, doc, parent (container or -1), colon (the one whose value it
    is, or -1) describe containers in the order of their open brackets; owner (a container), key and value describe colons.
    """

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.bytes = b"\n".join(raw) + b"\n"
        b = self.b = np.frombuffer(self.bytes, np.uint8)
        base = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)])
        self.base, n = base, len(texts)
        own = lambda total: total - np.repeat(np.concatenate([[0], total[base[1:-1] - 1]]), np.diff(base)) if n else total
        at = np.arange(len(b))
        before = np.concatenate([[-1], np.maximum.accumulate(np.where(b != 0x5C, at, -1))[:-1]])
        quote = (b == 0x22) & ((at - before) % 2 == 1)  # an even number of backslashes before it
        inside = own(np.cumsum(quote)) % 2 == 1
        out = ~(inside | quote)
        opens, closes = out & _OPEN[b], out & _CLOSE[b]
        depth = own(np.cumsum(opens.astype(np.int64) - closes))
        text_of = lambda pos: np.searchsorted(base, pos, side="right") - 1
        ok = np.ones(n, np.bool_)
        if n:
            end = base[1:] - 1
            ok &= ~inside[end] & (depth[end] == 0) & (np.minimum.reduceat(depth, base[:-1]) >= 0)
            bad = inside & ~quote & (b < 0x20)  # a raw control character in a string
            slash = np.flatnonzero(inside & (b == 0x5C) & ((at - before) % 2 == 1))  # a backslash that escapes the next character
            after = b[slash + 1]
            wrong = ~_ESCAPED[after]
            u = slash[after == 0x75]
            hexed = np.ones(len(u), np.bool_)
            for k in range(2, 6):
                hexed &= _HEX[b[np.minimum(u + k, len(b) - 1)]]
            ok[text_of(np.concatenate([np.flatnonzero(bad), slash[wrong], u[~hexed]]))] = False
        live = np.repeat(ok, np.diff(base))
        marks = np.flatnonzero((opens | closes) & live)
        level = np.where(opens[marks], depth[marks], depth[marks] + 1)
        pairs = marks[np.lexsort((marks, level))]
        o, c = pairs[0::2], pairs[1::2]
        by_pos = np.argsort(o)
        self.open, self.close = o[by_pos], c[by_pos]
        self.level, self.doc = depth[self.open], text_of(self.open)
        ok[self.doc[b[self.close] != b[self.open] + 2]] = False
        self.quotes = np.flatnonzero(quote & live)
        self._find = self._finder(len(b))
        self._grammar(b, quote, inside, out, opens, live, depth, ok, text_of)
        self.ok = ok
        keep = ok[self.doc]
        to = np.append(np.cumsum(keep) - 1, -1)  # -1, for none, stays -1
        alive = ok[text_of(self.colons)]
        colon_to = np.append(np.cumsum(alive) - 1, -1)
        self.colons, self.owner, self.value = self.colons[alive], to[self.owner[alive]], self.value[alive]
        self.parent, self.colon = to[self.parent[keep]], colon_to[self.colon[keep]]
        self.open, self.close, self.level, self.doc = self.open[keep], self.close[keep], self.level[keep], self.doc[keep]

    def _finder(self, size: int):
        """(level, position) to the last container of that level that opens before; for positions inside one."""
        key = self.level * (size + 1) + self.open
        order = np.argsort(key)
        return lambda level, pos: order[np.searchsorted(key[order], level * (size + 1) + pos, side="right") - 1] if len(order) else np.zeros(len(pos), np.int64)

    def _grammar(self, b, quote, inside, out, opens, live, depth, ok, text_of) -> None:
        """Every token must be one that may follow the token before it, in an object or a list; flags texts where one isn't."""
        dark = out & ~_WS[b] & live
        mark = dark & _MARKS[b]
        plain = dark & ~mark
        first = plain & ~np.concatenate([[False], plain[:-1]])
        starts = quote & inside & live
        tok = np.flatnonzero(mark | first | starts)
        kind = np.where(starts[tok], 0x22, np.where(first[tok], 0x30, b[tok]))
        doc = text_of(tok)
        prev = np.concatenate([[0], kind[:-1]])
        if len(tok):
            prev[np.concatenate([[True], doc[1:] != doc[:-1]])] = 0
        level = depth[tok] - opens[tok] + np.isin(kind, (0x7D, 0x5D))
        around = np.where(level > 0, self._find(level, tok - 1), -1)
        is_obj = (around >= 0) & (b[self.open[np.maximum(around, 0)]] == 0x7B) if len(self.open) else np.zeros(len(tok), np.bool_)
        key = (kind == 0x22) & is_obj & ((prev == 0x7B) | (prev == 0x2C))
        kept = np.concatenate([[False], key[:-1]])
        ended = np.isin(prev, (0x30, 0x7D, 0x5D)) | ((prev == 0x22) & ~kept)
        value = np.isin(kind, (0x7B, 0x5B, 0x30)) | ((kind == 0x22) & ~key)
        fits = key.copy()
        fits |= value & ((prev == 0) | (prev == 0x3A) | (prev == 0x5B) | ((prev == 0x2C) & ~is_obj))
        fits |= (kind == 0x3A) & (prev == 0x22) & kept
        fits |= (kind == 0x2C) & ended & (around >= 0)
        fits |= (kind == 0x7D) & (ended | (prev == 0x7B))
        fits |= (kind == 0x5D) & (ended | (prev == 0x5B))
        ok[doc[~fits]] = False
        some = np.zeros(len(ok), np.bool_)
        some[doc] = True
        ok &= some
        self.plain_start = np.flatnonzero(first)
        self.plain_end = np.flatnonzero(plain & ~np.concatenate([plain[1:], [False]])) + 1
        said = pc.match_substring_regex(self.strings(self.plain_start, self.plain_end), _PRIMITIVE).to_numpy(zero_copy_only=False)
        ok[text_of(self.plain_start[~said])] = False
        # a colon's key is the token before it, its value the token behind it
        c = np.flatnonzero(kind == 0x3A)
        c = c[ok[doc[c]]]
        self.colons, self.owner = tok[c], around[c]
        self.key_start = tok[c - 1] + 1 if len(c) else np.zeros(0, np.int64)
        self.value = tok[np.minimum(c + 1, len(tok) - 1)] if len(c) else np.zeros(0, np.int64)
        self.parent = np.where(self.level > 1, self._find(np.maximum(self.level - 1, 1), self.open - 1), -1)
        k = np.searchsorted(self.value, self.open)
        hit = (k < len(self.value)) & (self.value[np.minimum(k, len(self.value) - 1)] == self.open) if len(self.value) else np.zeros(len(self.open), np.bool_)
        self.colon = np.where(hit, k, -1)
        keep = ok[text_of(self.colons)]
        self.key_start = self.key_start[keep]

    def strings(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """The bytes of each span as one array."""
        size = end - start
        off = np.concatenate([[0], np.cumsum(size)])
        held = self.b[np.repeat(start - off[:-1], size) + np.arange(off[-1])] if off[-1] else np.zeros(0, np.uint8)
        return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(held))]).cast(pa.binary() if off[-1] < 2**31 else pa.large_binary())

    def closing_quote(self, at: np.ndarray) -> np.ndarray:
        return self.quotes[np.minimum(np.searchsorted(self.quotes, at) + 1, len(self.quotes) - 1)] if len(self.quotes) else at

    def value_end(self, at: np.ndarray) -> np.ndarray:
        """Where the value that begins at each position ends, whatever it is and however long."""
        first = self.b[at]
        end = self.closing_quote(at) + 1
        if len(self.plain_start):
            i = np.clip(np.searchsorted(self.plain_start, at, side="right") - 1, 0, None)
            end = np.where(first != 0x22, self.plain_end[i], end)
        if len(self.open):
            i = np.clip(np.searchsorted(self.open, at, side="right") - 1, 0, None)
            end = np.where(_OPEN[first], self.close[i] + 1, end)
        return end

    def keys(self) -> tuple[np.ndarray, list[str]]:
        """For each colon the number of its key, and the keys in lower case."""
        end = self.closing_quote(self.key_start - 1)
        code = self.strings(self.key_start, end).dictionary_encode()
        return code.indices.to_numpy(), [_decoded(k).lower() for k in code.dictionary.to_pylist()]

    def texts(self, at: np.ndarray) -> pa.Array:
        """The strings that begin at the positions, without quotes and escapes."""
        return pa.array([_decoded(x) for x in self.strings(at + 1, self.closing_quote(at)).to_pylist()], pa.string())


def _decoded(raw: bytes) -> str:
    """A JSON string's bytes as text; lone surrogates become question marks."""
    text = raw.decode("utf-8", "surrogatepass")
    if "\\" not in text:
        return text if text.isascii() else text.encode("utf-8", "replace").decode()
    return json.loads(f'"{text}"').encode("utf-8", "replace").decode()


def _integers(said: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(value, known) of the first number in each text: whole numbers digit by digit, others cut off; none beyond 64 bits."""
    got = pc.struct_field(pc.extract_regex(said, _FIRST), "v").to_pylist()
    out, known = np.zeros(len(got), np.int64), np.zeros(len(got), np.bool_)
    for i, g in enumerate(got):
        if g is not None:
            v = int(g) if g.lstrip("-").isdigit() else int(float(g))
            if -(2**63) <= v < 2**63:
                out[i], known[i] = v, True
    return out, known


def _first_of(names: np.ndarray, owner: np.ndarray, wanted: list[int], n: int) -> np.ndarray:
    """For each container its first colon with one of the keys; -1 for none."""
    out = np.full(n, -1, np.int64)
    at = np.flatnonzero(np.isin(names, wanted))[::-1]
    out[owner[at]] = at
    return out


def _objects(texts: list[str], records: list[int], where: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Batches of FIELDS. where: for each text the member it stands in ("" for a page) and the object around it."""
    while texts:
        texts = [_bare(t) for t in texts]
        ix = _Index(texts)
        again: list[tuple[str, int, tuple[str, int]]] = [(json.loads(t), r, w) for t, r, w, fine in zip(texts, records, where, ix.ok) if fine and t.lstrip()[:1] == '"']
        n = len(ix.open)
        code, names = ix.keys() if len(ix.colons) else (np.zeros(0, np.int64), [])
        fields = {name: i for i, name in enumerate(dict.fromkeys(["", *names, *(w[0] for w in where)]))}
        of = np.array([fields[x] for x in names], np.int64) if names else np.zeros(0, np.int64)
        have = lambda wanted: [i for i, x in enumerate(names) if x in wanted]
        named = np.where(ix.colon >= 0, code[np.maximum(ix.colon, 0)] if len(code) else 0, -1)
        digit = np.array([x.isdigit() for x in names] + [False])[named]
        slot = (named < 0) | digit
        root_field = np.array([fields[w[0]] for w in where], np.int64)
        root_obj = np.array([w[1] for w in where], np.int64)
        field = np.where(slot, -1, of[named] if len(of) else -1)
        levels = np.argsort(ix.level, kind="stable")
        cuts = np.searchsorted(ix.level[levels], np.arange(1, (ix.level.max() if n else 0) + 2))
        steps = [levels[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for i in steps:  # a level at a time, parents first
            up = np.where(ix.parent[i] >= 0, field[ix.parent[i]], root_field[ix.doc[i]])
            field[i] = np.where(field[i] < 0, up, field[i])
        texty = np.isin(field, [fields[x] for x in TEXT_FIELDS if x in fields])
        listed = (texty | np.isin(field, [fields[x] for x in OBJECT_FIELDS if x in fields])) & (ix.b[ix.open] == 0x7B)
        member = {k: _first_of(code, ix.owner, have((k,)), n) for k in (*ID_FIELDS, *TEXT_MEMBERS, "box_2d")}
        said = member[ID_FIELDS[0]]
        for k in ID_FIELDS[1:]:
            said = np.where(said < 0, member[k], said)
        number, known = np.zeros(n, np.int64), np.zeros(n, np.bool_)
        i = np.flatnonzero(listed & (said >= 0))
        at = ix.value[said[i]] if len(i) else np.zeros(0, np.int64)
        i, at = i[~_OPEN[ix.b[at]]], at[~_OPEN[ix.b[at]]]
        number[i], known[i] = _integers(ix.strings(at, ix.value_end(at)).cast(pa.string()))
        says = np.zeros(n, np.bool_)
        for k in (*TEXT_MEMBERS, "box_2d"):
            says |= member[k] >= 0
        i = np.flatnonzero(listed & ~known & digit & says)
        number[i], known[i] = _integers(pa.array([names[x] for x in named[i]], pa.string()))
        around = np.full(n, -1, np.int64)
        for i in steps:
            p = ix.parent[i]
            around[i] = np.where(p < 0, root_obj[ix.doc[i]], np.where(known[p], number[p], around[p]))
        rows = np.flatnonzero(known)
        if len(rows):
            yield _batch(ix, rows, texty, np.array(records, np.int64)[ix.doc[rows]], number, around, member)
        inner = np.flatnonzero(np.isin(code, have((*OBJECT_FIELDS, *TEXT_FIELDS, *WRAPPERS))) & (ix.b[ix.value] == 0x22)) if len(code) else np.zeros(0, np.int64)
        back = list(fields)
        for c, text in zip(inner.tolist(), ix.texts(ix.value[inner]).to_pylist() if len(inner) else ()):
            if _bare(text).lstrip()[:1] in ("{", "["):
                o, k = ix.owner[c], names[code[c]]
                again.append((text, records[ix.doc[o]], (back[field[o]] if k in WRAPPERS else k, int(number[o] if known[o] else around[o]))))
        texts, records, where = [a[0] for a in again], [a[1] for a in again], [a[2] for a in again]


def _batch(ix: _Index, rows: np.ndarray, texty: np.ndarray, record: np.ndarray, number: np.ndarray, around: np.ndarray, member: dict[str, np.ndarray]) -> pa.RecordBatch:
    spot = np.full(len(rows), -1, np.int64)
    for k in TEXT_MEMBERS:
        c = member[k][rows]
        at = np.where(c >= 0, ix.value[np.maximum(c, 0)], 0)
        spot = np.where((spot < 0) & (c >= 0) & (ix.b[at] == 0x22), at, spot)
    has = np.flatnonzero(spot >= 0)
    slot = np.full(len(rows), -1, np.int64)
    slot[has] = np.arange(len(has))
    text = ix.texts(spot[has]).take(pa.array(slot, mask=slot < 0)) if len(has) else pa.nulls(len(rows), pa.string())
    c = member["box_2d"][rows]
    has = np.flatnonzero(c >= 0)
    slot = np.full(len(rows), -1, np.int64)
    slot[has] = np.arange(len(has))
    box = [pa.nulls(len(rows), pa.float64())] * 4
    if len(has):
        at = ix.value[c[has]]
        four = pc.extract_regex(ix.strings(at, ix.value_end(at)).cast(pa.string()), _FOUR)
        box = [pc.struct_field(four, x).cast(pa.float64()).take(pa.array(slot, mask=slot < 0)) for x in "abcd"]
    kind = pa.array(np.where(texty[rows], "raw_text", "raw_object"), pa.string())
    return pa.RecordBatch.from_arrays([kind, pa.array(record), pa.array(number[rows]), pa.array(around[rows]), text, *box], _NAMES)


def json_objects(df: DataFrame, record: str = "response_id", text: str = "response_json") -> DataFrame:
    """One row per numbered text box or object at any depth of the JSON in ``text``, with the number of the object around it.

    kind is raw_text or raw_object; parent_object_id is -1 where the page itself holds the object. Code fences,
    JSON encoded as a string, wrapping members and lists, objects listed, single or keyed by number, and numbers
    written as strings are read alike, whatever white space stands between. Null, empty and incomplete JSON give no rows;
    objects without a number, or with one beyond 64 bits, give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                whole = [(t, r) for t, r in zip(part.column(text).to_pylist(), part.column(record).to_pylist()) if t and r is not None]
                yield from _objects([t for t, _ in whole], [r for _, r in whole], [("", -1)] * len(whole))

    return df.select(F.col(record).cast("long").alias(record), text).mapInArrow(run, FIELDS)


def refined_children(pages: DataFrame) -> DataFrame:
    """(origin, record_id, object_id, parent_object_id, text, box) of the members of refined_version's two lists."""

    def part(origin: str, member: str, said: str) -> DataFrame:
        o = F.col("o")
        return pages.select(F.col("page_id").alias("record_id"), F.explode(f"refined_version.{member}").alias("o")).where("o.cluster_number IS NOT NULL").select(
            F.lit(origin).alias("origin"), "record_id", o["cluster_number"].cast("long").alias("object_id"), F.lit(-1).cast("long").alias("parent_object_id"),
            o[said].alias("text"), o["bb_y_min"].alias("y_min"), o["bb_x_min"].alias("x_min"), o["bb_y_max"].alias("y_max"), o["bb_x_max"].alias("x_max"),
        )

    return part("refined_text", "OCR_text_clusters", "text").unionByName(part("refined_object", "non_text_objects", "description"))


def page_table(pages: DataFrame) -> DataFrame:
    """One row per distinct page: its own members, the struct members of metadata flat, and counts of its children."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    return pages.select(
        "page_id", "document_id", "pdf_page_num", "printed_page_number", "contains_table", "is_empty_page", "incomplete_text", "scan_quality",
        F.col("metadata.ocr_model_name").alias("ocr_model_name"), F.col("metadata.ocr_datetime").alias("ocr_datetime"), F.col("metadata.ocr_json_version").alias("ocr_json_version"),
        F.col("refined_version").isNotNull().alias("has_refined"), n("OCR_text_clusters").alias("n_texts"), n("non_text_objects").alias("n_objects"),
        n("refined_version.OCR_text_clusters").alias("n_refined_texts"), n("refined_version.non_text_objects").alias("n_refined_objects"),
    ).distinct()


def child_objects(pages: DataFrame, responses: DataFrame) -> DataFrame:
    """(origin, record_id, object_id, parent_object_id), distinct: every child object of pages and responses."""
    raw = json_objects(responses).withColumnRenamed("kind", "origin")
    cols = ["origin", "record_id", "object_id", "parent_object_id"]
    return refined_children(pages).select(*cols).unionByName(raw.select(*cols)).distinct()
