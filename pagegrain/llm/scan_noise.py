"""Noise in text from scanned pages: what is wrong with each text, and the text put right.

Candidates for a misread word are retrieved completely: a Levenshtein automaton over characters, in which the merges and
splits that recognition makes (rn for m, cl for d) are one place as well, is run against tries of the corpus vocabulary.
Words meet the vocabulary by what is left of both when characters are left out, which is complete for one wrong place in
a word and for two from five characters on, shorter words would keep less than they lose; long words by one of five pieces. Where a single confusion of the table
explains a word, a far more common candidate decides; any other candidate must also be far more common between the same
two neighbouring words, so a rare word that merely looks like a common one stays. Words of one character have no candidates. Words broken over a line end are told from compounds by which form the corpus has. Running
headers and footers are the short first lines that return on several pages of one document; page numbers are texts
that say nothing but the number of their page.

Null and blank texts have no noise; repeated rows count once; texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bitfilter
from ..functions.textvec import Words, chunks, mix64, signed
from ..operators.nested import json_objects
from ..session import cut

_U = np.uint64

# What recognition reads (left) for what is printed (right).
CONFUSIONS = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("c", "e"), ("e", "c"), ("o", "a"), ("a", "o"), ("l", "i"), ("i", "l"),
    ("f", "t"), ("t", "f"), ("b", "h"), ("h", "b"), ("u", "n"), ("n", "u"), ("q", "g"), ("vv", "w"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"),
    ("ri", "n"), ("ii", "u"), ("ii", "n"), ("li", "h"), ("nn", "m"), ("m", "in"), ("in", "m"), ("m", "ni"), ("j", "i"), ("v", "y"), ("s", "5"), ("l", "1"), ("o", "0"),
)

#: Characters from which on a word may have two wrong places.
TWO = 5
HEADER_WORDS = 7
_HYPHENS = "-‐¬\u00ad"
_BREAK = re.compile(rf"([^\W_]+)([{_HYPHENS}])[ \t]*\r?\n[ \t]*([^\W_]+)")
_BROKEN_END = re.compile(rf"[{_HYPHENS}][ \t]*\r?\n")
_PAGE = re.compile(r"[^\w]*(?:(?:page|pagina|página|seite|folio|strona|str|pag|pág|p|s|f)\b\.?\s*)?(\d{1,6}|[ivxlcdm]{1,12})(?:\s*(?:of|/|von|de|sur|z|di)\s*\d{1,6})?[^\w]*", re.I)
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
_LETTERS = re.compile(r"[^\W\d_]{2,}")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n")
_TRAILING = re.compile(r"[\s\d]+$")
_SHAPED = re.compile(r"\||^\s*(?:\([A-Za-z0-9]{1,3}\)|[-*•])\s")


def roman(text: str) -> int:
    """The value of a roman number in either case; 0 if it is none."""
    total = 0
    values = [_ROMAN.get(c, 0) for c in text.lower()]
    if not values or 0 in values:
        return 0
    for a, b in zip(values, [*values[1:], 0]):
        total += -a if a < b else a
    return total


def is_page_number(text: str, page: int | None, printed: str | None = None) -> bool:
    """Is the text nothing but the number of ``page``?"""
    m = _PAGE.fullmatch(text.strip())
    if not m or page is None:
        return False
    return (int(m[1]) if m[1].isdigit() else roman(m[1])) == page


def folded(line: str) -> str:
    """A line without case and trailing number, the same however recognition confused its characters."""
    s = _TRAILING.sub("", line).lower()
    for a, b in (("ri", "n"), ("ii", "n"), ("rn", "m"), ("nn", "m"), ("in", "m"), ("ni", "m"), ("cl", "d"), ("vv", "w"), ("li", "h")):
        s = s.replace(a, b)
    return " ".join(s.translate(_FOLD).split())


_FOLD = str.maketrans({"0": "o", "a": "o", "1": "l", "i": "l", "5": "s", "6": "b", "h": "b", "9": "g", "c": "e", "t": "f", "u": "n"})


def header_line(text: str) -> str | None:
    """The first line where it may be a running header or footer: short, no sentence and no row.

    It has 2 to HEADER_WORDS words of two letters and more, and at most twice as many pieces and two between blanks.
    """
    first = text.strip().partition("\n")[0]
    if len(first.split()) > 2 * HEADER_WORDS + 2 or _SHAPED.search(first) or re.search(r"[.,;!?:]\s*$", _TRAILING.sub("", first)):
        return None
    n = len(_LETTERS.findall(first))
    if not 2 <= n <= HEADER_WORDS:
        return None
    return first


def texts_of(clusters: DataFrame, responses: DataFrame) -> DataFrame:
    """(origin, record_id, item_id, document_id, page, text) of the clusters and of the boxes of complete JSON."""
    own = clusters.where("text IS NOT NULL").select(F.lit("cluster").alias("origin"), F.col("page_id").cast("long").alias("record_id"), F.col("cluster_number").cast("long").alias("item_id"), "document_id", F.col("pdf_page_num").cast("int").alias("page"), "text")
    boxes = json_objects(responses).where("kind = 'raw_text' AND text IS NOT NULL").select("record_id", "object_id", "text")
    pages = responses.select(F.col("response_id").cast("long").alias("record_id"), "document_id", F.col("pdf_page_num").cast("int").alias("page")).distinct()
    raw = boxes.join(pages, "record_id").select(F.lit("box").alias("origin"), "record_id", F.col("object_id").alias("item_id"), "document_id", "page", "text")
    return own.unionByName(cut(raw))  # the texts are read several times, their JSON once


SCHEMA = "what string, origin string, record_id long, item_id long, document_id string, page int, text string, key long, pair long, n long, glued boolean"
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]


def _is_hyphen(cp: np.ndarray) -> np.ndarray:
    out = cp == ord(_HYPHENS[0])
    for c in _HYPHENS[1:]:
        out |= cp == ord(c)
    return out


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _U(0x9E3779B97F4A7C15) + b)


def _one(words: list[str]) -> np.ndarray:
    """The hash of each string as one word; 0 where it is none."""
    w = Words(words)
    out = np.zeros(len(words), _U)
    single = w.counts() == 1
    out[single] = w.hash[w.first[:-1][single]]
    return out


def _profile(texts: list[str], part: dict) -> list[tuple]:
    """Vocabulary counts, inline hyphen pairs, broken words, header lines and page numbers of a batch."""
    rows: list[tuple] = []
    w = Words(texts)
    if len(w.hash):
        at = w.base[w.doc] + w.end
        after = w.cp[at]
        hyphen = _is_hyphen(after)
        newline = w.cp[np.minimum(at + 1, len(w.cp) - 1)] == 10
        broken = hyphen & newline
        tail = np.zeros(len(w.hash), np.bool_)
        n = w.counts()
        tail[w.first[1:][n > 0] - 1] = True
        tail &= after == 0  # the last word of a text without an ending may be a piece
        piece = broken | tail
        piece[1:] |= broken[:-1]
        same = np.flatnonzero((w.doc[:-1] == w.doc[1:]) & hyphen[:-1] & ~newline[:-1] & (w.start[1:] == w.end[:-1] + 1))
        u, c = np.unique(_pair_key(w.hash[same], w.hash[same + 1]), return_counts=True)
        rows += [("pair", *[None] * 6, None, k, v, None) for k, v in zip(signed(u).tolist(), c.tolist())]
        ok = np.flatnonzero(~piece & (w.end - w.start >= 2))
        u, first, c = np.unique(w.hash[ok], return_index=True, return_counts=True)
        for k, i, v in zip(signed(u).tolist(), ok[first].tolist(), c.tolist()):
            word = texts[w.doc[i]][w.start[i] : w.end[i]].lower()
            if not word.isdigit():
                rows.append(("word", *[None] * 5, word, k, None, v, None))
    sites: list[tuple[int, str, str, str]] = []
    for i, (t, *ident) in enumerate(zip(texts, *(part[k] for k in _KEYS))):
        if _BROKEN_END.search(t):
            sites += [(i, m[1], m[2], m[3]) for m in _BREAK.finditer(t)]
        if is_page_number(t, ident[4]):
            rows.append(("number", *ident, None, None, None, None, None))
        elif line := header_line(t):
            rows.append(("line", *ident, folded(line), None, None, None, "\n" in t.strip()))
    if sites:
        whole, left, right = _one([a + b for _, a, _, b in sites]), _one([a for _, a, _, _ in sites]), _one([b for _, _, _, b in sites])
        pair = signed(_pair_key(left, right)).tolist()
        for (i, a, mark, b), k, p in zip(sites, signed(whole).tolist(), pair):
            hard = a.isalpha() and b.isalpha() and b[:1].islower()
            rows.append(("break", part["origin"][i], part["record_id"][i], part["item_id"][i], None, None, mark, k, p, int(hard), None))
    return rows


_KEYS = ("origin", "record_id", "item_id", "document_id", "page")


def profile(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                rows = _profile(piece.column("text").to_pylist(), {k: piece.column(k).to_pylist() for k in _KEYS})
                cols = list(zip(*rows)) if rows else [()] * len(_NAMES)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _NAMES)

    return texts.select(*_KEYS, "text").mapInArrow(run, SCHEMA)


def vocabulary(seen: DataFrame) -> DataFrame:
    """(key, word, n) over all texts."""
    return seen.where("what = 'word'").groupBy("key").agg(F.min("text").alias("word"), F.sum("n").alias("n"))


@cache
def _pieces() -> dict[str, tuple[str, ...]]:
    out: dict[str, list[str]] = {}
    for seen, meant in CONFUSIONS:
        out.setdefault(seen, []).append(meant)
    return {k: tuple(v) for k, v in out.items()}


def build_trie(words: list[str]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def candidates(trie: dict, word: str, most: int = 1, free: bool = True) -> list[tuple[str, int]]:
    """All words of the trie that ``word`` can be a misreading of, with the number of wrong places (1 to ``most``).

    States are (trie node, position in the word, wrong places): the automaton's transitions are a match, one confusion, or,
    if ``free``, any substitution, insertion or deletion, taken only where the trie has them, so nothing outside the
    vocabulary is ever formed.
    """
    out: dict[str, int] = {}
    todo = [(trie, 0, 0)]
    seen: dict[tuple[int, int], int] = {}
    table = _pieces()
    end = len(word)
    while todo:
        node, i, k = todo.pop()
        if seen.get((id(node), i), most + 1) <= k:
            continue
        seen[id(node), i] = k
        if i == end and k and "" in node and out.get(node[""], most + 1) > k:
            out[node[""]] = k
        if i < end and (nxt := node.get(word[i])) is not None:
            todo.append((nxt, i + 1, k))
        if k == most:
            continue
        for size in (1, 2) if i < end else ():
            for meant in table.get(word[i : i + size], ()) if i + size <= end else ():
                at = node
                for c in meant:
                    at = at.get(c)
                    if at is None:
                        break
                if at is not None:
                    todo.append((at, i + size, k + 1))
        if free:
            if i < end:
                todo.append((node, i + 1, k + 1))
            for c, nxt in node.items():
                if c:
                    todo.append((nxt, i, k + 1))
                    if i < end and c != word[i]:
                        todo.append((nxt, i + 1, k + 1))
    out.pop(word, None)
    return sorted(out.items())


def _left_out(word: str, most: int) -> set[str]:
    """The word without up to ``most`` of its characters; never empty strings."""
    out = last = {word}
    for _ in range(most):
        last = {x[:i] + x[i + 1 :] for x in last for i in range(len(x))}
        out = out | last
    return out - {""}


def _put_back(word: str, most: int) -> dict[str, int]:
    """The word with up to ``most`` merges and splits of the table put back, each with their number."""
    out = {word: 0}
    todo = [("", word, 0)]
    while todo:
        done, rest, k = todo.pop()
        for i in range(len(rest)):
            for size in (1, 2):
                for meant in _pieces().get(rest[i : i + size], ()) if i + size <= len(rest) else ():
                    if max(size, len(meant)) > 1:
                        head, tail = done + rest[:i] + meant, rest[i + size :]
                        if out.get(head + tail, most + 1) > k + 1:
                            out[head + tail] = k + 1
                        if k + 1 < most:
                            todo.append((head, tail, k + 1))
    return out


#: Length from which words meet by equal pieces, of which two wrong places leave one whole, and not by what is left of them.
LONG = 24
PIECES = 5


def _cuts(n: int) -> list[int]:
    return [n * i // PIECES for i in range(PIECES + 1)]


def meeting_forms(word: str, asked: bool) -> set[str]:
    """What a word and the words it may be misread from have in common: at least one form, of ``word`` as asked and of each of those as known.

    A long word is cut into five pieces: a wrong place spoils two of them at most, as when a merge stands where they meet, and
    moves the rest by one. So a word as asked gives, for every length the other may have, its pieces at every shift.
    """
    n, out = len(word), set()
    if asked:
        if n > LONG:
            for m in range(n - 2, n + 3):
                at = _cuts(m)
                out |= {f"{m}:{i}:{word[a + d : b + d]}" for i, (a, b) in enumerate(zip(at[:-1], at[1:])) for d in range(-2, 3) if a + d >= 0 and b + d <= n}
            return out
        most = 2 if n >= TWO else 1
        return {x for form, k in _put_back(word, most).items() for x in _left_out(form, most - k)}
    if n > LONG - 2:
        at = _cuts(n)
        out |= {f"{n}:{i}:{word[a:b]}" for i, (a, b) in enumerate(zip(at[:-1], at[1:]))}
    return out | _left_out(word, 2) if n <= LONG + 2 else out


def _forms(words: DataFrame, asked: bool) -> DataFrame:
    """(form, word, n) of (word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [(f, w, n) for w, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for f in meeting_forms(w, asked)]
                cols = list(zip(*rows)) if rows else [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))], ["form", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "form string, word string, n long")


def near_words(vocab: DataFrame, sure: DataFrame, ratio: float = 10.0) -> DataFrame:
    """(key, word, meant, n_meant, rank): words that ``sure`` has not, with all words within the automaton's reach at least ``ratio`` times as common.

    rank is higher the fewer places are wrong and, among these, where confusions alone explain them.
    """
    letters = vocab.where(F.col("word").rlike(r"\p{L}"))
    known = _forms(letters.where(F.col("n") >= ratio).where(~F.col("word").rlike(r"\d")), False).select("form", F.col("word").alias("meant"), F.col("n").alias("n_meant"))
    met = _forms(letters.join(sure.select("key").distinct(), "key", "left_anti"), True).join(known, "form").where((F.col("n_meant") >= F.col("n") * ratio) & (F.col("word") != F.col("meant")))
    by = met.groupBy("word").agg(F.collect_set(F.struct("meant", "n_meant")).alias("near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for w, near in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                common = {x["meant"]: x["n_meant"] for x in near}
                trie, most = build_trie(list(common)), 2 if len(w) >= TWO else 1
                plain = dict(candidates(trie, w, most, free=False))
                rows += [(w, m, common[m], 2 * (most - k) + (plain.get(m) == k)) for m, k in candidates(trie, w, most)]
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int32()))], ["word", "meant", "n_meant", "rank"])

    found = by.mapInArrow(run, "word string, meant string, n_meant long, rank int")
    return found.join(vocab.select("word", "key"), "word").select("key", "word", "meant", "n_meant", "rank")


def misreadings(vocab: DataFrame, ratio: float = 10.0) -> DataFrame:
    """(key, word, meant, n_meant): words with the words at least ``ratio`` times as common that one confusion of the table makes them from.

    One confusion leaves a word's first or its last character whole, so words and vocabulary meet by either, per length.
    """
    side = lambda i: F.struct(F.lit(i).alias("side"), (F.substring("word", 1, 1) if i == 0 else F.substring("word", -1, 1)).alias("c"))
    two = F.explode(F.array(side(0), side(1))).alias("s")
    letters = vocab.where(F.length("word") >= 3)
    known = letters.where("n >= {r}".format(r=ratio)).where(~F.col("word").rlike(r"\d")).select(F.col("word").alias("meant"), F.col("n").alias("n_meant"), two, F.length("word").alias("at_len")).select("meant", "n_meant", F.col("s.side").alias("at_side"), F.col("s.c").alias("at_c"), "at_len")
    digit = F.col("word").rlike(r"\d")
    asked = letters.where((F.length("word") >= 4) | digit).where(F.col("word").rlike(r"\p{L}"))
    asked = asked.select("key", "word", "n", two, F.length("word").alias("l")).select("key", "word", "n", "s.*", F.explode(F.array(F.col("l") - 1, F.col("l"), F.col("l") + 1)).alias("len"))

    def search(asked: pa.Table, known: pa.Table) -> pa.Table:
        rows = []
        if asked.num_rows and known.num_rows:
            words, counts = known.column("meant").to_pylist(), known.column("n_meant").to_pylist()
            trie, common, top = build_trie(words), dict(zip(words, counts)), max(counts)
            for k, w, n in zip(*(asked.column(c).to_pylist() for c in ("key", "word", "n"))):
                if n * ratio <= top:
                    rows += [(k, w, m, common[m], c) for m, c in candidates(trie, w, free=False) if common[m] >= n * ratio]
        cols = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], ["key", "word", "meant", "n_meant", "places"])

    keys = ["side", "c", "len"]
    found = asked.groupBy(*keys).cogroup(known.groupBy(*[f"at_{k}" for k in keys])).applyInArrow(search, "key long, word string, meant string, n_meant long, places int")
    return found.distinct()


def occurrences(texts: DataFrame, keys: DataFrame, phrase: bool = False) -> DataFrame:
    """(origin, record_id, item_id, key, before, after): where words with such keys stand, pieces of broken words left out.

    before and after are 0 where there is no neighbour, with ``phrase`` also where a mark stands between.
    """
    sent = texts.sparkSession.sparkContext.broadcast(bitfilter.build(keys, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            for part in chunks(batch, "text"):
                w = Words(part.column("text").to_pylist())
                hit = bitfilter.probe(bits, w.hash)
                if len(hit):
                    at = w.base[w.doc] + w.end
                    broken = _is_hyphen(w.cp[at]) & (w.cp[np.minimum(at + 1, len(w.cp) - 1)] == 10)
                    hit &= ~broken
                    hit[1:] &= ~broken[:-1]
                i = np.flatnonzero(hit)
                near = np.concatenate([[_U(0)], w.hash, [_U(0)]]).astype(_U)
                own = np.concatenate([[-1], w.doc, [-1]])
                left, right = own[i] == w.doc[i], own[i + 2] == w.doc[i]
                if phrase and len(i):
                    blank = lambda k: np.isin(w.cp[k], (32, 10, 13, 9, 160))
                    first = w.base[w.doc] + w.start
                    last = len(w.hash) - 1
                    left &= blank(first[i] - 1) & blank(at[np.maximum(i - 1, 0)])
                    right &= blank(at[i]) & blank(first[np.minimum(i + 1, last)] - 1)
                before = np.where(left, near[i], _U(0))
                after = np.where(right, near[i + 2], _U(0))
                row = pa.array(w.doc[i])
                cols = [part.column(c).take(row) for c in ("origin", "record_id", "item_id")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(signed(w.hash[i])), pa.array(signed(before)), pa.array(signed(after))], ["origin", "record_id", "item_id", "key", "before", "after"])

    found = texts.select("origin", "record_id", "item_id", "text").mapInArrow(run, "origin string, record_id long, item_id long, key long, before long, after long")
    return found.join(keys.select("key").distinct(), "key", "left_semi")


def broken_words(seen: DataFrame, vocab: DataFrame) -> DataFrame:
    """(origin, record_id, item_id, joined key, is_word) of words over a line end; is_word: one word, not a compound."""
    pairs = seen.where("what = 'pair'").groupBy("pair").agg(F.sum("n").alias("n_pair"))
    at = seen.where("what = 'break'").select("origin", "record_id", "item_id", "key", "pair", F.col("text").alias("mark"), (F.col("n") == 1).alias("plain"))
    both = at.join(vocab.select("key", F.col("n").alias("n_word")), "key", "left").join(pairs, "pair", "left")
    w, p = F.coalesce("n_word", F.lit(0)), F.coalesce("n_pair", F.lit(0))
    return both.select("origin", "record_id", "item_id", "key", (F.when((w > 0) | (p > 0), w > p).otherwise(F.col("plain"))).alias("is_word"))


def running_lines(seen: DataFrame, pages: int = 2) -> DataFrame:
    """(origin, document_id, text): folded first lines that stand on at least ``pages`` pages of their document."""
    lines = seen.where("what = 'line' AND text <> ''").select("origin", "document_id", "text", "page").distinct()
    return lines.groupBy("origin", "document_id", "text").count().where(F.col("count") >= pages).drop("count")


def bigram_counts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pair, n): how often each wanted pair of neighbouring words stands in the corpus."""
    sent = texts.sparkSession.sparkContext.broadcast(bitfilter.build(wanted, "pair"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            for part in chunks(batch, "text"):
                w = Words(part.column("text").to_pylist())
                same = np.flatnonzero(w.doc[:-1] == w.doc[1:])
                k = _pair_key(w.hash[same], w.hash[same + 1])
                u, n = np.unique(k[bitfilter.probe(bits, k)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(u)), pa.array(n)], ["pair", "n"])

    return texts.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).join(wanted.select("pair").distinct(), "pair", "left_semi")


def _context_pairs(spots: DataFrame) -> DataFrame:
    """Adds the pair keys of each candidate with the word before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = _one(b.column("meant").to_pylist())
            left, right = (b.column(c).to_numpy().view(_U) for c in ("before", "after"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(signed(_pair_key(left, own))), pa.array(signed(_pair_key(own, right)))], [*b.schema.names, "pair_l", "pair_r"])

    cols = "origin string, record_id long, item_id long, key long, before long, after long, word string, meant string, n_meant long"
    return spots.select(*[c.split()[0] for c in cols.split(", ")]).mapInArrow(run, cols + ", pair_l long, pair_r long")


def corrections(texts: DataFrame, wrong: DataFrame) -> DataFrame:
    """(origin, record_id, item_id, word, meant): the best candidate for each misread word of each text.

    Candidates are ranked by how often they stand next to the same neighbours, then by how common they are.
    """
    spots = cut(_context_pairs(occurrences(texts, wrong).join(wrong.select("key", "word", "meant", "n_meant"), "key")))
    wanted = spots.select(F.col("pair_l").alias("pair")).union(spots.select("pair_r")).distinct()
    n = cut(bigram_counts(texts, wanted))
    both = spots.join(n.select(F.col("pair").alias("pair_l"), F.col("n").alias("n_l")), "pair_l", "left").join(n.select(F.col("pair").alias("pair_r"), F.col("n").alias("n_r")), "pair_r", "left")
    near = F.coalesce("n_l", F.lit(0)) + F.coalesce("n_r", F.lit(0))
    return both.groupBy("origin", "record_id", "item_id", "word").agg(F.max_by("meant", F.struct(near, "n_meant", "meant")).alias("meant"))


def near_misreadings(texts: DataFrame, at: DataFrame, near: DataFrame, vocab: DataFrame, ratio: float = 10.0) -> DataFrame:
    """(origin, record_id, item_id, word, meant): the words of ``near_words`` in places where a candidate fits both neighbours ``ratio`` times as often. at: their ``occurrences``.

    Numbers say nothing about the word beside them (26 marzo 2012, 26 March 2012): a place
    without two neighbouring words, or with a mark between, is not judged.
    """
    words = vocab.where(F.col("word").rlike(r"\p{L}"))
    at = at.where("before <> 0 AND after <> 0").join(words.select(F.col("key").alias("before")), "before", "left_semi").join(words.select(F.col("key").alias("after")), "after", "left_semi")
    spots = cut(_context_pairs(at.join(near.select("key", "word", "meant", "n_meant"), "key")).join(near.select("key", "meant", "rank"), ["key", "meant"]))
    own = _own_pairs(spots)
    wanted = own.select(F.explode(F.array("pair_l", "pair_r", "own_l", "own_r")).alias("pair")).distinct()
    n = cut(bigram_counts(texts, wanted))
    count = lambda c: n.select(F.col("pair").alias(c), F.col("n").alias(f"n_{c}"))
    both = own.join(count("pair_l").where(F.col("n_pair_l") >= ratio), "pair_l").join(count("pair_r").where(F.col("n_pair_r") >= ratio), "pair_r")
    both = both.join(count("own_l"), "own_l").join(count("own_r"), "own_r").where((F.col("n_pair_l") >= F.col("n_own_l") * ratio) & (F.col("n_pair_r") >= F.col("n_own_r") * ratio))
    return both.groupBy("origin", "record_id", "item_id", "word").agg(F.max_by("meant", F.struct("rank", F.col("n_pair_l") + F.col("n_pair_r"), "n_meant", "meant")).alias("meant"))


def _own_pairs(spots: DataFrame) -> DataFrame:
    """Adds the pair keys of the word itself with the word before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, own, right = (b.column(c).to_numpy().view(_U) for c in ("before", "key", "after"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(signed(_pair_key(left, own))), pa.array(signed(_pair_key(own, right)))], [*b.schema.names, "own_l", "own_r"])

    cols = "origin string, record_id long, item_id long, key long, before long, after long, word string, meant string, n_meant long, pair_l long, pair_r long, rank int"
    return spots.select(*[c.split()[0] for c in cols.split(", ")]).mapInArrow(run, cols + ", own_l long, own_r long")


def _same_case(word: str, like: str) -> str:
    if like.isupper() and len(like) > 1:
        return word.upper()
    return word[:1].upper() + word[1:] if like[:1].isupper() else word


def repair_text(text: str, fixes: dict[str, str], joined: set[str], header: bool, number: bool) -> str:
    """The text with the lines of each paragraph joined; blank lines stay between paragraphs. joined: the broken words, in lower case without their hyphen."""
    if number:
        return ""
    if header:
        _, _, text = text.strip().partition("\n")
    if _BROKEN_END.search(text):
        text = _BREAK.sub(lambda m: m[1] + m[3] if (m[1] + m[3]).lower() in joined else m[1] + "-" + m[3], text)
    text = re.sub(r"[^\W_]+", lambda m: _same_case(fixes[m[0].lower()], m[0]) if m[0].lower() in fixes else m[0], text)
    return "\n\n".join(" ".join(p.split()) for p in _PARAGRAPH.split(text) if p.strip())


def paragraphs(fixed: DataFrame) -> DataFrame:
    """(origin, document_id, page, item_id, n_parts, paragraph) of ``repaired`` texts: what goes on in the next text of the page, or on the next page, is one paragraph, found where it begins.

    A text goes on if it ends in a hyphen or without an end mark and the one that follows begins in lower case; page furniture,
    which is empty by now, doesn't stand between. Null documents and pages keep their texts apart.
    """
    ident = ["origin", "document_id", "page"]
    rows = fixed.where("repaired_text <> ''").select(*ident, "item_id", F.col("repaired_text").alias("t")).distinct()
    open_ = F.col("t").rlike(rf"[{_HYPHENS}]$") | ~F.col("t").rlike(r"[.!?:;…][\"'”’»)\]]*$")
    w = Window.partitionBy(*ident).orderBy("item_id", "t")
    rows = rows.withColumns({"open": open_, "low": F.col("t").rlike(r"^\p{Ll}"), "nth": F.row_number().over(w)})
    rows = cut(rows.withColumn("before", F.lag("open").over(w)))
    last = rows.groupBy(*ident).agg(F.max_by("open", "nth").alias("left_open")).select("origin", "document_id", (F.col("page") + 1).alias("page"), "left_open")
    rows = rows.join(last, ident, "left").withColumn("on", F.col("low") & F.coalesce(F.when(F.col("nth") == 1, F.col("left_open")).otherwise(F.col("before")), F.lit(False)))
    # the text a paragraph begins with: on the page, or where the paragraph that the page before leaves open begins
    mark = F.when(~F.col("on"), F.struct(F.col("page").alias("p"), F.col("nth").alias("n")))
    rows = cut(rows.withColumn("start", F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    tail = rows.groupBy(*ident).agg(F.max_by("start", "nth").alias("tail")).select("origin", "document_id", F.col("page").alias("to"), "tail")
    need = cut(rows.where("start IS NULL").select(*ident).distinct().withColumn("to", F.col("page") - 1))
    done = None
    while need.limit(1).count():  # pages that lie in one paragraph from end to end pass it on
        got = cut(need.join(tail, ["origin", "document_id", "to"]))
        found = got.where("tail IS NOT NULL").select(*ident, "tail")
        done = found if done is None else done.unionByName(found)
        need = cut(got.where("tail IS NULL").select(*ident, (F.col("to") - 1).alias("to")))
    if done is not None:
        rows = rows.join(done, ident, "left").withColumn("start", F.coalesce("start", "tail")).drop("tail")
    part = F.struct("page", "nth", "t", "item_id")
    g = rows.groupBy("origin", "document_id", F.coalesce("start.p", "page").alias("page"), F.coalesce("start.n", "nth").alias("nth")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    glued = F.aggregate("parts", F.lit(""), lambda a, x: F.when(a == "", x["t"]).when(a.rlike(rf"[{_HYPHENS}]$"), F.concat(F.regexp_replace(a, rf"[{_HYPHENS}]$", ""), x["t"])).otherwise(F.concat(a, F.lit(" "), x["t"])))
    return g.select("origin", "document_id", "page", F.col("parts")[0]["item_id"].alias("item_id"), F.size("parts").alias("n_parts"), glued.alias("paragraph"))


def repaired(clusters: DataFrame, responses: DataFrame) -> DataFrame:
    """(origin, record_id, item_id, document_id, page, repaired_text, n_fixed) of every text, page furniture empty."""
    texts = texts_of(clusters, responses)
    seen = cut(profile(texts))
    vocab = cut(vocabulary(seen))
    item = ["origin", "record_id", "item_id"]
    sure = cut(misreadings(vocab))
    near = cut(near_words(vocab, sure))
    fixes = corrections(texts, sure).unionByName(near_misreadings(texts, occurrences(texts, near, phrase=True), near, vocab)).groupBy(*item).agg(F.map_from_entries(F.collect_set(F.struct("word", "meant"))).alias("fixes"))
    whole = broken_words(seen, vocab).where("is_word").groupBy(*item).agg(F.collect_set("key").alias("joined"))
    run = seen.where("what = 'line'").join(running_lines(seen), ["origin", "document_id", "text"], "left_semi").select(*item, F.lit(True).alias("header")).distinct()
    number = seen.where("what = 'number'").select(*item, F.lit(True).alias("number")).distinct()
    rows = texts.distinct().join(fixes, item, "left").join(whole, item, "left").join(run, item, "left").join(number, item, "left")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                out, n = [], []
                for t, f, j, h, p in zip(*(part.column(c).to_pylist() for c in ("text", "fixes", "joined", "header", "number"))):
                    f, keys = dict(f or ()), set(j or ())
                    found = [m[1] + m[3] for m in _BREAK.finditer(t)] if keys else []
                    words = {x.lower() for x, k in zip(found, signed(_one(found)).tolist()) if k in keys} if found else set()
                    out.append(repair_text(t, f, words, bool(h), bool(p)))
                    n.append(len(f) + len(words))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in _KEYS), pa.array(out, pa.string()), pa.array(n, pa.int64())], [*_KEYS, "repaired_text", "n_fixed"])

    return rows.select(*_KEYS, "text", "fixes", "joined", "header", "number").mapInArrow(go, "origin string, record_id long, item_id long, document_id string, page int, repaired_text string, n_fixed long")


def noise(clusters: DataFrame, responses: DataFrame) -> DataFrame:
    """(origin, record_id, item_id, kind): one row per kind of noise in a text."""
    texts = texts_of(clusters, responses)
    seen = cut(profile(texts))
    vocab = cut(vocabulary(seen))
    item = ["origin", "record_id", "item_id"]
    kind = lambda df, k: df.select(*item, F.lit(k).alias("kind")).distinct()
    wrong = cut(misreadings(vocab).select("key").distinct())
    run = seen.where("what = 'line'").join(running_lines(seen), ["origin", "document_id", "text"], "left_semi")
    out = kind(broken_words(seen, vocab).where("is_word"), "hyphen")
    near = cut(near_words(vocab, wrong))
    at = cut(occurrences(texts, wrong.unionByName(near.select("key")), phrase=True))
    out = out.unionByName(kind(at.join(wrong, "key", "left_semi").select(*item).unionByName(near_misreadings(texts, at, near, vocab).select(*item)), "misread"))
    return out.unionByName(kind(run, "running")).unionByName(kind(seen.where("what = 'number'"), "page_number"))
