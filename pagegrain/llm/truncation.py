"""Texts cut short by a field limit or a broken transfer.

Two kinds of evidence. Near-copies: texts without an ending are sought in all texts by min-hash banding of five-word
shingles. A cut copy shares the beginning of the whole one, however much of it is left, so signatures are those of beginnings: of
every length on a grid that grows by a quarter, for a text without an ending only of the longest that fits. Whoever shares a
band with it shares nearly all of that beginning. Equal texts count once. Each band and length class is stood for by its
longest text, so a group of a million edited copies is a row per class and not their pairs; a text is aligned with the
longer ones it meets, 16 bands giving it as many chances. If 0.8 or more of its shingles are in the other and the
alignment ends at its end while the other goes on, it is cut. What the bands leave open is sought exactly: a text of u
shingles may lack 0.2 u of them, so of one more than that many, the rarest by a count sketch, a copy has one at least, and
one of the last three besides; the longer texts that have both are aligned with it, wherever the copy stands in them, in
blocks that grow until one bears it out or none is left. So the copies found are those among all pairs, whatever the bands
miss or the longest text hides. Texts of less than ten words are headings rather than copies and not compared. Closing
words: for what has no such copy, counts over the whole corpus say how often the text's last word closes a sentence or a
text at all. An ending in a mark for the lost rest is a cut by itself; a text that the document's next page carries on is
none, and neither are headings, labels, table rows and list items.

What is sent to every task is bit filters of bounded size and the count sketch (4 MB), which only order and drop early; all
else is joined by key. Null and blank texts are never cut; repeated rows count once in the result; texts may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bitfilter
from ..functions.textvec import Words, _tables, chunks, distinct_per_text, mix64, signed
from ..session import cut

_U = np.uint64
BANDS, ROWS, SHINGLE, SIMILAR = 16, 4, 5, 0.8
BUCKETS, PARTS = 1 << 20, 16  # of the count sketch
BLOCK = 64  # texts that are aligned first of those that hold a shingle
LAST = 3  # shingles of which a cut copy's end must have one
_END = _U(0xA24BAED4963EE407)  # tells the keys of ends from others in one filter
_OPENING = "“«„\"'¿¡( "
_MARK = re.compile(r"(?:…|\.\.\.|\[\s*(?:…|\.\.\.)\s*\]|�)\s*$")
_SHUT = "\"'”“»’)]" + "".join(c for c in map(chr, range(0x110000)) if c.isspace())
_LIST = re.compile(r"\s*(?:\([A-Za-z0-9]{1,3}\)|[-*•–]\s|\d{1,3}[.)]\s)")
_ROW = re.compile(r"\S\s*[|\t]\s*\S")
#: Words that a heading, label or page number may have at most, its own number included.
HEADING_WORDS = 6

SCHEMA = (
    "kind string, uid long, document_id string, page int, number int, mark boolean, n_words int, inner boolean, capital boolean, "
    "word long, second long, low boolean, bands array<long>, counts array<long>, h long, grams array<long>, packed binary"
)
_FIELDS = [f.strip().split()[0] for f in SCHEMA.split(",")]
_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.binary()]


def _grid() -> np.ndarray:
    """Lengths in words of the beginnings that are compared: from two shingles on, each a quarter longer."""
    out = [2 * SHINGLE]
    while out[-1] < 1 << 40:
        out.append(-(-out[-1] * 5 // 4))
    return np.array(out, np.int64)


GRID = _grid()


def length_class(n: np.ndarray) -> np.ndarray:
    """Number of the longest grid length that fits ``n`` words; -1 for none."""
    return np.searchsorted(GRID, n, side="right") - 1


def _bands(w: Words, which: np.ndarray, longest: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, grid number, band keys) of the beginnings of the texts ``which``, or of the longest ones only."""
    top = np.full(w.n_texts, -1, np.int64)
    top[which] = length_class(w.counts()[which])
    at, h = w.grams(SHINGLE)
    doc = w.doc[at]
    level = np.searchsorted(GRID, at - w.first[doc] + SHINGLE)
    keep = level <= top[doc]
    doc, level, h = doc[keep], level[keep], h[keep]
    if not len(doc):
        return doc, level, np.zeros((0, BANDS), _U)
    at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (level[1:] != level[:-1])]))
    doc, level = doc[at], level[at]  # a row per text and grid number, in order
    last = np.concatenate([doc[1:] != doc[:-1], [True]])
    picked = np.flatnonzero(last) if longest else np.arange(len(doc))
    steps = [np.flatnonzero(level == j) for j in range(1, int(level.max()) + 1)]
    keys = np.zeros((len(picked), BANDS), _U)
    for b in range(BANDS):
        key = mix64((level[picked] * BANDS + b + 1).astype(_U))
        for r in range(ROWS):
            k = b * ROWS + r
            mul = _U(0x9E3779B97F4A7C15 * (2 * k + 1) & 0xFFFFFFFFFFFFFFFF) | _U(1)
            low = np.minimum.reduceat(((h ^ _U(k * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * mul) >> _U(8), at)
            for i in steps:  # a beginning holds the shorter ones
                low[i] = np.minimum(low[i], low[i - 1])
            key = mix64(key * _U(0xD6E8FEB86659FD93) + low[picked])
        keys[:, b] = key
    return doc[picked], level[picked], keys


def _closing_key(w: Words) -> np.ndarray:
    """Word hashes, with one value for all words that begin with a digit."""
    first = w.cp[w.base[w.doc] + w.start]
    return np.where((first >= 48) & (first <= 57), _U(35), w.hash)


def _marked(s: str) -> bool:
    """Does a text without outer blanks end in a mark for its rest?"""
    return s.endswith(("…", "...", "�")) or (s[-1:] == "]" and bool(_MARK.search(s)))


def _closed(text: str) -> bool:
    """Does the text end in a full stop or the like, whatever quotes or brackets close after it?"""
    return text.rstrip(_SHUT).endswith((".", "!", "?"))


def _heading_line(text: str) -> str:
    """The text without a short first line that could have held the second line's first word: a running header."""
    first, line, rest = text.partition("\n")
    if not line or len(first.split()) > HEADING_WORDS + 2 or _closed(first) or re.search(r"[,;]\s*$", first):
        return text
    lines = rest.split("\n")
    width = max(map(len, lines))
    short = len(first) + 1 + len((lines[0].split() or [""])[0]) <= width - 2 or len(lines) == 1
    return rest if short and first[:1].isupper() else text


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> _U(44)).astype(np.int64)


def _features(texts: list[str | None], uid, document, page, number, same, total: np.ndarray) -> tuple[list[tuple], list[tuple]]:
    """Rows of SCHEMA's first fields, and the candidates'; the shingles of all texts are counted into ``total``."""
    w = Words(texts)
    alnum, lower, _ = _tables()
    key = _closing_key(w)
    n = w.counts()
    rows: list[tuple] = []
    if len(key):
        after = w.cp[w.base[w.doc] + w.end]
        ends = np.isin(after, np.array([ord(c) for c in ".!?…"], np.uint32))
        last = np.zeros(len(key), np.bool_)
        last[w.first[1:][n > 0] - 1] = True
        start = np.zeros(len(key), np.bool_)
        start[w.first[:-1][n > 0]] = True
        start[1:] |= ends[:-1]
        first = w.cp[w.base[w.doc] + w.start]
        capital = lower[first] != first

        def tally(kind: str, k: np.ndarray, *flags: np.ndarray) -> None:
            u, inv = np.unique(k, return_inverse=True)
            cols = [np.bincount(inv, minlength=len(u)), *(np.bincount(inv, f, minlength=len(u)).astype(np.int64) for f in flags)]
            rows.extend((kind, None, None, None, None, None, None, None, None, v, None, None, None, c, None) for v, c in zip(signed(u).tolist(), np.stack(cols, 1).tolist()))

        prose = n[w.doc] > HEADING_WORDS  # what closes a sentence is seen in prose, not in labels such as "p. 7"
        tally("word", key, prose, ends & prose, last, start, capital, capital & start)
        two = np.flatnonzero(capital[:-1] & (w.doc[1:] == w.doc[:-1]))
        tally("after", key[two + 1], start[two])
    flags = []
    for i, t in enumerate(texts):
        if t is None or not t.strip() or n[i] == 0:
            flags.append(None)
            continue
        s = t.strip()
        mark = _marked(s)
        shaped = bool((("|" in s or "\t" in s) and _ROW.search(s)) or _LIST.match(s))
        closed = _closed(s) and not mark
        flags.append((mark, closed, shaped, s))
    cand = [i for i, f in enumerate(flags) if f and (f[0] or not (f[1] or f[2])) and (f[0] or n[i] >= 2)]
    own, _, keys = _bands(w, np.array(cand, np.int64), longest=True)
    bands = dict(zip(own.tolist(), signed(keys).tolist()))
    at, g = w.grams(SHINGLE)
    total += np.bincount(_bucket(g), minlength=BUCKETS)
    from_ = np.searchsorted(at, w.first[:-1])
    cuts: list[tuple] = []
    for i in cand:
        mark, _, _, s = flags[i]
        j = w.first[i + 1] - 1
        inner = bool(re.search(r"[,;»”“«„]|\s[–—]\s|[.!?]\s", s.rstrip(",;")[:-1])) or s[-1:] in ",;"
        cuts.append(("cut", uid[i], document[i], page[i], number[i], mark, int(n[i]), inner, bool(lower[w.cp[w.base[i] + w.start[j]]] != w.cp[w.base[i] + w.start[j]]), int(signed(key[j : j + 1])[0]), None, None, bands.get(i), None, same[i], signed(g[from_[i] : from_[i] + n[i] - SHINGLE + 1]) if n[i] >= GRID[0] else None, None))
    prose: dict[tuple, int | None] = {}  # the last of each page
    opens: dict[tuple, tuple[int, tuple]] = {}  # the first of each page that has words
    k = signed(key)
    for i, f in enumerate(flags):
        if not f or f[2]:
            continue
        where, at_ = (document[i], page[i]), number[i]
        if n[i] > HEADING_WORDS or f[0]:
            seen = prose.get(where)
            prose[where] = seen if at_ is None else at_ if seen is None else max(at_, seen)
        if at_ is None or where in opens and opens[where][0] <= at_:
            continue
        if n[i] > HEADING_WORDS or f[1]:
            t = _heading_line(f[3])
        elif f[3][:1].islower() and len(f[3]) > 8:
            t = f[3]
        else:
            continue
        a, b = int(w.first[i]), int(w.first[i + 1])
        if len(t) < len(f[3]):
            a += int(np.searchsorted(w.start[a:b], len(texts[i]) - len(texts[i].lstrip()) + len(f[3]) - len(t)))
        if b > a:
            low, quoted = not t.lstrip(_OPENING)[:1].isupper(), t[:1] in _OPENING
            opens[where] = at_, (*[None] * 4, int(k[a]), int(k[a + 1]) if b > a + 1 else None, low, None, [int(quoted)], None)
    rows.extend(("prose", None, *where, last, *[None] * 10) for where, last in prose.items())
    rows.extend(("open", None, *where, at_, *opener) for where, (at_, opener) in opens.items())
    return rows, cuts


def _scan(clusters: DataFrame) -> DataFrame:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array(x, t) for x, t in zip(zip(*rows), _TYPES)]
        return pa.RecordBatch.from_arrays(cols + [pa.nulls(len(rows), t) for t in _TYPES[len(cols) :]], _FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                c = {f: part.column(f).to_pylist() for f in ("text", "cluster_uid", "document_id", "pdf_page_num", "cluster_number", "same")}
                yield from map(out, _features(c["text"], c["cluster_uid"], c["document_id"], c["pdf_page_num"], c["cluster_number"], c["same"], total))
        yield out([("sketch", None, None, None, i, *[None] * 11, zlib.compress(x.tobytes(), 1)) for i, x in enumerate(np.split(total, PARTS)) if x.any()])

    return clusters.select(F.col("cluster_uid").cast("long").alias("cluster_uid"), "document_id", F.col("pdf_page_num").cast("int").alias("pdf_page_num"), F.col("cluster_number").cast("int").alias("cluster_number"), "text", F.xxhash64("text").alias("same")).mapInArrow(run, SCHEMA)


def _sketch(seen: DataFrame) -> np.ndarray:
    """How many shingles of the corpus fall into each bucket."""

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in pdf["packed"])
        return pd.DataFrame({"number": [key[0]], "packed": [zlib.compress(total.tobytes(), 1)]})

    got = seen.where("kind = 'sketch'").select("number", "packed").groupBy("number").applyInPandas(add, "number int, packed binary").collect()  # PARTS rows
    by = {r["number"]: np.frombuffer(zlib.decompress(bytes(r["packed"])), np.int64) for r in got}
    total = np.concatenate([by.get(i, np.zeros(BUCKETS // PARTS, np.int64)) for i in range(PARTS)])
    return np.minimum(total, 2**31 - 1).astype(np.int32)


def _ends(grams: np.ndarray) -> np.ndarray:
    """The bit of each shingle in the sign of the ends a text may carry on."""
    return _U(1) << (grams & _U(63))


def _rarest(cands: DataFrame, counts: np.ndarray, similar: float = SIMILAR) -> DataFrame:
    """(h, n_words, ends, k): of each text without an ending the shingles k of which a copy has one, and the sign of its last."""
    sent = cands.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("grams")
            off, values = col.offsets.to_numpy(), col.values.to_numpy().view(_U)
            keys, signs = [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                u = np.unique(values[a:b])
                lack = len(u) - int(np.ceil(similar * len(u)))
                keys.append(u[np.argsort(sent.value[_bucket(u)], kind="stable")[: lack + 1]])
                signs.append(np.bitwise_or.reduce(_ends(values[b - LAST : b])))
            if keys:
                rows = np.repeat(np.arange(len(keys)), list(map(len, keys)))
                cols = [batch.column("h").take(pa.array(rows)), batch.column("n_words").take(pa.array(rows)), pa.array(signed(np.array(signs, _U)[rows])), pa.array(signed(np.concatenate(keys)))]
                yield pa.RecordBatch.from_arrays(cols, ["h", "n_words", "ends", "k"])

    return cut(cands.where("grams IS NOT NULL").select("h", "n_words", "grams").dropDuplicates(["h"]).mapInArrow(run, "h long, n_words int, ends long, k long"))


def _held(clusters: DataFrame, cands: DataFrame, rarest: DataFrame | None = None) -> DataFrame:
    """(k, other, n, size, ends): of texts that go on after a shingle that may be a candidate's last, the bands that may be a
    candidate's, with size, the longest text of a batch for each; and with ends, the shingles that may be among its rarest."""
    last = F.transform(F.slice("grams", -LAST, LAST), lambda x: x.bitwiseXOR(F.lit(int(signed(np.array([_END]))[0]))))
    keys = cands.where("grams IS NOT NULL").select(F.explode(F.concat("bands", last)).alias("k"))
    keys = cut((keys if rarest is None else keys.union(rarest.select("k"))).distinct())
    sent = clusters.sparkSession.sparkContext.broadcast(bitfilter.build(keys, "k"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                same = part.column("same").to_numpy()
                w = Words(part.column("text").to_pylist())
                n = w.counts()
                at, g = w.grams(SHINGLE)
                doc = w.doc[at]
                on = np.flatnonzero(w.first[doc + 1] - at > SHINGLE)  # words follow
                on = on[bitfilter.probe(sent.value, g[on] ^ _END)]
                ends = np.zeros(len(n), _U)
                np.bitwise_or.at(ends, doc[on], _ends(g[on]))
                own, _, bands = _bands(w, np.flatnonzero(ends))
                i, j = np.nonzero(bitfilter.probe(sent.value, bands)) if len(own) else (own, own)
                k, d = signed(bands[i, j]), own[i]
                size = length_class(n[d])
                order = np.lexsort((same[d], n[d], size, k))
                k, d, size = k[order], d[order], size[order]
                best = np.flatnonzero(np.concatenate([(k[1:] != k[:-1]) | (size[1:] != size[:-1]), [True]])) if len(k) else order
                k, d, size = k[best], d[best], size[best].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(same[d]), pa.array(n[d].astype(np.int32)), pa.array(size), pa.nulls(len(k), pa.int64())], names)
                at = np.flatnonzero(ends[doc])
                at = at[bitfilter.probe(sent.value, g[at])]
                d, k = distinct_per_text(doc[at], g[at])
                yield pa.RecordBatch.from_arrays([pa.array(signed(k)), pa.array(same[d]), pa.array(n[d].astype(np.int32)), pa.nulls(len(k), pa.int32()), pa.array(signed(ends[d]))], names)

    names = ["k", "other", "n", "size", "ends"]
    return cut(clusters.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("same")).mapInArrow(run, "k long, other long, n int, size int, ends long"))


def _copies(clusters: DataFrame, cands: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(h, other): texts without an ending, by hash, with the longest ones that share a band with them."""
    own = cands.where("bands IS NOT NULL").select("h", "n_words", F.explode("bands").alias("k")).distinct()
    held = _held(clusters, cands) if held is None else held
    best = held.where("size IS NOT NULL").groupBy("k", "size").agg(F.max(F.struct("n", "other")).alias("b")).select("k", "b.n", "b.other")
    return own.join(best, "k").where("n > n_words AND h <> other").select("h", "other").distinct()


def goes_on(a: str, b: str, k: int = SHINGLE, similar: float = SIMILAR) -> bool:
    """Is ``a`` nearly all in ``b``, and does ``b`` go on where ``a``'s alignment with it ends?"""
    wa, wb = Words([a]), Words([b])
    ga, gb = wa.grams(k)[1], wb.grams(k)[1]
    if not len(ga) or not len(gb) or np.isin(u := np.unique(ga), gb).sum() < similar * len(u):
        return False
    hit = np.flatnonzero(np.isin(ga, gb))
    i = int(hit[-1])
    at = np.flatnonzero(gb == ga[i])
    j = int(at[np.argmin(np.abs(at - i))])  # a repeated phrase counts where it stands in a
    tail_a, tail_b = len(wa.hash) - (i + k), len(wb.hash) - (j + k)
    return tail_a <= 2 and tail_b > tail_a


def _verified(clusters: DataFrame, pairs: DataFrame) -> DataFrame:
    """(h): texts that end before a near-copy does."""
    need = cut(pairs.select(F.col("h").alias("i")).union(pairs.select("other")).distinct())
    bits = clusters.sparkSession.sparkContext.broadcast(bitfilter.build(need, "i"))

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitfilter.probe(bits.value, batch.column("i").to_numpy().view(_U))))

    texts = clusters.where("text IS NOT NULL").select(F.xxhash64("text").alias("i"), "text").mapInArrow(few, "i long, text string")
    held = cut(texts.join(need, "i", "left_semi").dropDuplicates(["i"]))
    a, b = held.select(F.col("i").alias("h"), F.col("text").alias("ta")), held.select(F.col("i").alias("other"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [i for i, x, y in zip(*(batch.column(c).to_pylist() for c in range(3))) if goes_on(x, y)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["h"])

    return pairs.join(a, "h").join(b, "other").select("h", "ta", "tb").mapInArrow(run, "h long").distinct()


def _all_copies(clusters: DataFrame, held: DataFrame, rarest: DataFrame, met: DataFrame) -> DataFrame:
    """(h): ``met`` and whichever other texts without an ending, by hash, ``goes_on`` finds in any longer one.

    The texts that hold a shingle are aligned longest first, in blocks that grow eightfold, each with what the blocks before
    left open. One witness is enough, so a family of edited copies meets few of its pairs; what has none meets all of them.
    """
    posts = held.where("ends IS NOT NULL").select("k", "other", "n", F.col("ends").alias("on")).distinct()
    posts = cut(posts.withColumn("at", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("n"), "other"))))
    most = posts.agg(F.max("at")).first()[0] or 0
    low, high = 0, BLOCK
    while low < most:
        left = rarest.join(met, "h", "left_anti")
        block = posts.where(F.col("at").between(low + 1, high)).join(left, "k")
        pairs = cut(block.where("n > n_words AND h <> other AND (on & ends) <> 0").select("h", "other").distinct())
        if not pairs.isEmpty():
            met = cut(met.union(_verified(clusters, pairs)))
        low, high = high, high * 8
    return met


def truncated(clusters: DataFrame, closes: float = 0.8, ends_heading: float = 0.01, opens: float = 0.02) -> DataFrame:
    """(cluster_uid, evidence): the cut texts; evidence is mark, copy or closing.

    closes: a last word that closes a sentence in at least this share of its occurrences leaves the text whole.
    ends_heading: in texts of a heading's length the last word must end texts more rarely than this.
    opens: a capital first word that begins sentences more rarely than this begins none on the next page.
    """
    seen = cut(_scan(clusters))
    few = cut(seen.where("kind IN ('cut', 'sketch')"))
    cands = few.where("kind = 'cut'")
    stats = lambda kind: seen.where(F.col("kind") == kind).groupBy("word").agg(*[F.sum(F.col("counts")[i]).alias(c) for i, c in enumerate(["n", "n_prose", "n_end", "n_last", "n_start", "n_cap", "n_cap_start"] if kind == "word" else ["n_pair", "n_pair_start"])])
    words, after = stats("word"), stats("after").withColumnRenamed("word", "second")

    # the next page's opening: of its first texts that are prose, the first
    heads = seen.where("kind = 'open'").groupBy("document_id", "page").agg(F.min_by(F.struct("word", "second", "low", (F.col("counts")[0] == 1).alias("quoted")), "number").alias("o"))
    heads = heads.select("document_id", (F.col("page") - 1).alias("page"), "o.*").join(words.select("word", "n", "n_start", "n_cap", "n_cap_start"), "word", "left").join(after, "second", "left")
    # lower case goes on, unless in quotes; so does a capital word that begins none, or one that may be either before one that never comes second
    seldom = lambda a, b, share: F.coalesce(F.col(a) < F.col(b) * share, F.lit(False))
    capital_on = seldom("n_cap_start", "n_cap", opens) | (seldom("n_cap_start", "n_cap", 0.5) & seldom("n_pair_start", "n_pair", opens))
    carries = F.when(F.col("low"), ~F.col("quoted") | seldom("n_start", "n", opens)).otherwise(capital_on)
    on = heads.where(carries).select("document_id", "page", F.lit(True).alias("carried"))
    last = seen.where("kind = 'prose'").select("document_id", "page", "number").union(cands.select("document_id", "page", "number")).groupBy("document_id", "page").agg(F.max("number").alias("last"))
    # a heading or label after the text doesn't count as what follows it on the page
    prose = seen.where("kind = 'prose'").groupBy("document_id", "page").agg(F.max("number").alias("last_prose"))
    tails = on.join(last, ["document_id", "page"]).join(prose, ["document_id", "page"], "left")

    base = cands.select("uid", "h", "document_id", "page", "number", "mark", "n_words", "inner", "capital", "word").distinct()
    scored = base.join(words, "word", "left").join(tails, ["document_id", "page"], "left")
    carried = F.coalesce(F.col("carried") & (F.col("number") >= F.coalesce("last_prose", F.lit(0))), F.lit(False))
    rarest = _rarest(cands, _sketch(few))
    held = _held(clusters, cands, rarest)
    met = cut(_verified(clusters, cut(_copies(clusters, cands, held))))
    copies = _all_copies(clusters, held, rarest, met).withColumn("copy", F.lit(True))
    scored = scored.join(copies, "h", "left")
    long_ = F.col("n_words") > HEADING_WORDS
    open_end = F.coalesce((F.col("n_end") < F.col("n_prose") * closes) | (F.col("n_prose") == 0), F.lit(True))
    rare_end = F.coalesce((F.col("n_last") < F.col("n") * ends_heading) | ~F.col("capital") & F.col("inner"), F.lit(False))
    closing = (long_ & open_end) | (~long_ & (F.col("n_words") >= 3) & (rare_end | F.col("inner") & ~F.col("capital")))
    evidence = F.when(F.col("mark"), "mark").when(carried, None).when(F.col("copy"), "copy").when(closing, "closing")
    return scored.select(F.col("uid").alias("cluster_uid"), evidence.alias("evidence")).where("evidence IS NOT NULL").distinct()


def truncation_report(clusters: DataFrame, cut_texts: DataFrame, pages: DataFrame) -> DataFrame:
    """Per source: texts, cut texts and their share, and of the pages with a cut text how many say so themselves."""
    says = pages.groupBy("page_id").agg(F.max("incomplete_text").alias("says"))
    rows = clusters.where("text IS NOT NULL AND text <> ''").select("cluster_uid", "page_id", "ocr_model_name").distinct()
    marked = rows.join(cut_texts.select("cluster_uid", F.lit(1).alias("is_cut")), "cluster_uid", "left").join(says, "page_id", "left")
    cut_ = F.coalesce("is_cut", F.lit(0))
    flag = F.coalesce(F.col("says").cast("int"), F.lit(0))
    return marked.groupBy("ocr_model_name").agg(
        F.count(F.lit(1)).alias("n_texts"), F.sum(cut_).alias("n_cut"), F.avg(cut_).alias("cut_share"), F.sum(flag).alias("n_claimed"), F.sum(cut_ * flag).alias("n_cut_claimed")
    )
