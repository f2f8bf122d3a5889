"""Text decoded with the wrong encoding: found and repaired by joining tokens with garbled forms of clean ones.

Every distinct corpus token with a character beyond ASCII is sent through all encoding chains: UTF-8 read as one of ten
encodings up to three times over, in any mix of them, one one-byte encoding read as another, the two kinds one after the
other in either order, and one-byte text read as UTF-8. What comes out is joined by hash with the tokens themselves; forms that
are no token of the corpus are dropped by a bit filter where they are made. Deeper chains are reached through the forms in between that occur:
an original that is itself garbled is followed to its own. A match is accepted when the supposed original is much the more common
of the two, or when several tokens of one text are explained alike, so a source that is garbled in many rows is found too.
For the latter tokens are counted once per distinct text. Inside tokens the same is done for runs of characters beyond ASCII, which repairs words whose clean form
never occurs. Tables are keyed by distinct tokens, never by documents; nothing is collected.

Null and empty texts have no tokens and come back as they are; repeated rows are each repaired.
"""

from __future__ import annotations

import codecs
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bitfilter
from ..functions.textvec import chunks
from ..session import cut

#: Decoders that UTF-8 bytes are wrongly read with; one-byte encodings as (written, read).
UTF8_READ_AS = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "mac_roman", "cp437", "cp850", "iso8859-15", "koi8-r")
ONE_BYTE = (("cp1252", "cp1250", "iso8859-2", "cp850", "cp437"), ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "iso8859-2"))
_RUN = re.compile(r"[^\x00-\x7f]+")


@cache
def _reader(codec: str) -> dict[int, str]:
    """For each byte what ``codec`` makes of it; bytes it does not know stay the control characters they are."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            table[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            table[b] = chr(b)
    return table


@cache
def _writer(codec: str) -> dict[str, int]:
    return {c: b for b, c in _reader(codec).items()}


def _misread(word: str, codec: str) -> str:
    return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(_reader(codec))


def _swapped(word: str, written: str, read: str) -> str | None:
    to, back = _writer(written), _reader(read)
    out = []
    for c in word:
        if ord(c) < 0x80:
            out.append(c)
        elif c in to:
            out.append(back[to[c]])
        else:
            return None
    return "".join(out)


def _replaced(word: str, written: str) -> str | None:
    """One-byte text read as UTF-8, with the replacement character for what is no UTF-8."""
    to = _writer(written)
    raw = bytearray()
    for c in word:
        if ord(c) < 0x80:
            raw.append(ord(c))
        elif c in to:
            raw.append(to[c])
        else:
            return None
    return codecs.decode(bytes(raw), "utf-8", "replace")


def garbled_forms(word: str) -> dict[str, str]:
    """Each garbled form of ``word`` with the first chain that makes it; forms equal to the word are none."""
    out: dict[str, str] = {}

    def put(form: str | None, chain: str) -> None:
        if form is not None and form != word and form not in out:
            out[form] = chain

    def read_on(forms: dict[str, str]) -> dict[str, str]:
        """One more reading of UTF-8 bytes by each decoder; of equal results the first chain stays."""
        step: dict[str, str] = {}
        for form, chain in forms.items():
            for c in UTF8_READ_AS:
                step.setdefault(_misread(form, c), f"{chain}>{c}")
        return step

    swaps: dict[str, str] = {}
    for a in ONE_BYTE[0]:
        for b in ONE_BYTE[1]:
            if a != b and (form := _swapped(word, a, b)) is not None and form != word:
                swaps.setdefault(form, f"{a}>{b}")
    once = read_on({word: "utf-8"})
    twice = read_on(once)
    for forms in (once, twice, read_on(twice)):
        for form, chain in forms.items():
            put(form, chain)
    for form, chain in once.items():  # read wrongly, then swapped
        for a in ONE_BYTE[0]:
            for b in ONE_BYTE[1]:
                if a != b:
                    put(_swapped(form, a, b), f"{chain}; {a}>{b}")
    for form, chain in read_on({form: f"utf-8>{chain}; utf-8" for form, chain in swaps.items()}).items():  # swapped, then read wrongly
        put(form, chain)
    for a in ("cp1252", "mac_roman", "cp850", "iso8859-2", "cp1250"):
        if (form := _replaced(word, a)) and "\ufffd" in form:  # else it is UTF-8 and reading it so the repair
            put(form, f"{a}>utf-8")
    for form, chain in swaps.items():
        put(form, chain)
    return out


def _tokens(texts: list[str | None]) -> Iterator[list[str]]:
    """The tokens of each text that hold a character beyond ASCII; a token is a run of ASCII letters, digits and such characters."""
    texts = ["" if t is None else t for t in texts]
    joined = "\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    high = cp >= 0x80
    inside = high | ((cp >= 48) & (cp <= 57)) | ((cp >= 65) & (cp <= 90)) | ((cp >= 97) & (cp <= 122))
    edge = np.flatnonzero(np.diff(inside, prepend=np.False_, append=np.False_))
    s, e = edge[0::2], edge[1::2]
    sums = np.concatenate([[0], np.cumsum(high)])
    keep = sums[e] > sums[s]
    s, e = s[keep], e[keep]
    base = np.cumsum([0, *(len(t) + 1 for t in texts)])
    cuts = np.searchsorted(s, base)
    s, e = s.tolist(), e.tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield [joined[x:y] for x, y in zip(s[a:b], e[a:b])]


def document_tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, n, same): the distinct tokens beyond ASCII of each text; same is equal for equal texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                ids, toks, ns, same = [], [], [], []
                for i, h, found in zip(part.column(key).to_pylist(), part.column("same").to_pylist(), _tokens(part.column(text).to_pylist())):
                    for t, n in Counter(found).items():
                        ids.append(i), toks.append(t), ns.append(n), same.append(h)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(toks, pa.string()), pa.array(ns, pa.int64()), pa.array(same, pa.int64())], [key, "token", "n", "same"])

    return df.select(F.col(key).cast("long").alias(key), text, F.xxhash64(text).alias("same")).mapInArrow(run, f"{key} long, token string, n long, same long")


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def _filter(vocabulary: DataFrame) -> np.ndarray:
    """The bit filter of the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(b.column(0).to_pylist()).view(np.int64))], ["k"])

    return bitfilter.build(vocabulary.select("token").mapInArrow(run, "k long"), "k")


def _garble(vocabulary: DataFrame) -> DataFrame:
    """(form, original, chain) of (token): the garbled forms that are tokens themselves, and maybe a few others.

    The distinct tokens are spread over all cores, since each makes some hundred forms.
    """
    spark = vocabulary.sparkSession
    sent = spark.sparkContext.broadcast(_filter(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                form, own, chain = [], [], []
                for i, t in enumerate(part.column(0).to_pylist()):
                    forms = garbled_forms(t)
                    form += forms
                    chain += forms.values()
                    own += [i] * len(forms)
                hit = pa.array(np.flatnonzero(bitfilter.probe(sent.value, _hashes(form))))
                at_ = pa.array(own, pa.int32()).take(hit)
                yield pa.RecordBatch.from_arrays([pa.array(form, pa.string()).take(hit), part.column(0).take(at_), pa.array(chain, pa.string()).take(hit)], ["form", "original", "chain"])

    spread = vocabulary.select("token").repartition(2 * spark.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, "form string, original string, chain string")


def _utf() -> F.Column:
    """Does the chain read UTF-8 bytes as something else?"""
    return F.col("chain").contains("utf-8>")


def vocabulary(tokens: DataFrame) -> DataFrame:
    """(token, n, n_texts): how often each token stands in all rows, and in all distinct texts."""
    once = tokens.groupBy("token", "same", "n").agg(F.count(F.lit(1)).alias("rows"))
    return once.groupBy("token").agg(F.sum(F.col("n") * F.col("rows")).alias("n"), F.sum("n").alias("n_texts"))


def explanations(words: DataFrame) -> DataFrame:
    """(token, original, chain, counts of both) of the tokens that are a garbled form of another; ``words`` has (token, counts)."""
    counts = [c for c in words.columns if c != "token"]
    own = words.select(F.col("token").alias("original"), *[F.col(c).alias(f"{c}_original") for c in counts])
    return cut(_garble(words).join(words.withColumnRenamed("token", "form"), "form").join(own, "original").withColumnRenamed("form", "token"))


def _best(hits: DataFrame, n: str, *by: str) -> DataFrame:
    """Per token (and ``by``) the most common original."""
    best = hits.groupBy("token", *by).agg(F.max_by(F.struct("original", "chain"), F.struct(f"{n}_original", "original")).alias("b"))
    return best.select("token", *by, F.col("b.original").alias("original"), F.col("b.chain").alias("chain"))


def explained_texts(tokens: DataFrame, key: str, hits: DataFrame, least: int = 3) -> DataFrame:
    """(key, token, original, chain) of the texts in which several distinct tokens are garbled alike, however common that is.

    Alike: all UTF-8 chains, or all swaps of one-byte encodings. It takes ``least`` tokens, or two that are half of the
    text's. A word misread as UTF-8 bytes can't be the original of the other, so counts don't matter; which side of a swap is
    the original only counts over distinct texts can tell: it must be the more common one.
    """
    some = hits.where(_utf() | (F.col("token").rlike(r"\p{L}") & (F.col("n_texts_original") > F.col("n_texts"))))
    best = _best(some.withColumn("kind", F.when(_utf(), "utf-8").otherwise("swap")), "n_texts", "kind")
    per = cut(tokens.select(key, "token").distinct().join(best, "token").select(key, "token", "kind", "original", "chain"))
    size = tokens.join(per.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.countDistinct("token").alias("size"))
    many = per.groupBy(key, "kind").agg(F.count(F.lit(1)).alias("k")).join(size, key).where((F.col("k") >= least) | ((F.col("k") >= 2) & (2 * F.col("k") >= F.col("size"))))
    return per.join(many.select(key, "kind"), [key, "kind"], "left_semi").groupBy(key, "token").agg(F.min_by(F.struct("original", "chain"), F.struct(F.col("kind") != "utf-8", "original")).alias("b")).select(key, "token", "b.original", "b.chain")


def repairs(words: DataFrame, hits: DataFrame, ratio: float = 2.0, swap_ratio: float = 20.0) -> DataFrame:
    """(token, original, chain) of all garbled tokens of the ``vocabulary``, by its ``explanations``.

    The original must be ``ratio`` times as common. A form that only swaps one-byte encodings looks like an ordinary word, so
    there it must be ``swap_ratio`` times as common and the token must hold a letter or a replacement character. Tokens with
    a replacement character that no original explains are lost: their original is null.
    """
    enough = F.col("n_original") >= F.col("n") * ratio
    letters = F.col("token").rlike(r"[\p{L}�]")
    best = _best(hits.where(enough), "n")
    n = hits.select("token", "original", "n", "n_original").distinct()
    whole = best.join(n, ["token", "original"]).where(_utf() | (letters & (F.col("n_original") >= F.col("n") * swap_ratio))).select("token", "original", "chain")

    runs = cut(words.select("n", F.explode(F.regexp_extract_all("token", F.lit(r"([^\x00-\x7f]+)"), F.lit(1))).alias("token")).groupBy("token").agg(F.sum("n").alias("n")))
    bad = _best(explanations(runs).where(enough), "n").where((F.length("token") >= 2) & _utf())
    pieces = words.select("token", F.posexplode(F.regexp_extract_all("token", F.lit(r"([^\x00-\x7f]+|[\x00-\x7f]+)"), F.lit(1))).alias("at", "piece"))
    b = bad.select(F.col("token").alias("piece"), F.col("original").alias("_as"), "chain")
    hit = pieces.join(b.select("piece").distinct(), "piece", "left_semi").select("token").distinct()
    mended = pieces.join(hit, "token", "left_semi").join(b, "piece", "left").groupBy("token").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("_as", "piece").alias("p")))), lambda x: x["p"]), "").alias("original"), F.max("chain").alias("chain")
    )
    known = _to_the_root(cut(whole.unionByName(mended.join(whole.select("token"), "token", "left_anti"))))
    lost = words.where(F.contains(F.col("token"), F.lit("\ufffd"))).join(known, "token", "left_anti").select("token", F.lit(None).cast("string").alias("original"), F.lit("lost").alias("chain"))
    return known.unionByName(lost)


def _to_the_root(known: DataFrame) -> DataFrame:
    """Originals that are garbled themselves give way to their own, chain by chain; a round doubles the steps. Tokens that explain each other stay as they are."""
    up = lambda d: d.select(F.col("token").alias("original"), F.col("original").alias("_o"), F.col("chain").alias("_c"))
    for _ in range(6):  # 64 misreadings one upon the other
        deeper = known.join(up(known).where("original <> _o"), "original").where("token <> _o")
        if not deeper.limit(1).count():
            break
        moved = deeper.select("token", F.col("_o").alias("original"), F.concat_ws("; ", "_c", "chain").alias("chain"))
        known = cut(known.join(moved.select("token"), "token", "left_anti").unionByName(moved))
    return known


def garbled_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key): the rows that hold a garbled token, each once."""
    tokens = cut(document_tokens(df, key, text))
    words = cut(vocabulary(tokens))
    hits = explanations(words)
    alone = tokens.join(repairs(words, hits).select("token"), "token", "left_semi").select(key)
    return alone.unionByName(explained_texts(tokens, key, hits).select(key)).distinct()


def restored(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, restored_text, n_repaired, n_lost) of the rows that hold a garbled token.

    n_lost counts replacement characters left over: what stood there can't be told.
    """
    tokens = cut(document_tokens(df, key, text))
    words = cut(vocabulary(tokens))
    hits = explanations(words)
    alone = cut(tokens.join(repairs(words, hits), "token").select(key, "token", "original"))
    alike = explained_texts(tokens, key, hits).select(key, "token", "original").join(alone.where("original IS NOT NULL"), [key, "token"], "left_anti")
    own = alone.join(alike, [key, "token"], "left_anti").unionByName(alike).groupBy(key).agg(F.collect_list(F.struct("token", "original")).alias("pairs"))
    rows = df.select(F.col(key).cast("long").alias(key), text).join(own, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, done, lost = [], [], [], []
            for i, t, pairs in zip(*(batch.column(c).to_pylist() for c in range(3))):
                to, n = {p["token"]: p["original"] for p in pairs if p["original"] is not None}, 0

                def sub(m: re.Match) -> str:
                    nonlocal n
                    got = to.get(m[0])
                    n += got is not None
                    return m[0] if got is None else got

                out = re.sub(r"[A-Za-z0-9\x80-\U0010ffff]+", sub, t)
                ids.append(i), texts.append(out), done.append(n), lost.append(out.count("�"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(done, pa.int64()), pa.array(lost, pa.int64())], [key, "restored_text", "n_repaired", "n_lost"])

    return rows.select(key, text, "pairs").mapInArrow(run, f"{key} long, restored_text string, n_repaired long, n_lost long")
