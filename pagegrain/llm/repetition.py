"""Share of a text's words that only repeat what the text has already said.

A word is repeated when it lies in ``n`` consecutive words that already occurred, as ``n`` consecutive
words, at an earlier position of the same text. Texts with a share of at least ``share`` are sought through tokeniser
fertility: of T tokens with W words in a text, at least share * W were there before, and T tokens of which R were there
before have an entropy of at most log2 T - 2 R / T, since c log2 c >= 2 (c - 1) for any count c. So the band
``entropy <= log2 T - 2 share W / T`` rejects no such text, in whatever language or script; which words repeat in what
is left only the n-grams themselves can say. Fertility alone (characters per token, byte fallback, token entropy, with
bands per script) tells broken or spammy text from ordinary text of its script and is a measure of its own.

Null and empty texts have no words and share 0; repeated rows keep their own result; extra columns pass through.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.textvec import Words, _tables, chunks, mix64

_U = np.uint64


def repeated_words(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, repeated words) of each text."""
    w = Words(texts)
    at, g = w.grams(n)
    rep = np.zeros(len(w.hash) + 1, np.int64)
    if len(at):
        key = g ^ mix64(w.doc[at].astype(_U) + _U(0x51ED27))
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(at), np.bool_)
        k = key[order]
        again[order[1:]] = k[1:] == k[:-1]  # the sort is stable: all but the earliest of a run
        hit = at[again]
        np.add.at(rep, hit, 1)
        np.add.at(rep, hit + n, -1)
    lies = np.cumsum(rep[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(lies)])
    return w.counts(), total[w.first[1:]] - total[w.first[:-1]]


def repetition(df: DataFrame, text: str = "text", n: int = 4) -> DataFrame:
    """Adds n_words, n_repeated (bigint) and repeated_share (double) to every row.

    >>> repetition(spark.createDataFrame([("a b c d a b c d",)], "text string"))  # share 4 / 8
    """
    schema = T.StructType(
        [f for f in df.schema if f.name not in ("n_words", "n_repeated", "repeated_share")]
        + [T.StructField("n_words", T.LongType()), T.StructField("n_repeated", T.LongType()), T.StructField("repeated_share", T.DoubleType())]
    )
    keep = [f.name for f in schema][:-3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                words, rep = repeated_words(part.column(text).to_pylist(), n)
                share = np.divide(rep, words, out=np.zeros(len(words)), where=words > 0)
                cols = [part.column(c) for c in keep] + [pa.array(words), pa.array(rep), pa.array(share)]
                yield pa.RecordBatch.from_arrays(cols, [*keep, "n_words", "n_repeated", "repeated_share"])

    return df.select(*keep).mapInArrow(run, schema)


def word_tokens(w: Words, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(text, token) of the words of all texts, in lower case and with one blank before each; every distinct word is tokenised once."""
    _, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
    low = _tables()[1]
    at = w.base[w.doc[first]]
    size = w.end[first] - w.start[first]
    off = np.cumsum(size + 1) - size - 1
    cp = np.full(int((size + 1).sum()), 32, np.uint32)
    into = np.repeat(off + 1 - (np.cumsum(size) - size), size) + np.arange(size.sum())
    cp[into] = low[w.cp[np.repeat(at + w.start[first] - (np.cumsum(size) - size), size) + np.arange(size.sum())]]
    joined = cp.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    words = [joined[a : a + n + 1] for a, n in zip(off.tolist(), size.tolist())]
    toks = _encoder(path).encode_ordinary_batch(words, num_threads=1)
    n = np.fromiter(map(len, toks), np.int64, len(toks))
    flat = np.fromiter(chain.from_iterable(toks), np.int64, int(n.sum()))
    begin = np.cumsum(n) - n
    own = n[back]
    idx = np.repeat(begin[back] - (np.cumsum(own) - own), own) + np.arange(own.sum())
    return np.repeat(w.doc, own), flat[idx]


def token_measures(doc: np.ndarray, tok: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, entropy in bits) of each text, 0 where it has none."""
    total = np.bincount(doc, minlength=n_texts)
    order = np.lexsort((tok, doc))
    d, t = doc[order], tok[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])])) if len(d) else np.zeros(0, np.int64)
    c = np.diff(np.append(new, len(d)))
    log = np.bincount(d[new], c * np.log2(np.maximum(c, 1)), minlength=n_texts) if len(d) else np.zeros(n_texts)
    safe = np.maximum(total, 1)
    return total, np.maximum(0.0, np.log2(safe) - log / safe)


def may_repeat(texts: list[str | None], share: float, path: str) -> np.ndarray:
    """Which texts lie in the band that texts with such a share of repeated words can't leave."""
    w = Words(texts)
    doc, tok = word_tokens(w, path) if len(w.hash) else (w.doc, w.doc)
    total, entropy = token_measures(doc, tok, w.n_texts)
    return (total > 0) & (entropy <= np.log2(np.maximum(total, 1)) - 2 * share * w.counts() / np.maximum(total, 1) + 1e-9)


def repeating_texts(df: DataFrame, key: str, text: str = "text", share: float = 0.3, n: int = 4, min_words: int = 12, vocabulary: str | None = None) -> DataFrame:
    """(key): the rows with at least ``min_words`` words of which at least ``share`` are repeated, each once.

    Fertility picks the candidates, without losing any; the n-grams of these decide.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                held = part.filter(pa.array(may_repeat(part.column(text).to_pylist(), share, path)))
                words, rep = repeated_words(held.column(text).to_pylist(), n)
                yield pa.RecordBatch.from_arrays([held.column(key).filter(pa.array((words >= min_words) & (rep >= share * words)))], [key])

    return df.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias(key), text).mapInArrow(run, f"{key} long").distinct()


@cache
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(8)
def _pieces(path: str) -> np.ndarray:
    """For each token id: is it a single byte above ASCII (the fallback for what the vocabulary lacks)?"""
    enc = _encoder(path)
    flag = np.zeros(enc.n_vocab, np.bool_)
    for b in range(0x80, 0x100):
        flag[enc.encode_single_token(bytes([b]))] = True
    return flag


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def fertility(df: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Adds n_tokens, chars_per_token, byte_share and token_entropy (bits; at most log2 n_tokens).

    Null and empty texts have 0 tokens and null measures.
    """
    path = vocabulary or default_vocabulary()
    extra = [("n_tokens", T.LongType()), ("chars_per_token", T.DoubleType()), ("byte_share", T.DoubleType()), ("token_entropy", T.DoubleType())]
    names = [k for k, _ in extra]
    schema = T.StructType([f for f in df.schema if f.name not in names] + [T.StructField(k, t) for k, t in extra])
    keep = [f.name for f in schema][: -len(extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                toks = _encoder(path).encode_ordinary_batch(texts, num_threads=1)
                n = np.fromiter(map(len, toks), np.int64, len(toks))
                doc, tok = np.repeat(np.arange(len(n)), n), np.fromiter(chain.from_iterable(toks), np.int64, int(n.sum()))
                total, entropy = token_measures(doc, tok, len(n))
                safe, none = np.maximum(total, 1), total == 0
                single = np.bincount(doc, _pieces(path)[tok], minlength=len(n)) if len(tok) else np.zeros(len(n))
                chars = np.fromiter(map(len, texts), np.int64, len(texts))
                new = [pa.array(total), *(pa.array(x, mask=none) for x in (chars / safe, single / safe, entropy))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + new, [*keep, *names])

    return df.select(*keep).mapInArrow(run, schema)


def script_of(text: str = "text") -> F.Column:
    """The script most of the first letters belong to: cyrillic, greek, han, arabic or latin; none without letters."""
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda p: F.length(t) - F.length(F.regexp_replace(t, p, ""))
    kinds = [("latin", r"\p{IsLatin}"), ("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}"), ("han", r"\p{IsHan}"), ("arabic", r"\p{IsArabic}")]
    best = F.greatest(*[F.struct(count(p).alias("n"), F.lit(k).alias("k")) for k, p in kinds])
    return F.when(best["n"] > 0, best["k"]).otherwise(F.lit("none"))


def fertility_bands(measured: DataFrame, key: str, low: float = 0.01, high: float = 0.99, min_tokens: int = 16) -> DataFrame:
    """Per ``key`` (a language or script) the accepted band of each measure: approximate quantiles over all rows."""
    q = lambda c: F.percentile_approx(c, [low, high], 10000)
    m = measured.where(F.col("n_tokens") >= min_tokens).groupBy(key).agg(q("chars_per_token").alias("c"), q("token_entropy").alias("e"), q("byte_share").alias("b"), F.count(F.lit(1)).alias("n"))
    return m.select(key, "n", F.col("c")[0].alias("min_chars"), F.col("c")[1].alias("max_chars"), F.col("e")[0].alias("min_entropy"), F.col("b")[1].alias("max_bytes"))


def entropy_ceiling(n_tokens: int) -> float:
    """The most bits that ``n_tokens`` tokens can carry each."""
    return math.log2(n_tokens) if n_tokens > 0 else 0.0
