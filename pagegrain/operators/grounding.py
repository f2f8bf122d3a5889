"""Pointers anchored in their source units: exact tiers as column expressions, fuzzy tiers as a batch function.

Tier ``same``: the span holds the text apart from white space and stays. Tier ``contain``: one holds the other; the
span stays and its text follows it. Tier ``search``: the exact occurrence nearest to the proposed start. Otherwise the
pointer is ``lost``, or ``unknown`` where its unit doesn't exist. Null starts and ends point at nothing and are lost.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.textvec import chunks


_DARK = re.compile(r"\S+")


def ground(pointers: DataFrame, units: DataFrame, unit: str = "source_cluster_id") -> DataFrame:
    """The pointers with tier, new_start, new_end and new_text. ``units`` has (unit, text), a row per unit."""
    p = pointers.join(units.select(unit, F.col("text").alias("_t"), F.lit(True).alias("_known")), unit, "left")
    t = F.coalesce("_t", F.lit(""))
    said = F.coalesce("verbatim_text", F.lit(""))
    end = X.open_end("end_char")
    actual = X.span_slice(t, "start_char", end)
    p = p.withColumns({"_actual": actual, "_a": X.squeeze_out(actual), "_v": X.squeeze_out(said)})
    null = F.col("start_char").isNull() | F.col("end_char").isNull()
    same = F.col("_a") == F.col("_v")
    contain = (F.col("_actual") != "") & (F.contains(F.col("_v"), F.col("_a")) | F.contains(F.col("_a"), F.col("_v")))
    # only what neither tier settles is searched for
    hit = F.when(~null & ~same & ~contain, X.nearest(X.occurrences(t, said), F.col("start_char")))
    p = p.withColumn("_hit", hit)
    tier = F.when(F.col("_known").isNull(), "unknown").when(null, "lost").when(same, "same").when(contain, "contain").when(F.col("_hit").isNotNull(), "search").otherwise("lost")
    p = p.withColumn("tier", tier)
    past = F.when(end == -1, F.length(t)).otherwise(end + 1)
    kept, moved = F.col("tier") == "contain", F.col("tier") == "search"
    return p.withColumns(
        {
            "new_start": F.when(F.col("tier") == "same", F.col("start_char")).when(kept, F.greatest("start_char", F.lit(0))).when(moved, F.col("_hit")),
            "new_end": F.when(F.col("tier") == "same", F.col("end_char")).when(kept, F.greatest(past - 1, F.lit(-1))).when(moved, F.col("_hit") + F.length(said) - 1),
            "new_text": F.when(F.col("tier") == "same", F.col("verbatim_text")).when(kept, F.col("_actual")).when(moved, said),
        }
    ).drop("_t", "_known", "_actual", "_a", "_v", "_hit")


def ground_one(text: str, start: int, end: int, said: str) -> tuple[str, int | None, int | None, str | None]:
    """The same rules for one pointer: (tier, start, end, text)."""
    squeeze = lambda s: "".join(s.split())
    past = len(text) if end == -1 else end + 1
    actual = text[max(start, 0) : max(past, 0)]
    a, v = squeeze(actual), squeeze(said)
    if a == v:
        return "same", start, end, said
    if actual and (a in v or v in a):
        return "contain", max(start, 0), max(past - 1, -1), actual
    best, at = None, text.find(said) if said else -1
    while at != -1:
        if best is None or abs(at - start) < abs(best - start):
            best = at
        at = text.find(said, at + len(said))
    return ("lost", None, None, None) if best is None else ("search", best, best + len(said) - 1, said)


def layer_repair(grounded: DataFrame, child: str = "node_id") -> DataFrame:
    """Per child: its pointers, how many changed, and whether all could be grounded (one lost pointer loses the child)."""
    changed = (F.col("tier") == "search") | ((F.col("tier") == "contain") & ((F.col("new_text") != F.coalesce("verbatim_text", F.lit(""))) | (F.col("new_end") != F.col("end_char"))))
    return grounded.groupBy(child).agg(F.count(F.lit(1)).alias("n_pointers"), F.count_if(changed).alias("n_changed"), F.bool_and(~F.col("tier").isin("lost", "unknown")).alias("repaired"))


def resolve_delimiters(df: DataFrame, text: str, first: str, last: str) -> DataFrame:
    """Adds span_start, span_end (inclusive, both delimiters within) and error.

    Each delimiter must stand in the text exactly once, and the last must not end before the first begins.
    """
    a, b = X.occurrences(F.col(text), F.col(first)), X.occurrences(F.col(text), F.col(last))
    d = df.withColumns({"_a": a, "_b": b})
    end = F.get("_b", F.lit(0)) + F.length(last) - 1
    error = (
        F.when(F.size("_a") == 0, "start not found").when(F.size("_a") > 1, "start is not unique").when(F.size("_b") == 0, "end not found").when(F.size("_b") > 1, "end is not unique").when(end < F.get("_a", F.lit(0)), "end before start")
    )
    d = d.withColumn("error", error)
    return d.withColumns({"span_start": F.when(F.col("error").isNull(), F.get("_a", F.lit(0))), "span_end": F.when(F.col("error").isNull(), end)}).drop("_a", "_b")


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def threshold(n: int) -> float | None:
    """The similarity that a fuzzy match of n characters needs; None for no fuzzy match."""
    return None if n <= 10 else 0.99 if n <= 20 else 0.95 if n <= 50 else 0.90 if n <= 100 else 0.85


class Collapsed:
    """A text with runs of white space as one blank, and the way back to its own offsets."""

    def __init__(self, text: str):
        pieces = [(m.start(), m[0]) for m in _DARK.finditer(text)]
        self.text = " ".join(p for _, p in pieces)
        size = np.fromiter((len(p) + 1 for _, p in pieces), np.int64, len(pieces))
        self._at = np.cumsum(size) - size
        self._start = np.fromiter((s for s, _ in pieces), np.int64, len(pieces))
        self._end = self._start + size - 1

    def back(self, i: int) -> int:
        """Where character ``i`` stands in the text itself; a blank stands where its run begins."""
        k = int(np.searchsorted(self._at, i, side="right")) - 1
        return int(min(self._start[k] + i - self._at[k], self._end[k]))


def collapsed_find(text: str, said: str, near: int | None = None) -> tuple[int, int] | None:
    """The occurrence nearest to ``near`` (the first, without one) when runs of white space count as one blank, as offsets of the text."""
    need, c = " ".join(said.split()), Collapsed(text)
    best, at = None, c.text.find(need) if need else -1
    while at >= 0:
        s = c.back(at)
        if best is None or near is not None and abs(s - near) < abs(best[0] - near):
            best = (s, c.back(at + len(need) - 1))
        if near is None:
            break
        at = c.text.find(need, at + 1)
    return best


def fuzzy_find(text: str, said: str) -> tuple[int, int, float] | None:
    """Best window by common subsequence over the longer length, else the longest equal block widened to the length; both texts collapsed.

    Windows are three quarters, once and five quarters as long, a tenth apart; the first of equals wins. Texts of 10
    characters and fewer have none.
    """
    c, said = Collapsed(text), " ".join(said.split())
    got = _fuzzy(c.text, said)
    return None if got is None else (c.back(got[0]), c.back(got[1]), got[2])


def _fuzzy(text: str, said: str) -> tuple[int, int, float] | None:
    need = threshold(len(said))
    if need is None or not text:
        return None
    best: tuple[int, int, float] | None = None
    step = max(1, round(0.1 * len(said)))
    for size in dict.fromkeys((int(0.75 * len(said)), len(said), -(-5 * len(said) // 4))):
        for s in range(0, max(1, len(text) - size + 1), step):
            piece = text[s : s + size]
            if min(len(piece), len(said)) < need * max(len(piece), len(said)):  # too short or long to reach what is asked
                continue
            score = lcs_length(piece, said) / max(len(piece), len(said))
            if best is None or score > best[2]:
                best = (s, s + len(piece) - 1, score)
    if best and best[2] >= need:
        return best
    m = difflib.SequenceMatcher(None, text.lower(), said.lower(), autojunk=False).find_longest_match()
    if m.size:
        s = max(0, m.a - m.b)
        piece = text[s : s + len(said)]
        score = difflib.SequenceMatcher(None, piece.lower(), said.lower(), autojunk=False).ratio()
        if score >= need:
            return s, s + len(piece) - 1, score
    return None


def partial_ratio(a: str, b: str) -> float:
    """0 to 100: the best match of the shorter text with an equally long part of the longer one."""
    short, long_ = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long_ else 0.0
    m = difflib.SequenceMatcher(None, short, long_, autojunk=False)
    starts = {max(0, j - i) for i, j, n in m.get_matching_blocks() if n} or {0}
    return 100 * max(difflib.SequenceMatcher(None, short, long_[s : s + len(short)], autojunk=False).ratio() for s in starts)


def fuzzy_ground(lost: DataFrame, units: DataFrame, unit: str = "source_cluster_id") -> DataFrame:
    """For pointers that no exact tier grounds: (node_id, ptr_ord, unit, fuzzy_tier, fuzzy_start, fuzzy_end, score)."""
    rows = lost.where("verbatim_text IS NOT NULL").select("node_id", "ptr_ord", unit, "verbatim_text", "start_char").join(units.select(unit, "text"), unit).where("text IS NOT NULL")
    schema = f"node_id string, ptr_ord int, {unit} string, fuzzy_tier string, fuzzy_start int, fuzzy_end int, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                out = []
                for n, o, u, v, t, at in zip(*(part.column(c).to_pylist() for c in ("node_id", "ptr_ord", unit, "verbatim_text", "text", "start_char"))):
                    if got := collapsed_find(t, v, at):
                        out.append((n, o, u, "collapsed", *got, 1.0))
                    elif hit := fuzzy_find(t, v):
                        out.append((n, o, u, "fuzzy", *hit))
                cols = list(zip(*out)) if out else [()] * 7
                kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [f.split()[0] for f in schema.split(", ")])

    return rows.select("node_id", "ptr_ord", unit, "verbatim_text", "text", "start_char").mapInArrow(run, schema)


def completeness(leaf_text: DataFrame, source_text: DataFrame, key: str, accept: float = 98.0) -> DataFrame:
    """Per document: do the leaves hold the source, apart from white space or nearly? (key, complete, score)."""
    both = source_text.select(key, F.col("text").alias("src")).join(leaf_text.select(key, F.col("text").alias("leaf")), key, "left")

    @F.pandas_udf("double")
    def score(a, b):
        squeeze = lambda s: "".join((s or "").split())
        import pandas as pd

        pairs = [(squeeze(x), squeeze(y)) for x, y in zip(a, b)]
        return pd.Series([100.0 if x == y else partial_ratio(x, y) for x, y in pairs])

    return both.withColumn("score", score("src", "leaf")).select(key, "score", (F.col("score") >= accept).alias("complete"))
