import random

from conftest import rows

from pagegrain.operators import intervals as I
from pagegrain.plans import queries


def brute(spans):
    out = []
    for s, e in sorted(x for x in spans if None not in x and x[0] <= x[1]):
        if out and s <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def test_merge_and_gaps_match_brute_force_over_shards(make):
    rnd = random.Random(1)
    data = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(5)}", s := rnd.randrange(3000), s + rnd.randrange(60)) for _ in range(500)]
    data += [("hot", None, 4), ("hot", 9, 3), ("long", 5, 2000), ("touch", 0, 7), ("touch", 8, 15), ("touch", 16, 16), ("gap", 0, 7), ("gap", 9, 9)]
    df = make(data, "k string, s int, e int")
    for width in (8, 64, 4096):
        want = [(k, *x) for k in {d[0] for d in data} for x in brute([(d[1], d[2]) for d in data if d[0] == k])]
        assert rows(I.merge_intervals(df, ["k"], "s", "e", width)) == sorted(want, key=lambda t: tuple((True, str(x)) for x in t))
        runs = {k: brute([(d[1], d[2]) for d in data if d[0] == k]) for k in {w[0] for w in want}}
        gaps = [(k, a[1] + 1, b[0] - 1) for k, r in runs.items() for a, b in zip(r, r[1:])]
        assert rows(I.interval_gaps(df, ["k"], "s", "e", width)) == sorted(gaps, key=lambda t: tuple((True, str(x)) for x in t))


def test_empty_repeats_and_negative_positions(make):
    assert I.merge_intervals(make([], "k string, s int, e int"), ["k"], "s", "e").count() == 0
    df = make([("a", -5, -2), ("a", -5, -2), ("a", -1, 3)], "k string, s int, e int")
    assert rows(I.merge_intervals(df, ["k"], "s", "e", 4)) == [("a", -5, 3)]


def test_island_sum_and_coverage(make):
    spans = make([("u", 0, 4), ("u", 3, 9), ("u", 10, 12), ("u", 20, -1), ("v", 0, 1), ("w", 0, 3)], "unit string, s int, e int")
    units = make([("u", 23), ("v", 0), ("x", 7)], "unit string, n int")
    per = I.coverage(spans, units, "unit", "s", "e", "n")
    assert rows(per) == [("u", 16, 23)]
    assert I.cover_ratio(per).first()[0] == 16 / 23
    assert I.cover_ratio(per.limit(0)).first()[0] == 1.0


def test_overlaps_across_shards_come_once(make):
    df = make([("k", 1, 0, 9000, "a"), ("k", 2, 4090, 8300, "b"), ("k", 3, 9001, 9002, "c")], "k string, o int, s int, e int, c string")
    got = I.overlaps(df, ["k"], "o", "s", "e", ["c"])
    assert rows(got.select("left_c", "right_c", "overlap_start", "overlap_end")) == [("a", "b", 4090, 8300)]


def test_pointer_stretches(make):
    p = make([("d|p1_t0", 2, 4), ("d|p1_t0", 8, -1), ("d|p1_t0", None, 3), ("d|p1_t0", 2, 4), ("d|p1_t1", 0, 1), ("d|p1_t1", 4, 200_000_000), ("x", 0, 1)], "source_cluster_id string, start_char int, end_char int")
    c = make([("d", 1, 0, "abcdefghij"), ("d", 1, 0, "abcdefghij"), ("d", 1, 1, "ab  cd"), ("d", 1, 2, None), (None, 1, 3, "x")], "document_id string, pdf_page_num int, cluster_number int, text string")
    n = make([("conflict", "u", 1, 5, None, None), ("conflict", "u", 6, 9, None, None), ("gap", "u", None, None, 3, 4), ("gap", None, None, None, 3, 4), (None, "u", 1, 2, 3, 4)], "note_kind string, source_cluster_id string, overlap_start int, overlap_end int, gap_start int, gap_end int")
    assert rows(I.pointer_stretches(p, c, n)) == [("conflict", "u", 1, 9), ("gap", "d|p1_t0", 5, 7), ("missing", "u", 3, 4)]


def test_tolerance(make):
    df = make([("u", 0, 10), ("u", 8, 20), ("u", 20, 25)], "u string, s int, e int")
    assert rows(I.overlap_tolerance(df, ["u"], "s", "e", 1)) == [("u", 8, 20, 10)]


def test_p6_merged_resolves_open_ends(spark, make, tmp_path):
    p = [("d|p1_t0", 0, 1), ("d|p1_t0", 2, -1), ("d|p1_t1", -3, 1), ("d|p1_t1", 4, 200_000_000), ("d|p1_t1", 1, 2), ("d|p1_t1", None, 5), ("d|p1_t1", 3, None), ("d|p1_t2", 0, 5), ("d|p1_t2", 7, -1), ("d|p1_t3", 0, 0), ("x", 3, 99_999_999), ("x", 0, -1)]
    make(p, "source_cluster_id string, start_char int, end_char int").write.parquet(f"{tmp_path}/node_pointers.parquet")
    c = [("d", 1, 0, "abcdefghij"), ("d", 1, 0, "abcdefghij"), ("d", 1, 1, "ab  cd"), ("d", 1, 2, None), ("d", 1, 3, "")]
    make(c, "document_id string, pdf_page_num int, cluster_number int, text string").write.parquet(f"{tmp_path}/text_clusters.parquet")
    want = [("d|p1_t0", 0, 9), ("d|p1_t1", 0, 2), ("d|p1_t1", 4, 5), ("d|p1_t2", 0, 5), ("x", 3, 99_999_999)]
    assert rows(queries.p6_merged(spark, str(tmp_path))) == want


def test_very_long_spans_stay_few_rows(make):
    day = 86_400_000_000
    data = [("u", 0, day - 1), ("u", day, day + 5), ("u", day + 9, day + 12), ("u", 40, 50), ("u", 5 * day, 5 * day), ("v", -day, day), ("v", 3 * day, 4 * day), ("v", 3 * day + 7, 3 * day + 8), (None, 1, 2)]
    df = make(data, "k string, s long, e long")
    assert sum(x.count() for x in I._pieces(df.where("k IS NOT NULL"), ["k"], "s", "e", I.SHARD)) < 300 and I._pieces(df.where("e - s < 9"), ["k"], "s", "e", I.SHARD)[1] is None
    assert rows(I.merge_intervals(df, ["k"], "s", "e")) == sorted([("u", 0, day + 5), ("u", day + 9, day + 12), ("u", 5 * day, 5 * day), ("v", -day, day), ("v", 3 * day, 4 * day)], key=lambda t: tuple((True, str(x)) for x in t))
    assert set(rows(I.interval_gaps(df, ["k"], "s", "e"))) == {("u", day + 6, day + 8), ("u", day + 13, 5 * day - 1), ("v", day + 1, 3 * day - 1)}


def test_tolerance_over_shards_matches_brute_force(make):
    rnd = random.Random(3)
    data = sorted({("hot", s := rnd.randrange(40_000), s + rnd.randrange(6000)) for _ in range(300)})
    want = [(*d, m) for i, d in enumerate(data) if i and (m := max(x[2] for x in data[:i])) - d[1] + 1 > 8]
    assert set(rows(I.overlap_tolerance(make(data, "u string, s int, e int"), ["u"], "s", "e", 8))) == set(want)
