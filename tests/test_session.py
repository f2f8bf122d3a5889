import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegrain.functions import text as X
from pagegrain.operators import graph, grounding, hierarchy, layers, legacy, session, units, versions
from pagegrain.operators.hierarchy import heights, levels, links

LAYER = "collection_id string, local_id long, parent_id string, node_type string, title string, spans array<string>"
PROPOSAL = "collection_id string, seq long, edit_type string, target_id string, target_type string, target_title string, parent_id string, node_type string, title string, valid boolean"


def layer(make):
    return make([("c", 0, "p", "SECTION", "One", ["a"]), ("c", 1, "p", "TERM", "Two", ["b"]), ("c", 2, "p", "TERM", " two ", ["c"]), ("d", 0, "q", "TERM", "Two", ["d"])], LAYER)


def test_edits_by_number_and_by_title(make):
    p = make(
        [
            ("c", 1, "EDIT_NODE", "0", None, None, None, None, "First", True), ("c", 2, "EDIT_NODE", "0", None, None, None, "PAGE", None, True), ("c", 3, "EDIT_NODE", "0", None, None, None, None, "Last", True),
            ("c", 4, "EDIT_NODE", "0", None, None, None, None, "Broken", False), ("c", 5, "DELETE_NODE", "9", "TERM", "TWO", None, None, None, True), ("c", 6, "DELETE_NODE", "x", "SECTION", "One", None, None, None, True),
            ("c", 7, "ADD_NODE", None, None, None, None, "TERM", "New", True), ("c", 8, "ADD_NODE", None, None, None, "z", "TERM", "Lost", False), ("d", 1, "EDIT_NODE", "7", None, None, None, None, "Nobody", True),
        ],
        PROPOSAL,
    )
    got = session.apply_proposals(layer(make), p)
    assert rows(got.select("collection_id", "local_id", "parent_id", "node_type", "title")) == [("c", 0, "p", "PAGE", "Last"), ("c", 2, "p", "TERM", " two "), ("c", 3, "p", "TERM", "New"), ("d", 0, "q", "TERM", "Two")]
    assert session.apply_proposals(layer(make), p.limit(0)).count() == 4 and session.apply_proposals(layer(make).limit(0), p.where("edit_type = 'ADD_NODE' AND valid")).count() == 1


def test_edit_loop_ends_when_nothing_is_proposed_or_after_three_rounds(make):
    add = lambda now, k: make([("c", 1, "ADD_NODE", None, None, None, "p", "TERM", f"new {k}", True)], PROPOSAL)
    out, n = session.edit_loop(layer(make), add)
    assert n == 3 and out.count() == 7
    out, n = session.edit_loop(layer(make), lambda now, k: add(now, k) if k < 1 else add(now, k).limit(0), lambda d: d.where("title <> 'One'"))
    assert n == 1 and out.count() == 4


def test_level_repair_asks_again_for_what_is_left(make):
    kids = make([("a", "p", "A", 1), ("b", "p", "B", 2), ("b2", "p", "B", 3), ("c", "p", "C", 4)], "node_id string, parent_id string, title string, ord int")
    ptr = "node_id string, ptr_ord int, source_cluster_id string, start_char int, end_char int, verbatim_text string"
    p = make([("a", 0, "u", 0, 4, "Alpha"), ("b", 0, "u", 0, 0, "zz"), ("b2", 0, "u", 0, 4, "Alpha"), ("b2", 1, "u", 0, 3, "nowhere"), ("c", 0, "x", 0, 1, "q")], ptr)
    u = make([("u", "Alpha clause")], "source_cluster_id string, text string")
    fix = lambda left, old: make([("b2", 0, "u", 0, 0, "clause")], ptr)
    fixed, pending = session.level_repair(kids, p, u, fix)
    assert rows(fixed.select("node_id", "round", "start_char", "verbatim_text")) == [("a", 0, 0, "Alpha"), ("b2", 1, 6, "clause")] and rows(pending.select("node_id")) == [("c",)]
    assert rows(session.level_repair(kids, p, u)[1].select("node_id")) == [("b2",), ("c",)]


def test_review_overrides_the_hook_and_is_merged(make):
    front = make([("k", "r", 0, 0)], "collection_id string, parent_node_id string, depth int, `order` long")
    nodes = make([("r", None, "DOCUMENT_ROOT", None, 0)], "node_id string, parent_id string, node_type string, title string, level_from_root int")
    p = make([("r", 0, "u", 0, 9, None)], "node_id string, ptr_ord int, source_cluster_id string, start_char int, end_char int, verbatim_text string")
    lay, rest = session.prepare_frontier(front, nodes, p, make([("k", 0, 2)], "collection_id string, depth int, tries int"))
    assert rows(lay) == [("k", "r", 0, 0, "r", 1, 2)] and rest.count() == 0
    kids = make([("r", "a", "A", 1, "TERM"), ("r", "b", "B", 2, "KEY_VALUE_PAIR")], "parent_id string, child_id string, title string, ord int, node_type string")
    cp = make([("r", "a", 1, 0, "u", 0, 5, "x"), ("r", "b", 2, 0, "u", 4, 9, "y")], "parent_id string, child_id string, ord long, ptr_ord int, source_cluster_id string, start_char int, end_char int, verbatim_text string")
    spans = make([("r", "u", 0, 9)], "parent_id string, source_cluster_id string, start_char int, end_char int")
    u = make([("u", "0123456789")], "source_cluster_id string, text string")
    said = make([("k", True, ["fine"])], "collection_id string, satisfied boolean, notes array<string>")
    r = session.review_layer(lay, kids, cp, spans, u, said).first()
    assert (r.satisfied, r.coverage_ok, r.n_overlaps, r.n_gaps, r.tries) == (False, True, 1, 0, 3) and r.notes == ["fine", "overlap conflict: a vs b @ u:4-5"]
    assert session.review_layer(lay, kids, cp, spans, u, said, checked=False).first().satisfied
    alone = session.review_layer(lay, kids, cp.where("child_id = 'a'"), spans, u).first()
    assert (alone.satisfied, alone.coverage_ok, alone.n_gaps) == (False, False, 1)
    res = make([("k", True, 1, {"split_strategy": "old", "own": "x"}), ("l", True, 0, {})], "collection_id string, satisfied boolean, review_rounds int, metadata map<string,string>")
    got = {x.collection_id: x for x in session.apply_review(res, session.review_layer(lay, kids, cp, spans, u, said).withColumn("strategy_used", F.lit("new"))).collect()}
    assert (got["k"].satisfied, got["k"].review_rounds, got["k"].metadata["split_strategy"], got["k"].metadata["own"], got["k"].metadata["layer_coverage_ok"]) == (False, 2, "new", "x", "true") and got["l"].review_rounds == 0
    tree = session.commit_layer(nodes, kids.select(F.col("child_id").alias("node_id"), "parent_id", "node_type", "title"))
    assert rows(tree.select("node_id", "level_from_root")) == [("a", 1), ("b", 1), ("r", 0)]
    nxt = session.enqueue(rest, lay, kids.withColumnRenamed("child_id", "node_id"), 10)
    assert rows(nxt) == [("k", "a", 1, 0)] and session.enqueue(rest, lay, kids.withColumnRenamed("child_id", "node_id"), 1).count() == 0
    assert rows(session.replayed(lay, tree).select("node_id")) == [("a",), ("b",)]


def test_gate_and_small_operators(make):
    c = make([(0.5,), (0.99,)], "coverage double")
    assert rows(session.validation_gate(c)) == [(0.5, False, "text coverage below threshold: 0.500 < 0.990"), (0.99, True, None)]
    a, b = session.split_by(make([(1,), (5,), (None,)], "x int"), F.col("x") > 2)
    assert rows(a) == [(5,)] and rows(b) == [(1,), (None,)] or rows(b) == [(None,), (1,)]
    ids = lambda *x: make([(i,) for i in x], "id string")
    assert rows(session.unmatched_ids(ids("a", "b", None, "a"), ids("b", "c"), "id")) == [("a", "extra"), ("c", "missing")]
    n = make([("x", "t", 2), ("x", "s", 1)], "node_id string, title string, ord int")
    assert session.find_node(n, "x").first().title == "s" and session.find_node(n, "y").count() == 0
    assert X.zero_of(T.StructType.fromDDL("a string, b array<int>, c struct<d: double, e: boolean>")) == {"a": "", "b": [], "c": {"d": 0.0, "e": False}}
    d = make([("call 555-1234 now", "2024-01-02 03:04:05.678")], "t string, ts string")
    assert d.select(X.clip("t", 9, r"\d")).first()[0] == "call ███-" and d.select(X.iso_utc(F.to_timestamp("ts"))).first()[0] == "2024-01-02T03:04:05.678+00:00"


def test_refine_gate_and_images(make):
    assert units.text_kept(["Total 12", " ", None], ["Sum", "Total 12"]) and not units.text_kept(["Total 12"], ["Total 13"])
    long_ = "The quick brown fox jumps over the lazy dog and then over the fence again"
    assert units.text_kept([long_], [long_.replace("quick", "quikc")]) and not units.text_kept([long_], [long_[:40] + " and what follows here is another text, long enough to stand for it"])
    i = make([(1, "/a/b.jpg", None, None), (2, None, "aGk=", None), (3, "", "aGk=", "own.png")], "page_number int, image_path string, image_bytes_b64 string, filename string")
    assert rows(units.image_payloads(i).select("file_name", "content")) == [("own.png", bytearray(b"hi")), ("page_1.jpg", None), ("page_2.png", bytearray(b"hi"))]
    with pytest.raises(Exception, match="needs a path"):
        units.image_payloads(make([(1, None, "", None)], "page_number int, image_path string, image_bytes_b64 string, filename string")).collect()
    pages = units.rasterised(make([("f.pdf", bytearray(b"x"))], "path string, content binary"), lambda p: p.assign(page_number=1)[["path", "page_number", "content"]].astype({"page_number": "int32"}))
    assert rows(pages.select("path", "page_number")) == [("f.pdf", 1)]
    o = make([(1, 5), (1, 6), (2, 7), (2, 7)], "record_id long, object_id long")
    assert rows(units.response_checks(o)) == [(1, True), (2, False)]


def test_additions_lean_on_each_other(make):
    c = make([(1, "a", 0), (1, "b", 1), (2, "x", 0)], "chain_id long, file_path string, position long")
    a = make([(1, "n1", "a", None), (2, "n2", "n1", None), (3, "n3", None, "a"), (4, "alone", None, None), (5, "lost", "gone", None), (6, "n4", "a", None), (7, "late", None, "alone")], "seq long, file_path string, prev string, next string")
    got = {}
    for r in versions.apply_additions(c, a).orderBy("chain_id", "position").collect():
        got.setdefault(r.chain_id, []).append(r.file_path)
    assert got == {1: ["n3", "a", "n1", "n2", "n4", "b"], 2: ["x"], 3: ["late", "alone"]}
    assert versions.apply_additions(c, a.limit(0)).count() == 3 and versions.apply_additions(c.limit(0), a.where("seq = 4")).count() == 1
    n = make([(1, "p.PDF"), (2, "q.txt"), (3, "r.pdf")], "id long, file_path string")
    h = make([(3, 0, "h")], "node_id long, page_num int, page_hash string")
    assert rows(versions.backfill(n, h, lambda m: m.select("node_id", F.lit(0).alias("page_num"), F.lit("new").alias("page_hash")))) == [(1, 0, "new"), (3, 0, "h")]


def test_frontier_order_limits_and_what_is_not_reached(make):
    n = make([("r", None, "DOCUMENT_ROOT", 0), ("b", "r", "PAGE", 1), ("a", "r", "PAGE", 2), ("a1", "a", "KEY_VALUE_PAIR", 0), ("b1", "b", "PAGE", 9), ("k", "a1", "PAGE", 0), ("o", "gone", "PAGE", 0), ("l", "m", "PAGE", 0), ("m", "l", "PAGE", 0)], "node_id string, parent_id string, node_type string, ord int")
    assert [(r.node_id, r.depth, r.wave_order) for r in layers.frontier(n).orderBy("depth", "wave_order").collect()] == [("r", 0, 0), ("b", 1, 0), ("a", 1, 1), ("b1", 2, 0), ("a1", 2, 1), ("k", 3, 0)]
    assert rows(layers.frontier(n, 2).select("node_id")) == [("a",), ("b",), ("r",)]
    assert rows(layers.frontier(n, expandable=lambda: F.col("node_type") != "KEY_VALUE_PAIR").select("node_id")) == [("a",), ("a1",), ("b",), ("b1",), ("r",)]


def test_frontier_takes_few_jobs_and_matches_a_walk(make, spark, monkeypatch):
    rnd = random.Random(5)
    parent = {f"n{i}": f"n{rnd.randrange(i)}" if i > 3 else None for i in range(80)} | {f"c{i}": f"c{i - 1}" if i else "" for i in range(37)} | {f"d{i}": f"d{i - 1}" if i else "c2" for i in range(36)} | {"x": "y", "y": "x", "z": "x", "s": "s", "o": "gone", "o1": "o"}
    rows_ = [(k, p, rnd.choice("PQ") if k[0] == "n" else "P", rnd.randrange(3)) for k, p in parent.items()]
    kids = {}
    for k, p, _, o in rows_:
        kids.setdefault(p or "", []).append((o, k))
    kind = {r[0]: r[2] for r in rows_}

    def walk(opens):
        layer, depth, out = [k for _, k in sorted(kids[""])], 0, []
        while layer:
            out += [(k, depth, i) for i, k in enumerate(layer)]
            layer, depth = [c for k in layer if opens(k) for _, c in sorted(kids.get(k, []))], depth + 1
        return sorted(out)

    n = make(rows_ + rows_[:9], "node_id string, parent_id string, node_type string, ord int")
    for widest in (2, 4, 64):
        monkeypatch.setattr(hierarchy, "WIDEST", widest, raising=False)
        assert sorted(tuple(r) for r in layers.frontier(n).collect()) == walk(lambda k: True)
    assert sorted(tuple(r) for r in layers.frontier(n, expandable=lambda: F.col("node_type") == "P").collect()) == walk(lambda k: kind[k] == "P")
    flat = make([(f"{d}.{i}", f"{d}.{(i - 1) // 3}" if i else None, "P", i) for d in range(5) for i in range(50)], "node_id string, parent_id string, node_type string, ord int")
    spark.sparkContext.setJobGroup("flat", "frontier of flat trees")
    try:
        assert layers.frontier(flat).count() == 250
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("flat"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 80, jobs


def test_heights_match_brute_force(make):
    rnd = random.Random(2)
    parent = {f"n{i}": f"n{rnd.randrange(i)}" if i else None for i in range(60)} | {f"c{i}": f"c{i - 1}" if i else None for i in range(33)} | {"x": "y", "y": "x", "z": "x", "s": "s"}
    kids = {}
    for k, v in parent.items():
        kids.setdefault(v, []).append(k)
    deep = lambda k: 1 + max(map(deep, kids[k])) if k in kids else 0
    rows_ = links(make(list(parent.items()), "id string, parent string"), "id", "parent")
    assert {r.id: r.height for r in heights(rows_).collect()} == {k: deep(k) for k in parent if k not in "xys"}
    assert heights(rows_.limit(0)).count() == levels(rows_.limit(0)).count() == 0


def test_collapsed_and_fuzzy_search_and_ladder(make):
    t = "one  two\n\nthree one two three"
    assert grounding.collapsed_find(t, "one two") == (0, 7) and grounding.collapsed_find(t, "one two", 15) == (16, 22) and grounding.collapsed_find(t, " ") is None
    hit = grounding.fuzzy_find("intro. The  keeper\nsigns the ledger before noon. outro", "The keeper sigms the ledger before noon.")
    assert hit and hit[0] <= 8 and hit[2] >= 0.95
    u = make([("d|p1_t0", "Alpha  clause of the treaty"), ("d|p1_t1", "needle in hay"), ("d|p2_t0", "far thing")], "source_cluster_id string, text string")
    p = make([("a", 0, "d|p1_t0", 0, 4, "Alpha"), ("b", 0, "d|p1_t0", 1, 2, "Alpha clause"), ("c", 0, "d|p1_t0", 0, 3, "needle"), ("e", 0, "d|p1_t0", None, None, "thing"), ("f", 0, "d|p1_t0", 20, 22, "nowhere")], "node_id string, ptr_ord int, source_cluster_id string, start_char int, end_char int, verbatim_text string")
    got = {r.node_id: (r.tier, r.unit, r.start_char) for r in legacy.ladder(p, u).collect()}
    assert got["a"] == ("same", "d|p1_t0", 0) and got["c"] == ("elsewhere", "d|p1_t1", 0) and got["e"] == ("elsewhere", "d|p2_t0", 4) and got["f"][0] == "lost"


def test_first_of_repeated_ids_and_edge_spans(make):
    new = make([("a", 2, "late"), ("a", 1, "soon"), ("b", 1, "x")], "id string, at int, v string")
    assert rows(graph.insert_if_absent(make([("b",)], "id string"), new, order="at")) == [("a", 1, "soon")]
    n = make([("r", None, "d", "R", 0, "DOCUMENT_ROOT"), ("c", "r", "d", "C", 1, "PAGE"), ("e", "r", "d", "E", 1, "PAGE")], "node_id string, parent_id string, document_id string, title string, level_from_root int, node_type string")
    p = make([("r", 0, "d|p3_t0", 0, 4, "whole"), ("c", 0, "d|p3_t0", 1, 2, "ho")], "node_id string, ptr_ord int, source_cluster_id string, start_char int, end_char int, verbatim_text string")
    e = graph.edge_spans(graph.graph_edges(n), graph.graph_nodes(n, p))
    assert {r.target_ids[0]: r.mentions[0].excerpt for r in e.collect()} == {"c": "ho", "e": "whole"}
    ln, le = graph.legacy_graph(n, p)
    got = {r.id: r for r in ln.collect()}
    assert got["r"].kind == "document_root" and got["c"].summary == "C:\nho" and got["c"].mentions[0].page_number == 3 and got["c"].mentions[0].end_char == 2 and got["e"].mentions is None
    assert all(r.mentions[0].excerpt == "whole" for r in le.collect())
