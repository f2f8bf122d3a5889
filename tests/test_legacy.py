from conftest import rows
from pyspark.sql import functions as F

from pagegrain.operators import legacy


def test_pointers_and_units(make):
    u = make([("d", 1, 0, "d|p1_t0"), ("d", 1, 0, "d|p1_i0"), ("e", 1, 0, "e|p1_t0")], "collection_id string, page_number int, cluster_number int, unit_id string")
    p = make([("n", "d", "p1_c0"), ("m", "d", "p9_c9"), ("k", "e", "e|p1_t0"), ("j", "e", None)], "node_id string, collection_id string, source_cluster_id string")
    got = legacy.canonical_pointers(p, legacy.legacy_aliases(u))
    assert rows(got.select("node_id", "source_cluster_id")) == [("j", None), ("k", "e|p1_t0"), ("m", "p9_c9"), ("n", "d|p1_i0")]


def test_small_helpers(make):
    d = make([([1], None, True, {"a": False}, [True, None])], "a array<int>, b array<int>, f boolean, m map<string,boolean>, l array<boolean>")
    assert d.select(legacy.concat_lists("a", "b")).first()[0] == [1] and d.select(legacy.concat_lists("b", "b")).first()[0] is None
    r = legacy.booleans_as_words(d).first()
    assert (r.f, r.m, r.l) == ("Yes", {"a": "No"}, ["Yes", None])
    t = make([('"a\\nb"',), ("plain 'x'",), ("'''q'''",), (None,)], "t string")
    assert [x[0] for x in t.select(legacy.unescaped("t")).collect()] == ["a\nb", "plain 'x'", "q", None]
    c = legacy.page_of_response(make([('{"OCR_text_clusters": [{"text": "x", "cluster_number": 3}]}',), ("broken {",), (None,)], "response_json string"))
    assert [x.clusters[0].text for x in c.collect()] == ["x", "broken {", ""]


def test_lost_text_elsewhere(make):
    lost = make([("n", 0, "d|p1_t0", "needle"), ("m", 0, "d|p1_t0", ""), ("k", 0, "d|p1_t0", "absent")], "node_id string, ptr_ord int, source_cluster_id string, verbatim_text string")
    u = make([("d|p1_t0", "nothing"), ("d|p1_t2", "a needle"), ("d|p0_t0", "needle"), ("e|p1_t1", "needle")], "source_cluster_id string, text string")
    assert rows(legacy.same_page_first(lost, u)) == [("n", 0, "d|p1_t2", 2)]
    units = make([("d", "u", "text", "a"), ("d", "u", "object", "b")], "document_id string, unit_id string, kind string, text string")
    assert rows(legacy.collide(units).select(F.col("text"))) == [("b",)]
