from conftest import rows
from pyspark.sql import functions as F

from pagegrain.operators import state, telemetry, versions


def pages(make, seqs):
    return versions.hash_pages(make([(n, i, h) for n, s in seqs.items() for i, h in enumerate(s)], "node_id long, page_num int, page_hash string"))


def test_containment(make):
    p = pages(make, {1: "ab", 2: "xabab", 3: "axb", 4: "b", 5: "xa", 6: "ab"})
    found = versions.contained(p)
    assert rows(found.where("small_id = 1").select("big_id", "start_page")) == [(2, 1), (2, 3), (6, 0)]
    assert rows(found.where("small_id = 5").select("big_id", "start_page")) == [(2, 0)]
    assert rows(found.where("small_id = 3")) == [] and found.where("small_id = 4").count() == 5
    d = versions.containment_duplicates(found, versions.page_counts(p))
    assert (6, 1) in rows(d) and (1, 6) not in rows(d)
    assert versions.contained(p.limit(0)).count() == 0
    pairs = make([(1, 3), (3, 1), (9, 1)], "small_id long, big_id long")
    assert {(r.small_id, r.big_id): r.is_subsequence for r in versions.gapped_subsequence(p, pairs).collect()} == {(1, 3): True, (3, 1): False, (9, 1): True}


def test_chains(make):
    n = make([(1, 7, None), (2, 7, 1), (3, 7, 2), (3, 7, 2), (4, 8, 99), (5, 8, 4), (6, 9, 6)], "id long, chain_id long, prev_id long")
    pos = versions.chain_positions(n)
    assert rows(pos) == [(7, 1, 0), (7, 2, 1), (7, 3, 2), (8, 4, 0), (8, 5, 1)]
    got = rows(versions.insert_node(pos, 7, 50, before=2).where("chain_id = 7"))
    assert got == [(7, 1, 0, None, 50), (7, 2, 2, 50, 3), (7, 3, 3, 2, None), (7, 50, 1, 1, 2)]
    assert rows(versions.delete_nodes(pos, make([(2,)], "id long")).where("chain_id = 7")) == [(7, 1, 0, None, 3), (7, 3, 1, 1, None)]


def test_ledger_nulls(make):
    n = make([(1, "a", "h"), (2, "b", "h"), (3, "c", None), (4, "d", "k")], "id long, file_path string, file_hash string")
    assert rows(versions.duplicates_by_hash(n)) == [("h", 2, 1)]
    ledger = make([("b", "h")], "file_name string, file_hash string")
    assert rows(versions.canonical_files(n, ledger).select("id")) == [(1,), (3,), (4,)]
    assert rows(versions.non_duplicates_null_aware(n, ledger).select("id")) == [(4,)]
    assert versions.non_duplicates_null_aware(n, make([(None, None), ("b", "h")], "file_name string, file_hash string")).count() == 0
    assert versions.non_duplicates_null_aware(n, ledger.limit(0)).count() == 4
    u = versions.update_nodes(n, make([(1, "z")], "id long, file_path string"))
    assert rows(u.select("id", "file_path"))[0] == (1, "z")


def test_state(make):
    log = make([("d", 1, "ocr", 1, "failed", "m1", "h", None), ("d", 1, "ocr", 2, "completed", "m2", "h", "a"), ("d", 2, "ocr", 3, "failed", "m1", "h2", None)], "document_id string, page_number int, stage string, ts int, status string, model_name string, content_hash string, artifact_path string")
    s = state.latest(log, "ts")
    assert rows(s.select("page_number", "attempt_count", "status")) == [(1, 2, "completed"), (2, 1, "failed")]
    plan = make([("d", 1, "ocr", "h"), ("d", 1, "tree", "h"), ("d", 2, "ocr", "h2")], "document_id string, page_number int, stage string, content_hash string")
    assert rows(state.to_do(plan, s).select("page_number", "stage", "skip")) == [(1, "ocr", True), (1, "tree", False), (2, "ocr", False)]
    total = make([("d", 2), ("e", 0)], "document_id string, total_pages int")
    assert rows(state.completion(s, total).select("document_id", "is_completed")) == [("d", False), ("e", False)]
    pg = make([("d", 2, "x"), ("d", 1, "y"), ("e", 1, None)], "document_id string, page_number int, content_hash string")
    assert rows(state.fingerprint(pg)) == rows(state.fingerprint(pg.orderBy("content_hash").repartition(3)))
    hook = lambda p, m: p.withColumn("text", F.when((F.col("page_number") == 1) | F.lit(m == "backup"), "ok"))
    tried = state.run_ladder(pg.select("document_id", "page_number"), ["primary", "backup"], hook, lambda: F.col("text").isNotNull())
    assert rows(state.first_success(tried)) == [("d", 1, "primary", 0, True), ("d", 2, "backup", 1, True), ("e", 1, "primary", 0, True)]


def test_cost_and_cache(spark, make):
    calls = make([("models/gemini-2.5-flash", 1000, 2000, 400), ("gemini-2.5-flash", 100, 0, 400), (None, 1000, 0, None)], "model_name string, input_tokens int, output_tokens int, cached_tokens int")
    got = [(round(r.cost, 9), r.priced) for r in telemetry.with_cost(calls, telemetry.price_table(spark)).collect()]
    assert got == [(round(0.6 * 0.0003 + 0.4 * 0.0000375 + 2 * 0.0025, 9), True), (0.000015, True), (0.00000125, False)]
    seen = []
    cache = make([("k1", "old")], "key string, answer string")

    def hook(miss):
        seen.extend(r.key for r in miss.collect())
        return miss.withColumn("answer", F.lit("new"))

    out, new = telemetry.cached_calls(make([("k1",), ("k2",), ("k2",)], "key string"), cache, hook)
    assert rows(out) == [("k1", "old", True), ("k2", "new", False), ("k2", "new", False)] and rows(new) == [("k2", "new")] and seen == ["k2"]
    e = make([(1, "a"), (2, "a"), (3, None)], "id long, event_name string")
    assert rows(telemetry.distinct_events(e)) == [(1, "a"), (3, None)]
