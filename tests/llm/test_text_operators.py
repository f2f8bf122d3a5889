import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pagegrain.functions.textvec import Words
from pagegrain.llm import leakage, mixing, mojibake, near_duplicates, queries, repetition, scan_noise, truncation

W = lambda t: re.findall(r"[^\W_]+", (t or "").lower())


def test_words_match_a_regex():
    texts = ["Ab aB, c-d e_f 1.5", "", None, "été ÉTÉ ١٢ ß", "x" * 50_000 + " y"]
    w = Words(texts)
    assert w.counts().tolist() == [len(W(t)) for t in texts]
    by = {}
    for d, s, e, h in zip(w.doc, w.start, w.end, w.hash):
        assert by.setdefault(texts[d][s:e].lower(), h) == h
    assert len(set(by.values())) == len(by)


def brute_repeats(t, n=4):
    w, seen, hit = W(t), set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i : i + n])
        if g in seen:
            hit |= set(range(i, i + n))
        seen.add(g)
    return len(w), len(hit)


def test_repetition_matches_brute_force(make):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(60))) for _ in range(200)] + [None, "", "A b, C d. a B c D", "w " * 200_000]
    df = make([(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1)], "i int, text string, n_words int")
    got = {r.i: (r.n_words, r.n_repeated) for r in repetition.repetition(df).collect()}
    assert got == {i: brute_repeats(t) for i, t in enumerate(texts)}
    assert repetition.repetition(df.limit(0)).count() == 0


def test_the_band_rejects_no_repeating_text(make):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(NOUN) + rnd.choice(["", "s", "ly", "-é", "12"]) for _ in range(rnd.randrange(80))) for _ in range(150)]
    texts += [t + ". " + " ".join(W(t)[: int(len(W(t)) * rnd.random())]).upper() for t in texts] + [None, "", "中文字 " * 30, "w " * 50_000, "x" * 20_000]
    texts += [" ".join(rnd.sample("abcdefghijklmnopqrstuvwxyz", 16)) for _ in range(20)]
    for share in (0.3, 0.6):
        keep = repetition.may_repeat(texts, share, repetition.default_vocabulary())
        want = [(n >= 12, n >= 12 and r >= share * n) for n, r in map(brute_repeats, texts)]
        assert all(k or not hit for k, (_, hit) in zip(keep, want)) and not all(k for k, (long_, _) in zip(keep, want) if long_)
    df = make([(i, t) for i, t in enumerate(texts)] * 2, "cluster_uid int, text string")
    hits = {i for i, (n, r) in enumerate(map(brute_repeats, texts)) if n >= 12 and r >= 0.3 * n}
    assert {r[0] for r in repetition.repeating_texts(df, "cluster_uid").collect()} == hits
    assert repetition.repeating_texts(df.limit(0), "cluster_uid").count() == 0


def test_fertility(make):
    df = make([("the cat sat on the mat " * 5,), ("中\U0001f600ก" * 20,), (None,), ("",)], "text string")
    plain, odd, none, empty = (r.asDict() for r in repetition.fertility(df).collect())
    assert plain["chars_per_token"] > odd["chars_per_token"] and odd["byte_share"] > plain["byte_share"] == 0
    assert none["n_tokens"] == empty["n_tokens"] == 0 and none["token_entropy"] is None
    assert plain["token_entropy"] <= repetition.entropy_ceiling(plain["n_tokens"])
    m = repetition.fertility(make([("abc def " * 10,)] * 50 + [("zq" * 40,)], "text string").withColumn("script", repetition.script_of()))
    assert repetition.fertility_bands(m, "script").first().script == "latin"


SENT = ["The keeper signs the {0} before noon.", "No {0} may be moved without the {1}.", "Where the {0} meets the {1}, a fee is due.", "Every {0} follows its own {1}."]
NOUN = ["ledger", "crane", "meter", "orchard", "boiler", "seal", "annex", "quarry", "lantern", "docket"]


def prose(rnd, n=4):
    return " ".join(rnd.choice(SENT).format(rnd.choice(NOUN), rnd.choice(NOUN)) for _ in range(n))


CL = "cluster_uid long, page_id long, document_id string, pdf_page_num int, cluster_number int, text string, ocr_model_name string"


def test_truncation(make):
    rnd = random.Random(4)
    data = [(i, 1000 + i, f"d{i}", 1, 0, prose(rnd), "m") for i in range(150)]
    whole = "The keeper signs the ledger before noon. No crane may be moved without the lantern. Where the docket meets the annex, a fee is due. Every seal follows its own meter."
    extra = [
        (200, "e0", 1, 0, whole), (201, "e1", 1, 0, whole[:150]), (202, "e2", 1, 0, prose(rnd)[:120] + " the"), (203, "e3", 1, 0, "Repair of the Boiler"), (204, "e4", 1, 0, "ledger | AB-12 | 4 | Name"),
        (205, "e5", 1, 0, "(c) the open ledger of the yard;"), (206, "e6", 1, 0, prose(rnd)[:90] + "..."), (207, "e7", 1, 0, prose(rnd)[:90] + " […]"), (208, "e8", 1, 0, "Every seal follows its own meter. Where the docket meets"),
        (209, "e8", 2, 0, "the annex, a fee is due. The keeper signs the seal before noon."), (210, "e9", 1, 0, None), (211, "e9", 1, 1, " "), (212, "e10", 1, 0, "Every seal follows its own meter. Where the docket meets"), (213, "e10", 2, 0, "No crane may be moved without the seal."),
        (214, "e11", 1, 0, prose(rnd)[:80] + "�"),
    ]
    df = make(data + [(u, 1, d, p, n, t, None) for u, d, p, n, t in extra] + [(202, 1, "e2", 1, 0, extra[2][4], None)], CL)
    got = {r.cluster_uid: r.evidence for r in truncation.truncated(df).collect()}
    assert got.keys() == {201, 202, 206, 207, 212, 214} and got[201] == "copy" and got[206] == got[214] == "mark" and got[212] == "closing"
    pages = make([(1, True), (1, True)], "page_id long, incomplete_text boolean")
    rep = {r.ocr_model_name: r for r in truncation.truncation_report(df, truncation.truncated(df), pages).collect()}
    assert rep[None].n_cut == 6 and rep["m"].n_cut == 0 and rep[None].n_cut_claimed == 6
    assert truncation.truncated(df.limit(0)).count() == 0


def test_opening_after_many_headings(make):
    rnd = random.Random(4)
    head = ["Repair of the Boiler", "ledger | AB-12 | 4", "Care of the Seal", "- the crane", "Use of the Annex"]
    data = [(i, 1000 + i, f"d{i}", 1, 0, prose(rnd), "m") for i in range(150)] + [(212, 1, "e", 1, 0, "Every seal follows its own meter. Where the docket meets", None)]
    data += [(300 + i, 2, "e", 2, i, t, None) for i, t in enumerate([*head, "the annex, a fee is due. The keeper signs the seal before noon."])]
    assert truncation.truncated(make(data, CL)).count() == 0


def test_goes_on():
    a = "one two three four five six seven eight nine ten eleven twelve"
    assert truncation.goes_on(a[:-7], a) and not truncation.goes_on(a, a[:-7]) and not truncation.goes_on(a, a) and not truncation.goes_on("x", a)
    assert truncation.goes_on("one two three four five six", a) and not truncation.goes_on("zz yy xx ww vv one two three four five six", a)


def test_copies_cut_to_any_share_are_found(make):
    rnd = random.Random(21)
    noun = lambda: rnd.choice(NOUN) + str(rnd.randrange(40))
    data, want = [], set()
    for i, share in enumerate((30, 50, 70, 80, 85, 95)):
        words = [noun() for _ in range(100)]
        whole = " ".join(words) + "."
        some = list(words[: share])
        some[7] = "edited"
        data += [(1000 + i, whole), (2000 + i, " ".join(some))]
        want.add(2000 + i)
    hot = [noun() for _ in range(60)]
    data += [(3000 + i, " ".join(hot) + f" end{i % 7} of it all.") for i in range(300)] + [(4000 + i, " ".join(hot[:45])) for i in range(300)]
    df = make([(u, u, f"d{u}", 1, 0, t, "m") for u, t in data], CL)
    got = {r.cluster_uid: r.evidence for r in truncation.truncated(df).collect()}
    assert {u for u, e in got.items() if e == "copy"} == want | {4000 + i for i in range(300)}
    cands = truncation._scan(df).where("kind = 'cut'")
    assert truncation._copies(df, cands).count() < 40  # equal texts are one, and a group's longest stand for it


def test_the_longest_text_hides_no_copy(make):
    rnd = random.Random(31)
    words = [rnd.choice(NOUN) + str(rnd.randrange(1000)) for _ in range(100)]
    texts = {1: " ".join(words[:60]), 2: " ".join(words[:65]) + ".", 3: " ".join(words[:55] + words[80:93]) + "."}
    assert truncation.goes_on(texts[1], texts[2]) and not truncation.goes_on(texts[1], texts[3])
    df = make([(u, u, f"d{u}", 1, 0, t, "m") for u, t in texts.items()], CL)
    assert {r.cluster_uid: r.evidence for r in truncation.truncated(df).collect()} == {1: "copy"}


def test_copies_match_all_pairs(make, monkeypatch):
    monkeypatch.setattr(truncation, "BLOCK", 1)  # many rounds
    rnd = random.Random(32)
    texts = []
    for _ in range(12):
        base = [rnd.choice(NOUN) + str(rnd.randrange(30)) for _ in range(rnd.choice([30, 60, 90]))]
        for _ in range(12):
            some = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                some[rnd.randrange(len(some))] = "edited" + str(rnd.randrange(3))
            some = [rnd.choice(NOUN) for _ in range(rnd.choice([0, 0, 3, 30]))] + some
            texts.append(" ".join(some[: int(len(some) * rnd.choice([0.4, 0.7, 0.9, 1]))]) + rnd.choice(["", "."]))
    texts += [None, "", "a b", "w " * 30, "w " * 50 + ".", " ".join(map(str, range(20_000))), " ".join(map(str, range(30_000))) + "."]
    n = [len(W(t)) for t in texts]
    want = {i for i, a in enumerate(texts) if n[i] >= 10 and not a.endswith(".") and any(n[j] > n[i] and truncation.goes_on(a, b) for j, b in enumerate(texts))}
    df = make([(i, i, f"d{i}", 1, 0, t, "m") for i, t in enumerate(texts)] * 2, CL)
    assert {r.cluster_uid for r in truncation.truncated(df).collect() if r.evidence == "copy"} == want
    assert len(want) > 20


RAW = "response_id long, document_id string, pdf_page_num int, response_json string"


def noisy(make):
    rnd = random.Random(6)
    body = [(i, 100 + i, f"b{i}", 1, 0, " ".join(prose(rnd, 6).split()), "m") for i in range(60)]
    cases = [
        (301, "h", 1, 0, "Care of the Old Orchard"), (302, "h", 1, 1, "The keeper signs the led-\nger before noon."), (303, "h", 1, 2, "- 1 -"), (304, "h", 2, 0, "Care of the Old 0rchard   2\nNo crane may be moved without the lantem of the yard and the quarry.\nEvery seal follows its own meter."),
        (305, "h", 2, 1, "ii"), (306, "h", 2, 2, "Page 7 of 9"), (307, "h", 3, 0, "Tbe cranc follows its own meter."), (308, "h", 3, 1, "It is a cross-\nreference to a cross-reference."), (309, "h", 3, 2, None), (310, "h", 3, 3, ""), (311, "h", 3, 4, "3"),
    ]
    rows_ = body + [(u, 7000 + u, d, p, n, t, None) for u, d, p, n, t in cases]
    return make(rows_ + rows_[-3:], CL), make([(1, "r", 1, '{"boxes_2d": [{"label": "The keeper signs the ledger and the lan\\u00ad\\ntern.", "id": 4}]}'), (2, "r", 2, "{broken")], RAW)


def test_scan_noise(make):
    clusters, raw = noisy(make)
    got = set(map(tuple, scan_noise.noise(clusters, raw).collect()))
    assert {(o, r - 7000 if o == "cluster" else r, k) for o, r, _, k in got} == {
        ("cluster", 301, "running"), ("cluster", 302, "hyphen"), ("cluster", 303, "page_number"), ("cluster", 304, "running"), ("cluster", 304, "misread"), ("cluster", 305, "page_number"), ("cluster", 307, "misread"), ("cluster", 311, "page_number"), ("box", 1, "hyphen"),
    }
    fixed = {(r.origin, r.record_id): r.repaired_text for r in scan_noise.repaired(clusters, raw).collect()}
    assert fixed["cluster", 7302] == "The keeper signs the ledger before noon." and fixed["cluster", 7303] == "" and "lantern" in fixed["cluster", 7304] and fixed["cluster", 7304].startswith("No crane")
    assert fixed["cluster", 7307].split()[1] == "crane" and "cross-reference to" in fixed["cluster", 7308] and fixed["box", 1].endswith("lantern.")
    assert scan_noise.noise(clusters.limit(0), raw.limit(0)).count() == 0


def test_candidates_are_complete():
    vocab = ["modern", "clarify", "hill", "barn", "window", "register", "under"]
    trie = scan_noise.build_trie(vocab)
    for w in vocab:
        for seen, meant in scan_noise.CONFUSIONS:
            for m in re.finditer(re.escape(meant), w):
                assert (w, 1) in scan_noise.candidates(trie, w[: m.start()] + seen + w[m.end() :]) or w[: m.start()] + seen + w[m.end() :] in vocab
    assert scan_noise.candidates(trie, "zzz") == [] and scan_noise.candidates({}, "a") == []


def test_levenshtein_automaton_is_complete():
    def edits(w):
        out = {w[:i] + c + w[i + n :] for i in range(len(w) + 1) for n in (0, 1) if i + n <= len(w) for c in ("", "é", "x")}
        return out | {w[: m.start()] + seen + w[m.end() :] for seen, meant in scan_noise.CONFUSIONS for m in re.finditer(re.escape(meant), w)} - {w}

    rnd = random.Random(5)
    vocab = ["of", "it", "été", "größe", "modern", "clarify", "register", "władza", "under"]
    trie = scan_noise.build_trie(vocab)
    for w in vocab:
        known, once = scan_noise.meeting_forms(w, False), sorted(edits(w) - {""})
        for x in set(once) - {w}:
            assert w in dict(scan_noise.candidates(trie, x)), (w, x)
            assert len(x) < 2 or known & scan_noise.meeting_forms(x, True), (w, x)
        twice = sorted({x + y for i in range(1, len(w)) for x in edits(w[:i]) for y in edits(w[i:])} - {w, ""})
        for x in rnd.sample(twice, min(150, len(twice))):
            assert dict(scan_noise.candidates(trie, x, 2))[w] <= 2, (w, x)
            assert len(x) < scan_noise.TWO or known & scan_noise.meeting_forms(x, True), (w, x)


def test_misreadings_beyond_the_table(make):
    rnd = random.Random(6)
    texts = [prose(rnd, 6) for _ in range(60)] + ["See 26 marzo 2012 here."] * 2 + [f"See {i % 28} march 2012 here." for i in range(60)]
    wrong = ["Thus the kéeper signs the seal before noon.", "Thus the kceqer signs the seal before noon.", "No crane may bc moved without the seal.", "A beeper is loud and the beeper was sold.", "Every seal follows its ovn meter."]
    rows_ = [(i, i, f"d{i}", 1, 0, t, "m") for i, t in enumerate(texts)] + [(900 + i, 900 + i, f"w{i}", 1, 0, t, "m") for i, t in enumerate(wrong)]
    clusters, raw = make(rows_, CL), make([], RAW)
    got = {r.record_id for r in scan_noise.noise(clusters, raw).where("kind = 'misread'").collect()}
    assert got == {900, 901, 902, 904}
    fixed = {r.record_id: r.repaired_text for r in scan_noise.repaired(clusters, raw).where("record_id >= 900").collect()}
    assert fixed[900] == fixed[901] == "Thus the keeper signs the seal before noon." and "may be moved" in fixed[902] and fixed[903] == wrong[3] and "its own meter" in fixed[904]


def test_long_words_meet_whatever_is_wrong_in_two_places():
    rnd = random.Random(8)
    for n in (22, 23, 24, 25, 26, 27, 40, 90):
        for _ in range(60):
            w = "".join(rnd.choice("abcdmnrlie") for _ in range(n))
            x = w
            for _ in range(2):
                i = rnd.randrange(len(x))
                seen, meant = rnd.choice(scan_noise.CONFUSIONS)
                x = rnd.choice([x[:i] + x[i + 1 :], x[:i] + "q" + x[i:], x[:i] + "q" + x[i + 1 :], x.replace(meant, seen, 1)])
            if x != w:
                assert scan_noise.meeting_forms(w, False) & scan_noise.meeting_forms(x, True), (w, x)
                assert w in dict(scan_noise.candidates(scan_noise.build_trie([w]), x, 2))
    assert len(scan_noise.meeting_forms("x" * 50_000, True)) < 200


def test_paragraphs_go_on_over_texts_and_pages(make):
    t = [("d", 1, 0, "A heading"), ("d", 1, 1, "The keeper signs the"), ("d", 1, 2, "ledger before noon."), ("d", 1, 3, "No crane may be mo-"), ("d", 2, 0, ""), ("d", 2, 1, "ved without"), ("d", 3, 0, "the seal"), ("d", 4, 5, "of the yard."), ("d", 4, 6, "every"), ("d", 6, 0, "lone end."), (None, None, 0, "x")]
    df = make([("cluster", 1, i, d, p, x, 0) for d, p, i, x in t] + [("box", 1, 0, "d", 2, "ved alone.", 0)], "origin string, record_id long, item_id long, document_id string, page int, repaired_text string, n_fixed long")
    got = [(r.page, r.item_id, r.n_parts, r.paragraph) for r in scan_noise.paragraphs(df).where("origin = 'cluster' AND document_id = 'd'").orderBy("page", "item_id").collect()]
    assert got == [(1, 0, 1, "A heading"), (1, 1, 2, "The keeper signs the ledger before noon."), (1, 3, 4, "No crane may be moved without the seal of the yard."), (4, 6, 1, "every"), (6, 0, 1, "lone end.")]
    assert scan_noise.paragraphs(df).count() == 7
    assert scan_noise.repair_text("One para-\ngraph\nhere.\n \nTwo\nlines.", {}, {"paragraph"}, False, False) == "One paragraph here.\n\nTwo lines."


def test_page_numbers():
    ok = [("- 4 -", 4), ("Page 4 of 9", 4), ("[12]", 12), ("xiv", 14), ("— 3 —", 3), ("Folio 7", 7), ("5 / 8", 5)]
    assert all(scan_noise.is_page_number(t, p) for t, p in ok)
    assert not any(scan_noise.is_page_number(t, p) for t, p in [("4", 5), ("mix", 1), ("", 1), ("4 apples", 4), ("4", None)])


def brute_pairs(sets, t):
    ids = sorted(sets)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}


@pytest.mark.parametrize(("t", "hot"), [(0.6, 2000), (0.7, 3), (0.8, 2000)])
def test_similar_pairs_lose_nothing(make, monkeypatch, t, hot):
    monkeypatch.setattr(near_duplicates, "HOT", hot)
    rnd = random.Random(int(t * 100))
    sets = {}
    for i in range(260):
        base = set(rnd.sample(range(400), rnd.choice([1, 2, 3, 5, 12, 20, 60, 150]))) if i % 3 == 0 or not sets else set(sets[rnd.choice(list(sets))])
        for _ in range(rnd.randrange(6)):
            base ^= {rnd.randrange(400)}
        sets[i] = base
    sets[900], sets[901] = set(range(5000)), set(range(400, 5200))
    df = make([(i, [int(x) for x in s]) for i, s in sets.items()] + [(0, [int(x) for x in sets[0]])], "id long, toks array<long>")
    got = near_duplicates.similar_pairs(df, t)
    assert set(map(tuple, got.select("id_a", "id_b").collect())) == brute_pairs(sets, t)


def test_near_duplicate_records_and_groups(make):
    text = " ".join(f"w{i}" for i in range(30))
    c = make([(1, text), (2, text + " end"), (3, text), (3, text), (4, "short text"), (5, None), (6, "")], "cluster_uid long, text string")
    n = make([(1, "a/b/report_one.pdf"), (2, "a/b/report_one2.pdf"), (3, None), (4, "x")], "id long, file_path string")
    h = make([(1, "p"), (1, "q"), (2, "q"), (2, "p"), (2, None), (9, "p"), (9, "q")], "node_id long, page_hash string")
    assert rows(near_duplicates.near_duplicate_records(c, n, h)) == [("cluster", 1, 2), ("cluster", 1, 3), ("cluster", 2, 3), ("pages", 1, 2), ("path", 1, 2)]
    s = near_duplicates.record_sets("cluster", c, n, h)
    g = near_duplicates.similarity_groups(s, 0.7)
    assert rows(g) == [(1, 1, 2), (2, 1, 2), (3, 1, 2)]
    assert near_duplicates.near_duplicate_records(c.limit(0), n.limit(0), h.limit(0)).count() == 0


def test_leakage(make):
    item = " ".join(f"i{i}" for i in range(30))
    docs = {1: "x " * 20 + item + " y", 2: " ".join(f"i{i}" for i in range(15, 30)) + " z " + " ".join(f"i{i}" for i in range(12)), 3: " ".join(f"i{i}" for i in range(9)), 4: None, 5: "", 6: item.upper().replace(" ", ", ")}
    d = make([(i, t, "e") for i, t in docs.items()] + [(1, docs[1], "e")], "doc_id long, text string, item_id string")
    e = make([(1, item, "s"), (2, "too short", "s"), (3, None, "s"), (1, item, "s")], "item_id long, text string, suite string")
    got = {r.doc_id: (r.covered_words, r.n_tiles, r.longest) for r in leakage.leaked(d, e, k=10).collect()}
    assert got == {1: (30, 1, 30), 2: (27, 2, 15), 6: (30, 1, 30)}
    assert {r.item_id: (r.n_docs, r.searchable) for r in leakage.leak_report(leakage.leaked(d, e), e).collect()} == {1: (3, True), 2: (0, False), 3: (0, False)}
    assert leakage.leaked(d.limit(0), e).count() == leakage.leaked(d, e.limit(0)).count() == 0


def test_reordered_passages_are_found_by_coverage(make):
    item = [f"i{i}" for i in range(30)]
    pieces = [item[i : i + 6] for i in range(0, 30, 6)]
    e = make([(1, " ".join(item), "s")], "item_id long, text string, suite string")
    d = make([(1, " z ".join(" ".join(x) for x in pieces[::-1])), (2, " ".join(pieces[0]) + " z " + " ".join(pieces[3])), (3, " y ".join(" ".join(x) for x in pieces[:4]))], "doc_id long, text string")
    assert rows(leakage.leaked(d, e)) == [(1, 1, 30, 30, 5, 6), (3, 1, 30, 24, 4, 6)]
    assert leakage.leaked(d, e, k=10, coverage=1.0).count() == 0


def brute_tiles(item, doc, k):
    """Longest free match first, found anew each time."""
    free_i, free_d, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and free_i[a + n] and free_d[b + n]:
                    n += 1
                if n >= k and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return out
        out.append(best)
        for x in range(best[2]):
            free_i[best[0] + x] = free_d[best[1] + x] = False


def test_tiling_matches_brute_force():
    rnd = random.Random(12)
    for _ in range(60):
        item, doc = ([rnd.randrange(5) for _ in range(rnd.randrange(5, 40))] for _ in range(2))
        for k in (2, 3):
            seeds = [(a, b) for a in range(len(item) - k + 1) for b in range(len(doc) - k + 1) if item[a : a + k] == doc[b : b + k]]
            got = leakage.tile(*np.array(seeds, np.int32).T, k) if seeds else []
            assert sorted(got, key=lambda t: (-t[2], t[0], t[1])) == got and got == brute_tiles(item, doc, k)


def test_quotas_and_splits():
    q = mixing.quotas({"a": 1000, "b": 10, "c": 0}, {"a": (0.5, 1), "b": (0.25, 4), "c": (0.25, 9), "d": (0.1, 1)})
    assert q == {"a": 80, "b": 40}
    assert mixing.quotas({}, {"a": (1.0, 1)}) == {} and mixing.quotas({"a": 5}, {"a": (1.0, 2)}, 100) == {"a": 10}
    m = mixing.split_blocks(np.array([100, 7, 0]), 13, 1)
    assert m.sum(axis=0).tolist() == [100, 7, 0] and m.sum(axis=1).max() - m.sum(axis=1).min() <= 2 and (m >= 0).all()


def test_large_draws_are_hypergeometric():
    rng = np.random.default_rng(1)
    good, bad, n = 3 * 10**9, 7 * 10**9, 2 * 10**9
    x = np.array([mixing.hypergeometric(rng, good, bad, n) for _ in range(1500)], np.float64)
    sd = (n * 0.3 * 0.7 * (good + bad - n) / (good + bad - 1)) ** 0.5
    assert abs(x.mean() - 0.3 * n) < 4 * sd / len(x) ** 0.5 and abs(x.std() / sd - 1) < 0.08
    y = np.array([mixing.hypergeometric(rng, 10**9, 2 * 10**9, 500) for _ in range(600)], np.float64)
    assert abs(y.mean() - 500 / 3) < 2.5 and abs(y.std() / (500 * 2 / 9) ** 0.5 - 1) < 0.15
    assert mixing.hypergeometric(rng, 10**10, 0, 10**9) == 10**9 and mixing.hypergeometric(rng, 5, 10**10, 10**10 + 5) == 5
    m = mixing.split_blocks(np.array([2 * 10**9, 10**9, 3]), 5, 1)
    assert m.sum(axis=0).tolist() == [2 * 10**9, 10**9, 3] and m.sum(axis=1).max() - m.sum(axis=1).min() <= 2 and (m >= 0).all()


def test_mix(make):
    rnd = random.Random(8)
    sizes = make([(i, "big" if i % 3 else "small" if i % 2 else None, rnd.randrange(1, 200)) for i in range(3000)] + [(9999, "big", 0), (9998, "other", 50)], "doc_id long, source string, n_tokens long")
    targets = make([("big", 0.5, 1), ("small", 0.45, 3), ("missing", 0.05, 2)], "source string, target_share double, max_repeats int")
    m = mixing.mix(sizes, targets, shards=8, block_tokens=512).collect()
    use = Counter((r.doc_id, r.source) for r in m)
    assert max(n for (_, s), n in use.items() if s == "big") <= 1 and max(use.values()) <= 3 and all(len({r.copy for r in m if r.doc_id == d}) == n for (d, _), n in list(use.items())[:20])
    tot = Counter()
    for r in m:
        tot[r.source] += r.n_tokens
    assert abs(tot["big"] / sum(tot.values()) - 0.5 / 0.95) < 0.005 and set(tot) == {"big", "small"}
    assert {r.shard for r in m} == set(range(8))
    for k in range(8):
        assert sorted(r.pos for r in m if r.shard == k) == list(range(sum(r.shard == k for r in m)))
    again = mixing.mix(sizes.repartition(7), targets, shards=8, block_tokens=512).collect()
    assert set(map(tuple, again)) == set(map(tuple, m))
    sh = {r.source: r for r in mixing.mix_shares(mixing.mix(sizes, targets, shards=8, block_tokens=512), targets).collect()}
    assert sh["missing"].reached_share == 0 and sh["big"].most_uses == 1
    assert mixing.mix(sizes.limit(0), targets).count() == 0 and mixing.mix(sizes, targets.limit(0)).count() == 0
    t = make([(1, "s", "Hello world"), (2, None, None), (3, "s", "")], "doc_id long, source string, text string")
    assert rows(mixing.token_sizes(t).select("doc_id", "n_tokens")) == [(1, 2), (2, 0), (3, 0)]


def test_garbled_forms_round_trip():
    for w in ("résumé", "Größe", "źdźbło", "’s", "“quoted”"):
        forms = mojibake.garbled_forms(w)
        assert w.encode().decode("latin-1") in forms and w not in forms
        twice = w.encode().decode("latin-1").encode().decode("latin-1")
        assert twice in forms
    assert mojibake.garbled_forms("plain") == {}
    long_ = "é" + "abcdefgh" * 6
    mis = lambda t, *codecs: t if not codecs else mis(t.encode().decode(codecs[0], "replace"), *codecs[1:])
    forms = mojibake.garbled_forms(long_)
    for c in (("latin-1",) * 3, ("latin-1", "cp437", "koi8-r"), ("cp850", "latin-1", "mac_roman")):
        assert mis(long_, *c) in forms, c
    assert mis(long_.encode("cp1252").decode("cp1250"), "latin-1") in forms and "utf-8" in forms[mis(long_.encode("cp1252").decode("mac_roman"), "latin-1")]
    assert mis(long_, "latin-1").encode("cp1252", "replace").decode("mac_roman") in forms


def test_mojibake(make):
    clean = "Le procédé révisé est daté à l’hôtel près du marché, où l’été déjà passé."
    bad = clean.encode().decode("latin-1")
    docs = [(i, clean) for i in range(40)] + [(100, bad), (101, "Only " + "été".encode().decode("latin-1")), (102, clean.encode("cp1252").decode("cp1251")), (103, "procédé".encode("latin-1").decode("utf-8", "replace") + " ok"), (104, "½ × ¾ · SÃO"), (105, None), (106, ""), (107, "“new’s”".encode().decode("latin-1")), (108, "zz\ufffdq")]
    df = make(docs + [docs[41]], "doc_id long, text string")
    # 107 has no clean form in this corpus, but its apostrophe has
    assert [r[0] for r in rows(mojibake.garbled_documents(df))] == [100, 101, 102, 103, 107, 108]
    got = {r.doc_id: (r.restored_text, r.n_lost) for r in mojibake.restored(df).collect()}
    assert got[100] == (clean, 0) and got[101] == ("Only été", 0) and got[102][0] == clean and got[103] == ("procédé ok", 0) and got[108] == ("zz\ufffdq", 1)
    assert mojibake.garbled_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("write, read, share", [("cp1252", "cp1250", 3), ("cp1252", "mac_roman", 3), ("utf-8", "cp1252", 3), ("utf-8", "cp1252", 1.4)])
def test_heavily_garbled_source(make, write, read, share):
    clean = "El niño señaló la función del jardín en otoño según la razón pública número {0}"
    texts = [clean.format(i) for i in range(60)]
    bad = set(range(int(60 / share)))
    df = make([(i, t.encode(write).decode(read) if i in bad else t) for i, t in enumerate(texts)] + [(100 + i, texts[0].encode(write).decode(read)) for i in range(50)], "doc_id long, text string")
    assert {r.doc_id for r in mojibake.garbled_documents(df).collect()} == bad | set(range(100, 150))
    got = {r.doc_id: r.restored_text for r in mojibake.restored(df).collect()}
    assert all(got[i] == texts[i] for i in bad)


def test_every_found_query_has_its_columns():
    assert {"p1_found", "p4_found", "p5_found", "p7_found", "p8_found", "p10_found", "p9_mix"} <= set(queries.queries())
    assert all(v.__doc__ for v in queries.queries().values())


def test_hot_group_of_copies(make):
    text = " ".join(f"t{i}" for i in range(40))
    df = make([(i, text if i % 3 == 0 else f"{i} " + " ".join(f"u{i}_{j}" for j in range(30))) for i in range(120)], "cluster_uid long, text string")
    p = near_duplicates.similar_pairs(near_duplicates.word_sets(df, "cluster_uid", "text", 3, 24), 0.7)
    assert p.count() == 40 * 39 // 2
    assert p.agg(F.min("similarity")).first()[0] == 1.0
    assert near_duplicates.class_pairs(near_duplicates.word_sets(df, "cluster_uid", "text", 3, 24), 0.7)[1].count() == 0
    g = near_duplicates.similarity_groups(near_duplicates.word_sets(df, "cluster_uid", "text", 3, 24), 0.7)
    assert rows(g.groupBy("n_links").count()) == [(0, 80), (39, 40)]


def test_an_original_that_is_garbled_itself_is_followed(make):
    mis = lambda t, n: t if not n else mis(t.encode().decode("latin-1"), n - 1)
    docs = [(i, "Le procédé passé") for i in range(50)] + [(100 + i, mis("procédé", 3)) for i in range(10)] + [(200, "x " + mis("procédé", 5))]
    got = {r.doc_id: r.restored_text for r in mojibake.restored(make(docs, "doc_id long, text string")).collect()}
    assert got[200] == "x procédé" and got[100] == "procédé" and 0 not in got
