import random

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from pagegrain.operators.components import components
from pagegrain.operators.hierarchy import descendants, hierarchy, links, loop_members, loops


def walk(parent):
    """Brute force: loop id of every id whose line never ends, path of the others."""
    bad, path = {}, {}
    for i in parent:
        line, at = [], i
        while at in parent and at not in line:
            line.append(at)
            at = parent[at]
        if at in line:
            bad[i] = min(line[line.index(at) :])
        else:
            path[i] = line[::-1]
    return bad, path


def check(make, parent):
    df = links(make(list(parent.items()), "id string, parent string"), "id", "parent")
    bad, path = walk({k: v or None for k, v in parent.items()})
    assert {r.id: r.loop_id for r in loops(df).collect()} == bad
    got = hierarchy(df).collect()
    assert {r.id: r.path for r in got} == {k: "/".join(p) for k, p in path.items()}
    assert all(r.depth == len(path[r.id]) - 1 and r.root == path[r.id][0] for r in got)
    span = {r.id: (r.root, r.entry, r.exit) for r in got}
    for a in span:
        below = {b for b in span if span[b][0] == span[a][0] and span[a][1] < span[b][1] and span[b][2] < span[a][2]}
        assert below == {b for b in path if a in path[b][:-1]}
        assert next(r.n_descendants for r in got if r.id == a) == len(below)


def test_trees_loops_and_orphans(make):
    check(make, {"a": None, "b": "a", "c": "a", "d": "b", "x": "y", "y": "z", "z": "x", "t": "x", "u": "t", "o": "gone", "p": "o", "s": "s", "e": ""})


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10**6))
def test_random_forests(make, seed):
    rnd = random.Random(seed)
    ids = [f"n{i}" for i in range(40)]
    check(make, {i: rnd.choice([None, *ids, "missing"]) for i in ids})


def test_long_chain_and_wide_root(make):
    chain = {f"c{i:04d}": f"c{i - 1:04d}" if i else None for i in range(70)}
    wide = {"r": None} | {f"k{i}": "r" for i in range(200)}
    check(make, chain | wide)


def test_all_loop_and_empty(make):
    check(make, {"a": "b", "b": "a"})
    empty = links(make([], "id string, parent string"), "id", "parent")
    assert loops(empty).count() == 0 and hierarchy(empty).count() == 0


def test_repeated_rows_and_extra_columns(make):
    df = make([("a", None, 1), ("a", None, 1), ("b", "a", 2), (None, "a", 3)], "node_id string, parent_id string, ptr int")
    h = hierarchy(links(df, "node_id", "parent_id"))
    assert rows(h.select("id", "depth")) == [("a", 0), ("b", 1)]
    assert rows(descendants(h)) == [("a", "b")]


def test_loop_members_of_both_kinds(make):
    n = make([("a", "b"), ("b", "a")], "node_id string, parent_id string")
    e = make([("r", "r"), ("q", ""), ("q", None)], "run_id string, parent_run_id string")
    assert rows(loop_members(n, e)) == [("node", "a", "a"), ("node", "b", "a"), ("run", "r", "r")]


def test_components_match_union_find(make):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges = [e for e in edges if e[0] != e[1]]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(make(edges, "id_a long, id_b long")).collect()}
    assert got == {x: find(x) for x in up}
    assert components(make([], "id_a long, id_b long")).count() == 0


def test_further_parents_are_named(make):
    df = make([("a", "x"), ("a", "y"), ("a", "y"), ("b", ""), ("b", "x"), (None, "x"), ("c", None)], "node_id string, parent_id string")
    from pagegrain.operators.hierarchy import other_parents

    assert rows(other_parents(df, "node_id", "parent_id")) == [("a", "y")]


def test_entries_number_each_tour_without_holes(make):
    rnd = random.Random(9)
    parent = {f"m{i:03d}": f"m{rnd.randrange(max(0, i - 40), i):03d}" if i and i % 90 else None for i in range(300)} | {f"l{i}": "m001" for i in range(150)}
    got = hierarchy(links(make(list(parent.items()), "id string, parent string"), "id", "parent")).collect()
    for root in {r.root for r in got}:
        own = [r for r in got if r.root == root]
        assert sorted(x for r in own for x in (r.entry, r.exit)) == list(range(2 * len(own)))
