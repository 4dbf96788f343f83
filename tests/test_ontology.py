from __future__ import annotations

import pytest

from annofold.operators import ontology as onto
from annofold.sources import obo

OBO = """format-version: 1.2

[Term]
id: X:1
name: root
namespace: biological_process

[Term]
id: X:2
name: middle
namespace: biological_process
alt_id: X:22
alt_id: X:21
is_a: X:1 ! root

[Term]
id: X:3
name: leaf
namespace: biological_process
is_a: X:2 ! middle
relationship: regulates X:1 ! root

[Term]
id: X:4
name: cell
namespace: cellular_component

[Term]
id: X:5
name: part
namespace: cellular_component
relationship: part_of X:4 ! cell
is_a: X:1 ! other branch

[Term]
id: X:6
name: old
namespace: biological_process
is_obsolete: true

[Typedef]
id: part_of
name: part of
"""


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("obo") / "x.obo"
    path.write_text(OBO)
    return onto.build_ontology(*obo(spark, str(path)))


def test_terms(tables, rows):
    assert rows(tables.all_terms, "term", "branch", "is_obsolete", "n_alt_ids") == [
        ("X:1", "BP", False, 0),
        ("X:2", "BP", False, 2),
        ("X:3", "BP", False, 0),
        ("X:4", "CC", False, 0),
        ("X:5", "CC", False, 0),
        ("X:6", "BP", True, 0),
    ]
    assert tables.terms.count() == 5
    assert rows(tables.alt_ids) == [("X:21", "X:2"), ("X:22", "X:2")]


def test_edges_and_ancestors(tables, rows):
    assert rows(tables.edges, "child_term", "parent_term", "relation") == [("X:2", "X:1", "is_a"), ("X:3", "X:2", "is_a"), ("X:5", "X:4", "part_of")]
    assert rows(tables.edge_drops) == [("cross_branch", 1), ("kept", 3)]
    assert rows(tables.ancestors, "term", "ancestor", "distance") == [("X:2", "X:1", 1), ("X:3", "X:1", 2), ("X:3", "X:2", 1), ("X:5", "X:4", 1)]
    assert rows(onto.parents_of(tables.edges)) == [("X:2", ["X:1"]), ("X:3", ["X:2"]), ("X:5", ["X:4"])]


def test_every_drop_reason(spark, rows):
    terms = spark.createDataFrame([("a", "MF"), ("b", "MF"), ("c", "CC"), ("d", None)], "term string, branch string")
    edges = spark.createDataFrame(
        [("a", "b", "is_a"), ("a", "b", "regulates"), ("z", "b", "is_a"), ("a", "z", "is_a"), ("a", "d", "is_a"), ("a", "c", "part_of")],
        "child_term string, parent_term string, relation string",
    )
    got = {(r["child_term"], r["parent_term"], r["relation"]): r["drop_reason"] for r in onto.classify_edges(edges, terms).collect()}
    assert got == {
        ("a", "b", "is_a"): None,
        ("a", "b", "regulates"): "relation",
        ("z", "b", "is_a"): "unknown_child",
        ("a", "z", "is_a"): "unknown_parent",
        ("a", "d", "is_a"): "unknown_branch",
        ("a", "c", "part_of"): "cross_branch",
    }
    assert dict(rows(onto.edge_drop_counts(onto.classify_edges(edges, terms, ["is_a"]))))["relation"] == 2


def test_closure_equals_breadth_first_search_even_with_cycles(spark):
    import random

    random.seed(3)
    names = [f"n{k}" for k in range(25)]
    pairs = {(random.choice(names), random.choice(names)) for _ in range(45)}
    terms = spark.createDataFrame([(n, "MF") for n in names], "term string, branch string")
    edges = spark.createDataFrame(sorted(pairs), "child_term string, parent_term string")
    got = {(r["term"], r["ancestor"]): r["distance"] for r in onto.ancestor_table(terms, edges).collect()}
    want = {}
    for start in names:
        level, seen, d = {start}, {start}, 0
        while level:
            d += 1
            level = {p for c, p in pairs if c in level} - seen
            seen |= level
            want |= {(start, p): d for p in level}
    assert got == want


def test_label_closure(spark, tables, rows):
    labels = spark.createDataFrame(
        [("A", "X:3", "BP"), ("B", "X:21", "BP"), ("B", "X:2", "BP"), ("C", "X:6", "BP"), ("C", "X:9", "BP"), ("D", "X:5", "MF"), ("D", None, None)],
        "entry_id string, term string, branch string",
    )
    closed = onto.close_labels(labels, tables.terms, tables.ancestors, tables.alt_ids)
    assert rows(closed) == [
        ("A", "X:1", "P", "BP", False, 2, 1),
        ("A", "X:2", "P", "BP", False, 1, 1),
        ("A", "X:3", "P", "BP", True, 0, 1),
        ("B", "X:1", "P", "BP", False, 1, 2),
        ("B", "X:2", "P", "BP", True, 0, 2),
        ("D", "X:4", "C", "CC", False, 1, 1),
        ("D", "X:5", "C", "CC", True, 0, 1),
    ]
    issues = onto.label_issues(labels, tables.terms, tables.alt_ids, tables.all_terms)
    assert rows(issues) == [("alt_id", "X:21"), ("branch_mismatch", "X:5"), ("missing", "X:9"), ("obsolete", "X:6")]


def test_errors(spark, tmp_path):
    bad = tmp_path / "bad.obo"
    bad.write_text("[Term]\nname: nameless\n")
    with pytest.raises(Exception, match="without an id"):
        obo(spark, str(bad))[0].collect()
    twice = spark.createDataFrame([("a", ["x"]), ("b", ["x"])], "term string, alt_ids array<string>")
    with pytest.raises(ValueError, match="x"):
        onto.alt_id_table(twice)


def brute_distances(pairs):
    up = {}
    for c, p in pairs:
        if c != p:
            up.setdefault(c, set()).add(p)
    out = {}
    for start in up:
        seen, edge, d = {start}, {start}, 0
        while edge:
            d += 1
            edge = {p for c in edge for p in up.get(c, ())} - seen
            seen |= edge
            out |= {(start, p): d for p in edge}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_closure_of_random_graphs(spark, seed):
    import random

    rng = random.Random(seed)
    n = [12, 60, 40][seed]
    pairs = [(f"t{rng.randrange(n)}", f"t{rng.randrange(n)}") for _ in range(n + n // 3)]  # with cycles and repeats
    reach, _ = onto.closure(spark.createDataFrame(pairs, "child_term string, parent_term string"))
    assert {(r["term"], r["ancestor"]): r["distance"] for r in reach.collect()} == brute_distances(pairs)


def test_a_round_joins_only_what_the_last_one_reached(spark):
    chain = [(f"t{k:02d}", f"t{k + 1:02d}") for k in range(40)] + [("x", "t00"), ("x", "t39")]
    reach, rounds = onto.closure(spark.createDataFrame(chain, "child_term string, parent_term string"))
    assert {(r["term"], r["ancestor"]): r["distance"] for r in reach.collect()} == brute_distances(chain)
    joined = [r.joined for r in rounds]
    assert len(rounds) == 6  # distances 1, 2, 4, ..., 32, of at most 40
    assert joined[0] == 42 and all(a > b for a, b in zip(joined[1:], joined[2:], strict=False))
    assert joined[-1] == 10  # pairs at a distance of 32: nine of the chain, and one of x
    assert sum(r.added for r in rounds) + len(chain) == reach.count()
    nothing, none = onto.closure(spark.createDataFrame([], "child_term string, parent_term string"))
    assert nothing.count() == 0 and none == []
