"""Paths by pointer doubling against level by level."""

import random

import pytest

from runweave.operators import graph as G

EDGES = "parent string, ord int, name string, child string"


def rows(df):
    return sorted(((r.node, r.path, list(r.ordinals)) for r in df.collect()), key=repr)


def forest(kind, rng):
    edges = []
    if kind == "wide":
        edges = [("root", i, f"n{i}", f"c{i}") for i in range(300)] + [(f"c{i % 7}", i, f"d{i}", f"d{i}") for i in range(90)]
    elif kind == "random":
        for i in range(1, 200):
            edges.append((f"k{rng.randrange(i)}" if i > 3 else "root", i, rng.choice(["a", "b.c", "", None]), f"k{i}"))
    elif kind == "unreached and circles":
        edges = [("root", 0, "a", "x"), ("x", 0, "b", "y"), ("p", 0, "c", "q"), ("q", 0, "d", "p"), ("s", 0, "e", "s"), ("lost", 1, "f", "g"), ("p", 4, "t", "u"), (None, 1, "n", "m")]
    return edges


@pytest.mark.parametrize("kind", ["wide", "random", "unreached and circles"])
def test_forest_equals_levels(spark, kind):
    edges = spark.createDataFrame(forest(kind, random.Random(3)), EDGES)
    roots = spark.createDataFrame([("root",)], "node string")
    want = rows(G._graph_paths(edges, roots))
    assert rows(G.tree_paths(edges, roots)) == want and len(want) > 2
    inner = edges.where("child is not null and parent is not null")
    assert rows(G._forest_paths(inner, roots)) == want


@pytest.mark.parametrize("kind", ["two parents", "root below a root", "root twice", "empty"])
def test_other_graphs_and_empty_ones(spark, kind):
    edges = [("root", 0, "a", "x"), ("root", 1, "b", "y"), ("y", 0, "c", "z")]
    roots = [("root",)]
    if kind == "two parents":
        edges += [("x", 0, "d", "z"), ("z", 0, "back", "root")]
    elif kind == "root below a root":
        roots += [("y",)]
    elif kind == "root twice":
        roots *= 2
    else:
        edges = []
    edges, roots = spark.createDataFrame(edges, EDGES), spark.createDataFrame(roots, "node string")
    made, want = G.tree_paths(edges, roots), G._graph_paths(edges, roots)
    assert made.columns == ["node", "path", "ordinals"] and rows(made) == rows(want)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    n, kept, keep = 1500, [], G.reliable_checkpoint
    monkeypatch.setattr(G, "reliable_checkpoint", lambda df: kept.append(1) or keep(df))
    edges = spark.createDataFrame([(f"k{i}", 0, "x", f"k{i + 1}") for i in range(n)], EDGES)
    made = G.tree_paths(edges, spark.createDataFrame([("k0",)], "node string"))
    assert {r.node: len(r.ordinals) for r in made.collect()} == {f"k{i}": i for i in range(n + 1)}
    assert len(kept) <= 13
