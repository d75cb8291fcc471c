import random

import numpy as np
import pytest

from contrail.llm import components, embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, n long"


def brute_force(rows):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, embedding, label) by all pairs."""
    def unit(x):
        if not x or any(v is None for v in x):
            return None
        x = np.array(x, np.float32).astype(float)
        return x / np.linalg.norm(x) if np.isfinite(x).all() and x.any() else None

    units = [None if label is None else unit(x) for _, x, label in rows]
    linked = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None
               and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
               and units[i] @ units[j] >= 0.93] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            new = set(linked[stack.pop()]) - seen
            seen |= new
            stack += new
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(linked[i]), low, rows[i][0] == low))
    return sorted(out, key=repr)


def vectors(seed, n, dim, copies):
    """Random vectors, chains of near copies, and exact copies under two labels."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(base)]
    for k in range(copies):
        turned = base[k % 7] + rng.normal(size=dim) * rng.choice([0, 0.1, 0.25, 0.35])
        rows.append((n + k, turned.tolist(), int(k % 3 == 0)))
    random.Random(seed).shuffle(rows)
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = embedding_dedup.near_duplicates(df, **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("cell,block,dim", [(40, 16, 8), (30, 2048, 3)])
def test_equals_all_pairs_over_many_cells_and_blocks(spark, monkeypatch, cell, block, dim):
    for name, value in (("CELL", cell), ("BLOCK", block), ("BLOCKS_PER_TASK", 2), ("ASSIGNED", 100)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rows = vectors(1, 250, dim, 150)
    assert run(spark, rows) == brute_force(rows)


def test_one_hot_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, base.tolist(), 4) for i in range(400)]
    rows += [(400 + i, (base + 0.02 * rng.normal(size=16)).tolist(), 4) for i in range(300)]
    rows += [(700 + i, rng.normal(size=16).tolist(), 4) for i in range(100)]
    assert run(spark, rows) == brute_force(rows)


def test_a_small_margin_keeps_most_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    rows = vectors(5, 300, 16, 300)
    exact, fast = (sum(r[1] for r in x) for x in (brute_force(rows), run(spark, rows, margin=0.02)))
    assert 0.9 * exact <= fast <= exact


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [1.0, nan], 0), (6, [1.0, inf], 0),
            (7, [1.0, 2.0], None), (8, [1.0, 2.0], None), (9, [1.0, 2.0], 0), (10, [2.0, 4.0], 0), (10, [2.0, 4.0], 0),
            (11, [1.0, 2.0, 0.0], 0), (None, [1.0, 2.1], 0), (None, [-1.0, 2.0], 0), (12, [3e38, 3e38], 1),
            (13, [1e-38, 1e-38], 1), (14, [1.0, 2.0], 1)]
    got = run(spark, rows)
    expected = brute_force(rows)
    assert got == expected
    assert (None, 0, None, True) in got


def test_empty_and_double_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [1.0, 0.1], "a"), (3, [1.0, 0.0], "b")],
                               "vec_id int, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_components_equal_a_search(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 7)
    rng = random.Random(2)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(4)
    forest = components.Forest()
    for a, b in edges:
        forest.join(a, b)
    expected = {(x, forest.root(x)) for e in edges if e[0] != e[1] for x in e}
    got = [tuple(r) for r in components.smallest_members(df).collect()]
    assert len(got) == len(set(got))
    assert {g for g in got} == {(x, r) for x, r in expected}
    assert components.smallest_members(df.limit(0)).collect() == []
