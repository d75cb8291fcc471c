import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from contrail.llm import ranked_search
from contrail.llm.ranked_search import Treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for doc_id, c in held:
            m = 50 + 50 * c.total() * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top])]
    return sorted(rows, key=repr)


def run(docs, items, top):
    got = ranked_search.ranked_search(docs, items, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        rows.append((i, " ".join(rng.choices(words, range(120, 0, -1), k=rng.randint(1, 60)))))
    rows += [(n + i, rows[3][1]) for i in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells,docs_in,opened", [(300, 7, 2), (1_000_000, 16_384, 48)])
def test_equals_all_scores(spark, make_docs, monkeypatch, cells, docs_in, opened):
    for name, value in (("SHARD_CELLS", cells), ("SHARD_DOCS", docs_in), ("OPENED", opened), ("FIRST_SHARDS", 3),
                        ("ITEM_BLOCK", 100), ("COUNT_BUFFER", 50)):
        monkeypatch.setattr(ranked_search, name, value)
    docs = corpus(1, 160)
    rng = random.Random(7)
    items = [(k, " ".join(rng.choices([f"w{i}" for i in range(130)], k=rng.randint(1, 25)))) for k in range(12)]
    items += [(20, docs[0][1]), (20, docs[0][1]), (20, "w1 w2"), (21, None), (22, "no such term"), (23, "")]
    got = run(make_docs([(i, t, "en") for i, t in docs]).repartition(3),
              spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, number long"), 9)
    assert got == brute_force(docs, items, 9)


def test_odd_rows(spark, make_docs, odd_rows, empty_docs):
    docs = [(i, t) for i, t, _ in odd_rows]
    items = [(1, "one TWO Äöü same text"), (2, "日本語 ß"), (None, "word x"), (3, "\t -- \n")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert run(make_docs(odd_rows), table, 3) == brute_force(docs, items, 3)
    assert run(empty_docs, table, 3) == [] == run(make_docs(odd_rows), table.limit(0), 3)


@pytest.mark.parametrize("seed", range(4))
def test_treap_finds_the_largest_sums(seed):
    rng = np.random.default_rng(seed)
    grid = rng.integers(0, 40, (int(rng.integers(1, 40)), int(rng.integers(1, 300)))) * (rng.random((1, 1)) < 2)
    grid[rng.random(grid.shape) < 0.7] = 0
    grid[0, 0] = 5
    rows, columns = np.nonzero(grid)
    treap = Treap.load(Treap.build(rows, columns, grid[rows, columns]).dump())
    chosen = np.unique(rng.choice(np.unique(rows), 12))
    weights = rng.integers(1, 9, len(chosen))
    sums = weights @ grid[chosen]
    expected = sorted(((-s, c) for c, s in enumerate(sums.tolist()) if s > 0))
    for k in (1, 10, 1000):
        assert treap.top(chosen, weights, k, 0) == [(-s, c) for s, c in expected[:k]]
    floor = int(np.median(sums)) + 1
    assert treap.top(chosen, weights, 10, floor) == [(-s, c) for s, c in expected[:10] if -s >= floor]


def test_peaks_bound_all_cells_below():
    rng = np.random.default_rng(9)
    rows, columns = np.nonzero(rng.random((30, 50)) < 0.1)
    values = rng.integers(1, 1000, len(rows))
    treap = Treap.build(rows, columns, values)
    again = Treap.load(treap.dump())
    assert (treap.peaks == again.peaks).all() and (treap.maps == again.maps).all() and treap.peaks[0] == values.max()
    parent = np.repeat(np.arange(len(treap.maps)), ranked_search._CHILDREN[treap.maps])
    assert (treap.peaks[parent] >= treap.peaks[1:]).all()
