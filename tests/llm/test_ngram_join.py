import random

import pytest

from contrail.llm import ngram_join


def words_of(text):
    return text.encode().lower().split() if text else []


def shingles(text, size):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute_force(rows, size, threshold):
    """(doc_id, n, component) of rows (id, text) by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= threshold * len(sets[a] | sets[b]) and both:
                parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n_single, n_near, passage_in):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    base = rng.choices(vocabulary, k=90)
    texts = []
    for i in range(n_single):
        w = rng.choices(vocabulary, k=rng.randint(1, 120))
        texts.append(w + passage if i % passage_in == 0 else w)
    for _ in range(n_near):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(w)
    rng.shuffle(texts)
    texts += texts[:5]
    return [(i, " ".join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("size,threshold,part,queries", [(4, 85, 65_536, 64), (5, 80, 500, 2)])
def test_equals_all_pairs(make_docs, monkeypatch, size, threshold, part, queries):
    # small parts and few queries per task make the hot group span many parts
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", part)
    monkeypatch.setattr(ngram_join, "GROUP_QUERIES", queries)
    monkeypatch.setattr(ngram_join, "COUNT_BUFFER", 2_000)
    rows = corpus(size, 120, 80, 3)
    docs = make_docs([(i, t, "en") for i, t in rows])
    got = ngram_join.near_duplicates(docs, size, threshold).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_force(rows, size, threshold)


def test_other_ways_give_the_same(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROLES", 0)
    monkeypatch.setattr(ngram_join, "ROLES", 1)
    monkeypatch.setattr(ngram_join, "FREQUENT", 0)
    rows = corpus(9, 60, 40, 4)
    got = ngram_join.near_duplicates(make_docs([(i, t, "en") for i, t in rows])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_force(rows, 4, 85)


def test_odd_rows(make_docs, odd_rows):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in
           ngram_join.near_duplicates(make_docs(odd_rows)).collect()}
    assert got == {(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 2, None), (5, 1, 5), (6, 2, 6), (7, 2, 7), (8, 1, 8)}


def test_document_without_id_takes_its_copy_s_component(make_docs):
    docs = make_docs([(None, "a b c d e", "en"), (4, "A  B c d e", "en")])
    assert {(r.doc_id, r.component_id) for r in ngram_join.near_duplicates(docs).collect()} == {(None, 4), (4, 4)}


def test_keep_one(make_docs, odd_rows, empty_docs):
    rows = corpus(3, 30, 20, 5)
    docs = make_docs([(i, t, "en") for i, t in rows])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {d for d, _, c in brute_force(rows, 4, 85) if d == c}
    assert {r.doc_id for r in kept.collect()} == expected
    assert ngram_join.keep_one(make_docs(odd_rows)).count() == len(odd_rows)
    assert ngram_join.near_duplicates(empty_docs).collect() == []


@pytest.mark.parametrize("size,threshold,part,queries", [(4, 85, 65_536, 64), (5, 80, 500, 2)])
def test_every_link_is_counted(make_docs, monkeypatch, size, threshold, part, queries):
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", part)
    monkeypatch.setattr(ngram_join, "GROUP_QUERIES", queries)
    rows = corpus(7, 60, 40, 5)
    # repeated rows, ids with two texts, a null id and a null text
    rows += [rows[0], (rows[1][0], rows[2][1]), (rows[3][0], rows[50][1]), (None, rows[4][1]), (900, None)]
    links = {d: set() for d, _ in rows if d is not None}
    sets = [(d, shingles(t, size)) for d, t in rows if d is not None]
    for a, x in sets:
        for b, y in sets:
            if a != b and x and 100 * len(x & y) >= threshold * len(x | y):
                links[a].add(b)
    assert sum(map(len, links.values())) > 500
    docs = make_docs([(d, t, "en") for d, t in rows])
    got = ngram_join.link_counts(docs, size, threshold).collect()
    assert sorted((r.doc_id, r.n_links) for r in got) == sorted((d, len(s)) for d, s in links.items())
