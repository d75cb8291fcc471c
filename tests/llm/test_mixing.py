import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from contrail.llm import mixing

LEVELS = ("domain", "lang", "source")


def fill(children, budget):
    """Shares of (name, cap, weight) children by raising a common level step by step."""
    share, open_ = {}, {c[0]: c for c in children if c[2] > 0}
    share.update({c[0]: 0 for c in children if c[2] == 0})
    while True:
        weight = sum(c[2] for c in open_.values())
        full = [n for n, c in open_.items() if c[1] * weight <= budget * c[2]]
        if not full:
            break
        first = min(full, key=lambda n: (open_[n][1] / open_[n][2], n))
        share[first] = open_[first][1]
        budget -= open_.pop(first)[1]
    left = budget
    for n, c in open_.items():
        share[n] = budget * c[2] // weight
        left -= share[n]
    for n in sorted(open_):
        if left > 0:
            share[n] += 1
            left -= 1
    return share


def brute_force(leaves, weights, total, epochs):
    """Budget of each leaf path by recursion."""
    def weight(level, name):
        return weights.get(level, {}).get(name, 1)

    def usable(path):
        return all(weight(l, n) > 0 for l, n in zip(LEVELS, path))

    cap = defaultdict(int)
    for path, tokens in leaves.items():
        for d in range(4):
            cap[path[:d]] += tokens * epochs * usable(path)
    result = {}

    def down(prefix, budget):
        if len(prefix) == 3:
            result[prefix] = budget
            return
        names = sorted({p[len(prefix)] for p in leaves if p[:len(prefix)] == prefix})
        shares = fill([(n, cap[(*prefix, n)], weight(LEVELS[len(prefix)], n)) for n in names], budget)
        for n in names:
            down((*prefix, n), shares[n])

    down((), min(total, cap[()]))
    return result


LEAVES = {("a", "en", "s1"): 1000, ("a", "en", "s2"): 10, ("a", "de", "s1"): 70, ("b", "en", "s3"): 33,
          ("b", "fr", "s4"): 400, ("b", "fr", "s5"): 400, ("c", "en", "s6"): 5000}
WEIGHTS = {"domain": {"a": 3, "b": 5, "c": 1}, "lang": {"en": 2}, "source": {"s2": 4, "s5": 0}}


@pytest.mark.parametrize("total", [0, 1, 7, 100, 999, 2500, 9000, 10 ** 6])
def test_budgets(spark, total):
    leaves = spark.createDataFrame([(*p, t) for p, t in LEAVES.items()], "domain string, lang string, source string, tokens long")
    got = mixing.leaf_budgets(leaves, WEIGHTS, F.lit(total).cast("long"))
    expected = brute_force(LEAVES, WEIGHTS, total, mixing.MAX_EPOCHS)
    assert {(r.domain, r.lang, r.source): r.budget for r in got.collect()} == expected
    assert sum(expected.values()) == min(total, sum(expected.values()) if total > 8000 else total)


def test_shortage_goes_to_siblings_first(spark):
    leaves = {("a", "en", "small"): 5, ("a", "en", "large"): 1000, ("b", "en", "other"): 1000}
    df = spark.createDataFrame([(*p, t) for p, t in leaves.items()], "domain string, lang string, source string, tokens long")
    got = {r.source: r.budget for r in mixing.leaf_budgets(df, {}, F.lit(400).cast("long")).collect()}
    assert got == {"small": 10, "large": 190, "other": 200}


@pytest.mark.parametrize("bucket", [65_536, 4])
def test_prefixes_of_seeded_epochs(make_docs, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = [(i, "w " * (1 + i * 7 % 13), "en" if i % 3 else "de") for i in range(120)]
    docs = make_docs(rows).withColumn("domain", F.when(F.col("doc_id") < 90, "a").otherwise("b"))
    got = mixing.mixture(docs, {"domain": {"b": 6}}, seed=5, total_tokens=700).collect()
    size = {i: 1 + i * 7 % 13 for i, _, _ in rows}
    leaf = {i: ("a" if i < 90 else "b", l, "src1") for i, _, l in rows}
    held = defaultdict(int)
    for i in size:
        held[leaf[i]] += size[i]
    budgets = brute_force(held, {"domain": {"b": 6}}, 700, 2)
    expected = []
    for path, budget in budgets.items():
        for epoch in (1, 2):
            for i in sorted((i for i in leaf if leaf[i] == path),
                            key=lambda i: hashlib.md5(f"5:{epoch}:{i}".encode()).hexdigest()) if budget < held[path] else [
                                i for i in leaf if leaf[i] == path]:
                if budget > 0:
                    expected.append((i, *path, epoch, size[i], min(size[i], budget)))
                    budget -= size[i]
    assert sorted(map(tuple, got)) == sorted(expected)
    assert sum(r.n_taken for r in got) == 700


def test_odd_rows(make_docs, odd_rows, empty_docs):
    docs = make_docs(odd_rows).withColumn("domain", F.lit(None).cast("string"))
    got = mixing.mixture(docs, {}, seed=1, total_tokens=10 ** 9).collect()
    # everything with a word, twice
    assert len(got) == 2 * (len(odd_rows) - 3)
    assert {r.domain for r in got} == {""}
    assert mixing.mixture(empty_docs.withColumn("domain", F.lit("a")), {}, seed=1, share=(1, 2)).collect() == []
