import random
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from contrail.llm import quality_rules
from contrail.llm.columns import split_words


def repeated(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)})


def test_repeated_window_words(make_docs):
    rng = random.Random(1)
    texts = ["", "a", "a a", "a a a", "a a a a", "a b c a b c", "a b c d a b c"]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(1, 60))) for _ in range(60)]
    got = make_docs(texts).select("text", quality_rules.repeated_window_words(split_words(F.col("text"))).alias("n"))
    for r in got.collect():
        assert r.n == repeated(r.text.split()), r.text


@pytest.mark.parametrize("n,k,p", [(100, 0, 0.01), (1000, 3, 0.01), (5000, 20, 0.01), (400, 30, 0.1), (10, 9, 0.5)])
def test_binomial_tail(spark, n, k, p):
    q = Fraction(p)
    exact = float(sum(comb(n, j) * q ** j * (1 - q) ** (n - j) for j in range(k + 1))) if k < n * p else 1.0
    got = spark.range(1).select(quality_rules.binomial_tail(
        F.lit(float(k)), F.lit(float(n)), p).alias("x")).first().x
    assert got == pytest.approx(exact, rel=1e-9)


def corpus(n):
    rng = random.Random(4)
    rows, known = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [rng.choice("abcdefgh") * rng.randint(1, 6) + str(rng.randint(0, 10 ** 6)) for _ in range(60)]
        rows.append((i, " ".join(w + "###" * bad for w in words), "en" if i % 2 else "fr"))
        known.append((i, 0 if bad else 1, 0))
    return rows, known


def test_cutoffs_are_certified_and_used(make_docs, labels):
    rows, known = corpus(700)
    # only one stratum has enough labels to certify anything
    known = [k for k in known if k[0] % 2]
    options = dict(max_false_rejection=0.25, confidence=0.9)
    got = {r.doc_id: r for r in quality_rules.quality_digest(make_docs(rows), labels(known), **options).collect()}
    assert all(got[i].kept == (i % 5 != 0) for i, _, lang in rows if lang == "en")
    assert all(got[i].kept for i, _, lang in rows if lang == "fr")
    kept = quality_rules.keep_good(make_docs(rows), labels(known), **options)
    assert kept.columns == make_docs(rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_few_labels_reject_nothing(make_docs, labels):
    rows, known = corpus(40)
    got = quality_rules.quality_digest(make_docs(rows), labels(known)).collect()
    assert all(r.kept for r in got)


def test_odd_rows(make_docs, odd_rows, empty_docs, labels):
    some = labels([(1, None, None), (None, 1, 0), (6, 1, 0), (6, 0, 1)])
    got = quality_rules.quality_digest(make_docs(odd_rows), some).collect()
    assert len(got) == len(odd_rows)
    long = next(r for r in got if r.doc_id == 5)
    assert (long.n_words, long.n_repeat_words, long.base_failed, long.kept) == (30_000, 30_000, True, False)
    assert all(r.base_failed and not r.kept for r in got)
    assert quality_rules.quality_digest(empty_docs, labels([])).collect() == []
    assert quality_rules.keep_good(empty_docs, some).collect() == []


def test_repeated_rows_and_texts_are_one_trial(make_docs, labels):
    rng = random.Random(6)
    words = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(13)]
    rows = [(i, w.replace(" ", " ### ") if i < 3 else w, "en") for i, w in enumerate(words)]
    known = [(i, int(i >= 3), 0) for i in range(13)]
    repeated = rows * 300
    copied = rows + [(100 * k + i, t, lang) for i, t, lang in rows for k in range(1, 60)]
    copied_known = known + [(100 * k + i, q, t) for i, q, t in known for k in range(1, 60)]
    for docs, marks in ((rows, known), (repeated, known), (copied, copied_known)):
        measures = quality_rules.measured(make_docs(docs)).withColumn("th", F.md5("text"))
        assert quality_rules.certified_cutoffs(measures, labels(marks)).collect() == []
    # the rows would do if they counted as different documents
    other = [(100 * k + i, f"{t} z{k}", "en") for i, t, _ in rows for k in range(60)]
    measures = quality_rules.measured(make_docs(other)).withColumn("th", F.md5("text"))
    marks = [(100 * k + i, q, 0) for i, q, _ in known for k in range(60)]
    assert [r.rule for r in quality_rules.certified_cutoffs(measures, labels(marks), max_false_rejection=0.25).collect()]
