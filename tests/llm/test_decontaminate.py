import hashlib
import random
import re

import pytest

from contrail.llm import decontaminate

ITEMS = "item_id long, text string"


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]


def windows_of(words):
    return [tuple(words[i:i + 10]) for i in range(max(1, len(words) - 9))] if words else []


def brute_force(rows, items):
    index = [("" if i is None else str(i), w) for i, t in items for w in set(windows_of(words_of(t)))]
    result = []
    for doc_id, text in rows:
        words, hit, found = words_of(text), set(), set()
        for item, w in index:
            for at in range(len(words) - len(w) + 1):
                if tuple(words[at:at + len(w)]) == w:
                    hit.update(range(at, at + len(w)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(result, key=str)


def corpus():
    rng = random.Random(2)
    vocabulary = ["the", "of", "Über", "x1", "été"] + [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 9, 10, 11, 30])))) for i in range(25)]
    items += [(3, items[3][1]), (77, items[4][1]), (None, "null id item words here"), (80, None), (81, " .;: ")]
    rows = []
    for i in range(80):
        w = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 3 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = words_of(items[rng.randrange(25)][1])
        if i % 7 == 0:
            w += w[:20]
        rows.append((i, ", ".join(w)))
    return rows, items


@pytest.mark.parametrize("keys", [1_000_000, 20])
def test_equals_search_by_hand(spark, make_docs, monkeypatch, keys):
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", keys)
    rows, items = corpus()
    report = decontaminate.decontamination_report(
        make_docs([(i, t, "en") for i, t in rows]), spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, report.collect()), key=str) == brute_force(rows, items)


def test_drop_keeps_clean_rows(spark, make_docs):
    rows, items = corpus()
    docs = make_docs([(i, t, "en") for i, t in rows])
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame(items, ITEMS))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in brute_force(rows, items) if not r[5]}


def test_odd_rows(spark, make_docs, odd_rows, empty_docs):
    items = [(1, "word " * 12), (2, "same text here")]
    got = sorted(map(tuple, decontaminate.decontamination_report(
        make_docs(odd_rows), spark.createDataFrame(items, ITEMS)).collect()), key=str)
    assert got == brute_force([(i, t) for i, t, _ in odd_rows], items)
    no_items = spark.createDataFrame([], ITEMS)
    clean = decontaminate.decontamination_report(make_docs(odd_rows), no_items).collect()
    assert len(clean) == len(odd_rows) and not any(r.contaminated for r in clean)
    assert decontaminate.drop_contaminated(make_docs(odd_rows), no_items).count() == len(odd_rows)
    assert decontaminate.decontamination_report(empty_docs, spark.createDataFrame(items, ITEMS)).collect() == []
