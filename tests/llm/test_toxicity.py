import random

import numpy as np

from contrail.llm import toxicity


def corpus(n=900):
    rng = random.Random(7)
    rows, known = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcde", k=4)) for _ in range(rng.randint(5, 60))]
        toxic = i % 8 == 0
        if toxic:
            words.insert(rng.randint(0, len(words)), "vile" + rng.choice(["x", "ness", "st", "ly", "r"]))
        rows.append((i, " ".join(words), "en"))
        if i % 2 == 0 or rng.random() < 0.2:
            known.append((i, None, int(toxic)))
    return rows, known


def test_held_out_accuracy(make_docs, labels):
    rows, known = corpus()
    got = {r.doc_id: r for r in toxicity.toxicity_scores(make_docs(rows), labels(known)).collect()}
    assert {i for i, r in got.items() if r.held_out} == {
        i for i in got if __import__("zlib").crc32(str(i).encode()) % 4 == 2}
    wrong = [i for i, r in got.items() if r.held_out and r.predicted != int(i % 8 == 0)]
    assert len(wrong) <= 0.02 * len(got)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    docs = make_docs(rows)
    kept = toxicity.drop_toxic(docs, labels(known))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_labels_of_held_out_documents_do_not_matter(make_docs, labels):
    rows, known = corpus(300)
    flipped = [(i, q, 1 - t if __import__("zlib").crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in known]
    a, b = (toxicity.toxicity_scores(make_docs(rows), labels(k)).orderBy("doc_id").collect() for k in (known, flipped))
    assert a == b


def test_risk_floor_keeps_weights_finite():
    toxic = [np.array([1, 2], np.uint32)] * 5
    model = toxicity.fit(toxic, [np.array([9], np.uint32)] * 50, 0.5)
    assert all(np.isfinite(w) and 0 <= w < 50 for w in model.weights.values())


def test_odd_rows(make_docs, odd_rows, empty_docs, labels):
    some = labels([(1, None, None), (None, 1, 1), (6, 1, 1), (6, 0, 0)])
    got = toxicity.toxicity_scores(make_docs(odd_rows), some).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in toxicity.toxicity_scores(make_docs(odd_rows), labels([])).collect()} == {0}
    assert toxicity.toxicity_scores(empty_docs, some).collect() == []
    assert toxicity.drop_toxic(empty_docs, labels([])).collect() == []


def test_a_sampled_id_is_one_text_however_often_it_is_repeated(make_docs, labels, monkeypatch):
    rows, known = corpus(300)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda toxic, plain, prior: seen.append((len(toxic), len(plain))))
    toxicity.train(make_docs(rows), labels(known))
    toxicity.train(make_docs(rows + [rows[0]] * 3_000 + [(rows[8][0], "another text", "en")] * 2_000), labels(known))
    assert seen[0] == seen[1]


def test_fit_lowers_the_corrected_risk():
    """Against the risk written out from its definition, with a numeric derivative at the end."""
    rng = random.Random(5)
    sets = [np.array(sorted({rng.randrange(40) for _ in range(8)} | ({100, 101} if i % 3 == 0 else set())), np.uint32)
            for i in range(240)]
    toxic, plain, prior = [s for s in sets if 100 in s][:40], sets, 0.33

    def risk(weights, bias):
        def loss(s, sign):
            return float(np.log1p(np.exp(-sign * (bias + sum(weights.get(int(f), 0.0) for f in s)))))
        as_toxic = np.mean([loss(s, 1) for s in toxic])
        negative = np.mean([loss(s, -1) for s in plain]) - prior * np.mean([loss(s, -1) for s in toxic])
        return prior * as_toxic + max(0.0, negative)

    start = toxicity.fit(toxic, plain, prior, steps=1)
    model = toxicity.fit(toxic, plain, prior, steps=400)
    assert set(model.weights) >= {100, 101} and all(model.weights[f] > 0 for f in (100, 101))
    assert risk(model.weights, model.bias) < risk(start.weights, start.bias) < risk({}, start.bias) + 1e-9
    scores = [model.bias + sum(model.weights.get(int(f), 0.0) for f in s) for s in sets]
    assert min(z for z, s in zip(scores, sets) if 100 in s) > max(z for z, s in zip(scores, sets) if 100 not in s)
