import random
import time

import numpy as np

from contrail.llm import license_scan
from contrail.llm.license_scan import Scanner, TEMPLATES, words_of


def test_index_loses_no_diagonal():
    """Alignments at every place find nothing that the fingerprints do not lead to."""
    rng = random.Random(3)
    scanner = Scanner(TEMPLATES)
    names = [words_of(t) for t in TEMPLATES.values()]
    for _ in range(60):
        words = [w.encode() for w in rng.choices(["the", "under", "license", "x", "y"], k=rng.randint(0, 30))]
        for t in rng.sample(names, 2):
            copy = list(t)
            if rng.random() < 0.5 and len(copy) > 8:
                copy[rng.randrange(len(copy))] = b"changed"
            at = rng.choice([0, len(words)])
            words[at:at] = copy
        everywhere = {t: list(range(-len(w), len(words))) for t, (_, w) in enumerate(scanner.templates)}
        assert scanner.matches(words, scanner.candidates(words), 0.8) == scanner.matches(words, everywhere, 0.8)


def test_spans_are_the_texts(make_docs):
    text = "Ü — x.\nReleased UNDER the\tMIT License. More words. Licensed under CC BY-NC 4.0. all rights  reserved"
    got = license_scan.license_report(make_docs([text])).collect()
    assert [(r.template, r.coverage, text[r.char_start:r.char_end]) for r in got] == [
        ("mit", 1.0, "Released UNDER the\tMIT License"), ("cc-by-nc-4.0", 1.0, "Licensed under CC BY-NC 4.0"),
        ("all-rights-reserved", 1.0, "all rights  reserved")]


def test_partial_and_repeated(make_docs):
    gpl = TEMPLATES["gpl-3.0"]
    texts = [gpl.replace("work", "thing"), gpl + " " + gpl, gpl.replace("version 3", "")[:30]]
    got = license_scan.license_report(make_docs(texts), {"gpl": gpl}).collect()
    assert [(r.doc_id, r.n_matched, r.n_template) for r in got] == [(0, 11, 12), (1, 12, 12), (1, 12, 12)]


def test_odd_rows(make_docs, odd_rows, empty_docs):
    rows = [*odd_rows, (9, "no word " * 20_000 + TEMPLATES["mit"], "en"), (9, TEMPLATES["mit"], "en")]
    got = license_scan.license_report(make_docs(rows)).collect()
    assert [(r.doc_id, r.template) for r in got] == [(9, "mit"), (9, "mit")]
    assert license_scan.license_report(empty_docs).collect() == []
    assert license_scan.license_report(make_docs(rows), {}).collect() == []


def test_whole_texts_are_found(make_docs):
    """Every known template is found in its own text, whole and as the only one of its family at that place."""
    known = license_scan.known_licenses()
    assert {"bsd-2-clause-text", "bsd-3-clause-text", "isc-text", "mit-text", "apache-2.0-text", "gpl-3.0-text",
            "lgpl-2.1-text", "agpl-3.0-text", "mpl-2.0-text", "epl-1.0-text", "epl-2.0-header", "cc-by-4.0-text",
            "cc-by-sa-4.0-text", "cc0-1.0-text", "unlicense-text"} <= set(known)
    names = sorted(known)
    docs = make_docs([f"some words before it\n{known[n]}\nand some words behind" for n in names])
    got = license_scan.license_report(docs).collect()
    for i, name in enumerate(names):
        n = len(words_of(known[name]))
        whole = [r for r in got if r.doc_id == i and 2 * (r.word_end - r.word_start) > n]
        assert [(r.template, r.coverage, r.word_start, r.word_end) for r in whole if r.n_matched == n] == [
            (name, 1.0, 4, 4 + n)], name
        assert all(r.coverage == 1.0 for r in whole), name


def test_span_of_a_changed_body(make_docs):
    known = license_scan.known_licenses()
    body = known["mit-text"].replace("deal", "trade").replace("NONINFRINGEMENT", "more")
    half = known["mit-text"][:500]
    rows = [r for r in license_scan.license_report(make_docs([body + "\nx y", half])).collect()]
    text = [r for r in rows if r.template == "mit-text"]
    assert [(r.doc_id, r.n_template - r.n_matched, body[r.char_start:r.char_end]) for r in text] == [
        (0, 2, body.strip().rstrip("."))]
    assert [r.doc_id for r in rows if r.template == "mit-permission"] == [0, 1]


def test_family_members_are_told_apart(make_docs):
    texts = {"Licensed under CC BY 4.0.": "cc-by-4.0", "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa-4.0",
             "Released under the ISC License.": "isc", "SPDX-License-Identifier: MPL-2.0": "spdx-mpl-2.0",
             "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0"}
    got = license_scan.license_report(make_docs(list(texts))).collect()
    assert [(r.doc_id, r.template) for r in got] == list(enumerate(texts.values()))


def test_rows_of_numbers_equal_single_cells():
    rng = random.Random(9)
    for _ in range(200):
        template = [rng.choice(b"abcdef") for _ in range(rng.randint(1, 14))]
        text = [rng.choice(b"abcdefgh") for _ in range(rng.randint(0, 30))]
        d, band = rng.randint(-15, 30), rng.randint(1, 6)
        assert license_scan.aligned_long(np.array(template), np.array(text, int), d, band) == license_scan.aligned(
            template, text, d, band)


def test_repeated_notices_equal_single_alignments():
    """Alignments that are shared between places are those of every place for itself."""
    rng = random.Random(11)
    name = "apache-2.0-header"
    scanner = Scanner({name: TEMPLATES[name]})
    template = words_of(TEMPLATES[name])
    words = []
    for _ in range(25):
        copy = list(template)
        if rng.random() < 0.4:
            copy[rng.randrange(len(copy))] = rng.choice([b"changed", b"the"])
        words += copy + [b"x"] * rng.randint(0, 3)
    candidates = scanner.candidates(words)
    band = max(2, len(template) // 8)
    hits = [license_scan.aligned(template, words, d, band) for d in candidates[0]]
    single = license_scan.apart([(-h[0], h[2] - h[1], h[1], h[2]) for h in hits if h and h[0] >= 0.8 * len(template)])
    found = scanner.matches(words, candidates, 0.8)
    assert sorted((m, a, b) for _, _, m, _, a, b in found) == sorted(single) and len(found) >= 20


def test_many_copies_of_a_notice_in_one_text():
    text = (TEMPLATES["apache-2.0-header"] + " Some words of the file. ") * 3000
    began = time.monotonic()
    rows = Scanner(TEMPLATES).scan(text, 0.8)
    assert sum(r[0] == "apache-2.0-header" for r in rows) == 3000
    assert time.monotonic() - began < 60


def test_hits_apart_equal_the_plain_rule():
    rng = random.Random(4)
    for _ in range(200):
        found = [(-rng.randint(1, 5), 0, a, a + rng.randint(1, 6)) for a in rng.choices(range(30), k=12)]
        taken = []
        for m, _, a, b in sorted(set(found)):
            if all(b <= x or a >= y for _, x, y in taken):
                taken.append((-m, a, b))
        assert license_scan.apart(found) == taken
