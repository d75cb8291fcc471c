import random
import zlib

import numpy as np

from contrail.llm import language_id
from contrail.llm.language_id import Filters, Letters, grams

SYLLABLES = {"aa": "ka lo mi tu", "bb": "sch ver ung ein", "cc": "que ción ado ll"}


def corpus(n=150):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        words = ["".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randint(4, 40))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_accuracy(make_docs):
    rows = corpus()
    got = language_id.languages(make_docs(rows)).collect()
    right = {i: lang for i, _, lang in rows}
    assert all(r.lang_pred == right[r.doc_id] and 0 < r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_labels_of_held_out_documents_do_not_matter(make_docs):
    rows = corpus(90)
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else l) for i, t, l in rows]
    a, b = (language_id.languages(make_docs(r)).orderBy("doc_id").collect() for r in (rows, changed))
    assert a == b


def test_filter_answers_every_language_that_has_a_gram():
    rng = np.random.default_rng(1)
    sets = {f"l{i:03}": rng.integers(0, 1 << 63, 500, dtype=np.uint64) for i in range(70)}
    filters = Filters.build(sets)
    assert len(filters.slots) == 2
    for i, name in enumerate(filters.languages):
        counts = filters.counts(sets[name])
        assert counts[i] == 500
        # others are found as often as their chance says
        assert np.all(counts[np.arange(70) != i] <= 500 * filters.chance[np.arange(70) != i] + 30)


def test_grams_do_not_pass_between_words():
    hashes = [h for h in grams(Letters().codes("Ab, c"))]
    # " a", "ab", "b ", " c", "c "; " ab", "ab ", " c "; " ab "
    assert [len(h) for h in hashes] == [5, 3, 1]


def test_odd_rows(make_docs, odd_rows, empty_docs):
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in language_id.languages(make_docs(odd_rows)).collect()}
    assert {g for g in got if g[0] in (1, 2, 3)} == {(i, "und", False) for i in (1, 2, 3)}
    assert all(lang in {"en", "de", "fr", "es"} for i, lang, _ in got if i not in (1, 2, 3))
    assert language_id.languages(empty_docs).collect() == []
    nothing = make_docs([(1, "some text", None), (2, "123 !", "en")])
    assert {r.lang_pred for r in language_id.languages(nothing).collect()} == {"und"}


def test_borders_of_pieces_are_no_word_borders(monkeypatch):
    letters, rng = Letters(), random.Random(8)
    texts = ["".join(rng.choices("ab c", k=rng.randint(1, 60))) for _ in range(40)] + ["", "x", "  ", "日本語" * 9]
    for text in texts:
        whole = np.sort(np.concatenate([*grams(letters.codes(text)), np.empty(0, np.uint64)]))
        for piece in (1, 2, 5, 1000):
            monkeypatch.setattr(language_id, "PIECE", piece)
            parts = list(language_id.grams_of(text, letters))
            assert (np.sort(np.concatenate([*(h for h, _ in parts), np.empty(0, np.uint64)])) == whole).all()
            assert any(some for _, some in parts) == any(c.isalpha() for c in text)
