import random
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from contrail.llm.token_count import Tokenizer, folded, scan, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as f:
        return Tokenizer(f.read())


@pytest.fixture(scope="module")
def theirs():
    library = Library.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


ODD = ["", "  ", "\n", "a<|endoftext|>b <|startoftext|> x", "<|endoftext|", "don't we'll  I'VE 'tis ''s !'s", "ΣΑΣ ΟΔΟΣ",
       "İstanbul ǅ ﬃ", "école 한국어 日本語テキスト", "x\x1cy \x1f", "1234 ١٢٣ ⅻ²", "a b c​d\x85f", "🙂🙂 👩‍👩‍👧",
       "ab" * 3000, "!?" * 400 + "'s", " 's't", "zzzzzzzzzz'RE'd", "́́ á"]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_equals_the_library(ours, theirs, chunk):
    rng = random.Random(1)
    alphabet = [*"abcdefgh iou'sTLM.,!?19\n\t", "é", "ß", "Σ", "ñ", "日", "<|endoftext|>", "\x1d", " "]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 200))) for _ in range(400)]
    for text in texts:
        assert ours.tokens(text, chunk) == theirs(text), text[:80]


def test_scan_gives_every_prefix(ours):
    text = "The quick brown fox, jumping over it's lazy dog" * 3
    pieces = [ours.chunk(text[i:i + 5]) for i in range(0, len(text), 5)]
    got = [ours.total(m) for m in scan(pieces, ours.join)]
    assert got == [ours.tokens(text[:i + 5]) for i in range(0, len(text), 5)]


def test_forgetting_changes_nothing(ours, theirs, monkeypatch):
    monkeypatch.setattr("contrail.llm.token_count.MAX_STATES", 20)
    monkeypatch.setattr("contrail.llm.token_count.MAX_SPANS", 5)
    text = "Many different words make the machine forget its states and its spans again and again"
    assert ours.tokens(text) == theirs(text)


def test_rows(make_docs, odd_rows, empty_docs, theirs):
    got = token_counts(make_docs(odd_rows), PATH).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        ((i, len((t or "").encode()), theirs(t or ""), theirs(t or "") > 2048) for i, t, _ in odd_rows), key=str)
    assert token_counts(empty_docs, PATH).collect() == []


@pytest.mark.parametrize("letters", ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "天地玄黄宇宙洪荒日月", "abcdefgh"])
def test_long_texts_without_white_space_take_memory_in_proportion(ours, theirs, monkeypatch, letters):
    monkeypatch.setattr("contrail.llm.token_count.MAX_STATES", 2_000)
    rng = random.Random(3)
    text = "".join(rng.choices(letters, k=15_000))
    assert ours.tokens(text, 1_000) == theirs(text)
    long = text * 4
    tracemalloc.start()
    count = ours.tokens(long, 1_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count > 3 * ours.tokens(text) and peak < 40 * len(long)


def test_folding_is_the_last_prefix(ours):
    text = "It's 12 words, joined-together" * 9 + " end"
    pieces = [ours.chunk(text[i:i + 4]) for i in range(0, len(text), 4)]
    assert ours.total(folded(pieces, ours.join)) == ours.total(scan(pieces, ours.join)[-1]) == ours.tokens(text)
