"""Token counts from a compiled finite-state tokenizer.

A byte-pair vocabulary is compiled into a deterministic transducer over byte
symbols. A state knows the last token of what was read at each place; reading a symbol moves to a state whose last token is the one that ends
there and may follow the token before it (two tokens may be neighbours if they
encode to themselves side by side). Only the part that may still become a token
belongs to the state, so states are shared between words. Every transition is annotated
with the change in the number of tokens, so a word's count is a walk without building
tokens. States are made when they are first reached.

White space resets the machine. A text is cut into chunks of fixed size, at any
place; a chunk is a map from what the text before it left open to a count and what
it leaves open itself: the part before its first white space, the count of all that
lies between, and the part after its last one. Such maps compose associatively, so
a prefix scan over the chunks gives every position's count without a second look at
the text. A document's count is the last prefix, for which the upward half of the scan
does; memory stays in proportion to the text, also where it has no white space.

The count equals that of the library for the same file, without added special
tokens; special strings inside a text count as one token each.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
CHUNK = 1 << 16
# states and spans that a worker remembers before it starts anew
MAX_STATES = 400_000
MAX_SPANS = 400_000
# separators that str.split takes for white space and the tokenizer does not
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class WordTransducer:
    """Counts the tokens of words; ``end`` marks the last symbol of a word."""

    def __init__(self, vocab: set[str], merges: list[tuple[str, str]], end: str) -> None:
        self.vocab, self.end = vocab, end
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        # proper beginnings of tokens: what is read can only become one of these
        self.beginnings = {"".join(parts[:k]) for parts in map(self.split, vocab)
                           for k in range(1, len(parts))}
        self.symbols = byte_symbols()
        self.neighbours: dict[tuple[str | None, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        # what may still become part of a token: the symbols read last, and at every
        # place among them the token that ends there and the count relative to now
        self.states: list[tuple] = [((), (None,), (0,))]
        self.known: dict[tuple, int] = {self.states[0]: 0}
        # by state * 512 + byte, and 256 more for a word's last byte:
        # the next state and the change in the number of tokens
        self.next: dict[int, int] = {}
        self.emit: dict[int, int] = {}

    def restart(self, state: int) -> int:
        """Forget all states but one; its new number."""
        kept = self.states[state]
        self.reset()
        if kept != self.states[0]:
            self.known[kept] = len(self.states)
            self.states.append(kept)
        return self.known[kept]

    def merged(self, symbols: list[str]) -> list[str]:
        """The encoding by its definition: the best-ranked pair first, leftmost of equals."""
        parts = list(symbols)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: str) -> list[str]:
        """A token's symbols; the end marker belongs to the last one."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def may_follow(self, before: str | None, token: str) -> bool:
        key = (before, token)
        known = self.neighbours.get(key)
        if known is None:
            if len(self.neighbours) >= 2 * MAX_STATES:
                self.neighbours.clear()
            expected = [token] if before is None else [before, token]
            known = self.merged([s for t in expected for s in self.split(t)]) == expected
            self.neighbours[key] = known
        return known

    def compile(self, key: int) -> None:
        """Add the transition of a state and a byte."""
        state, code = divmod(key, 512)
        symbol = self.symbols[code % 256] + (self.end if code >= 256 else "")
        window, last, count = self.states[state]
        token, emitted = symbol, None
        for at in range(len(window), -1, -1):
            if token in self.vocab and self.may_follow(last[at], token):
                emitted = count[at] + 1
                break
            if at:
                token = window[at - 1] + token
        if emitted is None:
            # a symbol outside the vocabulary stands alone
            token, emitted = symbol, 1
        self.emit[key] = emitted
        if code >= 256:
            return
        window, last, count = (*window, symbol), (*last, token), (*(c - emitted for c in count), 0)
        first = 0
        while first < len(window) and "".join(window[first:]) not in self.beginnings:
            first += 1
        found = (window[first:], last[first:], count[first:])
        self.next[key] = self.known.setdefault(found, len(self.states))
        if self.next[key] == len(self.states):
            self.states.append(found)

    def tokens(self, word: bytes) -> int:
        """Number of tokens of one word."""
        if len(self.states) > MAX_STATES or len(self.emit) > 4 * MAX_STATES:
            self.reset()
        state, total, moves = 0, 0, self.next
        for byte in word[:-1]:
            key = state * 512 + byte
            if key not in moves:
                if len(self.states) > 2 * MAX_STATES:
                    # a very long word: go on with its state alone
                    state, moves = self.restart(state), self.next
                    key = state * 512 + byte
                self.compile(key)
            state = moves[key]
            total += self.emit[key]
        key = state * 512 + 256 + word[-1]
        if key not in self.emit:
            self.compile(key)
        return total + self.emit[key]


class ChunkMap(NamedTuple):
    """What a piece of text does: ``head`` and ``tail`` touch its neighbours.

    Without white space the piece is all ``head`` and ``tail`` is None.
    """

    head: str
    count: int
    tail: str | None


class Spans(dict):
    """Counts of spans that occurred; long ones are not kept."""

    def __init__(self, count: Callable[[str], int]) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, span: str) -> int:
        found = self.count(span)
        if len(span) <= 64:
            if len(self) >= MAX_SPANS:
                self.clear()
            self[span] = found
        return found


class Tokenizer:
    """The normalisation, splitting and counting that a tokenizer file describes."""

    def __init__(self, definition: bytes) -> None:
        spec = json.loads(definition)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"]:
            raise ValueError("not a lower-casing byte-pair tokenizer with word ends")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.words = WordTransducer(set(model["vocab"]), pairs, model["end_of_word_suffix"] or "")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.spans = Spans(self.span)

    def plain(self, text: str) -> int:
        # each letter is lowered by itself: a final sigma is no exception
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(self.words.tokens(m[0].encode("utf-8", "replace")) for m in self.pattern.finditer(lowered))

    def span(self, span: str) -> int:
        """Tokens of a text without white space."""
        if span.isascii() and span.isalpha():
            return self.words.tokens(span.lower().encode())
        parts = self.special.split(span) if self.special else [span]
        return len(parts) - 1 + sum(self.plain(p) for p in parts if p)

    def chunk(self, text: str) -> ChunkMap:
        spans = _SPACE.split(text) if _SEPARATORS.search(text) else text.split()
        if not spans:
            return ChunkMap("", 0, "" if text else None)
        head = "" if text[0].isspace() and not _SEPARATORS.match(text) else spans.pop(0)
        if len(head) == len(text):
            return ChunkMap(head, 0, None)
        tail = "" if not spans or text[-1].isspace() and not _SEPARATORS.match(text[-1]) else spans.pop()
        return ChunkMap(head, sum(map(self.spans.__getitem__, spans)), tail)

    def join(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of two neighbouring pieces."""
        if a.tail is None and b.tail is None:
            return ChunkMap(a.head + b.head, 0, None)
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        middle = a.tail + b.head
        return ChunkMap(a.head, a.count + self.spans[middle] + b.count, b.tail)

    def total(self, m: ChunkMap) -> int:
        return m.count + self.spans[m.head] + (self.spans[m.tail] if m.tail else 0)

    def tokens(self, text: str | None, chunk: int = CHUNK) -> int:
        """Tokens of a whole text; null and empty texts have none."""
        if not text:
            return 0
        pieces = [self.chunk(text[i:i + chunk]) for i in range(0, len(text), chunk)]
        return self.total(folded(pieces, self.join))


def scan(items: list, join: Callable) -> list:
    """Inclusive prefixes under an associative ``join``, in a logarithmic number of rounds."""
    found, reach = list(items), 1
    while reach < len(found):
        found = found[:reach] + [join(found[i - reach], found[i]) for i in range(reach, len(found))]
        reach *= 2
    return found


def folded(items: list, join: Callable):
    """All items under an associative ``join``: the upward half of a prefix scan.

    Neighbours are joined in a logarithmic number of rounds. Only the last prefix is asked for, so the
    other prefixes, which would each hold a text without white space up to their place, are not made.
    """
    while len(items) > 1:
        items = [join(*items[i:i + 2]) if i + 1 < len(items) else items[i] for i in range(0, len(items), 2)]
    return items[0]


def token_count(definition: bytes, text: Column) -> Column:
    """A column with the number of tokens of ``text``."""
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = Tokenizer(definition)
        for texts in batches:
            yield pd.Series([tokenizer.tokens(t) for t in texts], dtype="int64")
    return count(text)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``path`` is a tokenizer file that the driver reads. Null texts count like empty
    ones; repeated rows each get their row; an empty table gives an empty result;
    other columns are ignored.
    """
    with open(path, "rb") as f:
        definition = f.read()
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                    token_count(definition, F.col("text")).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
