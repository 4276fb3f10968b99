"""Exact token counts by a compiled finite-state transducer.

Method: the merge table of a byte-pair tokenizer is compiled into a deterministic
transducer that reads a word symbol by symbol; each transition is annotated with the
change in the number of emitted tokens, each state with the change if the word ends
there. No ids are made and no merges are run on a text. States are built when first
reached (a lazy subset construction) and shared by all words.

Why it is exact: the encoding of a word's prefix is a prefix path of tokens in which
neighbours are *compatible* (encoding the two tokens' joined text gives the two again).
So the last token at a position is the one that ends there and is compatible with the
last token at its own start; a state need only hold the last tokens and relative
counts of the positions that a longer token may still start from.

A long text is cut into chunks anywhere. A chunk maps the state it is entered in to the
state it leaves and a count; the maps are applied in order, one after the other, and only
the last state is kept. The state is the open piece's: a piece longer than a chunk is cut
where nothing can reach across (``safe_cut``), also inside a word, of which just the
transducer's state goes on. Open text is held, in linear memory, where no such place is.

Defined results: null text counts as empty (0 tokens); null and repeated doc_id rows
are kept, one row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from churnloom.llm.common import texts
from churnloom.llm.pieces import PieceValues, byte_letters, pieces

#: Characters per chunk. Any value gives the same counts.
CHUNK_CHARS = 1 << 16
#: States and compatible pairs kept before the tables start anew; a bound of memory only.
KEPT_STATES = 300_000
KEPT_PAIRS = 1_000_000
#: The normaliser and word splitter that ``safe_cut`` is proven for; with any other, a
#: piece is left whole.
NORMALISER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class State(NamedTuple):
    #: Symbols since the earliest start of a token that may still grow.
    suffix: str
    #: For each position of ``suffix`` and its end: last token there, tokens so far
    #: relative to the end. The word's start has no last token.
    at: tuple[tuple[str | None, int], ...]


class CountTransducer:
    """Counts the tokens of one pre-token (a string of the tokenizer's symbols)."""

    def __init__(self, merges: list[tuple[str, str]], suffix: str) -> None:
        self.rank = {m: i for i, m in enumerate(merges)}
        self.end = suffix
        self.tokens = {a + b for a, b in merges}
        self.starts = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.longest = max(map(len, self.tokens), default=1)
        self.first = State("", ((None, 0),))
        self.numbers: dict[State, int] = {}
        self.states: list[State] = []
        self.steps: list[dict[str, tuple[int, int]]] = []
        self.stops: list[dict[str, int]] = []
        self.pairs: dict[tuple[str, str], bool] = {}

    # --- building ------------------------------------------------------------------
    def _encode(self, symbols: list[str]) -> list[str]:
        """Plain pair merging, for the compatibility of two tokens only."""
        while len(symbols) > 1:
            ranks = [self.rank.get(p, len(self.rank)) for p in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == len(self.rank):
                break
            i = ranks.index(best)
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _compatible(self, left: str | None, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            whole = (self._symbols(left) if left else []) + self._symbols(right)
            known = self._encode(whole) == ([left, right] if left else [right])
            self.pairs[left, right] = known
        return known

    def _last(self, state: State, symbol: str) -> tuple[str, int]:
        """Last token after ``symbol`` and the change in the count, longest token first."""
        text = state.suffix
        for k in range(len(text) + 1):
            token = text[k:] + symbol
            if k < len(text) and token not in self.tokens:
                continue
            before, count = state.at[k]
            if self._compatible(before, token):
                return token, count + 1
        raise ValueError("no token ends here: the merge table is not closed")

    def _number(self, state: State) -> int:
        n = self.numbers.get(state)
        if n is None:
            n = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            self.stops.append({})
        return n

    def _step(self, n: int, symbol: str) -> tuple[int, int]:
        state = self.states[n]
        token, change = self._last(state, symbol)
        text = state.suffix + symbol
        at = [(t, c - change) for t, c in state.at] + [(token, 0)]
        keep = next(k for k in range(len(text) + 1) if k == len(text) or self._grows(text[k:]))
        step = self._number(State(text[keep:], tuple(at[keep:]))), change
        self.steps[n][symbol] = step
        return step

    def _grows(self, text: str) -> bool:
        return text in self.starts or text + self.end in self.starts

    def _stop(self, n: int, symbol: str) -> int:
        change = self._last(self.states[n], symbol + self.end)[1]
        self.stops[n][symbol] = change
        return change

    # --- running --------------------------------------------------------------------
    def _bound(self) -> None:
        if len(self.states) > KEPT_STATES:
            self.numbers.clear()
            self.states, self.steps, self.stops = [], [], []

    def count(self, word: str) -> int:
        if not word:
            return 0
        self._bound()
        n, total, steps = self._number(self.first), 0, self.steps
        for symbol in word[:-1]:
            step = steps[n].get(symbol) or self._step(n, symbol)
            n = step[0]
            total += step[1]
        change = self.stops[n].get(word[-1])
        return total + (self._stop(n, word[-1]) if change is None else change)

    def advance(self, state: State, symbols: str) -> tuple[State, int]:
        """The state that symbols inside a word lead to and the change in the count."""
        self._bound()
        n, total, steps = self._number(state), 0, self.steps
        for symbol in symbols:
            step = steps[n].get(symbol) or self._step(n, symbol)
            n = step[0]
            total += step[1]
        return self.states[n], total

    def finish(self, state: State, symbol: str) -> int:
        """The change in the count if the word ends with ``symbol``."""
        return self._last(state, symbol + self.end)[1]


class OpenWord(NamedTuple):
    """A word read so far but for its last symbol, which may or may not end it."""

    state: State
    symbol: str


@cache
def _joining() -> frozenset[str]:
    """Characters that canonical composition may join to the one before."""
    found = {chr(c) for a, b in ((0x1161, 0x1176), (0x11A8, 0x11C3)) for c in range(a, b)}
    for c in map(chr, range(0x110000)):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


@cache
def _kind(c: str) -> str:
    """L letter, N ASCII digit, S mark or symbol, W ASCII white space, or empty: left
    uncut. A letter has been one since Unicode 3.2 and stays one letter in lower case."""
    if c in "0123456789":
        return "N"
    if c in "\t\x0b\x0c\r":
        return "W"
    if c == "'" or unicodedata.combining(c) or c in _joining():
        return ""
    plain = unicodedata.normalize("NFC", c).lower()
    if len(plain) != 1:
        return ""
    kinds = [unicodedata.ucd_3_2_0.category(c), unicodedata.category(c), unicodedata.category(plain)]
    if all(k[0] == "L" for k in kinds):
        return "L"
    return "S" if all(k[0] in "PS" for k in kinds[1:]) else ""


class PieceCounts:
    """Token counts of texts: the library's normaliser and word splitter, then the
    transducer; special strings in a text are one token each, the library's default."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(tokenizer, encoding="utf-8") as f:
            spec = json.load(f)
        tok = Tokenizer.from_file(tokenizer)
        self.normalise = tok.normalizer.normalize_str if tok.normalizer else str
        self.split = tok.pre_tokenizer.pre_tokenize_str
        #: Words are runs of letters in the byte alphabet.
        probe = "ab\u00e9 c"
        self.letters = [w for w, _ in self.split(probe)] == [byte_letters(w) for w in probe.split()]
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.machine = CountTransducer(merges, model.get("end_of_word_suffix") or "")
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.opening = {t[0] for t in added}
        self.added, self.begun = tuple(added), tuple({t[:k] for t in added for k in range(1, len(t))})
        self.cuttable = spec["normalizer"] == NORMALISER and spec["pre_tokenizer"] == SPLITTER
        self.cuttable &= not any(self.opening.intersection(t[1:]) for t in added)
        special = [re.escape(t) for t in added]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True)) or r"(?!)")
        self.memo = PieceValues(self._words, self._any, lambda a, b: a + b, 0)

    def _any(self, piece: str) -> int:
        found = len(self.special.findall(piece))
        count = self.machine.count
        for part in self.special.split(piece) if found else (piece,):
            found += sum(count(w) for w, _ in self.split(self.normalise(part)))
        return found

    def _words(self, words: list[str]) -> list[int]:
        if not words:
            return []
        whole = self.normalise(" ".join(words)).split(" ")
        count = self.machine.count
        return [
            count(byte_letters(plain)) if self.letters and plain.isalpha() else self._any(word)
            for word, plain in zip(words, whole, strict=True)
        ]

    def values(self, parts: list[str]) -> int:
        return sum(self.memo.values(parts))

    # --- pieces longer than a chunk -------------------------------------------------
    def safe_cut(self, text: str) -> tuple[int, bool]:
        """The last place (0 if none) where a piece may be cut, and whether that is
        inside a word. No composition, special string or contraction lies across it; after a
        special string any place will do."""
        if not self.cuttable:
            return 0, False
        a = ""
        for at in range(len(text) - 1, -1, -1):
            a, b, after = _kind(text[at]), a, text[at + 1 : at + 2]
            if after and text.endswith(self.added, 0, at + 1):
                return at + 1, False
            inside = a == b and a in ("L", "S") or b == "S" and text[at] == "'"
            if not inside and not (b == "N" and a in ("L", "N", "W") or b == "L" and a in ("N", "W")):
                continue
            if a == "L" and "'" in text[max(at - 2, 0) : at + 1] or after in self.opening:
                continue
            if text.endswith(self.begun, 0, at + 1):
                continue
            return at + 1, inside
        return 0, False

    def read(self, text: str, word: OpenWord | None, inside: bool) -> tuple[int, OpenWord | None]:
        """The change in the count by a part of a piece that ``word`` goes on into, and
        the word left open if the part ends ``inside`` one."""
        found = len(self.special.findall(text))
        machine, words = self.machine, []
        for part in self.special.split(text):
            words += [w for w, _ in self.split(self.normalise(part))]
        if word:
            state, change = machine.advance(word.state, word.symbol + words[0][:-1])
            word = OpenWord(state, words[0][-1])
            found += change
            if len(words) == 1 and inside:
                return found, word
            found += machine.finish(*word)
            words = words[1:]
        if not inside:
            return found + sum(map(machine.count, words)), None
        state, change = machine.advance(machine.first, words[-1][:-1])
        found += sum(map(machine.count, words[:-1])) + change
        return found, OpenWord(state, words[-1][-1])


class OpenPiece:
    """What is left open between two chunks: the piece that no white space has ended yet.

    Text is held until a chunk's worth has come, then all before the last safe cut is
    read and only the transducer's state is kept. Where no cut is safe (runs of
    combining marks or apostrophes, other splitters) the text itself is held, as a list of
    parts.
    """

    def __init__(self, machine: PieceCounts, chunk: int) -> None:
        self.machine, self.chunk = machine, chunk
        self.parts: list[str] = []
        self.held, self.next = 0, chunk
        self.total = 0
        self.begun = False
        self.word: OpenWord | None = None

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.held += len(text)
        if self.held < self.next:
            return
        whole = "".join(self.parts)
        at, inside = self.machine.safe_cut(whole)
        if at:
            count, self.word = self.machine.read(whole[:at], self.word, inside)
            self.total += count
            self.begun = True
            whole = whole[at:]
        # Asked again when what is held has doubled, so that no text is searched often.
        self.parts, self.held = [whole], len(whole)
        self.next = max(self.chunk, 2 * self.held)

    def close(self, text: str) -> int:
        """The piece's count, ``text`` being its end; opens an empty piece."""
        whole, total = "".join([*self.parts, text]), self.total
        if self.begun:
            total += self.machine.read(whole, self.word, False)[0]
        else:
            total += self.machine.values([whole])
        self.__init__(self.machine, self.chunk)
        return total


def count_text(text: str, machine: PieceCounts, chunk: int = CHUNK_CHARS) -> int:
    """Chunks are read in order, each from the state that the one before leaves."""
    total, piece = 0, OpenPiece(machine, chunk)
    for i in range(0, len(text), chunk):
        parts = pieces(text[i : i + chunk])
        if len(parts) > 1:
            total += piece.close(parts[0]) + machine.values(parts[1:-1])
        piece.add(parts[-1])
    return total + piece.close("")


@cache
def _machine(tokenizer: str) -> PieceCounts:
    return PieceCounts(tokenizer)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether a document has more than ``limit`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(tokenizer)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column("text"):
                n_bytes.append(len(value.as_buffer()))
                n_tokens.append(count_text(value.as_py(), machine))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts(docs).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
