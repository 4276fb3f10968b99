"""Values of white-space pieces, remembered: shared by token counts and token files.

The tokenizer drops white space, splits words inside a piece and treats every word
on its own, so a text's value is the sequence of its pieces' values. Texts are cut
at space and line feed only; whatever else is white space stays inside a piece and
is left to the tokenizer. Special strings hold neither, so they are never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Generic, TypeVar

V = TypeVar("V")

#: Pieces remembered by a worker in each of two generations, and the longest piece
#: that is; bounds of memory only.
REMEMBERED = 600_000
LONGEST = 64
#: Letters below this code point have been letters in every Unicode version, so that
#: a run of them is one word for every version the library may be built with.
SETTLED = "\u0250"
#: ASCII marks that are neither letter, number nor space; not the apostrophe, which may
#: belong to the letters after it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_alphabet() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the
    code points from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)} | {b: chr(b) for b in printable}


_ALPHABET = _byte_alphabet()


def byte_letters(word: str) -> str:
    """A word in the byte-level alphabet of its UTF-8."""
    if word.isascii():
        return word
    return word.encode().decode("latin-1").translate(_ALPHABET)


def pieces(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


class PieceValues(Generic[V]):
    """``of_words`` values pieces of letters only; ``of_any`` any piece; both exact."""

    def __init__(
        self,
        of_words: Callable[[Sequence[str]], Iterable[V]],
        of_any: Callable[[str], V],
        add: Callable[[V, V], V],
        empty: V,
    ) -> None:
        self.of_words, self.of_any, self.add = of_words, of_any, add
        self.known: dict[str, V] = {"": empty}
        self.older: dict[str, V] = {}
        self.empty = empty

    def values(self, parts: list[str]) -> Iterable[V]:
        """The value of each piece, in order; to be read before the next call."""
        missing = set(parts).difference(self.known)
        if not missing:
            return map(self.known.get, parts)
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {"": self.empty}
            missing = set(parts) - {""}
        self._learn(missing)
        found = map(self.known.get, parts)
        long = [p for p in missing if len(p) > LONGEST]
        if long:
            found = list(found)
            for p in long:
                del self.known[p]
        return found

    def _learn(self, missing: set[str]) -> None:
        known, older, stems = self.known, self.older, []
        for p in missing:
            if p in older:
                known[p] = older[p]
                continue
            # A run of marks after letters is a word of its own at the end of a piece.
            stem = p.rstrip(MARKS)
            end = p[len(stem) :]
            # In lower case a mark may come off a letter and join the marks behind it.
            if not stem.isalpha() or max(stem) >= SETTLED or not stem.lower().isalpha():
                known[p] = self.of_any(p)
                continue
            if stem.isascii():  # so that both cases of a word are one entry
                stem = stem.lower()
            stems.append((p, stem, end))
        words = {s for _, s, _ in stems}.difference(known)
        for s in [s for s in words if s in older]:
            known[s] = older[s]
            words.discard(s)
        words = list(words)
        known.update(zip(words, self.of_words(words), strict=True))
        for p, stem, end in stems:
            if end:
                if end not in known:
                    known[end] = self.of_any(end)
                known[p] = self.add(known[stem], known[end])
            else:
                known[p] = known[stem]
