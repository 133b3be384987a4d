"""Cutting texts into pre-tokens, with remembered results for short ones.

A text is first cut before every single blank that stands between two other characters. No
pre-token spans such a place and none depends on what stands before it, so each piece can be
encoded alone, and pieces that come again are looked up. A text with white space runs is cut
by the pattern as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

#: Longer pieces are never remembered; beyond this many, all are forgotten before the next batch.
SHORT, REMEMBERED = 48, 150_000

# Two white space characters in a row, or one at either end.
RUNS = regex.compile(r"\s\s|^\s|\s$")


class Pieces[V]:
    """Values of texts, made from the values of their pre-tokens.

    ``encode`` gives the values of a list of distinct pre-tokens, ``join`` puts values together.
    """

    def __init__(self, pattern: str, encode: Callable[[list[bytes]], list[V]], join: Callable[[list[V]], V]):
        self.cut = regex.compile(pattern).findall
        self.encode, self.join = encode, join
        self.words: dict[str, V] = {}
        self.pieces: dict[str, V] = {}

    def texts(self, texts: list[str]) -> list[V]:
        """The value of every text; what is new in any of them is encoded together."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        parted, whole, new = [], [], set()
        for text in texts:
            if RUNS.search(text):
                parted.append(None)
                whole.append(self.cut(text))
            else:
                first, *rest = text.split(" ")
                parted.append(rest)
                whole.append(self.cut(first))
                new.update(rest)
        fresh = {p: self.cut(" " + p) for p in new if p not in self.pieces}
        wanted = {w for words in (*whole, *fresh.values()) for w in words}
        wanted.difference_update(self.words)
        listed = list(wanted)
        self.words.update(zip(listed, self.encode([w.encode("utf-8", "surrogatepass") for w in listed])))
        word, join = self.words.__getitem__, self.join
        self.pieces.update((p, join([*map(word, words)])) for p, words in fresh.items())
        piece = self.pieces.__getitem__
        values = [
            join([*map(word, words), *map(piece, rest)] if rest else [*map(word, words)])
            for words, rest in zip(whole, parted)
        ]
        for long in [w for w in listed if len(w) > SHORT]:
            del self.words[long]
        for long in [p for p in fresh if len(p) > SHORT]:
            del self.pieces[long]
        return values
