"""Whole-phrase lists read from one pass over a text.

All phrases of several lists stand in one prefix tree, written as one regular expression.
At each word start it gives the longest phrase that begins there; every shorter phrase that
begins at the same place is a beginning of that one and known beforehand. What a list finds
is then a lookup of those few phrases, so a text is read once however many lists there are.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.literals import literal_list, literal_map

WORD_CLASS = r"[\p{L}\p{N}_]"
_END = ""  # marks the end of a phrase in the tree


def _tree(phrases: Sequence[str]) -> dict:
    root: dict = {}
    for phrase in phrases:
        node = root
        for letter in phrase:
            node = node.setdefault(letter, {})
        node[_END] = {}
    return root


def _pattern(node: dict) -> str:
    """Alternatives of a node, longer phrases before the phrase that ends here."""
    ways = []
    for letter, child in node.items():
        if letter != _END:
            ways.append(re.escape(letter).replace(r"\ ", " ") + _pattern(child))
    if _END in node:
        ways.append(f"(?!{WORD_CLASS})")
    return ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"


def _is_word(letter: str) -> bool:
    return letter == "_" or letter.isalpha() or letter.isnumeric()


def beginnings(phrase: str, phrases: Sequence[str]) -> list[str]:
    """The phrases that are found wherever `phrase` is, at the same place."""
    return [
        p for p in phrases
        if phrase.startswith(p) and (len(p) == len(phrase) or not _is_word(phrase[len(p)]))
    ]


class PhraseIndex:
    """Named phrase lists that read one result of `found`.

    `found` is best computed once, behind `with_computed`, as the lists refer to it often.
    Phrases are compared in lower case with text that is in lower case already.
    """

    def __init__(self, lists: Mapping[str, Sequence[str]]):
        self.lists = {name: [p.lower() for p in own] for name, own in lists.items()}
        self.phrases = sorted({p for own in self.lists.values() for p in own if p})

    def found(self, text: Column) -> Column:
        """The longest phrases at the places of the text where one begins, each once."""
        if not self.phrases:
            return F.array().cast("array<string>")
        pattern = f"(?<!{WORD_CLASS})(?=({_pattern(_tree(self.phrases))}))"
        return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))

    def _places(self, name: str) -> dict[str, str]:
        """For each phrase of the tree the smallest place in the list that it stands for."""
        own = self.lists[name]
        places = {p: i for i, p in reversed(list(enumerate(own)))}
        out = {}
        for phrase in self.phrases:
            hits = [places[p] for p in beginnings(phrase, own) if p]
            if hits:
                out[phrase] = f"{min(hits):05d}"
        return out

    def first(self, found: Column, name: str) -> Column:
        """The first phrase, in the order of the list, that the text holds; NULL if none."""
        places = self._places(name)
        if not places:
            return F.lit(None).cast("string")
        table = literal_map(places)
        place = F.array_min(F.transform(found, lambda p: F.try_element_at(table, p)))
        return F.get(literal_list(self.lists[name]), place.cast("int"))

    def has(self, found: Column, name: str) -> Column:
        """Whether the text holds a phrase of the list."""
        places = self._places(name)
        if not places:
            return F.lit(False)
        return F.arrays_overlap(found, literal_list(list(places)))
