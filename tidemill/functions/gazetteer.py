"""Codes of place names out of a list of any length: an Aho-Corasick automaton instead of a pattern of alternatives.

A pattern tries its names one after another at every place of a text; the automaton goes through the text once, whatever
the number of names. A name counts where no small letter touches it; of names that begin at one place the longest counts,
and the next is looked for after its end, as places.codes() has it for its own list.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.lru_cache(maxsize=4)
def automaton(names: tuple[tuple[str, str], ...]):
    """Transitions over all names, each with its length and code; made once in a worker."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for name, code in names:
        if name:
            made.add_word(name, (len(name), code))
    made.make_automaton()
    return made


def _letter(c: str) -> bool:
    return "a" <= c <= "z"


def places_in(text: str, made) -> Iterable[str]:
    """The codes of the names of a text, in order."""
    longest: dict[int, tuple[int, str]] = {}
    for last, (size, code) in made.iter(text):
        start, end = last + 1 - size, last + 1
        if (not start or not _letter(text[start - 1])) and (end == len(text) or not _letter(text[end])) and size > longest.get(start, (0, ""))[0]:
            longest[start] = size, code
    at = 0
    for start in sorted(longest):
        if start >= at:
            size, code = longest[start]
            at = start + size
            yield code


def codes(folded: Column, names: Mapping[str, str]) -> Column:
    """The sorted codes of all places in a folded text; names: folded name to code. Null is no place."""
    told = tuple(sorted(names.items()))

    def find(s: pd.Series) -> pd.Series:
        made = automaton(told)
        none = not len(made)
        return pd.Series([[] if none or not x else sorted(set(places_in(x, made))) for x in s], index=s.index, dtype=object)

    return F.pandas_udf(find, "array<string>")(folded)
