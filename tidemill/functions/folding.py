"""Case folding without combining marks as native expressions: tables from the Unicode database, no Python at run time.

Compatibility decomposition, dropping what combines, and case folding each work character by character once order among
combining marks no longer matters, so a table of single characters gives what they give one after another. Characters
that become one other, or none, go through translate(). The few that become several are looked up one by one, and only in
texts that hold one; Hangul syllables, which are by far the most of them, by arithmetic.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

HANGUL, SYLLABLES = 0xAC00, 11172
#: Of the characters that become several those that prose has most: replaced in the whole text, so that it needs no more.
COMMON = "ß…™½¼¾ﬁﬂ"


def folded(text: str) -> str:
    """What the expressions below give, in Python."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


@functools.cache
def tables() -> tuple[str, str, dict[str, str]]:
    """Characters that change, what they become (those beyond its end become nothing), and those that become several."""
    one, gone, several = {}, [], {}
    for code in range(128, sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000 or HANGUL <= code < HANGUL + SYLLABLES:
            continue
        c = chr(code)
        to = folded(c)
        if len(to) > 1:
            several[c] = to
        elif not to:
            gone.append(c)
        elif to != c:
            one[c] = to
    upper = {chr(x): chr(x + 32) for x in range(65, 91)}
    one |= upper
    return "".join(one) + "".join(gone), "".join(one.values()), several


def _ranges(chars) -> str:
    """A class of characters for a regular expression."""
    out, codes = [], sorted(map(ord, chars))
    start = before = codes[0]
    for code in [*codes[1:], None]:
        if code is None or code != before + 1:
            out.append(f"\\x{{{start:x}}}-\\x{{{before:x}}}")
            start = code
        before = code
    return "".join(out)


def _character(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def fold(text: Column) -> Column:
    """text decomposed (NFKD), without combining marks, case folded; null stays null."""
    before, after, several = tables()
    # most characters are told by the first part
    wide = f"[[^\\x00-\\x7f]&&[\\x{{{HANGUL:x}}}-\\x{{{HANGUL + SYLLABLES - 1:x}}}{_ranges(c for c in several if c not in COMMON)}]]"
    keys, values = F.lit("".join(several)), F.split(F.lit("\0".join(several.values())), "\\x00")

    def one(c: Column) -> Column:
        # the code point, from UTF-32
        code = F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("int") - HANGUL
        head, vowel, tail = _character((F.floor(code / 588) + 0x1100).cast("long")), _character((F.floor(code % 588 / 28) + 0x1161).cast("long")), _character((code % 28 + 0x11A7).cast("long"))
        syllable = F.concat(head, vowel, F.when(code % 28 > 0, tail).otherwise(""))
        return F.when((code >= 0) & (code < SYLLABLES), syllable).otherwise(F.coalesce(F.get(values, F.nullif(F.position(c, keys), F.lit(0)) - 1), c))

    given = text
    for c in COMMON:
        text = F.replace(text, F.lit(c), F.lit(several[c]))
    spread = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike(wide), one(c)).otherwise(c)), "")
    whole = F.when(text.rlike(wide), spread).otherwise(text)
    return F.when(given.rlike(r"[^\x00-\x7f]"), F.translate(whole, before, after)).otherwise(F.lower(given))
