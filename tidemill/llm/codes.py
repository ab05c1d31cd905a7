"""Texts as arrays of code points, and tables of what kind each code point is."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

LETTER, NUMBER, SPACE = 1, 2, 3
# The code points of Unicode's White_Space property.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@functools.lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """LETTER, NUMBER, SPACE or 0 for every code point."""
    of = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((of.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE)] = SPACE
    return out


@functools.lru_cache(maxsize=1)
def wordlike() -> np.ndarray:
    """True for letters, numbers and combining marks."""
    out = (kinds() == LETTER) | (kinds() == NUMBER)
    out[[i for i in range(0x300, 0x110000) if unicodedata.category(chr(i))[0] == "M"]] = True
    return out


def pack(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts with one separator after each, and the position of each separator."""
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    raw = ("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32), ends


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
