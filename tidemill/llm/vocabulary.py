"""A byte-level BPE vocabulary, and when two tokens may stand side by side.

A text's encoding is fixed by one relation: tokens a and b are neighbours in some encoding exactly if merging the bytes
of a and b together never joins a symbol across their border. Both operators that tokenize rest on it: the last token
of a prefix is the one vocabulary suffix t whose neighbour, the last token before t, stands the border with it.
"""

from __future__ import annotations

import functools
import json

#: Pairs of tokens that a worker remembers (about 100 bytes each).
KNOWN = 200_000
#: Bits that hold a token's id.
BITS = 20
TOKEN = (1 << BITS) - 1


def byte_letters() -> dict[str, int]:
    """The printable letter that vocabulary files write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        of = byte_letters()
        # (letters from 256 on cover the bytes without a printable letter of their own)
        raw = {word: bytes(of[x] for x in word) for word in told["model"]["vocab"]}
        self.id_of = {raw[word]: i for word, i in told["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.special = {x["content"]: x["id"] for x in told.get("added_tokens", []) if x["content"] not in told["model"]["vocab"]}
        self.special_bytes = {i: s.encode() for s, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born = dict.fromkeys(self.bytes_of, -1)
        for n, pair in enumerate(told["model"]["merges"]):
            a, b = (raw[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole, pair = self.id_of[a + b], (self.id_of[a], self.id_of[b])
            self.rank[pair] = n
            if max(self.born[pair[0]], self.born[pair[1]]) >= n:
                raise ValueError(f"merge {n} uses a token that is merged later; encodings by neighbours need an ordered merge list")
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = pair, n
        #: every beginning of a token: its id if it is a token itself, else -1, or -2 less what ending() says once that is known
        self.nodes = {b[:i]: -1 for b in self.id_of for i in range(1, len(b))} | self.id_of
        #: of each token what ending() says, once that is known
        self.shorter = [0] * (max(self.bytes_of) + 1)
        self.known: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})

    def spine(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """The symbols that stand at a token's border (side 0: its left, 1: its right) while it is merged.

        Each with the ranks of the merges that make it and that take it up.
        """
        got = self.spines[side].get(token)
        if got is None:
            got, end, symbol = [], 1 << 30, token
            while True:
                got.append((symbol, self.born[symbol], end))
                if symbol not in self.parts:
                    break
                end = self.born[symbol]
                symbol = self.parts[symbol][side]
            self.spines[side][token] = got
        return got

    def ending(self, node: bytes) -> int:
        """The longest token that node ends in besides itself: its length and id, in one number. Worked out once for each node."""
        for i in range(1, len(node)):
            token = self.nodes.get(node[i:], -1)
            if token >= 0:
                told = (len(node) - i) << BITS | token
                own = self.nodes[node]
                if own < 0:
                    self.nodes[node] = -2 - told
                else:
                    self.shorter[own] = told
                return told
        raise ValueError(f"no token of the vocabulary ends {node!r}")

    def neighbours(self, a: int, b: int) -> bool:
        """Whether some encoding has a directly before b."""
        key = a << BITS | b
        got = self.known.get(key)
        if got is None:
            got = True
            for x, x_born, x_end in self.spine(a, 1):
                for y, y_born, y_end in self.spine(b, 0):
                    n = self.rank.get((x, y))
                    # equal ranks merge from left to right: a's own merge goes first, b's own merge second
                    if n is not None and x_born < n < x_end and y_born < n <= y_end:
                        got = False
            if len(self.known) > KNOWN:
                self.let_go()
            self.known[key] = got
        return got

    def let_go(self) -> None:
        """Forgets which tokens may stand side by side; it is worked out again when needed."""
        self.known.clear()
        for x in self.spines:
            x.clear()


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once in each worker process."""
    return Vocabulary(path)
