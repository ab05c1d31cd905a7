"""Where a byte-level tokenizer cuts a text before it merges: a finite-state transducer, run in chunks side by side.

The transducer reads one symbol for each code point (its kind, with what few code points of context settle) and marks
those that start a piece. Each chunk is read from all states at once, which gives a map from states to states, and (see
tokencount.py) to the tokens emitted; a parallel prefix scan composes the maps. Thus long texts cost the same as many
short ones, and numpy runs all chunks in step. States that have become one are read as one: this machine forgets the
state that a chunk was entered in after a few symbols.
"""

from __future__ import annotations

import numpy as np

from tidemill.llm.codes import LETTER, NUMBER, SPACE, kinds, pack

# Symbols: letter, number, other, white space before white space, last white space, a blank that joins what follows,
# an apostrophe that takes one letter, one that takes two, the end of a text.
L, N, P, W, LAST, JOIN, ONE, TWO, END = range(9)
# States: fresh, in letters, in numbers, in others, in white space, after a joining blank, one letter to take, two.
FRESH, IN_L, IN_N, IN_P, IN_W, JOINED, TAKE1, TAKE2 = range(8)
CHUNK = 256


def machine() -> tuple[np.ndarray, np.ndarray]:
    """Next states and start marks, by symbol * 8 + state."""
    go, mark = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for symbol, state in ((L, IN_L), (N, IN_N), (P, IN_P), (W, IN_W)):
        go[symbol] = state
        mark[symbol, state] = False
        if symbol != W:
            mark[symbol, JOINED] = False
    go[L, TAKE1], go[L, TAKE2] = FRESH, TAKE1
    mark[L, TAKE1] = mark[L, TAKE2] = False
    go[LAST], go[JOIN], go[ONE], go[TWO], go[END] = FRESH, JOINED, TAKE1, TAKE2, FRESH
    return go.ravel(), mark.ravel()


GO, MARK = machine()


def symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    kind = kinds()[codes]
    kind[ends] = 9
    n = len(codes)
    out = np.full(n, P, np.uint8)
    out[kind == LETTER] = L
    out[kind == NUMBER] = N
    out[ends] = END
    after = np.full(n, 9, np.uint8)
    after[:-1] = kind[1:]
    white = kind == SPACE
    last = white & (after != SPACE) & (after != 9)
    out[white] = W
    out[last] = LAST
    out[last & (codes == 32)] = JOIN
    quote = np.flatnonzero((codes == 39) & (kind != 9))
    if len(quote):
        at = np.concatenate([codes, np.zeros(3, np.uint32)])
        before = np.where(quote > 0, out[np.maximum(quote - 1, 0)], END)
        alone = quote[(before != P) & (before != JOIN)]
        a, b = at[alone + 1], at[alone + 2]
        one = np.isin(a, [ord(x) for x in "sdmt"])
        two = ((a == ord("l")) & (b == ord("l"))) | (np.isin(a, [ord("v"), ord("r")]) & (b == ord("e")))
        out[alone[one]] = ONE
        out[alone[two]] = TWO
    return out


def settled() -> int:
    """How many symbols of a chunk can pass until its state no longer depends on the one that it was entered in."""
    open_, n = {tuple(range(8))}, 0
    while any(len(set(m)) > 1 for m in open_):
        open_, n = {tuple(int(GO[symbol * 8 + s]) for s in m) for m in open_ if len(set(m)) > 1 for symbol in range(9)}, n + 1
    return n


#: With this machine, chunks longer than so many symbols have maps that are constant.
SETTLED = settled()


def compose(maps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States and counts of all chunks so far, one after another, by the state before the first (a parallel prefix scan with
    log2 steps): maps[i][s] is where chunk i leads from s, counts[i][s] what it emits on that way."""
    shift = 1
    while shift < len(maps):
        before = maps[:-shift].astype(np.int64)
        after = np.take_along_axis(maps[shift:], before, axis=1)
        told = counts[:-shift] + np.take_along_axis(counts[shift:], before, axis=1)
        maps, counts = np.concatenate([maps[:shift], after]), np.concatenate([counts[:shift], told])
        shift *= 2
    return maps, counts


class Chunks:
    """Texts in chunks of so many symbols, each text in chunks of its own, with each chunk's map of states.

    ends: the last chunk of each text, plus one. heads[j][i][s]: whether a piece starts at symbol j of chunk i if that is
    entered in state s; sure[i][j]: whether one does in any case, for symbols after the heads.
    """

    def __init__(self, texts: list[str], chunk: int = CHUNK):
        codes, stops = pack(texts)
        symbol = symbols(codes, stops)
        size = np.diff(np.concatenate([[0], stops + 1]))
        rows = -(-size // chunk)
        self.ends, self.chunk = np.cumsum(rows), chunk
        shift = np.repeat((self.ends - rows) * chunk - (stops + 1 - size), size)
        self.place = np.arange(len(symbol)) + shift
        n = int(self.ends[-1]) if len(rows) else 0
        grid = np.full(n * chunk, END, np.uint8)
        grid[self.place] = symbol
        grid = np.ascontiguousarray(grid.reshape(n, chunk).T).astype(np.int16) * 8
        maps, self.heads, j = np.tile(np.arange(8, dtype=np.uint8), (n, 1)), [], 0
        while j < chunk and not (maps == maps[:, :1]).all():
            at = grid[j][:, None] + maps
            self.heads.append(MARK[at])
            maps = GO[at]
            j += 1
        sure, state = np.zeros((chunk, n), bool), maps[:, 0]
        for k in range(j, chunk):
            at = grid[k] + state
            sure[k], state = MARK[at], GO[at]
        self.maps = maps if j == chunk else np.repeat(state[:, None], 8, axis=1)
        self.sure = sure.T
        #: the state that each chunk is entered in
        self.entry = np.zeros(n, np.uint8)
        self.entry[1:] = compose(self.maps, np.zeros((n, 8), np.int64))[0][:-1, FRESH]
        self.entry[self.ends[:-1]] = FRESH
        self.marks = self.sure.copy()
        for j, head in enumerate(self.heads):
            self.marks[:, j] = head[np.arange(n), self.entry]

    def starts(self) -> np.ndarray:
        """The positions (in the packed texts) at which pieces start; the end of a text counts as a piece."""
        return np.flatnonzero(self.marks.ravel()[self.place])

    def others(self) -> tuple:
        """Pieces that start in the head of a chunk, for states that give others than the chunk's own entry does.

        Chunk and state; then twice (number among these, start, end), places in the grid: with the entry, and with the state.
        """
        n, wide = len(self.maps), len(self.heads)
        if not wide or wide >= self.chunk:
            raise ValueError(f"counts need chunks of more than {SETTLED} symbols")
        heads = np.stack(self.heads, axis=2)
        own = heads[np.arange(n), self.entry]
        row, state = np.nonzero((heads != own[:, None, :]).any(axis=2))
        # the first place after the head at which a piece starts for certain, be it in a later chunk
        after, stop = np.flatnonzero(self.marks.ravel()), self.marks.size
        out = []
        for which, marks in ((row, own[row]), (row, heads[row, state])):
            k, j = np.nonzero(marks)
            start = which[k] * self.chunk + j
            follows = np.full(len(k), -1)
            same = np.flatnonzero(k[1:] == k[:-1])
            follows[same] = start[same + 1]
            first = np.searchsorted(after, which[k] * self.chunk + wide)
            beyond = np.where(first < len(after), after[np.minimum(first, len(after) - 1)], stop)
            out.append((k, start, np.where(follows >= 0, follows, beyond)))
        return row, state, out[0], out[1]


def pieces(texts: list[str]) -> list[list[str]]:
    """The pieces of each text, in order; joined they give the text back."""
    stops = np.cumsum([len(t) + 1 for t in texts])
    at = Chunks(texts).starts()
    out, last = [], 0
    for text, i, j, b in zip(texts, np.searchsorted(at, np.concatenate([[0], stops[:-1]])).tolist(), np.searchsorted(at, stops - 1).tolist(), [0, *stops[:-1].tolist()], strict=True):
        cuts = (at[i : j + 1] - b).tolist()
        out.append([text[x:y] for x, y in zip(cuts, cuts[1:])])
    return out
