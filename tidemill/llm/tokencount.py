"""Token counts by finite-state tokenizer compilation.

The tokenizer is compiled into two deterministic transducers. The first cuts texts into pieces (pretokens.py). The second
reads a piece byte by byte; each of its transitions carries the number of tokens that it adds to the count so far (it may
be negative: a byte can join what stood apart). A state of it holds what later bytes can still depend on: the longest
suffix that begins a token, and for each position in that suffix the last token up to there and by how much its count
differs from the current one. There are finitely many; a transition is compiled when first taken and then is a table
look-up, and the way through a whole piece is kept as one transition with its count.

A text's count comes from its chunks. Each has a map from the state that it is entered in to the state that it is left
in and the tokens that its transitions emit on that way (a piece counts where it starts). A parallel prefix scan composes
the maps, states and counts at once, and the count of a text is what they emit from its first chunk to its last.

Texts of any length are counted whole; very long ones in segments that end where a piece always ends. What a worker
keeps is bounded in bytes. Defined results: null counts as empty, with 0 tokens; a special string in a text is one token;
rows that repeat give equal rows, an empty table an empty one; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.bpe import Kept, segments, split_at
from tidemill.llm.common import in_arrow, slices
from tidemill.llm.pretokens import FRESH, Chunks, compose
from tidemill.llm.vocabulary import Vocabulary, vocabulary

#: Transitions that a worker keeps (about 150 bytes each; beyond them it compiles anew), and pieces in each of two generations.
TRANSITIONS, KEPT = 600_000, 200_000
#: Symbols of a chunk, and code points that are read at a time.
CHUNK, BLOCK = 1024, 1 << 20
#: No token; what is added to an emitted count so that it is above 0 (no token is longer, so none takes back as many).
NONE, OFFSET = -1, 1 << 15


class Transducer:
    def __init__(self, v: Vocabulary, chunk: int = CHUNK):
        self.v, self.chunk = v, chunk
        self.special = split_at(v.special)
        self.ways = Kept(KEPT)
        self.reset()

    def reset(self) -> None:
        start = (b"", (NONE,), (0,))
        self.states, self.number = [start], {start: 0}
        self.table: dict[int, int] = {}

    def compile(self, state: int, byte: int) -> int:
        """Next state and emitted count, in one number; a state is (suffix, last token at each of its positions, their counts - the current)."""
        suffix, last, behind = self.states[state]
        grown = suffix + bytes([byte])
        prefixes, id_of, neighbours = self.v.nodes, self.v.id_of, self.v.neighbours
        drop = 0
        while grown[drop:] not in prefixes:
            drop += 1
        # last[i] belongs to the position after i bytes of the suffix; the last of them is the current one
        for start in range(drop, len(grown)):
            token = id_of.get(grown[start:])
            if token is not None and (last[start] == NONE or neighbours(last[start], token)):
                emitted = behind[start] + 1
                break
        after = (grown[drop:], (*last[drop:], token), (*[x - emitted for x in behind[drop:]], 0))
        number = self.number.setdefault(after, len(self.states))
        if number == len(self.states):
            self.states.append(after)
        return number << 16 | emitted + OFFSET

    def run(self, piece: bytes) -> int:
        return self.advance(0, piece)[1]

    def advance(self, state: int, piece: bytes) -> tuple[int, int]:
        """The state after a stretch of a piece that is entered in a state, and what the transitions emit on that way."""
        total, table = 0, self.table
        for byte in piece:
            got = table.get(state | byte)
            if got is None:
                got = table[state | byte] = self.compile(state >> 8, byte)
            state = got >> 16 << 8
            total += (got & 0xFFFF) - OFFSET
        return state, total

    def through(self, start: int, end: int, cut, told: dict[tuple[int, int, int], int]) -> int:
        """The number of tokens of a piece that goes on through chunks, places in the grid.

        told keeps what is emitted from a chunk's beginning to the piece's end by the state there. Whatever chunk a piece is
        taken to start in, few states are met further on, so each chunk is read a few times at most.
        """
        text = lambda a, b: cut(np.array([a]), np.array([b]))[0].encode("utf-8", "replace")
        at, way = min((start // self.chunk + 1) * self.chunk, end), []
        state, first = self.advance(0, text(start, at))
        while at < end and (at, state, end) not in told:
            stop = min(at + self.chunk, end)
            after, emitted = self.advance(state, text(at, stop))
            way.append(((at, state, end), emitted))
            at, state = stop, after
        rest = told[at, state, end] if at < end else 0
        for key, emitted in reversed(way):
            rest += emitted
            told[key] = rest
        return first + rest

    def emitted(self, pieces: list[str]) -> np.ndarray:
        """The number of tokens of each piece: what the transitions through it emit."""
        distinct = dict.fromkeys(pieces)
        new, known = self.ways.missing(distinct), self.ways.now
        for p in new:
            if len(self.table) > TRANSITIONS:
                self.reset()
            known[p] = self.run(p.encode("utf-8", "replace"))
        out = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        self.ways.trim(distinct)
        return out

    def annotated(self, texts: list[str]) -> tuple[Chunks, np.ndarray]:
        """The chunks of texts without special strings, and what each emits by the state that it is entered in."""
        chunks = Chunks(texts, self.chunk)
        size = np.array([len(t) for t in texts])
        first = np.concatenate([[0], chunks.ends[:-1]]) * self.chunk
        every = "".join(texts)
        base = np.concatenate([[0], np.cumsum(size)[:-1]])

        def cut(start: np.ndarray, end: np.ndarray) -> list[str]:
            """The text between two places of the grid, of one text each."""
            t = np.searchsorted(first, start, side="right") - 1
            a, b = (base[t] + np.minimum(x - first[t], size[t]) for x in (start, end))
            return [every[x:y] for x, y in zip(a.tolist(), b.tolist())]

        start = chunks.place[chunks.starts()]
        counts = np.zeros((len(chunks.maps), 8), np.int64)
        counts += np.bincount(start // self.chunk, weights=self.emitted(cut(start, np.append(start[1:], chunks.marks.size))), minlength=len(counts)).astype(np.int64)[:, None]
        row, state, own, other = chunks.others()
        told: dict[tuple[int, int, int], int] = {}
        for sign, (k, a, b) in ((-1, own), (1, other)):
            n, far = np.zeros(len(k), np.int64), b - a > self.chunk
            n[~far] = self.emitted(cut(a[~far], b[~far]))
            told.clear()  # states may have been numbered anew
            # several states give the same piece
            pairs, which = np.unique(np.stack([a[far], b[far]], axis=1), axis=0, return_inverse=True)
            n[far] = np.array([self.through(x, y, cut, told) for x, y in pairs.tolist()], np.int64)[which.ravel()]
            np.add.at(counts, (row[k], state[k]), sign * n)
        return chunks, counts

    def plain(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text without special strings: the maps of its chunks, composed."""
        chunks, counts = self.annotated(texts)
        told = compose(chunks.maps, counts)[1][:, FRESH]
        return np.diff(np.concatenate([[0], told[chunks.ends - 1]]))

    def texts(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        out, plain, owner = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            for run in self.special.split(text) if self.special and self.special.search(text) else [text]:
                if run in self.v.special:
                    out[i] += 1
                else:
                    for part in segments(run):
                        plain.append(part)
                        owner.append(i)
        # blocks of about BLOCK code points, whatever the length of a text
        ends, at = np.cumsum([len(p) for p in plain]), 0
        while at < len(plain):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, side="right")))
            np.add.at(out, owner[at:stop], self.plain(plain[at:stop]))
            at = stop
        return out.tolist()


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One for each worker process: the compiled machine serves all its tasks."""
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = Transducer(vocabulary(path))
    return _TRANSDUCERS[path]


def count(documents: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than limit): one narrow pass over whole texts."""
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches):
        machine = transducer(path)
        for part, texts in slices(batches, "text", BLOCK):
            n = pa.array(machine.texts(texts), pa.int64())
            size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, n, pc.greater(n, limit)], names=schema.names)
        machine.ways.let_go()
        machine.v.let_go()

    return in_arrow(documents.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)
