"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct pieces of a block of texts, sorted, are a trie in depth-first order: what a piece shares with the one
before it is the path that is still on the stack. At each node stands the last token of the encoding of the bytes so
far; the encoding itself is that token, before it the last token of the node where it starts, and so on to the root.
A shared prefix is thus encoded once for all pieces below it.

Texts of any length are encoded whole; very long ones are read in segments that end where a piece always ends. What a
worker has learned of pieces is bounded, and goes when its task ends unless it is told to keep it.

Defined results: null counts as empty and gives no ids. Strings of special tokens in a text become those tokens, as the
library does by default. Rows that repeat give equal rows, an empty table an empty one; further columns, whatever their
names, are ignored. decode() gives back the text of ids, special tokens included.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.codes import WHITE
from tidemill.llm.common import PIECE, in_arrow, release, slices
from tidemill.llm.vocabulary import BITS, TOKEN, Vocabulary

#: Pieces that a worker keeps in each of two generations, and the longest that it keeps: an entry takes about 200 bytes and its text.
KEPT, LONGEST = 100_000, 128
# What byte-level tokenizers of this family cut a text into before they merge.
_S = "[" + "".join(f"\\U{c:08x}" for c in WHITE) + "]"
_NS = _S.replace("[", "[^", 1)
CUT = regex.compile(rf"'(?:[sdmt]|ll|re|ve)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S[1:-1]}\p{{L}}\p{{N}}]+|{_S}+(?!{_NS})|{_S}+")
#: Places where one piece always ends and another begins, whatever stands around them.
SURE = re.compile(r"(?<=\S)(?= \S)|(?<=\n)(?=\S)|(?<=[0-9])(?=[A-Za-z])")


def walk(words: Iterable[bytes], v: Vocabulary) -> Iterator[tuple[int, ...]]:
    """The ids of each word; words are sorted, so that neighbours share the longest prefixes."""
    last: list[int] = [-1]  # by depth: the last token of the path, where it starts, and where tokens may start at all
    back: list[int] = [0]
    least: list[int] = [0]
    path, node, known, fits, shorter = b"", v.nodes.get, v.known.get, v.neighbours, v.shorter
    for word in words:
        depth, most = 0, min(len(path), len(word))
        if path[:most] == word[:most]:
            depth = most
        else:
            while path[depth] == word[depth]:
                depth += 1
        del last[depth + 1 :], back[depth + 1 :], least[depth + 1 :]
        low = least[depth]
        for end in range(depth + 1, len(word) + 1):
            token = node(word[low:end])
            while token is None:
                low += 1
                token = node(word[low:end])
            start = low
            if token < 0:
                ending = -2 - token if token < -1 else v.ending(word[low:end])
                token, start = ending & TOKEN, end - (ending >> BITS)
            # from the longest token that ends here to ever shorter ones, until one fits the token before it
            while start:
                before = last[start]
                fit = known(before << BITS | token)
                if fit or fit is None and fits(before, token):
                    break
                ending = shorter[token] or v.ending(v.bytes_of[token])
                token, start = ending & TOKEN, end - (ending >> BITS)
            last.append(token)
            back.append(start)
            least.append(low)
        path = word
        ids, end = [], len(word)
        while end:
            ids.append(last[end])
            end = back[end]
        yield tuple(ids[::-1])


def segments(text: str, most: int = PIECE) -> Iterator[str]:
    """text in parts of about `most` code points that have the same pieces as the whole."""
    start = 0
    while len(text) - start > most:
        sure = SURE.search(text, start + most)
        if sure is None:
            break
        yield text[start : sure.start()]
        start = sure.start()
    yield text[start:]


class Kept:
    """What is known of pieces, in two generations: what a full one holds and later texts don't use is let go."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def missing(self, distinct: Iterable[str]) -> list[str]:
        """Those of distinct pieces that are not known; the others are in `now` afterwards."""
        if len(self.now) > self.most:
            self.now, self.before = {}, self.now
        now, before, new = self.now, self.before, []
        for p in distinct:
            if p not in now:
                x = before.get(p)
                if x is None:
                    new.append(p)
                else:
                    now[p] = x
        return new

    def trim(self, distinct: Iterable[str]) -> None:
        """Forgets the long ones of these."""
        for p in distinct:
            if len(p) > LONGEST:
                del self.now[p]

    def let_go(self) -> None:
        self.now, self.before = {}, {}


class Encoder:
    """Encodes blocks of texts, keeping the ids of pieces between blocks up to a bound."""

    def __init__(self, v: Vocabulary, kept: int = KEPT):
        self.v, self.kept, self.special = v, Kept(kept), split_at(v.special)
        top = max([*v.bytes_of, *v.special_bytes]) + 1
        self.words = pa.array([str(i) for i in range(top)], pa.string())
        self.raw = pa.array([v.bytes_of.get(i, v.special_bytes.get(i)) for i in range(top)], pa.binary())

    def cut(self, text: str) -> list[str]:
        """The pieces of a text; special strings are pieces of their own."""
        if not self.special or not self.special.search(text):
            return CUT.findall(text)
        return [p for r in self.special.split(text) if r for p in ([r] if r in self.v.special else CUT.findall(r))]

    def ids_of(self, distinct: dict[str, int]) -> list[bytes]:
        """The ids of distinct pieces, four bytes each."""
        new, known, special = self.kept.missing(distinct), self.kept.now, self.v.special
        words = sorted((p.encode("utf-8", "replace"), p) for p in new if p not in special)
        for (_, p), ids in zip(words, walk((w for w, _ in words), self.v), strict=True):
            known[p] = array("i", ids).tobytes()
        for p in new:
            if p in special:
                known[p] = array("i", (special[p],)).tobytes()
        return [known[p] for p in distinct]

    def coded(self, texts: list[str]) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
        """Of each text: how many ids, the ids as text and as the bytes that they stand for; and the ids of all."""
        parts = [self.cut(t) for t in texts]
        flat = list(chain.from_iterable(parts))
        number = {p: i for i, p in enumerate(dict.fromkeys(flat))}
        at = np.fromiter(map(number.__getitem__, flat), np.int32, len(flat))
        own = self.ids_of(number)
        self.kept.trim(number)
        many = np.fromiter(map(len, own), np.int64, len(own)) // 4
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), pa.array(np.frombuffer(b"".join(own), np.int32)))
        ids = lists.take(pa.array(at)).flatten()
        pieces = np.concatenate([[0], np.cumsum(many[at])])
        ends = pieces[np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])]
        joined = lambda values, between: pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.take(ids)), between)
        return np.diff(ends), joined(self.words, ","), joined(self.raw, b""), ids

    def runs(self, text: str) -> Iterator[str]:
        """A very long text in parts that can be encoded one after another."""
        for r in self.special.split(text) if self.special else [text]:
            if r in self.v.special:
                yield r
            else:
                yield from segments(r)

    def read(self, texts: list[str]) -> tuple[list[int], list[str], list[str], list[pa.Array]]:
        """Of each text the number of ids, the digests of the ids and of the decoded text; and the ids of all."""
        if all(len(t) <= PIECE for t in texts):
            many, words, raw, ids = self.coded(texts)
            return many.tolist(), [hashlib.sha256(w.as_buffer()).hexdigest() for w in words], [hashlib.sha256(text_of(r.as_py()).encode()).hexdigest() for r in raw], [ids]
        n, digests, back, ids = [], [], [], []
        for text in texts:
            total, told, read = 0, hashlib.sha256(), hashlib.sha256()
            for run in self.runs(text):
                many, words, raw, own = self.coded([run])
                told.update(b"," * bool(total and many[0]) + words[0].as_py().encode())
                read.update(text_of(raw[0].as_py()).encode())
                total += int(many[0])
                ids.append(own)
            n.append(total)
            digests.append(told.hexdigest())
            back.append(read.hexdigest())
        return n, digests, back, ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        many, _, _, ids = self.coded(texts)
        ends = np.concatenate([[0], np.cumsum(many)])
        return [ids[int(a) : int(b)].to_pylist() for a, b in zip(ends, ends[1:])]


def text_of(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def split_at(special: Iterable[str]) -> re.Pattern | None:
    """Finds special strings, the leftmost first and of those the longest."""
    ordered = sorted(special, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None


def decode(ids: Iterable[int], v: Vocabulary) -> str:
    return text_of(b"".join(v.special_bytes.get(i) or v.bytes_of[i] for i in ids))


_ENCODERS: dict[str, Encoder] = {}


def encode(documents: DataFrame, path: str, ids: bool = True, keep: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (of the ids read back as text) and, if asked for, ids.

    keep: workers keep the vocabulary and what they know of pieces, up to its bounds (about 150 MB each), for their next task.
    That saves some time where no other stage of the same executors needs the memory.
    """
    schema = T.StructType(
        [T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    )

    def run(batches):
        coder = _ENCODERS.get(path) or Encoder(Vocabulary(path))
        if keep:
            _ENCODERS[path] = coder
        for part, texts in slices(batches, "text", 1 << 20):
            n, digests, back, own = coder.read(texts)
            arrays = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
            if ids:
                arrays.append(pa.ListArray.from_arrays(pa.array([0, *accumulate(n)], pa.int32()), pa.concat_arrays(own)))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        del coder
        release()

    return in_arrow(documents.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)
