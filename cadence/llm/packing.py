"""Order-preserving packing of documents into token windows by dynamic programming.

Each task packs the documents of its own partition in ascending doc_id order (nulls
first, ties by text), so nothing is shuffled and a lost task repeats exactly its own
windows. Cuts are allowed at document ends (free), sentence ends and, only where a
stretch has neither for ``HARD`` tokens, at fixed steps. The cost of a window is its
padding (none at full length or a power of two) plus the penalty of the cut that ends
it; best(j) = min over i of best(i) + cost(i, j) takes the minimum of best(i) + place(i)
over the last ``size`` tokens from a monotone queue, and the few power-of-two windows by
direct look-up, so the work is linear in the number of possible cuts. Documents stream
through in blocks of about ``BLOCK`` windows: the windows of the best path are emitted except
the last few, whose documents wait for the next block.

Token ids are those of the given tokenizer, without special tokens added, then an end id for
each document. Texts are cut into pre-tokens at places where the byte-level
pattern always cuts; ids of a pre-token come from the tokenizer once and then from a cache bounded
by ``CACHE`` entries. A null text is an empty text: a document of the end id alone.
Repeated rows and ids are packed as rows of their own.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import compress, count, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cadence.llm.common import CACHES, narrow

BLOCK, HARD, STEP, CACHE = 128, 512, 128, 1_200_000
SENTENCE_PENALTY, HARD_PENALTY = 4, 64
#: Character classes below U+0180, where they are the same in every Unicode version.
_L, _N, _W = "A-Za-zªµºÀ-ÖØ-öø-ƿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
_PLAIN = re.compile(rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_W}{_L}{_N}]+|[{_W}]+(?![^{_W}])|[{_W}]+").findall
#: Elsewhere: one space between two characters that are no white space always starts a pre-token.
_SPACES = re.compile(r"(?<=\S)(?= \S)").split
_WIDE = re.compile("[^\x00-ſ]").search
_SOLID = re.compile(r" ?\S+").fullmatch
_WORKER: dict = {}
CACHES["packing"] = lambda: [x.known.clear() for x in _WORKER.values()]


class Ids:
    """A worker's tokenizer and its cache: pre-token to little-endian 32-bit ids."""

    def __init__(self, name: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        tokens = {i: x for x, i in self.tok.get_vocab().items()}
        spell = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        self.line = self.tok.encode("\n", add_special_tokens=False).ids
        self.ends = np.array([x[-1:] in (".", "!", "?", "Ċ") for x in spell])
        self.gaps = np.array([x[:1] in ("Ġ", "Ċ", "ĉ", "č") for x in spell])

    def units(self, text: str) -> list[str]:
        if not _WIDE(text) and not any(s in text for s in self.special):
            return _PLAIN(text)
        return _SPACES(text)

    def learn(self, units: list[str]) -> None:
        if len(self.known) > CACHE:
            self.known.clear()
        solid = [u for u in units if _SOLID(u)] if len(self.line) == 1 else []
        if any(x in y for x in self.special for y in ["\n".join(solid)]):
            solid = [u for u in solid if not any(x in u for x in self.special)]
        # pre-tokens without white space inside are encoded as lines of one text: a line end is a token of its own
        for k in range(0, len(solid), 200):
            part = solid[k:k + 200]
            ids = np.array(self.tok.encode_batch_fast(["\n" + "\n".join(part)], add_special_tokens=False)[0].ids, "<u4")
            at, data = [*np.flatnonzero(ids == self.line[0]).tolist(), len(ids)], ids.tobytes()
            if len(at) == len(part) + 1:
                self.known.update((u, data[4 * i + 4:4 * j]) for u, i, j in zip(part, at, at[1:]))
        rest = [u for u in units if u not in self.known]
        got = self.tok.encode_batch_fast(rest, add_special_tokens=False)
        self.known.update((u, np.array(g.ids, "<u4").tobytes()) for u, g in zip(rest, got, strict=True))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        found, open_ = [], []  # ids of each text's pre-tokens; which pre-tokens lack them, and where
        for t in texts:
            units = self.units(t)
            ids = list(map(self.known.get, units))
            found.append(ids)
            if None in ids:
                lacks = [*map(is_, ids, repeat(None))]
                open_.append((ids, [*compress(count(), lacks)], [*compress(units, lacks)]))
        if open_:
            self.learn(list(set().union(*[units for _, _, units in open_])))
        for ids, places, units in open_:
            for k, u in zip(places, units, strict=True):
                ids[k] = self.known[u]
        yield from map(b"".join, found)

    def stops(self, ids: bytes) -> np.ndarray:
        """Token places after a sentence end: a token that ends in . ! ? or a line end, before one that starts with a gap."""
        x = np.frombuffer(ids, "<u4")
        return np.flatnonzero(self.ends[x[:-1]] & self.gaps[x[1:]]) + 1 if len(x) else np.zeros(0, np.int64)


def tokenizer(name: str) -> Ids:
    if name not in _WORKER:
        _WORKER[name] = Ids(name)
    return _WORKER[name]


def candidates(lengths: list[int], sentences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a block, ascending from 0, and their penalties."""
    place, pen, base = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
    for n, s in zip(lengths, sentences, strict=True):
        s = s[(s > 0) & (s < n)]
        marks = np.concatenate([[0], s, [n]])
        wide = np.flatnonzero(np.diff(marks) > HARD)
        hard = np.concatenate([np.arange(marks[k] + STEP, marks[k + 1], STEP) for k in wide]) if len(wide) else np.zeros(0, np.int64)
        own = np.concatenate([s, hard, [n]])
        cost = np.concatenate([np.full(len(s), SENTENCE_PENALTY), np.full(len(hard), HARD_PENALTY), [0]])
        order = np.argsort(own, kind="stable")
        place.append(base + own[order])
        pen.append(cost[order])
        base += n
    return np.concatenate(place), np.concatenate(pen)


def cuts(at: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Places of the cheapest cuts from 0 to the last candidate, both included."""
    # candidates that lie a power of two before another one: windows without padding
    exact: dict[int, list[int]] = {}
    for k in range(size.bit_length()):
        if 1 << k < size:
            before = np.searchsorted(at, at - (1 << k))
            for j in np.flatnonzero(at[before] == at - (1 << k)).tolist():
                exact.setdefault(j, []).append(int(before[j]))
    place, pen = at.tolist(), penalty.tolist()
    best, back = [0] * len(place), [0] * len(place)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # best + place ascending, place, candidate
    for j in range(1, len(place)):
        here = place[j]
        while queue[0][1] < here - size:
            queue.popleft()
        value, _, i = queue[0]
        value += size - here
        if j in exact:
            for k in exact[j]:
                if best[k] < value:
                    value, i = best[k], k
        value += pen[j]
        best[j], back[j] = value, i
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, j))
    out, j = [place[-1]], len(place) - 1
    while j:
        j = back[j]
        out.append(place[j])
    return out[::-1]


def pack_stream(docs: Iterator[tuple[object, bytes, np.ndarray]], size: int, first: int) -> Iterator[tuple]:
    """Pieces (doc, start, length, crc, doc_tokens, sequence, offset) of documents (key, ids, sentence ends)."""
    held: list[list] = []  # key, ids, sentence ends, tokens that are already placed
    waiting, sequence = 0, first

    def settle(last: bool) -> Iterator[tuple]:
        nonlocal held, waiting, sequence
        place, pen = candidates([len(d[1]) // 4 - d[3] for d in held], [d[2] - d[3] for d in held])
        at = cuts(place, pen, size)
        if not last:
            at = at[:-8] if len(at) > 16 else at[:1]
        k, left = 0, 0
        for a, b in zip(at, at[1:]):
            offset = 0
            while offset < b - a:
                key, ids, _, done = held[k]
                n = min(len(ids) // 4 - done, b - a - offset)
                yield key, done, n, zlib.crc32(ids[4 * done:4 * (done + n)]), len(ids) // 4, sequence, offset
                offset += n
                held[k][3] += n
                k += held[k][3] == len(ids) // 4
            sequence += 1
            left = b
        held, waiting = held[k:], waiting - left

    for key, ids, ends in docs:
        held.append([key, ids, ends, 0])
        waiting += len(ids) // 4
        if waiting >= BLOCK * size:
            yield from settle(False)
    if held:
        yield from settle(True)


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 2048, end_id: int = 1,
         model: str = "byte_bpe_50k.json") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = narrow(df, doc_id=doc_id, text=text).sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(model)
        kinds: list[pa.DataType] = []

        def stream():
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type]
                for at in range(0, batch.num_rows, 128):
                    part = batch.slice(at, 128)
                    texts = [t or "" for t in part.column(1).to_pylist()]
                    for key, ids in zip(part.column(0).to_pylist(), tok.encode(texts), strict=True):
                        yield key, ids + end, tok.stops(ids)

        rows: list[tuple] = []

        def flush():
            cols = list(zip(*rows, strict=True))
            out = pa.RecordBatch.from_arrays([pa.array(cols[0], kinds[0]), *(pa.array(c, pa.int64()) for c in cols[1:])], names=names)
            rows.clear()
            return out

        for row in pack_stream(stream(), size, TaskContext.get().partitionId() << 36):
            rows.append(row)
            if len(rows) >= 20_000:
                yield flush()
        if rows:
            yield flush()

    return docs.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:]))
