"""Chat formatting checked by a grammar round trip.

    chat = turn*        turn = "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

``Parser`` is the deterministic reader of this grammar: it takes the formatted text in any pieces and
holds one turn at most. ``render`` writes a turn as it is, reads it back and, as long as the turn
read differs from the source, escapes more: first control strings in the text (a backslash after
"<|", one more where some are there already), then the role (backslash, line end, "<|"). What needs
no escape stays untouched. Turns end where the parser is back at its start, so a conversation is
the plain concatenation of its turns. ``segments`` renders every turn where it lies, ``read_back``
reads the formatted conversations in order and checks each turn against a hash of its source.

The loss mask is a span of code points in each assistant segment: the text as it is written there.

Null texts and roles are empty. Turns are in order of ``turn`` (null first), equal numbers in order of the
formatted turn; repeated rows are turns of their own. Rows with a null conversation id are one
conversation. An empty table gives no row. The hash of a conversation runs over its turns one after the
other, so one task reads a conversation, as a stream: sorted by Spark, one turn in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import narrow, parts

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
_CONTROL = re.compile(r"<\|(\\*)(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\|\\(\\*)(im_start|im_end)\|>")
_IN_ROLE = {"\\": "\\", "n": "\n", "|": "|"}


class Broken(ValueError):
    """Text that the grammar doesn't allow."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"<|\\\1\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<|\1\2|>", text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<|", "<\\|")


def unescape_role(role: str) -> str:
    def plain(m: re.Match) -> str:
        if m[1] not in _IN_ROLE:
            raise Broken(role)
        return _IN_ROLE[m[1]]

    return re.sub(r"\\(.?)", plain, role, flags=re.DOTALL)


class Parser:
    """Turns (role, text) of formatted text that arrives in pieces."""

    def __init__(self):
        self.rest, self.seen = "", 0

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.rest += piece
        while (end := self.rest.find(CLOSE, self.seen)) >= 0 and len(self.rest) > end + len(CLOSE):
            turn, after = self.rest[:end], self.rest[end + len(CLOSE)]
            role, line_end, text = turn[len(OPEN):].partition("\n")
            if not turn.startswith(OPEN) or after != "\n" or not line_end or OPEN in role or OPEN in text:
                raise Broken(turn[:80])
            self.rest, self.seen = self.rest[end + len(CLOSE) + 1:], 0
            yield unescape_role(role), unescape(text)
        self.seen = end if end >= 0 else max(0, len(self.rest) - len(CLOSE))

    def close(self) -> None:
        if self.rest:
            raise Broken(self.rest[:80])


def parse(formatted: str) -> list[tuple[str, str]]:
    parser = Parser()
    turns = list(parser.feed(formatted))
    parser.close()
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the span of its text, escaped only as far as the round trip needs."""
    for r, t in ((role, text), (role, escape(text)), (escape_role(role), escape(text))):
        turn = f"{OPEN}{r}\n{t}{CLOSE}\n"
        try:
            if parse(turn) == [(role, text)]:
                start = len(OPEN) + len(r) + 1
                return turn, start, start + len(t)
        except Broken:
            pass
    raise Broken(f"no round trip: {role[:80]!r}")


def source_hash(role: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"{len(role)} {role}{text}".encode())


def segments(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, segment, loss_from, loss_to (code points of the segment under the loss mask; an empty
    span outside assistant turns) and source, the hash of the turn as it was. No shuffle."""
    df = narrow(df, conv_id=conv_id, turn=turn, role=role, text=text)
    kinds = [df.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]

    def run(batches):
        for batch in parts(batches):
            made, spans, sources = [], [], []
            for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                r, t = r or "", t or ""
                segment, start, end = render(r, t)
                made.append(segment)
                spans.append((start, end) if r == LEARNED else (0, 0))
                sources.append(source_hash(r, t))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string()), pa.array([a for a, _ in spans], pa.int64()),
                                              pa.array([b for _, b in spans], pa.int64()), pa.array(sources, pa.binary())],
                                             names=["conv_id", "turn", "segment", "loss_from", "loss_to", "source"])

    return df.mapInArrow(run, f"conv_id {kinds[0]}, turn {kinds[1]}, segment string, loss_from long, loss_to long, source binary")


class Digest:
    """What is read back from one formatted conversation."""

    def __init__(self):
        self.parser, self.turns, self.loss = Parser(), hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def read(self, segment: str, start: int, end: int, source: bytes) -> None:
        for role, text in self.parser.feed(segment):
            if source_hash(role, text) != source:
                raise Broken(f"turn {self.n_turns} reads back differently")
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        learned = unescape(segment[start:end])
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.formatted_chars += len(segment)

    def close(self) -> tuple:
        self.parser.close()
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(made: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each formatted conversation."""
    made = made.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "segment")
    kind = made.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        own, digest = None, None
        for batch in parts(batches):
            done = []
            for conv, segment, start, end, source in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if digest is None or conv != own:
                    if digest is not None:
                        done.append((own, *digest.close()))
                    own, digest = conv, Digest()
                digest.read(segment, start, end, source)
            yield rows(done, batch.column(0).type)
            last = batch.column(0).type
        if digest is not None:
            yield rows([(own, *digest.close())], last)

    def rows(done, conv_kind):
        columns = list(zip(*done, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [conv_kind, *kinds], strict=True)], names=names)

    return made.select("conv_id", "segment", "loss_from", "loss_to", "source").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_digests(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Formats every conversation and reads the output back."""
    return read_back(segments(df, conv_id, turn, role, text))
