"""Byte-level BPE: encoding by a lazily determinised transducer, decoding as a stream.

What the merges make of a piece of text can be read off its prefixes: each prefix ends in one token,
and the token before that is the one the shorter prefix ends in. A token may follow another only if
the merges, applied to both texts together, leave this pair as it is. So one pass over the bytes
suffices that remembers, for every position a later token can still start at, the token that ends
there. Only as many positions stay open as the longest token has bytes, the lookahead.

A state of the transducer is the token emitted last and the bytes after it, relative to the open
positions. Reading a byte opens a position; as soon as all open positions lead back through the
same boundary, the tokens before it are emitted. States and transitions are made when they are
first met and kept up to a bound, beyond which they are made again.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loantape.llm.store import other_columns, prepare, worker_caches

# Bounds of what a worker keeps, some 400 MB in all.
MAX_STATES = 1 << 18
MAX_PAIRS = 1 << 19
MAX_PIECES = 3 << 17
LONG_PIECE = 256
CHUNK = 1 << 14
LONG_TEXT = 1 << 20


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """A rank file: per line a token in base64 and its rank."""
    rows = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in rows}


DEAD = -2


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.tokens = {token: token for token in ranks}
        self.digits = {rank: str(rank) for rank in ranks.values()}
        # All beginnings of longer tokens: a position stays open as long as what follows it is one.
        self.starts = {t[:n] for t in ranks for n in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.spines: dict[tuple[bytes, bool], tuple[tuple[bytes, int], ...]] = {}
        # Pieces met lately, and those met before them.
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.reset()

    def reset(self) -> None:
        # Number -> token before the tail, tail, for each position of the tail where the token that
        # ends there begins, and the open positions.
        self.states: list[tuple[bytes, bytes, tuple[int, ...], tuple[int, ...]]] = []
        # Few different places occur, so states share them.
        self.shapes: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.numbers: dict[tuple[bytes, bytes], int] = {}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.start = self._number(b"", b"", (-1,), (0,))

    def _number(self, before: bytes, tail: bytes, back: tuple[int, ...], open_: tuple[int, ...]) -> int:
        key = (before, tail)
        known = self.numbers.get(key)
        if known is None:
            key = before, tail = self.tokens.get(before, before), tail
            known = self.numbers[key] = len(self.states)
            share = self.shapes.setdefault
            self.states.append((before, tail, share(back, back), share(open_, open_)))
        return known

    def merge(self, text: bytes, stop: int = 1) -> list[bytes]:
        """Merges of lowest rank first, by definition, until ``stop`` parts are left."""
        rank = self.ranks.get
        none = len(self.ranks)
        parts = [text[i : i + 1] for i in range(len(text))]
        ranked = [rank(text[i : i + 2], none) for i in range(len(text) - 1)]
        while len(parts) > stop and (lowest := min(ranked)) < none:
            at = ranked.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranked[at]
            if at:
                ranked[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(ranked):
                ranked[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def spine(self, token: bytes, right: bool) -> tuple[tuple[bytes, int], ...]:
        """What stands at one end of a token while it is merged, latest first: each part with the
        rank of the merge that takes it in."""
        known = self.spines.get((token, right))
        if known is None:
            parts, taken, part = [], len(self.ranks), token
            while True:
                parts.append((part, taken))
                if len(part) == 1:
                    break
                halves = self.merge(part, 2)
                if len(halves) != 2 or b"".join(halves) not in self.ranks:
                    raise ValueError(f"no merges make the token {part!r}")
                taken, part = self.ranks[part], halves[1 if right else 0]
            known = self.spines[(token, right)] = tuple(parts)
        return known

    def follows(self, left: bytes, right: bytes) -> bool:
        """Whether the merges keep ``left`` (empty at the start) and ``right`` apart and each whole.

        They do unless some part at the end of the one and some part at the beginning of the other
        merge before either is taken into a larger part of its own. A part is always made before it
        is merged, as ranks follow the order of training; of equal ranks the left one goes first.
        """
        if not left:
            return True
        known = self.pairs.get((left, right))
        if known is None:
            rank, none = self.ranks.get, len(self.ranks)
            known = True
            ends = self.spine(right, False)
            for x, x_taken in self.spine(left, True):
                for y, y_taken in ends:
                    across = rank(x + y, none)
                    if across < x_taken and across <= y_taken and across < none:
                        known = False
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            self.pairs[(left, right)] = known
        return known

    def step(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Next state and emitted ids when this byte is read in this state."""
        before, tail, back, open_ = self.states[number]
        ranks, starts = self.ranks, self.starts
        tail += bytes((byte,))
        end = len(tail)
        # The prefix ends in the one token that may follow the token before it.
        last, still = -1, []
        for at in open_:
            token = tail[at:]
            if last < 0 and token in ranks:
                if self.follows(tail[back[at] : at] if at else before, token):
                    last = at
            if token in starts:
                still.append(at)
        if last < 0:
            raise ValueError("the vocabulary lacks a byte")
        back = (*back, last)
        # Where the paths back from all open positions meet, the tokens before are decided.
        base = end
        if still:
            path = {end}
            at = last
            while at >= 0:
                path.add(at)
                at = back[at]
            for at in still:
                while at not in path:
                    at = back[at]
                if at < base:
                    base = at
        ids: list[int] = []
        at = base
        while at > 0:
            ids.append(ranks[tail[back[at] : at]])
            at = back[at]
        still.append(end)
        if base:
            before = tail[back[base] : base]
            back = (-1, *[b - base if b >= base else DEAD for b in back[base + 1 :]])
            tail = tail[base:]
            still = [at - base for at in still]
        return self._number(before, tail, back, tuple(still)), tuple(ids[::-1])

    def run(self, piece: bytes) -> tuple[int, ...]:
        if len(self.states) > MAX_STATES:
            self.reset()
        state, moves, ids = self.start, self.moves, []
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = moves[state << 8 | byte] = self.step(state, byte)
            state = move[0]
            if move[1]:
                ids.extend(move[1])
        _, tail, back, _ = self.states[state]
        at, rest = len(tail), []
        while at > 0:
            rest.append(self.ranks[tail[back[at] : at]])
            at = back[at]
        return (*ids, *rest[::-1])

    def piece(self, piece: str) -> tuple[int, ...]:
        found = self.older.get(piece)
        if found is None:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            found = (whole,) if whole is not None else self.run(raw)
        if len(piece) <= LONG_PIECE:
            if len(self.pieces) >= MAX_PIECES:
                self.older, self.pieces = self.pieces, {}
            self.pieces[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_TEXT:
            return self._encode(self.pattern.findall(text))
        ids: list[int] = []
        matches = self.pattern.finditer(text)
        while pieces := [m.group() for m in islice(matches, CHUNK)]:
            ids.extend(self._encode(pieces))
        return ids

    def _encode(self, pieces: list[str]) -> list[int]:
        found = list(map(self.pieces.get, pieces))
        if None in found:
            found = [ids or self.piece(piece) for ids, piece in zip(found, pieces)]
        return list(chain.from_iterable(found))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text in chunks; a character whose bytes lie in two tokens or two chunks comes out whole."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        ids = list(ids)
        for low in range(0, len(ids), CHUNK):
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids[low : low + CHUNK])))
        yield machine.decode(b"", True)


@lru_cache(maxsize=2)
def _encoder(lines: bytes, pattern: str) -> Encoder:
    return Encoder(read_ranks(lines), pattern)


# Other operators' tasks in the same worker do without.
worker_caches.append(_encoder.cache_clear)


COLUMNS = {
    "ids": "array<int>",
    "n_tokens": "bigint",
    "ids_sha256": "string",
    "decoded": "string",
    "decoded_sha256": "string",
}


def tokenise(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    columns: Iterable[str] = ("ids",),
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the asked columns, in place of any of these names, made in one pass:

    ``ids``; ``n_tokens``; ``ids_sha256`` of the decimal ids joined by blanks; ``decoded``, the text
    that the ids give; ``decoded_sha256`` of its bytes.

    Each match of ``pattern`` is encoded separately, without special tokens. A null text counts as
    empty: no ids. Repeated rows each get their answer; an empty table stays empty. The rank file is
    read where the plan is built and broadcast; its size does not depend on the data.
    """
    spark = prepare(docs.sparkSession)
    names = list(columns)
    with open(ranks_path, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())

    @F.arrow_udf("struct<" + ",".join(f"{n}:{COLUMNS[n]}" for n in names) + ">")
    def run(texts: pa.Array) -> pa.Array:
        encoder = _encoder(ranks.value, pattern)
        made: dict[str, list] = {n: [] for n in names}
        for text in texts:
            ids = encoder.encode(text.as_py() or "")
            if "ids" in made:
                made["ids"].append(ids)
            if "n_tokens" in made:
                made["n_tokens"].append(len(ids))
            if "ids_sha256" in made:
                digest = hashlib.sha256()
                for low in range(0, len(ids), CHUNK):
                    part = " ".join(map(encoder.digits.__getitem__, ids[low : low + CHUNK]))
                    digest.update((" " + part if low else part).encode())
                made["ids_sha256"].append(digest.hexdigest())
            if "decoded" in made or "decoded_sha256" in made:
                parts = list(encoder.decode(ids))
                if "decoded" in made:
                    made["decoded"].append("".join(parts))
                if "decoded_sha256" in made:
                    digest = hashlib.sha256()
                    for part in parts:
                        digest.update(part.encode())
                    made["decoded_sha256"].append(digest.hexdigest())
        types = {"array<int>": pa.list_(pa.int32()), "bigint": pa.int64(), "string": pa.string()}
        arrays = [pa.array(made[n], types[COLUMNS[n]]) for n in names]
        return pa.StructArray.from_arrays(arrays, names)

    kept = other_columns(docs, names)
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    held = docs.select(row.alias("row"), run(F.col(f"`{text_col}`")).alias("made"))
    return held.select(*[F.col(f"row.`{c}`") for c in kept], *[F.col(f"made.{n}") for n in names])
