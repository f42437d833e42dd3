"""Removal of repeated passages by a hash-compared suffix sort.

A byte goes if a string of ``width`` bytes over it also starts in a document with a smaller id. The
strings are the beginnings of suffixes; two that are equal stand side by side once the suffixes are
sorted. Suffixes are sorted where equal ones are sure to meet:

- Each string of ``width`` bytes is filed under its anchor, the ``GRAM`` bytes in it of the smallest
  hash (the first, if there are several). Equal strings have equal anchors at equal places, and
  neighbouring strings mostly share theirs, so a text has some sixteenth as many anchors as bytes.
- Blocks of documents send the hashes of their anchors, four bytes each, to buckets, which answer
  which of them occur in two documents or more. Only for those, a block sends the run of bytes whose
  strings share the anchor, once for all its occurrences in the block, with the smallest id. What
  the block's later ids lose by that is settled in the block and passes the buckets by.
- An anchor in ``HOT`` documents or more can have as many different runs. Its runs are sent as single
  strings, each to the bucket of its own hash, where equal ones meet again.
- A bucket sorts the suffixes of the different runs of an anchor, by mergesort. Two suffixes are
  compared through prefix polynomial hashes: binary search finds how far they agree, and the next
  byte decides. The order is then verified byte by byte, and the sort repeated with another base
  should a collision have spoilt it. Neighbours that agree in ``width`` bytes share the smallest id.

Nothing is dropped or capped: an anchor that very many documents have is one entry per block, and
equal runs, or equal strings of a hot anchor, are one per block. A bucket holds of one anchor the
runs of ``HOT`` documents at most, or of one string an entry per block, and a block a bounded number
of bytes, but for single documents that are longer. Rows without an id go through no block.
A block sends a row to every bucket it has anchors in, so blocks grow with the fourth root of the
text (70 MB at 100 TB), and rows, of blocks and buckets, by its power of 1.5 instead of 2.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loantape.llm.store import give_back, prepare

WIDTH = 50
GRAM = 20
BLOCK_BYTES = 4 << 20
# Text up to which blocks keep that size.
EVEN_BYTES = 1 << 30
# Documents from which an anchor's strings are dealt by themselves.
HOT = 1 << 14
SLICE = (1 << 20) - 128
_PLACE = np.uint64((1 << 20) - 1)
_BITS = np.uint64(20)
_STEP = np.uint64(0xBF58476D1CE4E5B9)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(50).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all ``GRAM``-byte strings, put together from powers of two."""
    with np.errstate(over="ignore"):
        power, length, have = _BASE, 1, _BYTES[data]
        done, reach = None, 0
        while True:
            if GRAM & length:
                done = have if done is None else done[: len(have) - reach] * power + have[reach:]
                reach += length
                if reach == GRAM:
                    break
            have = have[:-length] * power + have[length:]
            power = power * power
            length *= 2
        done = done ^ (done >> np.uint64(31))
        done = done * _STEP
        return done ^ (done >> np.uint64(29))


def _sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    span = 1
    while 2 * span <= n:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (n - span)], values[n - span :]) if n > span else values


def anchors(data: bytes, width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of strings that share an anchor: its key, first string, last string, place of the anchor."""
    for low in range(0, max(0, len(data) - width + 1), SLICE):
        part = np.frombuffer(data, np.uint8, min(len(data) - low, SLICE + width - 1), low)
        hashes = _gram_hashes(part)
        marked = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_min(marked, width - GRAM + 1)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[first[1:], len(least)] - 1
        chosen = least[first]
        key = chosen >> _BITS
        with np.errstate(over="ignore"):
            key = key * _BASE
            key ^= key >> np.uint64(32)
            key *= _STEP
        yield key, first + low, last + low, (chosen & _PLACE).astype(np.int64) + low


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _HALF) % np.uint64(buckets)).astype(np.int64)


class Prefixes:
    """Polynomial hashes of all prefixes of a text, and so of all its substrings."""

    def __init__(self, data: np.ndarray, base: int, longest: int) -> None:
        with np.errstate(over="ignore"):
            base = np.uint64(base | 1)
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(longest, base, np.uint64)], dtype=np.uint64)
            # h[i + 1] = h[i] * base + byte, by doubling the stretch that is summed up.
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            up = np.cumprod(np.r_[np.uint64(1), np.full(len(data), base, np.uint64)], dtype=np.uint64)
            down = np.cumprod(np.r_[np.uint64(1), np.full(len(data), inverse, np.uint64)], dtype=np.uint64)
            sums = np.cumsum(_BYTES[data] * down[1:], dtype=np.uint64)
            self.h = np.r_[np.uint64(0), sums * up[1:]]

    def of(self, at: np.ndarray, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self.h[at + length] - self.h[at] * self.powers[length]


def common(prefixes: Prefixes, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """How far the suffixes at ``a`` and ``b`` agree, up to ``width``, by binary search."""
    reach = np.zeros(len(a), np.int64)
    step = 1 << (width.bit_length() - 1)
    while step:
        open_ = np.flatnonzero(reach + step <= width)
        if len(open_):
            x, y = a[open_] + reach[open_], b[open_] + reach[open_]
            same = prefixes.of(x, step) == prefixes.of(y, step)
            reach[open_[same]] += step
        step >>= 1
    return reach


def merge_sort(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, width: int, base: int) -> np.ndarray:
    """Order of the suffixes at ``starts``, cut at ``width``, within each of the sorted ``groups``.

    Runs of doubling length are merged, all pairs of runs of all groups at once: an element's place
    is its own place plus the number of elements of the other run before it, found by binary search.
    """
    prefixes = Prefixes(data, base, width)
    order = np.arange(len(starts))
    begin = np.r_[0, np.flatnonzero(groups[1:] != groups[:-1]) + 1]
    size = np.diff(np.r_[begin, len(groups)])
    low, end = np.repeat(begin, size), np.repeat(begin + size, size)
    place = np.arange(len(starts)) - low

    def before(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix y comes before x, or is equal to it where ``ties``."""
        reach = common(prefixes, x, y, width)
        ended = reach == width
        at = np.minimum(reach, width - 1)
        return np.where(ended, ties, data[y + at] < data[x + at])

    run = 1
    longest = int(size.max(initial=0))
    while run < longest:
        active = np.flatnonzero(end - low > run)
        own = place[active] // run
        right = own % 2 == 1
        other = low[active] + np.where(right, own - 1, own + 1) * run
        stop = np.minimum(other + run, end[active])
        lo, hi = np.minimum(other, stop), stop.copy()
        mine = starts[order[active]]
        while len(todo := np.flatnonzero(lo < hi)):
            middle = (lo[todo] + hi[todo]) // 2
            # Of equal suffixes those of the left run come first.
            less = before(mine[todo], starts[order[middle]], right[todo])
            lo[todo] = np.where(less, middle + 1, lo[todo])
            hi[todo] = np.where(less, hi[todo], middle)
        passed = np.maximum(lo - other, 0)
        left_start = low[active] + own // 2 * 2 * run
        target = left_start + (active - (low[active] + own * run)) + passed
        merged = order.copy()
        merged[target] = order[active]
        order = merged
        run *= 2
    return order


def sort_suffixes(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The verified order, and for each suffix in it whether it equals the one before it."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    for attempt in range(8):
        order = merge_sort(data, starts, groups, width, int(_BASE) + 2 * attempt * 0x1000003)
        at = starts[order]
        same = np.zeros(len(at), bool)
        sorted_ = True
        for low in range(1, len(at), 1 << 16):
            rows = np.arange(low, min(len(at), low + (1 << 16)))
            mine = data[at[rows, None] + np.arange(width)]
            prior = data[at[rows - 1, None] + np.arange(width)]
            differ = mine != prior
            first = differ.argmax(1)
            equal = ~differ.any(1)
            inside = groups[rows] == groups[rows - 1]
            picked = np.arange(len(rows))
            sorted_ &= bool((equal | ~inside | (prior[picked, first] < mine[picked, first])).all())
            same[rows] = equal & inside
        if sorted_:
            return order, same
    raise RuntimeError("no base without collisions")


def _texts(table: pa.Table) -> tuple[list[int], list, list[bytes]]:
    """Rows with an id in order of id and text: their places, ids and texts in bytes."""
    ids = table["doc_id"].to_pylist()
    texts = [t.as_py().encode() if t.is_valid else b"" for t in table["text"]]
    order = sorted((i for i, d in enumerate(ids) if d is not None), key=lambda i: (ids[i], texts[i]))
    return order, [ids[i] for i in order], [texts[i] for i in order]


def _split(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted places of the keys by bucket."""
    at = _bucket(keys, buckets)
    order = np.argsort(at, kind="stable")
    edges = np.flatnonzero(np.diff(at[order])) + 1
    for part in np.split(order, edges):
        if len(part):
            yield int(at[part[0]]), part


def _unpack(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(blob, kind)


def n_blocks(total: int, block_bytes: int = BLOCK_BYTES) -> int:
    """The number of blocks for so many bytes of text, of ``block_bytes`` up to ``EVEN_BYTES``."""
    size = block_bytes * max(1.0, total / EVEN_BYTES) ** 0.25
    return max(1, math.ceil(total / size))


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
    kept: str | None = "bytes",
) -> DataFrame:
    """``docs`` (the text apart) in a struct ``row``, with ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept_sha256`` of the remaining bytes and, if asked, ``kept``: these
    "bytes", or their "text", without the bytes of characters that a removed run cuts through.

    Matches never cross documents, strings overlap, and all are judged on the input. A null text is
    empty. Rows that share an id do not remove from one another; a row without an id neither removes
    nor loses anything. Of equal texts of ``width`` bytes or more, all but those with the smallest
    id go wholly. An empty table gives an empty table. Columns of any name pass through in ``row``.
    """
    prepare(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    blocks = buckets = n_blocks(total, block_bytes)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    every = docs.select(
        F.struct(*others).alias("row"),
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(blocks)).alias("block"),
    )
    rows = every.where("doc_id is not null")
    hot_from = HOT

    def offer(key: tuple, table: pa.Table) -> pa.Table:
        """A block's anchors by bucket: a hash once, or twice if two of its documents have it, with
        the number of its documents if there are more."""
        block = key[0].as_py()
        _, ids, texts = _texts(table)
        found: list[np.ndarray] = []
        last, own = None, []
        for doc_id, text in [*zip(ids, texts), (None, b"")]:
            if doc_id != last and own:
                found.append(np.unique(np.concatenate(own)))
                own = []
            last = doc_id
            own.extend(k for k, _, _, _ in anchors(text, width))
        if not found:
            found.append(np.zeros(0, np.uint64))
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        parts = []
        for b, p in _split(keys, buckets):
            low, n = (keys[p] & _LOW).astype(np.uint32), counts[p]
            more = np.c_[low[n > 2], n[n > 2]].astype(np.uint32)
            parts.append((b, block, np.repeat(low, np.minimum(n, 2)).tobytes(), more.tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*parts)) or [[]] * 4, kinds)], ["bucket", "block", "keys", "more"])

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        """Which of each block's anchors occur in two documents or more anywhere, and which are hot."""
        bucket = key[0].as_py()
        held = [_unpack(k, np.uint32) for k in table["keys"].to_pylist()]
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        shared = keys[counts > 1]
        more = np.concatenate([_unpack(m, np.uint32) for m in table["more"].to_pylist()]).reshape(-1, 2)
        np.add.at(counts, np.searchsorted(keys, more[:, 0]), more[:, 1].astype(np.int64) - 2)
        hot = keys[counts >= hot_from]
        out = []
        for block, own in zip(table["block"].to_pylist(), held):
            own = np.unique(own)
            own = own[np.isin(own, shared, assume_unique=True)]
            if len(own):
                out.append((block, bucket, own.tobytes(), own[np.isin(own, hot, assume_unique=True)].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, kinds)], ["block", "bucket", "keys", "hot"])

    run_columns = ["bucket", "block", "keys", "sizes", "offsets", "lowest", "counts", "bytes", "places", "settled"]
    run_types = [pa.int64(), pa.int64(), *[pa.binary()] * 8]

    def show(table: pa.Table, shared: pa.Table) -> pa.Table:
        """The runs of the block's shared anchors, by bucket, with where they occur in the smallest
        id that has them; and what its later ids lose, in a row that any bucket hands on."""
        out = []
        if shared.num_rows and table.num_rows:
            block = table["block"][0].as_py()
            wanted, hot = (
                np.sort(np.concatenate([
                    _unpack(k, np.uint32).astype(np.uint64) | np.uint64(b) << _HALF
                    for b, k in zip(shared["bucket"].to_pylist(), shared[name].to_pylist())
                ]))
                for name in ("keys", "hot")
            )
            _, ids, texts = _texts(table)
            # Per bucket and run: occurrences as document number and place, in order of the ids.
            runs: dict[int, dict[tuple[int, bytes, int], list[int]]] = defaultdict(dict)
            for number, text in enumerate(texts):
                for keys, first, last, place in anchors(text, width):
                    at = _bucket(keys, buckets)
                    small = keys & _LOW
                    full = small | at.astype(np.uint64) << _HALF
                    hit = np.searchsorted(wanted, full)
                    chosen = np.flatnonzero(wanted[np.minimum(hit, len(wanted) - 1)] == full)
                    if len(hot):
                        many = np.isin(full[chosen], hot)
                        for s, e, p in zip(first[chosen[many]].tolist(), last[chosen[many]].tolist(), place[chosen[many]].tolist()):
                            for i in range(s, e + 1):
                                string = text[i : i + width]
                                mixed = xxhash.xxh64_intdigest(string)
                                runs[(mixed >> 32) % buckets].setdefault((mixed & 0xFFFFFFFF, string, p - i), []).extend((number, i))
                        chosen = chosen[~many]
                    for b, k, s, e, p in zip(
                        at[chosen].tolist(), small[chosen].tolist(), first[chosen].tolist(), last[chosen].tolist(), place[chosen].tolist()
                    ):
                        of = runs[b]
                        run = (k, text[s : e + width], p - s)
                        if run in of:
                            of[run] += (number, s)
                        else:
                            of[run] = [number, s]
            del wanted, texts
            settled = []
            for bucket, of in runs.items():
                lists = []
                low = [ids[o[0]] for o in of.values()]
                # Occurrences in the smallest id stand first; later ids lose the whole run to it.
                for run, o, d in zip(of, of.values(), low):
                    n = 2
                    while n < len(o) and ids[o[n]] == d:
                        n += 2
                    lists.append(o[:n])
                    size = len(run[1])
                    for i in range(n, len(o), 2):
                        settled += (o[i], o[i + 1], o[i + 1] + size)
                out.append((
                    bucket, block,
                    np.array([r[0] for r in of], np.uint32).tobytes(),
                    np.array([len(r[1]) for r in of], np.uint8).tobytes(),
                    np.array([r[2] for r in of], np.uint8).tobytes(),
                    np.array(low, np.int64).tobytes(),
                    np.array([len(o) // 2 for o in lists], np.uint32).tobytes(),
                    b"".join(r[1] for r in of),
                    np.array([x for o in lists for x in o], np.uint32).tobytes(),
                    b"",
                ))
            if settled:
                out.append((block % buckets, block, *[b""] * 7, np.array(settled, np.uint32).tobytes()))
            runs.clear()
            del settled
        made = pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * len(run_types), run_types)], run_columns)
        del out
        give_back()
        return made

    def decide(table: pa.Table) -> pa.Table:
        """Per block what goes of its documents, after sorting the suffixes of all runs here."""
        out = [(p["block"], p["settled"]) for p in table.select(["block", "settled"]).to_pylist() if p["settled"]]
        parts = [p for p in table.to_pylist() if p["keys"]]
        if not parts:
            return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 2, (pa.int64(), pa.binary()))], ["block", "spans"])
        keys = np.concatenate([_unpack(p["keys"], np.uint32) for p in parts])
        sizes = np.concatenate([_unpack(p["sizes"], np.uint8) for p in parts]).astype(np.int64)
        offsets = np.concatenate([_unpack(p["offsets"], np.uint8) for p in parts]).astype(np.int64)
        lowest = np.concatenate([_unpack(p["lowest"], np.int64) for p in parts])
        whole = b"".join(p["bytes"] for p in parts)
        begin = np.cumsum(np.r_[0, sizes[:-1]])
        # Equal runs of different blocks are one.
        numbers: dict[tuple[int, bytes, int], int] = {}
        same_as = np.array([
            numbers.setdefault((k, whole[b : b + n], o), len(numbers))
            for k, b, n, o in zip(keys.tolist(), begin.tolist(), sizes.tolist(), offsets.tolist())
        ])
        first_at = np.full(len(numbers), -1)
        first_at[same_as[::-1]] = np.arange(len(same_as))[::-1]
        low = np.full(len(numbers), np.iinfo(np.int64).max)
        np.minimum.at(low, same_as, lowest)
        # Strings of all different runs; equal ones have the same anchor at the same place.
        n_strings = sizes[first_at] - width + 1
        string_at = np.cumsum(np.r_[0, n_strings])
        of_run = np.repeat(np.arange(len(numbers)), n_strings)
        offset = np.arange(len(of_run)) - string_at[of_run]
        least = low[of_run]
        lead = offsets[first_at][of_run] - offset
        group = keys[first_at][of_run].astype(np.int64) * 256 + lead
        order = np.argsort(group, kind="stable")
        grouped = group[order]
        alone = np.r_[True, grouped[1:] != grouped[:-1]] & np.r_[grouped[1:] != grouped[:-1], True]
        order, grouped = order[~alone], grouped[~alone]
        data = np.frombuffer(whole, np.uint8)
        sorted_, same = sort_suffixes(data, (begin[first_at][of_run] + offset)[order], grouped, width)
        if len(order):
            strings = order[sorted_]
            classes = np.cumsum(~same) - 1
            edges = np.flatnonzero(~same)
            least[strings] = np.minimum.reduceat(least[strings], edges)[classes]
        row = 0
        for part in parts:
            counts = _unpack(part["counts"], np.uint32).astype(np.int64)
            places = _unpack(part["places"], np.uint32).reshape(-1, 2).astype(np.int64)
            mine = np.arange(row, row + len(counts))
            row += len(counts)
            occurrence = np.cumsum(np.r_[0, counts[:-1]])
            # The smallest id loses the strings that an earlier one elsewhere has, in maximal runs.
            run = same_as[mine]
            span = n_strings[run]
            local = np.repeat(np.arange(len(mine)), span)
            step = np.arange(len(local)) - np.cumsum(np.r_[0, span[:-1]])[local]
            lost = least[string_at[run][local] + step] < lowest[mine][local]
            opens = lost & ~(np.r_[False, lost[:-1]] & (step > 0))
            closes = lost & ~(np.r_[lost[1:], False] & np.r_[step[1:] > 0, False])
            piece, start, stop = local[opens], step[opens], step[closes]
            times = counts[piece]
            which = np.repeat(np.arange(len(piece)), times)
            nth = np.arange(len(which)) - np.cumsum(np.r_[0, times[:-1]])[which]
            hit = places[occurrence[piece][which] + nth]
            found = np.c_[hit[:, 0], hit[:, 1] + start[which], hit[:, 1] + stop[which] + width]
            if len(found):
                out.append((part["block"], found.astype(np.uint32).tobytes()))
        del of_run, offset, least, lead, group, order, data
        give_back()
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 2, (pa.int64(), pa.binary()))], ["block", "spans"])

    made = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    if kept:
        made.append(("kept", pa.string() if kept == "text" else pa.binary()))

    def cut(table: pa.Table, spans: pa.Table) -> pa.Table:
        order, _, texts = _texts(table)
        found = [_unpack(s, np.uint32).reshape(-1, 3).astype(np.int64) for s in spans["spans"].to_pylist()]
        lost = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        lost = lost[np.lexsort((lost[:, 1], lost[:, 0]))]
        edges = np.searchsorted(lost[:, 0], np.arange(len(texts) + 1))
        results: list = [None] * table.num_rows
        for number, (place, text) in enumerate(zip(order, texts)):
            part = lost[edges[number] : edges[number + 1]]
            rest, removed, n = text, 0, 0
            if len(part):
                ends = np.maximum.accumulate(part[:, 2])
                opens = np.r_[True, part[1:, 1] > ends[:-1]]
                starts, stops = part[opens, 1].tolist(), ends[np.r_[opens[1:], True]].tolist()
                rest = b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)]))
                removed, n = len(text) - len(rest), len(starts)
            results[place] = (len(text), removed, n, hashlib.sha256(rest).hexdigest(), rest)
        return answered(table, results)

    def answered(table: pa.Table, results: list) -> pa.Table:
        columns = list(zip(*results)) or [[]] * 5
        if kept == "text":
            columns[4] = [rest.decode("utf-8", "ignore") for rest in columns[4]]
        return pa.table([table["row"], *(pa.array(c, t) for c, (_, t) in zip(columns, made))], ["row", *(n for n, _ in made)])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().encode() if t.is_valid else b"" for t in batch["text"]]
            table = answered(pa.table([batch["row"]], ["row"]), [(len(t), 0, 0, hashlib.sha256(t).hexdigest(), t) for t in texts])
            yield from table.combine_chunks().to_batches()

    offered = rows.groupBy("block").applyInArrow(offer, "bucket bigint, block bigint, keys binary, more binary")
    shared = offered.groupBy("bucket").applyInArrow(answer, "block bigint, bucket bigint, keys binary, hot binary")
    shown = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        show, ", ".join(f"{n} {'bigint' if t == pa.int64() else 'binary'}" for n, t in zip(run_columns, run_types))
    )
    spans = shown.groupBy("bucket").applyInArrow(decide, "block bigint, spans binary")
    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{n} {kinds[t]}" for n, t in made)
    done = rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)
    return done.unionByName(every.where("doc_id is null").select("row", "text").mapInArrow(passed, schema))
