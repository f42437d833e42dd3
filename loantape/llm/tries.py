"""Exact duplicates: Patricia tries whose terminal nodes know the owner of each text.

Texts travel at most once, and only those that may be copies. Every task first puts the whole texts
of its rows into one radix trie, under their length and a byte of their content hash, so equal texts
within a task meet in a terminal node before anything is shuffled. A trie that outgrows its bound
spills its heaviest subtrees: their terminals go out with what they know so far, and texts that come
later start the subtree anew. Terminals are then partitioned by length and content hash; where two
or more share both, their full byte strings go into a trie again, which tells true copies from
collisions and gives every terminal its final owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loantape.llm.store import give_back, prepare, stored

# Bytes a task's trie may hold before it spills, as counted by the two constants below.
TRIE_BYTES = 32 << 20
NODE_BYTES = 400
ITEM_BYTES = 120
# Terminals of one text that are merged in one group; more are merged in salted groups first.
FAN = 256
# Rows and bytes of a batch that leaves a task.
OUT_ROWS = 4096
OUT_BYTES = 4 << 20


class Node:
    __slots__ = ("label", "kids", "items")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.kids: dict[int, Node] = {}
        self.items: list | None = None


def shared_length(label: bytes, data: bytes, at: int) -> int:
    """Leading bytes that ``label`` and ``data`` from ``at`` have in common."""
    low, high = 0, min(len(label), len(data) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == data[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """Byte strings with the items added under each; edges are as long as they can be."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.held = 0

    def add(self, data: bytes, item) -> None:
        node, at = self.root, 0
        while at < len(data):
            kid = node.kids.get(data[at])
            if kid is None:
                kid = node.kids[data[at]] = Node(data[at:])
                self.held += NODE_BYTES + len(kid.label)
            elif not data.startswith(kid.label, at):
                kid = self._split(node, kid, shared_length(kid.label, data, at))
            node, at = kid, at + len(kid.label)
        if node.items is None:
            node.items = []
        node.items.append(item)
        self.held += ITEM_BYTES

    def _split(self, above: Node, kid: Node, n: int) -> Node:
        middle = Node(kid.label[:n])
        kid.label = kid.label[n:]
        middle.kids[kid.label[0]] = kid
        above.kids[middle.label[0]] = middle
        self.held += NODE_BYTES
        return middle

    @staticmethod
    def _below(node: Node, path: bytes) -> Iterator[tuple[bytes, list]]:
        todo = [(node, path)]
        while todo:
            node, path = todo.pop()
            path += node.label
            if node.items is not None:
                yield path, node.items
            todo += [(kid, path) for kid in node.kids.values()]

    @staticmethod
    def _weight(node: Node) -> int:
        total, todo = 0, [node]
        while todo:
            node = todo.pop()
            total += NODE_BYTES + len(node.label) + ITEM_BYTES * len(node.items or ())
            todo += node.kids.values()
        return total

    def spill(self, target: int = 0) -> Iterator[tuple[bytes, list]]:
        """Cut off the heaviest subtrees, and give their strings and items, until no more than
        ``target`` bytes are held; all of the trie by default."""
        if self.held <= target:
            return
        node, path = self.root, b""
        while len(node.kids) == 1 and node.items is None:
            path += node.label
            (node,) = node.kids.values()
        weights = sorted(((self._weight(kid), first) for first, kid in node.kids.items()), reverse=True)
        for weight, first in weights:
            if self.held <= target:
                return
            self.held -= weight
            yield from self._below(node.kids.pop(first), path + node.label)
        if self.held > target:
            if node.items is not None:
                yield path + node.label, node.items
            self.root, self.held = Node(b""), 0


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _owner(ids: list[int | None], largest: bool) -> int | None:
    known = [i for i in ids if i is not None]
    return (max(known) if largest else min(known)) if known else None


class _Out:
    """Rows gathered into batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, weight: int = 0) -> pa.RecordBatch | None:
        self.rows.append(row)
        self.bytes += weight
        return self.batch() if len(self.rows) >= OUT_ROWS or self.bytes >= OUT_BYTES else None

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(self.schema)
        made = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.bytes = [], 0
        return made


ROWS = pa.schema([
    ("class", pa.int64()), ("doc_id", pa.int64()), ("lead", pa.bool_()), ("sha", pa.binary()), ("n_bytes", pa.int64()),
    ("hash", pa.int64()), ("owner", pa.int64()), ("n", pa.int64()), ("head", pa.bool_()), ("text", pa.binary()),
])
ROWS_SQL = "class bigint, doc_id bigint, lead boolean, sha binary, n_bytes bigint, hash bigint, owner bigint, n bigint, head boolean, text binary"
MERGED = pa.schema([
    ("class", pa.int64()), ("top", pa.int64()), ("winner", pa.int64()), ("n_bytes", pa.int64()), ("hash", pa.int64()),
    ("owner", pa.int64()), ("n", pa.int64()), ("text", pa.binary()),
])
MERGED_SQL = "class bigint, top bigint, winner bigint, n_bytes bigint, hash bigint, owner bigint, n bigint, text binary"


def _fold(trie_bytes: int, largest: bool):
    """Rows of (id, text) to one row each, with what the task's trie knows of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = _Out(ROWS), TaskContext.get().partitionId() << 40
        trie = Trie()

        def rows(found: Iterator[tuple[bytes, list]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for key, ids in found:
                # The key's nine bytes ahead of the text are its length and a byte of its hash.
                text, owner = key[9:], _owner(ids, largest)
                sha, hashed, lead = hashlib.sha256(text).digest(), _signed(xxhash.xxh64_intdigest(text)), ids.index(owner)
                for i, doc_id in enumerate(ids):
                    full = out.add(
                        (number, doc_id, i == lead, sha, len(text), hashed, owner, len(ids), not i, None if i else text),
                        0 if i else len(text),
                    )
                    if full is not None:
                        yield full
                number += 1

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (text.as_py() or b"").lower()
                trie.add(len(data).to_bytes(8, "big") + xxhash.xxh32_digest(data)[:1] + data, doc_id)
                if trie.held > trie_bytes:
                    yield from rows(trie.spill(trie_bytes // 2))
        yield from rows(trie.spill())
        yield out.batch()
        give_back()

    return run


def _merge(largest: bool, fan: int):
    """Terminals sorted by length, hash and salt to one row each: the class that stands for its text
    from here on, and what is known of the text. The class that stands for it carries the text if
    it will be merged again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(MERGED)
        trie, now = Trie(), None

        def close() -> Iterator[pa.RecordBatch]:
            for text, items in trie.spill():
                owner, n = _owner([x[2] for x in items], largest), sum(x[3] for x in items)
                winner = min(x[1] for x in items if x[2] == owner)
                top = min(x[0] for x in items)
                for name, *_ in items:
                    again = name == top and now[3] > fan
                    full = out.add((name, top, winner, now[0], now[1], owner, n, text if again else None), len(text) if again else 0)
                    if full is not None:
                        yield full

        for batch in batches:
            for name, winner, n_bytes, hashed, owner, n, text, members, salt in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and now[:3] != (n_bytes, hashed, salt):
                    yield from close()
                now = (n_bytes, hashed, salt, members)
                trie.add(text, (name, winner, owner, n))
        if now is not None:
            yield from close()
        yield out.batch()
        give_back()

    return run


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    largest: bool = True,
    trie_bytes: int = TRIE_BYTES,
    fan: int = FAN,
) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` per row of ``docs``.

    Texts are equal if their UTF-8 bytes are, once A-Z are lower-cased; a null text counts as empty.
    ``keep_id`` is the largest id of the rows with that text, or the smallest if not ``largest``, and
    ``group_size`` their number. Exactly one row of a group is ``kept``: one with that id, should
    several rows repeat it, and any one in a group of rows without ids, whose ``keep_id`` is null.
    A row without an id counts, and goes if its group has one with an id. No other column is read.
    An empty table gives an empty table.

    Nothing is told apart by a hash alone: ``class`` numbers the terminals of the tasks' tries, and
    the merged tries hold whole texts. A text held by very many tasks is merged in groups of ``fan``
    terminals first, each of which gives one terminal to the next round.
    """
    spark = prepare(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("binary"))
    rows = stored(given.mapInArrow(_fold(trie_bytes, largest), ROWS_SQL), "tries")
    # Only the lengths and hashes of terminals are counted; texts follow for those that meet.
    now = rows.where("head").select("class", F.col("class").alias("winner"), "n_bytes", "hash", "owner", "n", "text")
    known = None
    while True:
        met = now.groupBy(F.col("n_bytes").alias("b"), F.col("hash").alias("h")).agg(F.count(F.lit(1)).alias("members"))
        met = stored(met.where("members > 1"), "meeting")
        most = met.agg(F.max("members")).first()[0]
        if most is None:
            break
        salts = F.ceil(F.col("members") / fan).cast("int")
        texts = now.join(met, (F.col("n_bytes") == F.col("b")) & (F.col("hash") == F.col("h"))).select(
            *now.columns, "members", F.pmod(F.xxhash64("class"), salts).alias("salt")
        )
        by = ["n_bytes", "hash", "salt"]
        level = stored(texts.repartition(*by).sortWithinPartitions(*by).mapInArrow(_merge(largest, fan), MERGED_SQL), "merged")
        step = level.select(F.col("class").alias("c"), F.col("top").alias("t"), F.col("winner").alias("w"), F.col("owner").alias("o"), F.col("n").alias("m"))
        if known is None:
            known = step
        else:
            # Classes whose text was merged again take what the next level knows.
            later = step.toDF("c2", "t2", "w2", "o2", "m2")
            again = F.col("c2").isNotNull()
            pick = lambda new, old: F.when(again, F.col(new)).otherwise(F.col(old)).alias(old)
            known = known.join(later, F.col("t") == F.col("c2"), "left").select(
                "c", pick("t2", "t"), pick("w2", "w"), pick("o2", "o"), pick("m2", "m")
            )
        if most <= fan:
            break
        now = level.where("text is not null").select("class", "winner", "n_bytes", "hash", "owner", "n", "text")
    found = rows.select("class", "doc_id", "lead", "sha", "owner", "n")
    if known is None:
        known = spark.createDataFrame([], "c bigint, t bigint, w bigint, o bigint, m bigint")
    found = found.join(known, F.col("class") == F.col("c"), "left")
    shared = F.col("c").isNotNull()
    return found.select(
        "doc_id",
        F.when(shared, F.col("o")).otherwise(F.col("owner")).alias("keep_id"),
        F.when(shared, F.col("m")).otherwise(F.col("n")).alias("group_size"),
        (F.col("lead") & F.when(shared, F.col("w") == F.col("class")).otherwise(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
