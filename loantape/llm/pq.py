"""Near-duplicate vectors by product quantisation: coarse lists, residual codes, exact rerank.

Vectors are brought to length one, where a cosine of ``c`` is a distance of ``sqrt(2 - 2c)``. Each
goes to the list of its nearest centroid; what is left is coded per subspace. A query looks into
every list that can hold a partner: a point within distance r of the query lies beyond the plane
between two centroids by r at most, so a list whose plane is further away holds none. Inside a list
the distance to a code, summed from a table per query, is off by no more than the coding error of
that vector, which is stored with it; whoever is further than r and that error is passed over, and
the rest is compared exactly in double precision. Lists of unit-length float vectors only lose pairs
to rounding, against which all bounds have a margin.

The centroids are bounded, the vectors are not: where lists would grow long, each is divided into
cells by the codes of its first subspaces, as many as it takes. The planes between two codes tell in
each of them how far a cell is away, and what these distances come to together decides whether it is
looked into. So tasks stay as small as before, and the index as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loantape.llm.components import components
from loantape.llm.store import prepare, stored

# Vectors the index is fitted on, in expectation, drawn by a hash of the id.
SAMPLE = 20_000
LIST_ROWS = 256
MAX_LISTS = 1024
SUBSPACES = 8
CODES = 32
ROUNDS = 8
MARGIN = 1e-6
# Rows of a list that one task compares queries with; larger lists are cut into chunks.
CHUNK_ROWS = 2048
QUERY_ROWS = 512
# Rows that ask in one task; more are cut into parts, each of which meets every chunk.
ASK_ROWS = 8192
# Pairs whose cosine is taken at a time.
PAIR_ROWS = 1 << 15


def unit(vector: list | None) -> np.ndarray | None:
    """The vector at length one; nothing if it cannot be compared."""
    if vector is None or any(x is None for x in vector):
        return None
    row = np.asarray(vector, np.float64)
    if not np.isfinite(row).all() or not (top := np.abs(row).max(initial=0.0)) > 0:
        return None
    row = row / top
    return row / np.sqrt(row @ row)


def kmeans(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    centres = points[random.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = squared(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=len(centres))
        filled = sizes > 0
        centres[filled] = sums[filled] / sizes[filled, None]
    return centres


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``."""
    found = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.maximum(found, 0)


class Index:
    """Centroids and code books; bounded by the sample, whatever the number of vectors."""

    def __init__(self, sample: np.ndarray, n_lists: int, depth: int = 0, seed: int = 7) -> None:
        self.centres = kmeans(sample, n_lists, seed)
        left = sample - self.centres[squared(sample, self.centres).argmin(1)]
        cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.parts = [slice(c[0], c[-1] + 1) for c in cuts]
        self.books = [kmeans(left[:, p], CODES, seed + 1 + i) for i, p in enumerate(self.parts)]
        self.between = np.sqrt(squared(self.centres, self.centres))
        # Lists are divided by the codes of so many subspaces.
        self.depth = min(depth, len(self.parts))
        self.cells = CODES**self.depth
        self.apart = [np.maximum(np.sqrt(squared(b, b)), 1e-12) for b in self.books[: self.depth]]

    def assign(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = squared(points, self.centres)
        return far.argmin(1), far

    def encode(self, points: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far the coded points are from the points."""
        left = points - self.centres[lists]
        codes = np.empty((len(points), len(self.parts)), np.uint8)
        lost = np.zeros(len(points))
        for i, (part, book) in enumerate(zip(self.parts, self.books)):
            far = squared(left[:, part], book)
            codes[:, i] = far.argmin(1)
            lost += far[np.arange(len(points)), codes[:, i]]
        return codes, np.sqrt(lost)

    def cell(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The numbers of the cells, which are those of the lists where lists are not divided."""
        number = lists.astype(np.int64)
        for i in range(self.depth):
            number = number * CODES + codes[:, i]
        return number

    def probes(self, points: np.ndarray, own: np.ndarray, far: np.ndarray, codes: np.ndarray, reach: float) -> list[np.ndarray]:
        """Per point the cells that can hold anything within ``reach``, its own first; what the points
        were assigned and their codes are given."""
        mine = self.cell(own, codes)
        out = []
        for i, first in enumerate(own):
            apart = np.maximum(self.between[first], 1e-12)
            beyond = (far[i] - far[i, first]) / (2 * apart)
            near = self.within(points[i], np.nonzero(beyond <= reach + MARGIN)[0], reach)
            out.append(np.r_[mine[i], near[near != mine[i]]])
        return out

    def within(self, point: np.ndarray, lists: np.ndarray, reach: float) -> np.ndarray:
        """The cells of these lists that can hold anything within ``reach`` of the point."""
        number, at, cost = lists.astype(np.int64), np.arange(len(lists)), np.zeros(len(lists))
        left = point - self.centres[lists]
        for part, book, apart in zip(self.parts[: self.depth], self.books, self.apart):
            far = squared(left[:, part], book)
            nearest = far.argmin(1)
            beyond = (far - far.min(1)[:, None]) / (2 * apart[nearest])
            total = cost[:, None] + (beyond * beyond)[at]
            row, code = np.nonzero(total <= (reach + MARGIN) ** 2)
            number, at, cost = number[row] * CODES + code, at[row], total[row, code]
        return number

    def table(self, queries: np.ndarray, number: int) -> np.ndarray:
        """Squared distances of each query's residual to every code: queries, subspaces, codes."""
        left = queries - self.centres[number]
        out = np.full((len(queries), len(self.parts), CODES), np.inf)
        for i, (part, book) in enumerate(zip(self.parts, self.books)):
            out[:, i, : len(book)] = squared(left[:, part], book)
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def leading(units: list[bytes], dims: int) -> np.ndarray:
    """The first ``dims`` components of vectors of any length, zero where there are none."""
    out = np.zeros((len(units), dims))
    for i, x in enumerate(units):
        row = np.frombuffer(x, np.float64, min(dims, len(x) // 8))
        out[i, : len(row)] = row
    return out


def fit(vectors: DataFrame, dims: int, sample: int = SAMPLE, max_lists: int = MAX_LISTS) -> Index | None:
    """An index of the first ``dims`` components of the classes in ``vectors`` (``class_id``, ``unit``),
    fitted on a bounded sample. Beyond ``max_lists`` lists of ``LIST_ROWS``, lists have cells."""
    n, most = vectors.groupBy("label").count().agg(F.sum("count"), F.max("count")).first()
    if not n:
        return None
    share = min(1.0, sample / n)
    drawn = F.pmod(F.xxhash64("label", "unit"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    rows = vectors.where(drawn).select("label", F.substring("unit", 1, 8 * dims).alias("unit")).toPandas().sort_values(["label", "unit"])
    if not len(rows):
        return None
    points = leading(rows["unit"].tolist(), dims)
    # Labels share the lists, so their number goes by the largest label.
    depth = 0
    while max_lists * CODES**depth * LIST_ROWS < most:
        depth += 1
    return Index(points, int(min(max_lists, max(1, most // LIST_ROWS), len(points))), depth)


class Forest:
    """Links that connect all that the pairs connect, of which there are no more than rows asked and
    rows held: pairs are folded in as they come, and none is kept that adds nothing."""

    def __init__(self, held: np.ndarray) -> None:
        self.held = held
        self.root = np.arange(len(held))
        self.links: list[tuple[int, int]] = []

    def add(self, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of ``ids[a]`` and the held row ``b``, in order of ``a``."""
        cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else []
        for start, met in zip(cuts, np.split(b, cuts[1:]) if len(a) else []):
            roots, first = np.unique(self.root[met], return_index=True)
            name = int(ids[a[start]])
            self.links += [(name, int(x)) for x in self.held[met[first]]]
            if len(roots) > 1:
                self.root[np.isin(self.root, roots)] = roots[0]


def _sides(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that ask and those held, by label, list, chunk of those held, part of those asking."""
    # A pair in two lists would be met from both sides; the side of the smaller list looks.
    ranged = members.select("class_id", "label", "unit", "copies", F.col("list").alias("own"), F.explode("probes").alias("list")).where("list >= own")
    held = members.groupBy("label", "list").agg(F.count(F.lit(1)).alias("n"))
    asks = ranged.groupBy(F.col("label").alias("al"), F.col("list").alias("ano")).agg(F.count(F.lit(1)).alias("asking"))
    sizes = held.join(asks, (F.col("label") == F.col("al")) & (F.col("list") == F.col("ano"))).select(
        F.col("label").alias("l"), F.col("list").alias("no"),
        F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("chunks"), F.ceil(F.col("asking") / ASK_ROWS).cast("int").alias("parts"),
    )
    sizes = stored(sizes, "lists")
    of = (F.col("label") == F.col("l")) & (F.col("list") == F.col("no"))
    asked = ranged.join(sizes, of).select(
        "label", "list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.hash("class_id", F.lit(1)), F.col("parts")).alias("part"),
        "class_id", "unit", "copies", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("lost"),
        F.col("own"),
    )
    # Names of their own, as both sides come from one table.
    own = {c: F.col(c).alias(c) for c in ("label", "list", "class_id", "unit", "copies", "codes", "lost")}
    held = members.join(sizes, of).select(
        own["label"], own["list"], F.pmod(F.hash("class_id"), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        own["class_id"], own["unit"], own["copies"], own["codes"], own["lost"], F.lit(-1).cast("bigint").alias("own"),
    )
    return asked, held


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    max_lists: int = MAX_LISTS,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` per row of ``vectors``.

    Two rows link if their labels are equal and not null and their cosine, in double precision, is
    at least ``cosine``. A vector that is null, empty or zero, or holds null or non-finite components
    links with nothing, and vectors of different numbers of components do not link. Vectors that are
    equal once at length one are one class, which is searched once; its rows count one another.
    Rows that repeat an id count as rows of their own; rows without an id link like any other, and
    have a null component if nothing they reach has one. An empty table gives an empty table.
    ``max_lists`` bounds the index; what it would take beyond that, cells of its lists do.
    """
    spark = prepare(vectors.sparkSession)
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    lengths = vectors.groupBy(F.size(vector_col).alias("d")).count().where("d > 0")
    commonest = lengths.orderBy(F.col("count").desc(), "d").first()
    # The index sees that many leading components of vectors of any length: two of them are no
    # further apart there than they are, so whatever it passes over is too far.
    dims = commonest["d"] if commonest else 0

    def ready(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, labels = [], []
            for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at = None if label is None else unit(vector)
                made.append(None if at is None else at.tobytes())
                # Each length is among itself, like each label.
                labels.append(None if at is None else f"{len(at)}:{label}")
            yield pa.record_batch(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(made, pa.binary())], ["vec_id", "label", "unit"]
            )

    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
    ).mapInArrow(ready, "vec_id bigint, label string, unit binary")
    rows = stored(rows, "units")
    # Copies meet here; a class carries its smallest id and its number of rows.
    classes = rows.where("unit is not null").groupBy("label", "unit").agg(
        F.min("vec_id").alias("lowest"), F.count(F.lit(1)).alias("copies")
    )
    classes = stored(
        # Numbers, which the stored table keeps; a hash could give two classes one.
        classes.select(F.monotonically_increasing_id().alias("class_id"), "label", "unit", "lowest", "copies"), "classes"
    )
    index = fit(classes, dims, max_lists=max_lists)
    if index is None:
        return rows.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    shared = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            points = leading(batch.column(2).to_pylist(), dims)
            own, far = at.assign(points)
            codes, lost = at.encode(points, own)
            probes = at.probes(points, own, far, codes, reach)
            lists = np.array([p[0] for p in probes], np.int64)
            arrays = [
                *batch.columns, pa.array(lists), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(lost),
                pa.array(probes, pa.list_(pa.int64())),
            ]
            yield pa.record_batch(arrays, ["class_id", "label", "unit", "copies", "list", "codes", "lost", "probes"])

    members = classes.select("class_id", "label", "unit", "copies").mapInArrow(
        place,
        "class_id bigint, label string, unit binary, copies bigint, list bigint, codes binary, lost double, probes array<bigint>",
    )
    asked, held = _sides(stored(members, "members"))

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        number = key[1].as_py()
        at = shared.value
        out: dict[str, list] = {"class_id": [], "links": [], "other": []}
        if left.num_rows and right.num_rows:
            ids = np.asarray(right["class_id"])
            points = _matrix(right["unit"].combine_chunks())
            codes = np.frombuffer(b"".join(right["codes"].to_pylist()), np.uint8).reshape(len(ids), -1)
            lost = np.asarray(right["lost"])
            copies = np.asarray(right["copies"])
            counts: dict[int, int] = {}
            forest = Forest(ids)
            for low in range(0, left.num_rows, QUERY_ROWS):
                part = left.slice(low, QUERY_ROWS)
                q_ids = np.asarray(part["class_id"])
                q_points = _matrix(part["unit"].combine_chunks())
                q_copies = np.asarray(part["copies"])
                own = np.asarray(part["own"])
                table = at.table(leading(part["unit"].to_pylist(), dims), number // at.cells)
                far = np.zeros((len(q_ids), len(ids)))
                for i in range(codes.shape[1]):
                    far += table[:, i, codes[:, i]]
                near = np.sqrt(far) <= reach + lost[None, :] + MARGIN
                # Within one list both sides look; the smaller id's look counts.
                near &= (own[:, None] != number) | (q_ids[:, None] < ids[None, :])
                a, b = np.nonzero(near)
                close = np.zeros(len(a), bool)
                for at_pair in range(0, len(a), PAIR_ROWS):
                    x, y = a[at_pair : at_pair + PAIR_ROWS], b[at_pair : at_pair + PAIR_ROWS]
                    close[at_pair : at_pair + PAIR_ROWS] = np.einsum("ij,ij->i", q_points[x], points[y]) >= cosine
                a, b = a[close], b[close]
                if len(a):
                    for who, n in ((q_ids[a], copies[b]), (ids[b], q_copies[a])):
                        names, where = np.unique(who, return_inverse=True)
                        for name, n_ in zip(names.tolist(), np.bincount(where, n).astype(np.int64).tolist()):
                            counts[name] = counts.get(name, 0) + n_
                    forest.add(q_ids, a, b)
            out["class_id"] = [*counts, *(x for x, _ in forest.links)]
            out["links"] = [*counts.values(), *([0] * len(forest.links))]
            out["other"] = [*([None] * len(counts)), *(y for _, y in forest.links)]
        return pa.table([pa.array(v, pa.int64()) for v in out.values()], list(out))

    by = ["label", "list", "chunk", "part"]
    met = stored(
        asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(compare, "class_id bigint, links bigint, other bigint"),
        "links",
    )
    counted = met.groupBy(F.col("class_id").alias("of")).agg(F.sum("links").alias("others"))
    named = components(met.where("other is not null").select("class_id", "other"))
    placed = stored(
        classes.join(named, F.col("class_id") == F.col("node"), "left")
        .join(counted, F.col("class_id") == F.col("of"), "left")
        .select("label", "unit", "lowest", "copies", F.coalesce("root", "class_id").alias("root"), F.coalesce("others", F.lit(0)).alias("others")),
        "placed",
    )
    lowest = placed.groupBy(F.col("root").alias("top")).agg(F.min("lowest").alias("component_id"))
    answer = stored(
        placed.join(lowest, F.col("root") == F.col("top")).select(
            F.col("label").alias("l"), F.col("unit").alias("u"), "component_id", (F.col("copies") - 1 + F.col("others")).alias("n_links")
        ),
        "answers",
    )
    joined = rows.join(answer, (F.col("label") == F.col("l")) & (F.col("unit") == F.col("u")), "left")
    component = F.when(F.col("u").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
