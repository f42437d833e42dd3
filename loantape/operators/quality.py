"""Which fields failed, for how many months, and which failed in all of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loantape.functions.scalars import split_tokens
from loantape.operators.skew import group_sizes
from loantape.operators.validate import QA

PROFILE_TYPE = "array<struct<field:string,cntFail:int>>"

# Rows of a group that may lie in one task, and rows that a task should take.
GROUP_ROWS = 1_000_000
TASK_ROWS = 250_000


def near_keys(df: DataFrame, keys: Iterable[str], limit: int = GROUP_ROWS) -> DataFrame:
    """The same rows, dealt out by ``keys`` if no group has more than ``limit`` of them; else as they are.

    Taken apart by ``explode_qa`` behind this one shuffle, rows are counted and regrouped where they lie,
    where names would be shuffled once for each. Longer groups are better combined before a shuffle. Runs one count
    of the key columns, which decides for all of the plan.
    """
    keys = list(keys)
    n_rows, longest = group_sizes(df, keys).agg(F.sum("n_rows"), F.max("n_rows")).first()
    if not n_rows or longest > limit:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-n_rows // TASK_ROWS)), *keys)


def explode_qa(df: DataFrame, keys: Iterable[str], qa: str = QA) -> DataFrame:
    """One row per row and token of the ``:a:b:`` text, empty tokens among them."""
    keys = list(keys)
    # Keys in the order they come out in, else each of the many rows is copied once more to change it.
    return df.select(*keys, qa).select(*keys, tokens_of(qa))


def tokens_of(qa: str) -> Column:
    # A split is never empty, so this equals explode; but for explode the optimizer adds a filter on
    # the array's size and pushes it below the validation, which is then computed twice.
    return F.explode_outer(split_tokens(F.col(qa))).alias("field")


def filter_nonempty(df: DataFrame, column: str = "field") -> DataFrame:
    return df.where(F.col(column) != "")


def count_by_key(df: DataFrame, keys: Iterable[str], name: str = "cntFail") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias(name))


def group_to_arrays(
    df: DataFrame, keys: Iterable[str], columns: Iterable[str], name: str = QA
) -> DataFrame:
    """Columns regrouped per key as one array of structs, sorted by the first column.

    For tables that hold a bounded number of rows per key, such as one per field name.
    """
    pairs = F.sort_array(F.collect_list(F.struct(*columns)))
    return df.groupBy(*keys).agg(pairs.alias(name))


def qa_profile(df: DataFrame, keys: Iterable[str], qa: str = QA, name: str = QA) -> DataFrame:
    """Per group and field the number of failing rows, as ``array<struct<field,cntFail>>``.

    Counts combine before the shuffle, whatever the size of a group; groups without failures are
    absent.
    """
    keys = list(keys)
    # Rows with the same failures meet first, so that few of them are taken apart. No filter on the
    # text: pushed below the validation, it would compute every field's check a second time.
    alike = df.groupBy(*keys, qa).agg(F.count(F.lit(1)).alias("n"))
    tokens = alike.select(*keys, "n", tokens_of(qa))
    counts = (
        filter_nonempty(tokens)
        .groupBy(*keys, "field")
        .agg(F.sum("n").cast("int").alias("cntFail"))
    )
    return group_to_arrays(counts, keys, ["field", "cntFail"], name)


def failure_counts(qa: Column, fields: Iterable[str]) -> dict[str, Column]:
    """One aggregate per field: rows whose text names it. For use inside a larger aggregation."""
    return {f: F.count_if(F.contains(qa, F.lit(f":{f}:"))).cast("int") for f in fields}


def profile_of_counts(counts: dict[str, Column]) -> Column:
    """Counts per field as the profile array, fields without failures left out, sorted by name."""
    pairs = [
        F.when(n > 0, F.struct(F.lit(f).alias("field"), n.alias("cntFail")))
        for f, n in sorted(counts.items())
    ]
    return F.array_compact(F.array(*pairs)).cast(PROFILE_TYPE)


def tokens_of_texts(texts: Column) -> Column:
    """All names in an array of ``:a:b:`` texts. Store it as a column before taking the profile."""
    return F.array_remove(split_tokens(F.array_join(texts, "")), "")


def profile_of_tokens(tokens: Column) -> Column:
    """The profile array of an array of names, sorted by name.

    ``tokens`` should be a plain column: inside the lambda an expression is computed once per name.
    """
    return F.transform(
        F.sort_array(F.array_distinct(tokens)),
        lambda f: F.struct(
            f.alias("field"), (F.size(tokens) - F.size(F.array_remove(tokens, f))).alias("cntFail")
        ),
    )


def packed(df: DataFrame, name: str = QA) -> DataFrame:
    """The profile column as one ``a:b`` text of names and an array of counts, for a shuffle: a third of what
    loans weigh there is structs of names otherwise. ``unpacked`` restores it."""
    names = F.array_join(F.col(f"`{name}`.field"), ":").alias(f"__{name}_names")
    counts = F.col(f"`{name}`.cntFail").alias(f"__{name}_counts")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], names, counts)


def unpacked(df: DataFrame, schema: T.StructType, name: str = QA) -> DataFrame:
    """Undo ``packed``; ``schema`` is the table's from before."""
    names, counts = F.split(F.col(f"__{name}_names"), ":"), F.col(f"__{name}_counts")
    pairs = F.zip_with(names, counts, lambda f, n: F.struct(f.alias("field"), n.alias("cntFail")))
    # The text of no names splits into one empty name.
    profile = F.when(F.size(counts) == 0, F.array()).otherwise(pairs).cast(PROFILE_TYPE)
    profile = F.when(counts.isNotNull(), profile)
    kind = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema[name].dataType.elementType]))
    fields = [T.StructField(name, kind, True, f.metadata) if f.name == name else f for f in schema.fields]
    return df.withColumn(name, profile).select(*[F.col(f"`{f.name}`") for f in fields]).to(T.StructType(fields))


# Columns that hold a row's failures as bits, and bits of each that are used.
MASKS = ("__failed0", "__failed1")
MASK_BITS = 63


def failure_masks(failed: Mapping[str, Column], order: Iterable[str]) -> dict[str, Column]:
    """``MASKS`` by name: bit ``i`` of the first is field ``i`` of ``order``, of the second field
    ``MASK_BITS + i``. ``failed`` has a condition per field; the others never fail."""
    order = list(order)
    if len(order) > len(MASKS) * MASK_BITS:
        raise ValueError(f"{len(order)} fields are more than {len(MASKS)} masks hold")
    out = {}
    for k, name in enumerate(MASKS):
        mask = F.lit(0).cast("bigint")
        for i, field in enumerate(order[k * MASK_BITS : (k + 1) * MASK_BITS]):
            if field in failed:
                mask = mask + F.when(failed[field], F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        out[name] = mask
    return out


def lanes(n_fields: int, bits: int) -> list[list[int]]:
    """Fields counted together in one number, each in a lane of so many bits."""
    per = 63 // bits
    return [list(range(low, min(low + per, n_fields))) for low in range(0, n_fields, per)]


def lane_sums(n_fields: int, bits: int) -> list[Column]:
    """Aggregates over ``MASKS`` that count the rows in which each field failed, some fields to a
    number: plain sums, which combine before the shuffle to a few numbers per group whatever its
    length. A group has fewer than ``2 ** bits`` rows."""
    out = []
    for group in lanes(n_fields, bits):
        added = F.lit(0).cast("bigint")
        for lane, field in enumerate(group):
            mask, bit = F.col(MASKS[field // MASK_BITS]), field % MASK_BITS
            one = F.shiftright(mask, bit).bitwiseAND(F.lit(1).cast("bigint"))
            added = added + F.shiftleft(one, lane * bits)
        out.append(F.sum(added))
    return out


def lane_sums_of_texts(qa: Column, order: Iterable[str], bits: int) -> list[Column]:
    """``lane_sums`` of ``:a:b:`` texts, for a table without ``MASKS``."""
    order, out = list(order), []
    for group in lanes(len(order), bits):
        added = F.lit(0).cast("bigint")
        for lane, field in enumerate(group):
            one = F.lit(1 << lane * bits).cast("bigint")
            added = added + F.when(F.contains(qa, F.lit(f":{order[field]}:")), one).otherwise(F.lit(0).cast("bigint"))
        out.append(F.sum(added))
    return out


def unlisted(qa: Column, order: Iterable[str]) -> Column:
    """The names of a ``:a:b:`` text that ``order`` lacks, as such a text; NULL if there are none."""
    known = list(order)
    others = F.array_join(F.filter(split_tokens(qa), lambda t: (t != "") & ~t.isin(known)), ":")
    return F.when(others != "", F.concat(F.lit(":"), others, F.lit(":")))


def counts_of_lanes(sums: list[Column], order: Iterable[str], bits: int) -> dict[str, Column]:
    """The counts per field that ``lane_sums`` packed."""
    order, out = list(order), {}
    for total, group in zip(sums, lanes(len(order), bits)):
        for lane, field in enumerate(group):
            out[order[field]] = F.shiftright(total, lane * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")).cast("int")
    return out


def qa_all_fail(profile: Column, n_rows: Column) -> Column:
    """Names of the fields that failed in every row of the group."""
    return F.transform(
        F.filter(profile, lambda p: p["cntFail"] == n_rows), lambda p: p["field"]
    )


def join_qa(df: DataFrame, profile: DataFrame, keys: Iterable[str], name: str = QA) -> DataFrame:
    """Profiles attached to their groups, an empty array where there is none; NULL keys match."""
    keys = list(keys)
    none = F.array().cast(PROFILE_TYPE)
    known = profile.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(name).alias("__profile"))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(known, match, "left").select(
        *df.columns, F.coalesce(F.col("__profile"), none).alias(name)
    )
