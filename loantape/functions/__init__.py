"""Column expressions; all built in, none needs Python at run time."""

from loantape.functions.arrays import (
    array_avg,
    array_filter,
    array_filter2,
    array_first,
    array_length,
    array_max,
    array_sum,
    element_at,
    index_of,
)
from loantape.functions.bits import bit_position_sum, bit_positions, bucket, reinterpret_uint64
from loantape.functions.scalars import (
    age_fp,
    bare_path,
    cast_f32,
    cast_i32,
    conditional,
    decoded_uri,
    dq_number,
    harp_flag,
    month_end,
    months_between_dates,
    parse,
    prop_val,
    split_tokens,
    vintage,
)

__all__ = [
    "age_fp",
    "array_avg",
    "array_filter",
    "array_filter2",
    "array_first",
    "array_length",
    "array_max",
    "array_sum",
    "bare_path",
    "bit_position_sum",
    "bit_positions",
    "bucket",
    "cast_f32",
    "cast_i32",
    "conditional",
    "decoded_uri",
    "dq_number",
    "element_at",
    "harp_flag",
    "index_of",
    "month_end",
    "months_between_dates",
    "parse",
    "prop_val",
    "reinterpret_uint64",
    "split_tokens",
    "vintage",
]
