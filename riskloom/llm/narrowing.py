"""Which rows can have a key of a smaller table: a hash filter of fixed size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, 2 MiB whatever the table. Of tables beyond some ten million keys it lets
#: everything pass, which costs the work it would have saved and changes no result.
FILTER_BITS = 1 << 24


def may_have(keys: DataFrame, column: Column) -> Column:
    """Whether the value of ``column`` can be among ``keys`` (one column of longs): true for all
    that are, false for most that are not; null is not. The filter is combined in the cluster, and has
    ``FILTER_BITS`` / 64 words at most when it gets to the driver."""
    shared = _filter(keys, F.pmod(F.xxhash64(F.col(f"`{keys.columns[0]}`")), F.lit(FILTER_BITS)))

    @F.arrow_udf("boolean")
    def test(places: pa.Array) -> pa.Array:
        at = places.fill_null(0).to_numpy(zero_copy_only=False)
        return pa.array(_hit(shared.value, at) & places.is_valid().to_numpy(zero_copy_only=False))

    return test(F.when(column.isNotNull(), F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))))


def may_have_hashes(keys: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """The same for arrays of 64-bit hashes, to be called inside a task, which then needs no second Python worker."""
    shared = _filter(keys, F.pmod(F.col(f"`{keys.columns[0]}`"), F.lit(FILTER_BITS)))
    return lambda hashes: _hit(shared.value, (hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64))


def _hit(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)) > 0


def _filter(keys: DataFrame, place: Column) -> Broadcast:
    words = (keys.where(F.col(f"`{keys.columns[0]}`").isNotNull()).select(place.alias("place"))
             .groupBy(F.shiftright("place", 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int"))).alias("bits"))).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.view(np.uint64))
