"""Comparing the rows of a key with each other in blocks of bounded size, without putting out their pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_pairs(rows: DataFrame, key: str, row_id: str, size: int, counted: DataFrame | None = None) -> DataFrame:
    """Add g (block), own and chunk: keys with more than ``size`` rows are cut into chunks that meet in pairs.

    ``counted`` (key, _n) names the keys to keep, with their rows, where that is known already.

    A row of a key with n chunks stands n times, once with each chunk, so a block
    has about ``2 * size`` rows at most and every two rows of a key meet in one.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(f"_n > {size}") if counted is None else counted
    many = sizes.select(key, F.ceil(F.col("_n") / size).cast("int").alias("_cs"))
    return rows.join(many, key, "left" if counted is None else "inner").withColumn("_cs", F.coalesce("_cs", F.lit(1))) \
        .withColumn("chunk", F.pmod(F.xxhash64(row_id, F.lit(17)), F.col("_cs")).cast("int")) \
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_cs") - 1))) \
        .withColumn("g", F.xxhash64(key, F.least("chunk", "_with"), F.greatest("chunk", "_with"))) \
        .withColumn("own", F.col("chunk") == F.col("_with")).drop("_cs", "_with")


def pairs_in(group: np.ndarray, own: np.ndarray, chunk: np.ndarray):
    """Index pairs (i, j) with the same group, row distance by row distance; ``group`` is sorted.

    own: the group holds one chunk only; else only pairs of different chunks count.
    """
    at = np.arange(len(group))
    step = 1
    while True:
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            return
        use = at[own[at] | (chunk[at] != chunk[at + step])]
        if len(use):
            yield use, use + step
        step += 1


def whole_groups(batches):
    """Batches cut at changes of column 0 (sorted), so that a group is never split."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        g = t.column(0).to_numpy()
        cut = int(np.searchsorted(g, g[-1]))
        if cut:
            yield t.slice(0, cut).combine_chunks()
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()
