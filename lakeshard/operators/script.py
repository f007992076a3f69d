"""Script-style operators (survey J5: ``SELECT TRANSFORM``, ``MAP``, ``REDUCE``).

Instead of piping rows through an external process, the user function runs
in Spark's Python workers on Arrow batches:

* ``map_rows``      - ``MAP``/``TRANSFORM``: ``mapInPandas`` per batch.
* ``reduce_groups`` - ``REDUCE ... CLUSTER BY key``: rows are distributed by
  key and sorted inside each partition, then a streaming reducer walks the
  sorted batches carrying one group's state at a time, so memory stays
  bounded by the state, not by the group size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.session import ship_package


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df`` (no shuffle)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    ship_package(df.sparkSession)
    return df.mapInPandas(run, schema)


def reduce_groups(df: DataFrame, keys: list[str], init: Callable[[], object],
                  step: Callable[[object, pd.DataFrame], object],
                  finish: Callable[[tuple, object], dict], schema,
                  combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> DataFrame:
    """Streaming per-key reduction over key-clustered, sorted partitions.

    ``step(state, chunk)`` folds a chunk of one key's rows into the state;
    ``finish(key, state)`` returns the output row as a dict.

    ``combine`` is an optional map-side combiner: it maps an Arrow batch to a
    smaller batch with the same columns (partial results per key), applied
    before the shuffle.  With it, a key holding a third of all rows reaches
    its reducer as at most one row per input batch.
    """
    ship_package(df.sparkSession)
    if combine is not None:
        df = _combined(df, combine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur_key, state, out = None, None, []

        def rows():
            return pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in arrow} for r in out], schema=arrow)

        for b in batches:
            if not b.num_rows:
                continue
            # keys as Python values: NULL is one key, 64-bit integers stay exact
            columns = [_keys(b.column(b.schema.get_field_index(k))) for k in keys]
            tuples = list(zip(*columns, strict=True))
            starts = [0, *(i for i in range(1, len(tuples)) if tuples[i] != tuples[i - 1]), len(tuples)]
            for a, e in zip(starts[:-1], starts[1:], strict=True):
                if cur_key is None or tuples[a] != cur_key:
                    if cur_key is not None:
                        out.append(_plain(finish(cur_key, state)))
                    cur_key, state = tuples[a], init()
                state = step(state, _frame(b.slice(a, e - a)))
            if len(out) >= 4096:
                yield rows()
                out = []
        if cur_key is not None:
            out.append(_plain(finish(cur_key, state)))
        if out:
            yield rows()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _combined(df: DataFrame, combine: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(df.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pandas(combine(_frame(b))[df_names], schema=arrow, preserve_index=False)

    df_names = df.columns
    return df.mapInArrow(run, df.schema)


def _keys(column: pa.Array) -> list:
    """Python values in which equal keys are equal: NaN is one key too."""
    return ["NaN" if isinstance(v, float) and v != v else v for v in column.to_pylist()]


def _frame(batch: pa.RecordBatch) -> pd.DataFrame:
    """pandas with nullable integers and booleans, so that a NULL beside them changes no value."""
    nullable = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(),
                pa.int64(): pd.Int64Dtype(), pa.bool_(): pd.BooleanDtype()}
    return batch.to_pandas(types_mapper=lambda t: nullable.get(t) if any(
        f.type == t and batch.column(i).null_count for i, f in enumerate(batch.schema)) else None)


def _plain(row: dict) -> dict:
    """Python scalars for what numpy and pandas return."""
    def one(v):
        if v is pd.NA or v is pd.NaT:
            return None
        return v.item() if hasattr(v, "item") and getattr(v, "ndim", 0) == 0 else v

    return {k: one(v) for k, v in row.items()}


def two_level_agg(df: DataFrame, keys: list[str], partial: list, final: list,
                  max_group_rows: int = 1_000_000) -> DataFrame:
    """Aggregate in two steps so no group handed to one task exceeds
    ``max_group_rows`` (on average).

    ``partial`` aggregates (built-in or grouped-aggregate pandas UDFs, which
    hold a whole group in memory) run per ``(keys, _salt)``; ``final`` merges
    the partial columns per key with built-ins (``sum`` of sums, ``max`` of
    maxima, ...).  The aggregate must be decomposable this way.

    Keys with more than ``max_group_rows`` rows, NULL included, get
    ``ceil(rows / max_group_rows)`` salt values, from a per-key count (partial
    aggregation).  There are at most ``rows / max_group_rows`` such keys; Spark
    broadcasts their table if it is small.  The row's hash is taken on the
    input, before that join, so a retried task repeats it.
    """
    from lakeshard.functions.hashing import salt_hash

    big = (df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
           .where(F.col("_rows") > max_group_rows)
           .withColumn("_salts", F.ceil(F.col("_rows") / max_group_rows).cast("int")).drop("_rows"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    salted = (df.withColumn("_h", salt_hash(df.columns)).join(big, same, "left")
              .withColumn("_salt", F.coalesce(F.pmod(F.col("_h"), F.col("_salts")), F.lit(0)).cast("int"))
              .select(*df.columns, "_salt"))
    return (salted.groupBy(*keys, "_salt").agg(*partial)
            .groupBy(*keys).agg(*final))
