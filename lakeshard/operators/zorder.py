"""Clustering a table on several keys at once along a Z-order curve (survey A4.3).

Each key becomes a rank among its own quantiles, so skewed and wide keys use
all bits; the ranks' bits are interleaved to one number in built-in
expressions, and the rows are written in ranges of it.  Files then hold small
boxes of the key space: a scan with a condition on any of the keys skips most
of them by their minimum and maximum, where a sort on (a, b) helps ``a`` only.

NULL keys rank lowest.  Strings rank by their first seven bytes.  Rows of one
box are dealt on by a hash of the row, so a third of all rows at one point
still fill several files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshard.functions.hashing import salt_hash
from lakeshard.operators.intervals import bin_of

#: bits of a key's rank
BITS = 8


def _number(df: DataFrame, c: str) -> Column:
    kind = dict(df.dtypes)[c]
    if kind == "string":
        return F.conv(F.hex(F.substring(F.rpad(F.col(c).cast("binary"), 7, b"\0"), 1, 7)), 16, 10).cast("double")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def ranks(df: DataFrame, keys: list[str], bits: int = BITS) -> list[Column]:
    """The rank of each key among ``2^bits`` quantiles of its column, from one pre-aggregated pass."""
    marks = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(_number(df, k), marks, 100 << bits).alias(f"q{i}") for i, k in enumerate(keys)]).first()
    return [F.coalesce(bin_of(_number(df, k), sorted(set(found[i] or []))), F.lit(0)).cast("long") for i, k in enumerate(keys)]


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """One number from the bits of several, the highest bits first."""
    if len(numbers) * bits > 62:
        raise ValueError("too many bits")
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, n in enumerate(numbers):
            out = out + F.shiftleft(F.shiftright(n, b).bitwiseAND(F.lit(1).cast("long")), b * len(numbers) + i)
    return out


def write_clustered(df: DataFrame, path: str, n: int, keys: list[str], fmt: str = "parquet", mode: str = "errorifexists", bits: int = BITS) -> str:
    """``n`` files along the Z-order curve of ``keys``."""
    z = df.select("*", *[r.alias(f"_r{i}") for i, r in enumerate(ranks(df, keys, bits))], salt_hash(keys).alias("_h"))
    z = z.select(*df.columns, interleaved([F.col(f"_r{i}") for i in range(len(keys))], bits).alias("_z"), "_h")
    (z.repartitionByRange(n, "_z", "_h").sortWithinPartitions("_z").select(*df.columns)
     .write.format(fmt).mode(mode).option("maxRecordsPerFile", 0).save(path))
    return path
