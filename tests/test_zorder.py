import random

import pytest
from pyspark.sql import functions as F

from lakeshard.operators import zorder
from sf_dir import SF


def _plain(numbers, bits):
    return sum((n >> b & 1) << (b * len(numbers) + i) for b in range(bits) for i, n in enumerate(numbers))


def test_interleaving_equals_plain_bits(spark):
    rng = random.Random(1)
    rows = [tuple(rng.randrange(256) for _ in range(3)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    got = df.select("a", "b", "c", zorder.interleaved([F.col(c) for c in "abc"]).alias("z")).collect()
    assert all(r["z"] == _plain((r["a"], r["b"], r["c"]), 8) for r in got)
    with pytest.raises(ValueError):
        zorder.interleaved([F.col("a")] * 8)


def test_every_key_prunes_files(spark, tmp_path):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    keys = ["l_partkey", "l_shipdate"]
    path = zorder.write_clustered(li, str(tmp_path / "z"), 16, keys)
    files = (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f"))
             .agg(*[f(k).alias(f"{k}_{n}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))]).collect())
    assert len(files) == 16
    for k in keys:
        values = sorted(r[0] for r in li.select(k).collect())
        opened = [sum(f[f"{k}_lo"] <= v <= f[f"{k}_hi"] for f in files) for v in values[50::500]]
        assert sum(opened) / len(opened) <= 9  # of 16; unsorted files would all be opened
    a, b = (sorted(map(tuple, d.collect()), key=str) for d in (li, spark.read.parquet(path)))
    assert a == b


def test_nulls_strings_and_hot_points(spark, tmp_path):
    rows = [(None if i % 7 == 0 else i, ("hot" if i % 3 == 0 else f"k{i % 50}") if i % 5 else None) for i in range(900)] + [(5, "hot")] * 450
    df = spark.createDataFrame(rows, "a long, s string").repartition(4)
    path = zorder.write_clustered(df, str(tmp_path / "z"), 8, ["s", "a"])
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    largest = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 450  # the hot point lies in several files
    assert zorder.write_clustered(df.limit(0), str(tmp_path / "none"), 3, ["s", "a"])
