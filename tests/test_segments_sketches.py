import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshard.operators import segments, sketches
from lakeshard.operators.index import index_lookup, term_frequency
from sf_dir import SF


def _docs(spark, ids, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, "the " + " ".join(rng.choice(words[: 3 + i % 50]) for _ in range(rng.randint(0, 30))) + (" rare" if i in (777, 1500) else "")) for i in ids]
    return spark.createDataFrame(rows, "doc long, text string").repartition(3)


def test_segments_equal_the_index_and_merge_without_documents(spark, tmp_path):
    path = str(tmp_path / "idx")
    parts = [_docs(spark, range(0, 700)), _docs(spark, range(700, 900), 2), _docs(spark, range(900, 2000), 3)]
    for p in parts:
        segments.append_segment(p, path, block_size=16)
    tf = term_frequency(parts[0].unionAll(parts[1]).unionAll(parts[2])).cache()
    want = Counter(map(tuple, tf.select("word", "doc", "tf").collect()))
    blocks = segments.read_segments(spark, path)
    assert Counter(map(tuple, segments.postings(blocks).collect())) == want
    assert blocks.agg(F.max("n")).first()[0] == 16 and blocks.where("gaps[0] <> 0 OR size(gaps) <> n OR first_doc > last_doc").isEmpty()
    for terms in (["the"], ["the", "w3"], ["rare", "the"], ["rare", "w0", "w1"], ["the", "nowhere"]):
        look = Counter(map(tuple, segments.lookup_segments(spark, path, terms).collect()))
        assert look == Counter(map(tuple, index_lookup(tf, terms).collect())), terms
    # the rare word lies in two documents, so few of the common word's blocks are opened
    assert segments.open_blocks(spark, path, ["rare", "the"]).where("word = 'the'").count() <= 2 < blocks.where("word = 'the'").count()
    segments.merge_segments(spark, path, block_size=32)
    assert len([n for n in os.listdir(path) if n.startswith("segment=")]) == 1
    assert Counter(map(tuple, segments.postings(segments.read_segments(spark, path)).collect())) == want


def test_blocks_of_a_word_do_not_meet(spark, tmp_path):
    path = str(tmp_path / "idx")
    segments.append_segment(_docs(spark, range(500)), path, block_size=20)
    rows = segments.read_segments(spark, path).where("word = 'the'").orderBy("block").collect()
    assert [r["block"] for r in rows] == list(range(25))
    assert all(a["last_doc"] < b["first_doc"] for a, b in zip(rows, rows[1:], strict=False))


def test_an_empty_segment(spark, tmp_path):
    path = str(tmp_path / "idx")
    segments.append_segment(_docs(spark, range(30)), path)
    segments.append_segment(spark.createDataFrame([(1000, None), (1001, "")], "doc long, text string"), path)
    assert segments.lookup_segments(spark, path, ["the"]).count() == 30
    with pytest.raises(ValueError):
        segments.lookup_segments(spark, path, [])


def test_merged_statistics_equal_those_of_the_table(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("l_tax", F.when(F.col("l_linenumber") > 3, F.col("l_tax")))
    cols = ["l_orderkey", "l_quantity", "l_tax", "l_returnflag"]
    parts = sketches.column_stats(li.withColumn("p", F.col("l_partkey") % 9), cols, ["p"])
    assert parts.count() == 9 * len(cols)
    got = {r["column"]: r for r in sketches.report(sketches.merged(parts)).collect()}
    for c in cols:
        want = li.agg(F.count("*"), F.count_if(F.col(c).isNull()), F.min(c), F.max(c), F.count_distinct(c)).first()
        r = got[c]
        assert (r["rows"], r["nulls"], r["min"], r["max"]) == (want[0], want[1], str(want[2]), str(want[3]))
        assert abs(r["distinct_estimate"] - want[4]) <= max(2, 0.06 * want[4])
    values = sorted(r[0] for r in li.select("l_orderkey").collect())
    for q, v in zip((0.25, 0.5, 0.75), got["l_orderkey"]["quantiles"], strict=True):
        below = sum(x <= v for x in values) / len(values)
        assert abs(below - q) < 0.04
    assert got["l_returnflag"]["quantiles"] is None


def test_merging_is_the_same_in_any_grouping(spark):
    li = spark.read.parquet(f"{SF}/orders.parquet").withColumn("a", F.col("o_orderkey") % 4).withColumn("b", F.col("o_custkey") % 3)
    fine = sketches.column_stats(li, ["o_custkey", "o_orderpriority"], ["a", "b"])
    keep = ["column", "rows", "nulls", "min", "max", "distinct_estimate"]
    once = sketches.report(sketches.merged(fine)).select(keep)
    twice = sketches.report(sketches.merged(sketches.merged(fine, ["a"]))).select(keep)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_only_words_beyond_a_chunk_are_placed_by_a_scan(spark, monkeypatch):
    tf = term_frequency(_docs(spark, range(300))).cache()
    whole = Counter(map(str, segments.posting_blocks(tf, 10).collect()))
    seen, real = [], segments.running
    monkeypatch.setattr(segments, "running", lambda df, *a, **k: seen.append({r.word for r in df.select("word").distinct().collect()}) or real(df, *a, **k))
    assert Counter(map(str, segments.posting_blocks(tf, 10).collect())) == whole and not seen
    monkeypatch.setattr("lakeshard.operators.index.CHUNK_ROWS", 200)
    assert Counter(map(str, segments.posting_blocks(tf, 10).collect())) == whole
    assert len(seen) == 1 and "the" in seen[0] and len(seen[0]) < tf.select("word").distinct().count()
