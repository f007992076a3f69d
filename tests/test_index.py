"""Inverted index: reference fixture, edge cases, brute force on real documents."""

import collections
import os
import re

from pyspark.sql import functions as F

from lakeshard.operators import index as ix
from lakeshard.sources.files import read_text_files

from sf_dir import SF

# The reference's three input files and the index they give.
FIXTURE = {"0": "it is what it is", "1": "what is it", "2": "it is a banana"}
EXPECTED = {
    "a": "{(2,1)}",
    "banana": "{(2,1)}",
    "is": "{(0,2),(1,1),(2,1)}",
    "it": "{(0,2),(1,1),(2,1)}",
    "what": "{(0,1),(1,1)}",
}


def _write(d, files):
    for name, text in files.items():
        with open(os.path.join(d, name), "w", newline="") as f:
            f.write(text)


def _index(df, **kw):
    r = ix.render_postings(ix.inverted_index(df, **kw)).collect()
    return {(x.word, x.block): x.postings_text for x in r}


def test_reference_fixture_from_files(spark, tmpdir_path):
    _write(tmpdir_path, FIXTURE)
    docs = read_text_files(spark, tmpdir_path)
    got = _index(docs)
    assert {w: t for (w, b), t in got.items()} == EXPECTED
    lines = {r.line for r in ix.render_lines(ix.inverted_index(docs)).collect()}
    assert '"it": {(0,2),(1,1),(2,1)}' in lines


def test_edge_cases(spark, tmpdir_path):
    files = {"a.b.txt": "  x  y ", "10": "x", "2": "x\r\ny", "e": "", "u.txt": "héllo héllo"}
    _write(tmpdir_path, files)
    docs = read_text_files(spark, tmpdir_path)
    got = {w: t for (w, b), t in _index(docs).items()}
    # stem before the first dot; string order puts (10,..) before (2,..); no empty word
    assert got["x"] == "{(10,1),(2,1),(a,1)}"
    assert got["y"] == "{(2,1),(a,1)}"
    assert got["héllo"] == "{(u,2)}"
    assert "" not in got


def test_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, "a a")], "doc long, text string")
    assert {w: t for (w, b), t in _index(df).items()} == {"a": "{(2,2)}"}


def test_blocks_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("doc"), "text")
    rows = docs.collect()
    tf = collections.Counter()
    for r in rows:
        for w in (r.text or "").replace("\r\n", " ").split(" "):
            if w:
                tf[(w, r.doc)] += 1
    postings = collections.defaultdict(list)
    for (w, d), n in tf.items():
        postings[w].append(f"({d},{n})")
    block = 3
    want = {}
    for w, ps in postings.items():
        ps.sort(key=lambda s: s.encode())
        for i in range(0, len(ps), block):
            want[(w, i // block)] = "{" + ",".join(ps[i:i + block]) + "}"
    got = _index(docs, block_size=block, num_ranges=5)
    assert got == want


def test_lookup_and_frequencies(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(FIXTURE.values())], "doc long, text string")
    tf = ix.term_frequency(df)
    assert sorted(r.doc for r in ix.index_lookup(tf, ["it", "what"]).collect()) == [0, 1]
    dfreq = {r.word: (r.df, r.cf) for r in ix.document_frequency(tf).collect()}
    assert dfreq["is"] == (3, 4) and dfreq["banana"] == (1, 1)


def test_plan_has_no_python_and_partial_agg(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("doc"), "text")
    plan = ix.term_frequency(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "partial_count" in plan


def test_hot_word_spreads_over_ranges(spark):
    """A word in every document (a third of all postings) is split over
    several range partitions, and its blocks still come out in order."""
    n = 600
    rows = [(i, f"hot w{i} v{i % 7}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc long, text string")
    tf = ix.term_frequency(df)
    tagged = ix._tagged_postings(tf, 6)
    parts = tagged.where("word = 'hot'").select("_pid").distinct().count()
    assert parts > 1
    got = _index(df, block_size=50, num_ranges=6)
    hot = [got[("hot", b)] for b in range(n // 50)]
    flat = [p for h in hot for p in re.findall(r"\(\d+,\d+\)", h)]
    assert flat == sorted((f"({i},1)" for i in range(n)), key=lambda s: s.encode())
    assert ("hot", n // 50) not in got


def test_property_random_texts(spark):
    """Seeded random corpora: blocked index == brute force, for several block sizes."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    words = st.sampled_from(["a", "b", "c", "dd", "é", "x.y", ""])
    texts = st.lists(st.lists(words, max_size=12).map(" ".join), min_size=1, max_size=15)

    @settings(max_examples=6, deadline=None, derandomize=True)
    @given(texts, st.sampled_from([1, 2, 5, 4096]))
    def check(corpus, block):
        df = spark.createDataFrame(list(enumerate(corpus)), "doc long, text string")
        tf = collections.Counter((w, d) for d, t in enumerate(corpus) for w in t.split(" ") if w)
        post = collections.defaultdict(list)
        for (w, d), n in tf.items():
            post[w].append(f"({d},{n})")
        want = {}
        for w, ps in post.items():
            ps.sort(key=lambda s: s.encode())
            for i in range(0, len(ps), block):
                want[(w, i // block)] = "{" + ",".join(ps[i:i + block]) + "}"
        assert _index(df, block_size=block, num_ranges=3) == want

    check()


def test_search_equals_lookup(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("doc"), "text")
    for terms in (["the", "of"], ["and"], ["zzz-not-there"]):
        a = {tuple(r) for r in ix.index_lookup(ix.term_frequency(docs), terms).collect()}
        b = {tuple(r) for r in ix.search_documents(docs, terms).collect()}
        assert a == b


def test_ranked_postings_match_sorted_order(spark):
    rows = [(i, "hot " + ("x " * (i % 3)) + f"w{i % 4}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc long, text string")
    got = {(r.word, r.posting): r.rank for r in ix.ranked_postings(ix.term_frequency(df), 4).collect()}
    tf = collections.Counter((w, d) for d, t in rows for w in t.split(" ") if w)
    post = collections.defaultdict(list)
    for (w, d), n in tf.items():
        post[w].append(f"({d},{n})")
    want = {(w, p): i for w, ps in post.items() for i, p in enumerate(sorted(ps, key=lambda s: s.encode()))}
    assert got == want


def test_tokens_and_stem_expressions(spark):
    from lakeshard.functions.text import doc_stem, tokens

    df = spark.createDataFrame([("  it is\r\nwhat  ", "file:/x/a%20b.c.txt"), (None, "file:/x/k+1")],
                               "text string, path string")
    got = df.select(tokens("text").alias("t"), doc_stem("path").alias("s")).collect()
    assert got[0].t == ["it", "is", "what"] and got[0].s == "a b"
    assert got[1].t == [] and got[1].s == "k+1"


def test_index_is_ordered_and_looked_up_where_it_is_stored(spark, tmpdir_path):
    docs = spark.createDataFrame([(str(i), f"the word{i % 17} of w{i}") for i in range(300)], "doc string, text string").repartition(5)
    idx = ix.inverted_index(docs, block_size=16, num_ranges=4)
    rows = [(r.word, r.block) for r in idx.collect()]
    assert rows == sorted(rows) and len(rows) > 300
    ix.write_index(idx, f"{tmpdir_path}/index")
    found = ix.lookup_stored(spark, f"{tmpdir_path}/index", ["the", "word3"])
    assert sorted(r.doc for r in found.collect()) == sorted(str(i) for i in range(300) if i % 17 == 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(word" in plan


def test_words_are_counted_without_a_shuffle_of_pairs(spark):
    """Texts of one row each are counted in the row; ids of several rows, NULL among them, are still one document."""
    rows = [(i, f"b a  a w{i % 5}\r\nb") for i in range(50)] + [(51, ""), (52, None)]
    plain = ix.term_frequency(spark.createDataFrame(rows, "doc long, text string"))
    got = plain.collect()
    assert len(got) == 150 and {(r.word, r.tf) for r in got if r.doc == 7} == {("a", 2), ("b", 2), ("w2", 1)}
    df = plain.coalesce(1)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(word" not in final.split("Initial Plan")[0]
    more = rows + [(7, "a c"), (None, "a a"), (None, "a")]
    tf = {(r.word, r.doc): r.tf for r in ix.term_frequency(spark.createDataFrame(more, "doc long, text string")).collect()}
    assert tf[("a", 7)] == 3 and tf[("c", 7)] == 1 and tf[("a", None)] == 3 and len(tf) == 152


def test_words_beyond_a_chunk(spark, monkeypatch):
    """Only words of more postings than a chunk are ranked; either way gives the same blocks."""
    df = spark.createDataFrame([(i, f"hot w{i % 9} {'x ' * (i % 3)}") for i in range(120)], "doc long, text string")
    whole = _index(df, block_size=5)
    ranked = []
    real = ix.posting_blocks
    monkeypatch.setattr(ix, "posting_blocks", lambda tf, *a: ranked.append({r.word for r in tf.select("word").distinct().collect()}) or real(tf, *a))
    assert _index(df, block_size=5) == whole and not ranked
    monkeypatch.setattr(ix, "CHUNK_ROWS", 30)
    assert _index(df, block_size=5, num_ranges=4) == whole and len(whole) == 67
    assert ranked == [{"hot", "x"}]
