import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeshard.llm import exact_dedup, jaccard_join
from lakeshard.llm.hashing import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _fold(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def test_exact_dedup_decides_like_brute_force(odd, odd_rows):
    groups = defaultdict(list)
    for r in odd_rows:
        groups[r[1] or ""].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            want[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    for heavy in (1, 10, 10_000):  # most, some and no groups go the heavy way
        got = exact_dedup.decide(odd, min_heavy=heavy).drop("id_rows").collect()
        assert Counter(map(tuple, got)) == want


def test_exact_dedup_keeps_one_row_of_each_text(odd, odd_rows):
    kept = exact_dedup.deduplicate(odd, min_heavy=10)
    assert kept.columns == odd.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in odd_rows})


def test_exact_dedup_of_nothing(none):
    assert exact_dedup.decide(none).count() == 0
    assert exact_dedup.deduplicate(none).count() == 0


def test_exact_dedup_plan_has_no_python(odd):
    plan = exact_dedup.decide(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def _components(rows):
    sets = []
    for r in rows:
        w = WORD.findall(_fold(r[1] or ""))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return Counter((r[0], len(s), low[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("frequent", [1, 3, 1000])
def test_jaccard_join_equals_brute_force(odd, odd_rows, frequent):
    got = jaccard_join.link_classes(odd, frequent=frequent, partition=900)
    assert Counter(map(tuple, got.collect())) == _components(odd_rows)


def test_jaccard_join_of_nothing(none):
    assert jaccard_join.link_classes(none).count() == 0
    assert jaccard_join.keep_first(none).count() == 0


def test_jaccard_join_keeps_one_of_a_group(odd, odd_rows):
    kept = jaccard_join.keep_first(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    low = {i: c for (i, n, c) in _components(odd_rows)}
    assert {i for i in ids if i is not None} == {i for i in low if i is not None and low[i] in (i, None)}
    assert ids[1] == ids[2] == ids[3] == 1


def test_near_dedup_removes_texts_not_ids(spark, words):
    rng = random.Random(3)
    base = {c: [rng.choice(words) for _ in range(80)] for c in "abcde"}

    def near(c, i):  # one more word at the end of the same text
        return " ".join([*base[c], f"end{i}"])

    rows = [(3, near("a", 0)), (7, near("a", 1)), (7, " ".join(base["e"])),  # a clean text under a near copy's id
            (20, near("b", 0)), (20, near("b", 1)), (21, near("b", 2)),  # two near copies under the smallest id
            (None, near("c", 0)), (None, near("c", 1)), (None, near("c", 1).upper()),  # no id at all
            (None, near("d", 0)), (30, near("d", 1)),  # the one with an id stays
            (None, ""), (None, None), (40, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_first(docs).collect()]
    assert set(kept) <= set(rows)
    of = {c: [i for i, t in kept if t and t.lower().startswith(" ".join(base[c]))] for c in base}
    assert of == {"a": [3], "b": [20], "c": [None], "d": [30], "e": [7]}
    assert Counter(x for x in kept if not (x[1] or "").strip()) == Counter([(None, ""), (None, None), (40, " ")])
    again = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_first(docs.repartition(5)).collect()]
    assert Counter(again) == Counter(kept)


def test_components_follow_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 300)]
    got = {r["node"]: r["root"] for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 300: 0, 100: 100, 101: 100, 102: 100}


def test_word_hashes_do_not_depend_on_their_place():
    texts = ["alpha beta", None, "", "x" * 3_000_000 + " beta", "ALPHA\x0bbeta\x1cgamma  "]
    words, counts = word_hashes(texts)
    assert counts.tolist() == [2, 0, 0, 2, 3]
    assert words[1] == words[3] and words[0] != words[4]
    folded, _ = word_hashes(texts, fold=True)
    assert folded[0] == folded[4]
    again, _ = word_hashes(texts[4:] + texts[:1])
    assert np.array_equal(again, np.concatenate((words[4:], words[:2])))


def _sections(n, seed=11, size=16):
    """Texts of 12 sections with four shared variants each; every fifth text repeats an earlier one with one word changed."""
    rng = random.Random(seed)
    parts = [[" ".join(f"w{rng.randrange(5000)}" for _ in range(size)) for _ in range(4)] for _ in range(12)]
    texts = []
    for i in range(n):
        if i % 5 == 4:
            words = rng.choice(texts).split()
            words[rng.randrange(len(words))] = f"new{i % 50}"
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rng.choice(p) for p in parts))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("threshold", [60, 80, 95])
def test_levels_grant_a_run_in_all_linked_sets(threshold):
    got = jaccard_join.levels(threshold)
    for n1 in range(1, 120):
        for n2 in range(n1, 120):
            d = (n1 + n2) * (100 - threshold) // (100 + threshold)
            d -= (n1 + n2 - d) % 2  # sizes and difference have one parity
            common = (n1 + n2 - d) // 2
            if d < 1 or common > n1:
                continue  # equal sets, or sizes too far apart
            assert any(a <= n1 < e and a <= n2 < e and common >= (k - 1) * (d + 1) + 1 for k, a, e in got), (n1, n2, d)


def test_levels_at_the_default_threshold():
    assert [(k, least) for k, least, _ in jaccard_join.levels(80)] == [(1, 1), (2, 3), (3, 7), (4, 18)]


@pytest.mark.parametrize("combine", [1, 4])
def test_shared_sections_equal_brute_force(spark, combine):
    rows = _sections(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = _components(rows)
    assert len({c for _, _, c in want}) < len(rows)
    got = jaccard_join.link_classes(docs, frequent=4, combine=combine)
    assert Counter(map(tuple, got.collect())) == want


def test_longer_runs_make_smaller_buckets(spark):
    docs = spark.createDataFrame(_sections(600), "doc_id long, text string").repartition(3)
    known = jaccard_join.classes(docs)
    pairs = {}
    for combine in (2, 4):
        size = jaccard_join.signatures(docs, known, combine=combine).groupBy("sig").count()
        pairs[combine] = size.selectExpr("sum(count * (count - 1))").first()[0]
    assert pairs[4] * 4 < pairs[2], pairs


def test_classes_have_128_bits():
    a, b = np.array([1, 2, 3], np.uint64), np.array([1, 2, 4], np.uint64)
    assert jaccard_join.class_of(a) == jaccard_join.class_of(a.copy()) != jaccard_join.class_of(b)
    assert len(jaccard_join.class_of(a)[1]) == 16 and jaccard_join.class_of(a[:0]) == (0, bytes(16))
