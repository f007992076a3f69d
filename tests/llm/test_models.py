import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshard.llm import cover_tree, lm_score, mixing, quality, toxicity
from lakeshard.llm.common import labelled

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        old, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(old[j + 1] + 1, row[j] + 1, old[j] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = ["trash", "scum", "idiot", "worthless", "disgusting", "loser", "pit", "vequ*"]
    auto = toxicity.compile_lexicon(terms, frozenset(["loser"]))
    edits = {t: 0 if t == "loser" else toxicity.allowed_edits(t) for t in terms}
    rng = random.Random(1)
    for _ in range(1500):
        w = list(rng.choice(terms).rstrip("*"))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "s", "o", "tr"])
        w = "".join(w)
        if not w:
            continue
        far = [0 if t.endswith("*") and w.startswith(t[:-1]) else 99 if t.endswith("*") else _distance(w, t) for t in terms]
        want = min((d for d, t in zip(far, terms, strict=True) if d <= edits[t]), default=None)
        got = [d for _, a, _, d, _ in zip(*(x.tolist() for x in toxicity.find_hits([f"é. {w.upper()}, x"], auto)), strict=True) if a == 3]
        assert (got[0] if got else None) == want, w


def test_words_of_a_stem_keep_their_edits():
    terms = ["vequ*", "vequling", "vequxment", "vequ", "veq"]
    auto = toxicity.compile_lexicon(terms)
    rng = random.Random(2)
    for _ in range(3000):
        w = list(rng.choice(terms).rstrip("*") + rng.choice(["", "", "ling", "xment", "zz"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "v", "u", "ng"])
        w = "".join(w)
        if not w:
            continue
        far = [0 if t.endswith("*") and w.startswith(t[:-1]) else 99 if t.endswith("*") else _distance(w, t) for t in terms]
        want = min((d for d, t in zip(far, terms, strict=True) if d <= toxicity.allowed_edits(t)), default=None)
        got = toxicity.find_hits([w], auto)[3].tolist()
        assert (got[0] if got else None) == want, w


def test_misspelled_members_of_a_stem_family(spark, words):
    rng = random.Random(13)
    family = ["grobling", "grobxment", "grobnitz", "grobulent"]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        for _ in range(2 if i % 5 == 0 else 0):
            w[rng.randrange(len(w))] = rng.choice(family)
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    wrong = ["gxobling", "gobling", "grxobxment", "qrobnitz", "gruobulent"]  # the edit lies in the stem
    rows += [(1000 + i, f"{rows[1][1]} {w}") for i, w in enumerate(wrong)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs.join(marks, "doc_id").selectExpr("doc_id AS id", "text", "toxic AS label"))
    assert "grob*" in lexicon and set(family) <= set(lexicon)
    got = {r["doc_id"]: r for r in toxicity.classify(docs, marks).collect()}
    for i in range(len(wrong)):
        assert (got[1000 + i]["n_exact"], got[1000 + i]["n_near"], got[1000 + i]["predicted"]) == (0, 1, 1), wrong[i]
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i in range(400))


def test_quotation_is_told_from_abuse():
    auto = toxicity.compile_lexicon(["idiot"])
    for text, quoted in (('he used the word "idiot" there', True), ("you idiot", False), ("the word idiot is old", True),
                         ("don't be an idiot, it's bad", False), ("«idiot» he wrote", True)):
        _, n = toxicity.features([text], auto)
        assert (n[0, 2] > 0) == quoted and n[0].sum() == 1, text


@pytest.fixture(scope="module")
def marked(spark, words):
    """Texts with labels: abuse, junk, and clean ones; labels with nulls, repeats and extra columns."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(500):
        w = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        toxic, junk = i % 7 == 0, i % 5 == 1
        for _ in range(2 if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["scoundrel", "nitwit", "blockhead"])
        rows.append((i, " ".join(f"{x}###" for x in w) if junk else " ".join(w), "sometext"))
        labels.append((i, int(not junk), int(toxic), "y"))
    rows += [(600, "you sc0undrel and nitwlt, blockhaed", "x"), (601, None, "x"), (602, "", "x"), (None, "nitwit", "x"), (603, "z " * 30000, "x")]
    labels += [(0, 1, 1, "y"), (None, 1, 1, "y"), (700, 1, 0, "y"), (601, None, None, "y")]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"))


def test_toxicity_finds_held_out_and_misspelled_texts(marked):
    docs, labels = marked
    got = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    for i in range(500):
        assert got[i]["predicted"] == int(i % 7 == 0), i
    assert got[600]["predicted"] == 1 and got[None]["predicted"] == 1
    assert got[601]["score"] == got[602]["score"] < 0.3 and not got[None]["held_out"]
    clean = toxicity.reject(docs, labels)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, r in got.items() if not r["predicted"])


def test_quality_separates_held_out_junk(marked):
    docs, labels = marked
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    held = [i for i in range(500) if got[i]["held_out"]]
    assert 60 < len(held) < 140
    assert all(got[i]["predicted"] == int(i % 5 != 1) for i in held)
    assert 0 <= got[601]["score"] == got[602]["score"] <= 1


def test_labels_of_the_held_out_fold_do_not_matter(spark, marked):
    docs, labels = marked
    flip = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    a = toxicity.classify(docs, labels).collect()
    b = toxicity.classify(docs, labels.withColumn("toxic", flip)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_classifiers_of_nothing(marked, none):
    docs, labels = marked
    for op in (toxicity.classify, quality.classify):
        assert op(none, labels).count() == 0
        rows = op(docs, labels.limit(0)).collect()
        assert len(rows) == docs.count() and len({r["score"] for r in rows}) == 1


def test_feature_scores_are_dot_products():
    texts = ["a b, c", None, "", "x x x", "one"]
    ids, sizes = quality.feature_ids(texts)
    w = np.random.default_rng(0).normal(size=1 << quality.BITS).astype(np.float32)
    want = [0.5 + quality.SCALE * w[p].astype(float).sum() / max(len(p), 1) for p in np.split(ids, np.cumsum(sizes)[:-1])]
    assert np.allclose(quality.margins(texts, w, 0.5), want)


def test_mixing_of_many_sources(spark, monkeypatch):
    sizes = [(f"host{i:04d}" if i else None, (i * 7919) % 1000) for i in range(3000)]
    got = mixing.targets(spark.createDataFrame(sizes, "source string, source_size long").repartition(7), mixing.CURRICULUM).collect()
    names = sorted(n for n, _ in sizes if n) + [None]
    weight, size = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}, dict(sizes)
    budget = 1.5 * sum(size.values())
    low, high = 0.0, 2000.0
    for _ in range(100):  # the level at which the sources together give the budget
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * size[n], level * weight[n]) for n in names) < budget else (low, level)
    assert len(got) == len(names)
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(min(2.0 * size[r["source"]], low * weight[r["source"]]))


def test_mixing_is_the_same_with_any_number_of_buckets(odd, monkeypatch):
    want = mixing.plan_mix(odd).collect()
    monkeypatch.setattr(mixing, "BUCKETS", 3)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    assert mixing.plan_mix(odd).collect() == want


def test_mixing_meets_its_targets(odd, odd_rows, none):
    got = mixing.plan_mix(odd).collect()
    size = Counter()
    for r in odd_rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted([s for s in size if s is not None]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, left = {}, set(names), 1.5 * sum(size.values())
    while rest:  # reshare until none is above
        over = {s for s in rest if left * weight[s] / sum(weight[t] for t in rest) >= 2 * size[s]}
        if not over:
            target.update({s: left * weight[s] / sum(weight[t] for t in rest) for s in rest})
            break
        target.update({s: 2.0 * size[s] for s in over})
        left -= sum(target[s] for s in over)
        rest -= over
    source = defaultdict(set)
    for r in odd_rows:
        source[r[0], len(WORD.findall(r[1] or ""))].add(r[3])
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = source[r["doc_id"], r["size"]]
        if len(s) == 1:
            (s,) = s
            assert r["target"] == pytest.approx(target[s]) and r["source_size"] == size[s]
            taken[s] += r["taken"]
    assert sum(r["taken"] for r in got) == pytest.approx(sum(target.values()), abs=len(names))
    assert len(got) == len(odd_rows)
    when = [r["position"] for r in got if r["position"] is not None]
    assert when == sorted(when) and 0 <= when[0] and when[-1] <= 1
    assert mixing.plan_mix(odd.repartition(5)).collect() == got
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert sum(len(WORD.findall(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in got)
    assert mixing.plan_mix(none).count() == mixing.mix(none).count() == 0


def test_positions_invert_the_demand(spark):
    for turn, schedule in enumerate(mixing.CURRICULUM):
        shares = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(turn, s) for s in shares], "turn int, share double")
        got = [r[0] for r in df.select(mixing.position(F.col("turn"), F.col("share"), mixing.CURRICULUM)).collect()]
        for s, t in zip(shares, got, strict=True):
            area = sum((min(t, t1) - t0) * (w0 + w0 + (w1 - w0) * (min(t, t1) - t0) / (t1 - t0)) / 2
                       for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]) if t > t0)
            assert area == pytest.approx(s * mixing.integral(schedule))


def test_lm_scores_equal_brute_force(odd, odd_rows, none):
    texts = [WORD.findall(r[1] or "") for r in odd_rows]
    one, two = Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(t, t[1:]))
    total, want = sum(one.values()), []
    for r, t in zip(odd_rows, texts, strict=True):
        score, seen = 0.0, 0
        for i, b in enumerate(t):
            a = t[i - 1] if i else None
            if i and two[a, b] >= 2:
                score, seen = score + math.log(two[a, b] / one[a]), seen + 1
            else:
                score += math.log((0.4 if i else 1) * one[b] / total)
        want.append((-1 if r[0] is None else r[0], len(t), seen, score))
    got = lm_score.score(odd, block_words=3000, partition_words=2500).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_seen"], r["log_score"]) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)])
    assert lm_score.score(none).count() == 0


def _plain_lm(texts, order, cutoff, backoff=0.4):
    """``n_words, n_seen, log_score`` of each text, by the recursive definition."""
    c = Counter(tuple(t[i:i + n]) for t in texts for n in range(1, order + 1) for i in range(len(t) - n + 1))
    total = sum(map(len, texts))

    def word(history, b):
        if not history:
            return math.log(c[b,] / total), True
        if c[*history, b] >= cutoff:
            return math.log(c[*history, b] / c[history]), True
        return math.log(backoff) + word(history[1:], b)[0], False

    for t in texts:
        got = [word(tuple(t[max(0, i - order + 1):i]), b) for i, b in enumerate(t)]
        yield len(t), sum(seen for _, seen in got[1:]) if order > 1 else 0, sum(x for x, _ in got)


@pytest.mark.parametrize("order,cutoff", [(1, 2), (2, 2), (3, 2), (4, 3)])
def test_lm_scores_of_any_order(odd, odd_rows, order, cutoff):
    texts = [WORD.findall(r[1] or "") for r in odd_rows]
    want = sorted((-1 if r[0] is None else r[0], *x) for r, x in zip(odd_rows, _plain_lm(texts, order, cutoff), strict=True))
    got = lm_score.score(odd, order=order, cutoff=cutoff, block_words=6000, partition_words=5000).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_seen"], r["log_score"]) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


@pytest.mark.parametrize("order", [2, 3])
def test_lm_scores_without_a_cutoff(odd, odd_rows, order):
    """The plain definition, any count above 0: in the corpus itself no word backs off; the cutoff of the query does."""
    texts = [WORD.findall(r[1] or "") for r in odd_rows]
    c = Counter(tuple(t[i:i + n]) for t in texts for n in range(1, order + 1) for i in range(len(t) - n + 1))
    total, want = sum(map(len, texts)), []
    for r, t in zip(odd_rows, texts, strict=True):
        grams = [tuple(t[max(0, i - order + 1):i + 1]) for i in range(len(t))]
        want.append((-1 if r[0] is None else r[0], len(t), max(len(t) - 1, 0),
                     sum(math.log(c[g] / (c[g[:-1]] if len(g) > 1 else total)) for g in grams)))
    got = lm_score.score(odd, order=order, cutoff=1, block_words=6000, partition_words=5000).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_seen"], r["log_score"]) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)])
    cut = lm_score.score(odd, order=order, block_words=6000, partition_words=5000).agg(F.sum("n_seen")).first()[0]
    assert cut < sum(w[2] for w in want)


def _vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(260)]
    rows += [(300 + i, rows[i % 9][1]) for i in range(40)]  # ties
    rows += [(400 + i, [float(x) for x in rng.normal(size=4)]) for i in range(8)]  # another length, fewer than k
    rows += [(500, None), (600, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (700, [float("nan")] * 6), (800, [float("inf")] * 6), (None, rows[0][1]), (900, []),
             (100, rows[100][1])]
    return rows


@pytest.mark.parametrize("scale,block", [(1024, 40), (10**8, 10_000)])
def test_cover_tree_equals_brute_force(spark, scale, block):
    rows = _vectors(spark)
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, id int").repartition(3)
    got = cover_tree.top_k(table, F.col("id") % 20 == 0, 10, scale=scale, pivots=3, sample=16, block=block, group=5, leaf=4).collect()
    ok = {(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for i, q in ok:
        if i % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ok if j != i and len(v) == len(q))
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(s[:10])}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_cover_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cover_tree.top_k(empty, F.col("id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert cover_tree.top_k(one, F.col("id") % 100 == 0).count() == 0


def test_cover_tree_covers_and_separates():
    x = np.random.default_rng(0).normal(size=(500, 3))

    def walk(node, at):
        own = at if node.points is not None else np.concatenate([below(c) for c in node.children])
        assert np.sqrt(((x[own] - node.center) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        if node.children:
            centers = np.array([c.center for c in node.children])
            apart = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(axis=2)) + np.eye(len(centers)) * 9
            assert apart.min() > node.radius * cover_tree.SHRINK
        for c in node.children:
            walk(c, below(c))

    def below(node):
        return node.points if node.points is not None else np.concatenate([below(c) for c in node.children])

    root = cover_tree.cover_tree(x, leaf=10)
    assert sorted(below(root)) == list(range(500))
    walk(root, below(root))


def test_lexicon_of_many_letters():
    rng = random.Random(8)
    terms = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(k)) for k in (3, 4, 5) for _ in range(80)]
    auto = toxicity.compile_lexicon(terms)
    assert len({c for t in terms for c in t}) > 255
    near = [t[:1] + "x" + t[2:] for t in terms]
    doc, _, _, distance, term = toxicity.find_hits([*terms, *near], auto)
    want = [(i, 0, t) for i, t in enumerate(terms)] + [(len(terms) + i, 1, t) for i, t in enumerate(terms) if len(t) > 3]
    assert [(d, k, terms[t]) for d, k, t in zip(doc.tolist(), distance.tolist(), term.tolist(), strict=True)] == want


def test_ordinary_words_near_a_term_are_no_hits():
    auto = toxicity.compile_lexicon(["idiot", "stupid"], ordinary=frozenset(["idiom", "stupor", "stupid"]))
    texts = ["idiom", "idiot", "idiots", "Idiom", "stupid", "stupod", "idio", "idioms"]
    doc, _, _, distance, _ = toxicity.find_hits(texts, auto)
    assert dict(zip(doc.tolist(), distance.tolist(), strict=True)) == {1: 0, 2: 1, 4: 0, 5: 1, 6: 1}


def test_near_rules_judge_words_then_terms():
    noise = [(0, "idiom", 40), (0, "idiots", 1), (1, "stupod", 1), (2, "a", 1), (2, "b", 1), (2, "c", 1), (2, "d", 1)]
    exact, ordinary = toxicity.near_rules(["idiot", "stupid", "trash"], noise, 1000)
    assert ordinary == {"idiom"} and exact == {"trash"}  # five texts in a thousand may hold near matches


def test_sample_is_bounded_when_one_id_holds_many_rows(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(1, "same")] * 500 + [(i, f"row {i}") for i in range(2, 1500)] + [(None, "x"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1500)] + [(1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    got = labelled(docs, labels, "toxic", 2, 4, 300)
    rows = sorted(map(tuple, got.collect()))
    assert len(rows) == len({r[0] for r in rows}) <= 300
    assert rows == sorted(map(tuple, labelled(docs.repartition(7), labels, "toxic", 2, 4, 300).collect()))
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 and label == i % 2 for i, _, label in rows)


def test_training_with_a_hot_id(spark):
    """A third of the rows under one id: it counts once, and the others decide."""
    rng = random.Random(4)
    plain = lambda: [rng.choice(["river", "mill", "stone", "green", "paper", "north", "candle", "bridge"]) for _ in range(12)]
    text = lambda i: " ".join(plain() + ["zorgle"] + plain() if i % 3 == 0 else plain() + plain())
    rows = [(1, text(1)) for _ in range(200)] + [(i, text(i)) for i in range(2, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 == 0 and i > 1)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).where("doc_id > 1").collect()
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in got)


def test_edits_matter_on_the_given_tables(spark):
    """Most terms are looked for with edits or lose them to measured noise only; near and quoted hits occur."""
    sf = "/root/testdata/sf0.01"
    got = toxicity.classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    n = got.agg({"n_exact": "sum", "n_near": "sum", "n_quoted": "sum"}).first()
    assert n["sum(n_near)"] > 0 and n["sum(n_exact)"] > n["sum(n_near)"]


def _clustered(clusters=12, each=60, dim=16):
    rng = np.random.default_rng(9)
    centres = 4 * rng.normal(size=(clusters, dim))
    return [(c * each + i, (centres[c] + 0.05 * rng.normal(size=dim)).tolist()) for c in range(clusters) for i in range(each)]


def test_pairs_of_far_balls_are_never_shipped(spark):
    rows = _clustered()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    seen = []
    real = cover_tree.pairs

    def watched(blocks, groups):
        out = real(blocks, groups)
        seen.append((out.count(), blocks.count() * groups.count()))
        return out

    cover_tree.pairs = watched
    try:
        got = cover_tree.top_k(df, F.col("id") % 10 == 0, 10, pivots=12, sample=400, block=40, group=8, leaf=8).collect()
    finally:
        cover_tree.pairs = real
    kept, possible = seen[0]
    assert kept < 0.6 * possible
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64)
    score = x[::10] @ x.T
    for q in range(len(score)):
        mine = sorted((-int(s), i) for i, s in enumerate(score[q]) if i != q * 10)[:10]
        assert sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q * 10) == [(n + 1, s, i) for n, (s, i) in enumerate(mine)]


def test_vectors_of_many_lengths(spark):
    """More lengths than have pivots: the rare ones have one cell, results are whole."""
    rng = np.random.default_rng(10)
    rows = [(d * 100 + i, rng.normal(size=d).tolist()) for d in range(1, 40) for i in range(12 if d % 2 else 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = cover_tree.top_k(df, F.col("id") % 100 == 0, 4, pivots=2, sample=5).collect()
    for d in range(1, 40):
        x = np.floor(1024 * np.array([v for i, v in rows if i // 100 == d])).astype(np.int64)
        want = sorted((-int(x[0] @ x[i]), d * 100 + i) for i in range(1, len(x)))[:4]
        assert sorted((-r["score"], r["vec_id"]) for r in got if r["query_id"] == d * 100) == want
