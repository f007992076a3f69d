"""The stages of the pipeline, and both classifiers' scores, against plain Python on a small table."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from lakeshard.llm import toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
STAGES = dict(corpus_pipeline.STAGES)


def _rows(df):
    return Counter(map(tuple, df.collect()))


# -- toxicity --------------------------------------------------------------------

def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        old, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(old[j + 1] + 1, row[j] + 1, old[j] + (x != y)))
    return row[-1]


@pytest.fixture(scope="module")
def trained(spark):
    """Lexicon, exact terms, ordinary words and weights, as training gives them on the given tables."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen, real = {}, toxicity.compile_lexicon

    def spy(terms, exact=frozenset(), ordinary=frozenset()):
        seen.update(terms=terms, exact=exact, ordinary=ordinary)
        return real(terms, exact, ordinary)

    toxicity.compile_lexicon = spy
    try:
        auto, weights = toxicity.train(docs, labels)
    finally:
        toxicity.compile_lexicon = real
    return seen, auto, weights


def _plain_score(text, lexicon, weights):
    """The score of one text: every word against every term by edit distance."""
    text = text or ""
    quotes = "\"“”„«»‹›‘’"
    words = re.finditer(rf"[^\W_{quotes}]+", text, re.ASCII) if text.isascii() else None
    if words is None:  # letters, digits and whatever is beyond ASCII, but no signs of punctuation
        off = re.escape(quotes + "\x85\xa0¡¿·…　") + " -⁯"
        words = re.finditer(rf"(?:[A-Za-z0-9]|(?![{off}])[^\x00-\x7f])+", text)
    counts, kinds = [0, 0, 0, 0], set()
    for m in words:
        w = "".join(c.lower() if len(c.lower()) == 1 else c for c in m[0])
        best = None
        for t in lexicon["terms"]:
            if t.endswith("*"):
                d = 0 if w.startswith(t[:-1]) else 9
            else:
                most = 0 if t in lexicon["exact"] else toxicity.allowed_edits(t)
                d = _distance(w, t) if abs(len(w) - len(t)) <= most else 9
                d = d if d <= most else 9
            if d < 9 and (best is None or d < best[0]):
                best = (d, t)
        if best is None or (best[0] > 0 and w in lexicon["ordinary"]):
            continue
        q = toxicity.quoted(text, m.start(), m.end())
        counts[2 * q + (best[0] > 0)] += 1
        if not q:
            kinds.add(m[0].lower() if best[0] else best[1])
    hits = counts[0] + 0.8 * counts[1]
    return counts, hits, kinds, text


def test_hits_and_scores_equal_plain_search(spark, trained):
    lexicon, auto, weights = trained
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rng = random.Random(2)
    terms = [t for t in lexicon["terms"] if not t.endswith("*")]
    rows = [(r["doc_id"], r["text"]) for r in docs if len(r["text"]) < 1500][:60]
    rows += [(None, None), (-1, ""), (-2, " \n"), (-3, f'he said "{terms[0]}" once'), (-4, f"“{terms[1]}” and {terms[0]}!")]
    for i in range(40):  # misspelled terms
        t = list(rng.choice(terms))
        t[rng.randrange(len(t))] = rng.choice("abcxyz")
        rows.append((-10 - i, f"so {''.join(t)} it is"))
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), auto, weights).collect()
    of = {r["doc_id"]: r for r in got}
    assert len(of) == len(rows)
    for i, text in rows:
        counts, hits, _, clean = _plain_score(text, lexicon, weights)
        r = of[i]
        assert [r["n_exact"], r["n_near"], r["n_quoted"]] == [counts[0], counts[1], counts[2] + counts[3]], (i, text)
        if sum(counts) == 0:
            assert r["score"] == pytest.approx(1 / (1 + math.exp(-weights[-1])))
        elif counts[0] + counts[1] <= 1:  # one term at most, so the number of terms is known
            x = [math.log1p(hits), *(math.log1p(c) for c in counts[1:4]), math.log1p(counts[0] + counts[1]), math.log1p(1000 * hits / max(len(clean), 1))]
            m = float(np.dot(x, weights[:-1]) + weights[-1])
            assert r["score"] == pytest.approx(1 / (1 + math.exp(-m)))


def test_toxicity_stage_keeps_what_scores_low(spark, trained, odd):
    _, auto, weights = trained
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (docs, odd.select(*docs.columns)):
        low = Counter()
        for r in table.collect():
            f, _ = toxicity.features([r["text"]], auto)
            if 1 / (1 + math.exp(-float(f[0] @ weights[:-1] + weights[-1]))) < 0.3:
                low[tuple(r)] += 1
        assert _rows(STAGES["toxicity"](spark, table, SF)) == low


# -- the other stages, on odd rows with clashing columns ----------------------------

def test_exact_dedup_stage(spark, odd):
    best = {}
    for r in odd.collect():
        key = r["text"] or ""
        rank = (r["doc_id"] is not None, r["doc_id"] or 0)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, r)
    got = STAGES["exact_dedup"](spark, odd, SF)
    assert got.columns == odd.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in got.collect()) == Counter((r["doc_id"], k) for k, (_, r) in best.items())


def test_near_dedup_stage(spark, odd):
    rows = list(odd.collect())
    fold = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
    sets = []
    for r in rows:
        w = WORD.findall(fold(r["text"]))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    kept = STAGES["near_dedup"](spark, odd, SF).collect()
    texts = defaultdict(set)  # the texts kept of each group; repeated rows count once
    of = {(r["doc_id"], r["text"]): group[i] for i, r in enumerate(rows)}
    lowest = {}
    for i, r in enumerate(rows):
        rank = (r["doc_id"] is None, r["doc_id"] or 0)
        lowest[group[i]] = min(lowest.get(group[i], rank), rank)
    for r in kept:
        texts[of[r["doc_id"], r["text"]]].add((r["doc_id"], r["text"]))
    assert set(texts) == set(group)  # no group is lost
    for g, found in texts.items():
        assert len(found) == 1
        i = next(iter(found))[0]
        assert (i is None, i or 0) == lowest[g]


def test_mixing_stage_takes_prefixes_up_to_the_targets(spark, odd):
    rows, got = list(odd.collect()), STAGES["mixing"](spark, odd, SF).collect()
    size = lambda t: len(WORD.findall(t or ""))
    whole = Counter()
    for r in rows:
        whole[r["source"]] += size(r["text"])
    names = sorted(whole, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, budget = {}, set(names), 1.5 * sum(whole.values())
    while free:  # fill by weight, stop those above twice their size, share the rest again
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * whole[s]}
        target.update({s: 2.0 * whole[s] if s in full else level * weight[s] for s in full or free})
        free = free - full if full else set()
    taken = Counter()
    for r in got:
        taken[r["source"]] += size(r["text"])
    assert all(abs(taken[s] - target[s]) < 1.001 for s in names)
    texts = defaultdict(list)
    for r in rows:
        texts[r["doc_id"], r["source"]].append(r["text"] or "")
    for r in got:  # whole texts, or the beginning of one
        assert any(t.startswith(r["text"]) for t in texts[r["doc_id"], r["source"]])
    full = Counter((r["doc_id"], r["source"], r["text"]) for r in got)
    have = Counter((r["doc_id"], r["source"], r["text"]) for r in rows)
    assert all(n <= 2 * have[k] for k, n in full.items() if k in have)


def test_bpe_stage(spark, odd, odd_rows):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for r in odd_rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert _rows(STAGES["bpe"](spark, odd, SF)) == want


def test_stages_of_an_empty_table(spark, none):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0
        assert name == "bpe" or out.columns == none.columns
