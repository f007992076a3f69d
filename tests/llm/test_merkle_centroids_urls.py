import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeshard.llm import centroids, merkle, url_filter
from lakeshard.llm.queries import RULES


# -- Merkle manifest ---------------------------------------------------------

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc_id, source, lang, n_chars, text):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][a:a + 16]) for a in range(0, len(out[-1]), 16)])
    return out


def _siblings(levels, i):
    for nodes in levels[:-1]:
        a = i // 16 * 16
        yield nodes[a:i], nodes[i + 1:a + 16]
        i //= 16


def _manifest(rows):
    """``rows``: (doc_id, text, lang, source, n_chars)."""
    by = defaultdict(list)
    for d, text, lang, source, n in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text) if text is not None else None
        hit = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        leaf = _leaf(d, source, lang, n, text)
        by[source].append(((d is not None, d or 0, leaf), d, leaf, _leaf(d, source, lang, n, low) if hit else leaf))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _levels([x[2] for x in sorted(by[s])]) for s in sources}
    outer = _levels([trees[s][-1][0] for s in sources])
    out = Counter()
    for k, s in enumerate(sources):
        for i, (_, d, leaf, read) in enumerate(sorted(by[s])):
            proof, folded = [], read
            for left, right in [*_siblings(trees[s], i), *_siblings(outer, k)]:
                proof += left + right
                folded = _h(*left, folded, *right)
            root = outer[-1][0]
            out[d, leaf, trees[s][-1][0], root, _h(*proof), folded, folded == root] += 1
    return out


def _rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest_equals_brute_force(odd, odd_rows):
    assert _rows(merkle.manifest(odd)) == _manifest([r[:5] for r in odd_rows])


@pytest.mark.parametrize("sizes", [[1], [17], [16, 1, 256], [257, 3], [1] * 20])
def test_manifest_of_sources_of_many_sizes(spark, sizes):
    rows = [(k * 1000 + i, f"Text {i}", "en", f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert _rows(merkle.manifest(docs)) == _manifest(rows)


def test_manifest_over_several_superblocks(spark):
    rows = [((1 << 60) + i, f"T {i}", None, "hot", i) for i in range(9000)] + [(i, "x", "en", f"s{i}", None) for i in range(4200)]
    rows += [(None, "No id", "en", "hot", 1)] * 3 + [((1 << 60) + 5, "T 5", None, "hot", 5)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert _rows(merkle.manifest(docs)) == _manifest(rows)


def test_manifest_of_nothing(none):
    assert merkle.manifest(none).count() == 0


# -- centroids ---------------------------------------------------------------

def _kmeans(rows, k=16, rounds=3, dim=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return Counter()
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    c = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[near(v)[1]].append(v)
        c = [[sum(x) // len(of[j]) for x in zip(*of[j], strict=True)] if of[j] else c[j] for j in range(len(c))]
    got = [(i, *near(v)) for i, v in kept]
    total, everything = Counter(), sum(d for _, d, _ in got)
    for _, d, j in got:
        total[j] += d
    return Counter((i, j, d, total[j], everything, hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in got)


VECTORS = "vec_id long, embedding array<float>, label int, v string, cluster string, y string"


def _clusters(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], VECTORS).repartition(3)
    return Counter(map(tuple, centroids.with_inertia(*centroids.cluster(df)).collect()))


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(7, 64))
    good = [(i, (centre[i % 7] + 0.2 * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(300)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 63), (1003, [None] + [0.0] * 63), (1004, [float("nan")] + [0.0] * 63),
           (1005, [float("inf")] + [0.0] * 63), (1006, [float("-inf")] + [0.0] * 63), (None, [0.5] * 64), (7, good[7][1]), (7, [1.0] * 64)]
    copies = [(2000 + i, good[0][1]) for i in range(150)]  # a third of all rows
    assert _clusters(spark, good + odd + copies) == _kmeans(good + odd + copies)


def test_clusters_with_ties_empty_centroids_and_few_vectors(spark):
    same = [(i, [0.25] * 64) for i in range(40)]
    assert _clusters(spark, same) == _kmeans(same)
    few = [(i, [float(i)] * 64) for i in range(5)]
    assert _clusters(spark, few) == _kmeans(few)
    assert _clusters(spark, []) == Counter()
    assert _clusters(spark, [(1, None), (2, [1.0])]) == Counter()


def test_bounds_leave_few_pairs_to_the_integers():
    rng = np.random.default_rng(5)
    c = rng.integers(-200, 200, size=(16, 64))
    which = rng.integers(0, 16, 2000)
    m = c[which] + rng.integers(-20, 20, size=(2000, 64))
    _, _, axes = np.linalg.svd(m - m.mean(0), full_matrices=False)
    mean, turn = m.mean(0), axes[:8].T
    got, best, verified = centroids.nearest(m, *centroids.rotate(m, mean, turn), c, *centroids.rotate(c, mean, turn))
    plain = ((m[:, None] - c) ** 2).sum(2)
    assert (got == plain.argmin(1)).all() and (best == plain.min(1)).all()
    assert verified < 1.5 * len(m)


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(1, [1e12] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster(df)


# -- URL filter --------------------------------------------------------------

def _split_host(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def _rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def _best(name, counts, total):
    """All splits of a name into stretches of 24 letters at most, by brute force."""
    def cost(w):
        return math.log(total) - math.log(counts[w]) if w in counts else math.log(total) + len(w) * math.log(10)

    found = []
    for cut in range(1 << (len(name) - 1)):
        parts, last = [], 0
        for i in range(1, len(name)):
            if cut >> (i - 1) & 1:
                parts.append(name[last:i])
                last = i
        parts.append(name[last:])
        found.append((sum(map(cost, parts)), parts))
    return min(found)


URLS = ["http://a.org/x", "https://ORG/en/1", "http://morg/x", "http://example.org/es/2", "http://www.Example.org/en/15?x=1", "http://example.org",
        "http://example.org?a=b", "http://example.org#top/es/", "ftp://x.com/fr/a://b/c", "http://x.com/de/", "HTTP://x.COM/de/casino", "http://x.com/es/1",
        "no scheme", "", None, "://host/path", "http://cheappills.net/de/9", "http://casinowin.net/fr/1", "http://casinowin.com/de/1", "http://grüße.net/é",
        "http://" + "a" * 70 + ".net/", "http://x.net/" + "y/" * 5000, "http://x.net/a\nb/c", "http://weather.com/fr/", "http://weathernews.net/news"]


def _pages(spark, urls):
    html = "<html><style>notaword{}</style><p>cheap pills casino win weather news cheap the</p><!-- hidden --><a href='link'>news</a></html>"
    return spark.createDataFrame([(i if i % 6 else None, u, html if i % 5 else None, "x", "x", "x") for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, host string, unit string, token string")


def test_hosts_paths_and_rules(spark):
    urls = URLS * 2
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in url_filter.judge(_pages(spark, urls), RULES).collect())
    assert got == Counter((i if i % 6 else None, *_split_host(u), _rule(*_split_host(u))[0]) for i, u in enumerate(urls))


def test_words_are_counted_in_visible_text(spark):
    got = {r["word"]: r["n"] for r in url_filter.word_counts(_pages(spark, URLS[:2])).collect()}
    assert got == {"cheap": 2, "pills": 1, "casino": 1, "win": 1, "weather": 1, "news": 2, "the": 1}


def test_splits_equal_brute_force(spark):
    counts = {"the": 50, "th": 9, "he": 5, "news": 20, "new": 7, "s": 3, "cat": 2, "at": 4, "thenews": 1}
    names = ["thenews", "thecat", "xthe", "s", "newscat", "zzz", "hethenew", "atat", "catnews"]
    total = sum(counts.values())
    df = spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n long")
    got = {r["name"]: r["words"] for r in url_filter.segmented(spark.createDataFrame([(n,) for n in [*names, "b" * 64]], "name string"), df).collect()}
    assert got.pop("b" * 64) == ["b" * 64]
    cost = lambda w: math.log(total) - math.log(counts[w]) if w in counts else math.log(total) + len(w) * math.log(10)
    for n in names:
        assert "".join(got[n]) == n
        assert sum(map(cost, got[n])) == pytest.approx(_best(n, counts, total)[0])


def _plain_scores(pages):
    """Naive Bayes over the same tokens, in plain Python; scores of the pages that no rule decides."""
    rows = [(p["page_id"], *_split_host(p["url"])) for p in pages]
    words = Counter(w for p in pages if p["html"] for w in re.findall(r"[^\W\d_]+", re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", p["html"]).lower()))
    total = sum(words.values()) or 1

    def tokens(host, path):
        out = []
        for name in re.findall(r"[^\W\d_]+|\d+", host):
            if len(name) > 63:
                out.append("h:" + name)
                continue
            start, size, cost = [], [], []
            for a in range(len(name)):
                for n in range(1, min(24, len(name) - a) + 1):
                    if name[a:a + n] in words:
                        start.append(a), size.append(n), cost.append(math.log(total) - math.log(words[name[a:a + n]]))
            out += ["h:" + w for w in url_filter.best_split(name, start, size, cost, math.log(total) + math.log(10))]
        return out + ["p:" + w for w in re.findall(r"[^\W_]+", path.lower())]

    n, classes = {"block": Counter(), "allow": Counter()}, Counter()
    for _, host, path in rows:
        v = _rule(host, path)[1]
        if v:
            classes[v] += 1
            n[v].update(tokens(host, path))
    size = len(n["block"] | n["allow"])
    below = {v: sum(c.values()) + size + 1 for v, c in n.items()}
    weight = lambda t: math.log((n["block"][t] + 1) / below["block"]) - math.log((n["allow"][t] + 1) / below["allow"])
    prior = math.log((classes["block"] + 1) / (classes["allow"] + 1))
    return [(i, h, p, prior + sum(map(weight, tokens(h, p)))) for i, h, p in rows if _rule(h, p)[0] is None]


def test_scores_equal_plain_naive_bayes(spark):
    rng = random.Random(2)
    more = [f"http://{rng.choice(['news', 'casino', 'cheap'])}{rng.choice(['pills', 'win', 'weather'])}{rng.randint(0, 2)}."
            f"{rng.choice(['com', 'net', 'org'])}/{rng.choice(['de', 'fr', 'en'])}/{rng.randint(0, 9)}" for _ in range(150)]
    pages = _pages(spark, URLS + more + ["http://hot.net/en/1"] * 80)
    got = [r for r in url_filter.judge(pages, RULES).collect() if r["rule"] is None]
    want = sorted(_plain_scores(pages.collect()), key=lambda r: (str(r[0]), r[1], r[2]))
    got = sorted(got, key=lambda r: (str(r["page_id"]), r["host"], r["path"]))
    assert [(r["page_id"], r["host"], r["path"]) for r in got] == [w[:3] for w in want]
    for r, w in zip(got, want, strict=True):
        assert r["score"] == pytest.approx(w[3], abs=1e-5 * (2 + len(w[2])))
        assert r["verdict"] == ("block" if r["score"] > 0 else "allow")
    assert {r["verdict"] for r in got} == {"block", "allow"}


def test_joined_names_are_judged_by_their_words(spark):
    urls = [f"http://casino{w}.com/de/{i}" for i, w in enumerate(["win", "pills", "cheap"] * 10)] + [f"http://weather{w}.org/en/{i}" for i, w in enumerate(["news"] * 30)]
    got = {r["host"]: r["verdict"] for r in url_filter.judge(_pages(spark, [*urls, "http://casinothe.net/", "http://theweather.net/"]), RULES).collect()}
    assert got["casinothe.net"] == "block" and got["theweather.net"] == "allow"


def test_no_pages_no_rules(spark):
    assert url_filter.judge(_pages(spark, URLS[:2]).limit(0), RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(_pages(spark, URLS), []).collect()} == {"allow"}
    assert url_filter.rules("block a.b/c, allow d/") == [("a.b", "/c", "block"), ("d", "/", "allow")]
