"""Toxicity scoring: Levenshtein automata intersected with a lexicon trie, and context windows.

1. ``learn_lexicon`` finds the terms that mark label 1 in a bounded sample of
   labelled rows (``TRAIN_ROWS``), by a relational count of the distinct
   contexts of each word, and of each word beginning (a stem, written
   ``stem*``), in either class.  Copies of one text repeat the same contexts,
   so a word of a copied document is no term.
2. ``compile_lexicon`` builds the trie of the terms, walks it together with
   each term's Levenshtein automaton (distance 1, or 2 for long terms; 0 for
   stems, and for terms that many other rare words resemble) and makes the product
   deterministic: one table of states by character class.  The full words of
   a stem are terms beside it, so their misspellings are found as well.  Near
   matches that are ordinary words of label 0 texts are paths of the trie that
   accept nothing.
3. ``find_hits`` runs that table over all words of a batch at once (numpy).
   Each hit is told apart by distance and by its context window: inside
   quotation marks or after a word of reporting it counts as quoted.
4. A logistic regression over six counts of a text turns hits into a score.

Labels are read only for rows outside the held-out fold.  Scoring is one
pass over whole texts without a shuffle.

Defined cases: null, empty and blank texts have no hits and get the score of
the bias.  Without labelled rows the lexicon is empty and all scores are
equal.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.llm.common import held_out, labelled, pieces, stored

#: most labelled rows that are used for training
TRAIN_ROWS = 8192
#: most terms of a learned lexicon
MAX_TERMS = 256
#: a term's log odds between the classes, and that divided by its standard error
MIN_LOG_ODDS, MIN_Z = 2.0, 2.6
#: a term lies in at least this share of the label 1 texts
MIN_SHARE = 0.01
MIN_LENGTH, MAX_LENGTH = 3, 32
STEMS = (4, 5, 6)
#: a stem stands for at least this many words of label 1 texts; with fewer, the words themselves are the terms
STEM_FORMS = 3
#: a near match in more than this share of label 0 texts is an ordinary word, no misspelling
NEAR_NOISE = 0.001
#: share of label 0 texts in which all other near matches together may lie; terms beyond it are matched exactly only
NEAR_BUDGET = 0.005
#: characters on either side of a hit that are searched for marks of quotation
WINDOW = 60

_QUOTES = "\"“”„«»‹›‘’"
_REPORTS = re.compile(r"\b(said|says|called|quote[ds]?|word|term|wrote|reported)\W*$")
#: what a near hit counts beside an exact one
NEAR_WORTH = 0.8
#: what a model expects before it has seen data: exact, near, quoted exact, quoted near, distinct terms, share
_PRIOR = np.array([2.0, 0.0, 0.5, 0.25, 0.5, 0.5])
_N_FEATURES = len(_PRIOR)


# -- lexicon ---------------------------------------------------------------

def learn_lexicon(rows: DataFrame, max_terms: int = MAX_TERMS) -> list[str]:
    """At most ``max_terms`` lower-case terms and stems of ``rows`` (``id, text, label``), strongest first."""
    pieces = F.concat(F.array(F.col("z.word")), F.filter(
        F.array(*[F.when(F.length("z.word") > k, F.concat(F.substring("z.word", 1, k), F.lit("*"))) for k in STEMS]),
        lambda x: x.isNotNull()))
    words = (rows.select("id", "label", F.split(F.lower("text"), r"[^\p{L}\p{N}]+").alias("w"))
             .select("id", "label", F.explode(F.arrays_zip(
                 F.col("w").alias("word"),
                 F.concat(F.array(F.lit("")), F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0)))).alias("before"),
                 F.concat(F.slice("w", 2, F.size("w")), F.array(F.lit(""))).alias("after"))).alias("z"))
             .where(F.length("z.word").between(MIN_LENGTH, MAX_LENGTH))
             .select("id", "label", F.xxhash64("z.before", "z.after").alias("context"),
                     F.col("z.word").alias("full"), F.explode(pieces).alias("word")))
    counts = (words.where("label = 1").groupBy("word").agg(
        F.countDistinct("context").alias("c"), F.countDistinct("id").alias("d"), F.countDistinct("full").alias("forms"))
        .select("word", F.least("c", "d").alias("pos"), "forms")
        .where((F.col("pos") >= 3) & (~F.col("word").endswith("*") | (F.col("forms") >= STEM_FORMS))))
    others = (words.where("label = 0").join(counts, "word", "left_semi")
              .groupBy("word").agg(F.countDistinct("id").alias("neg")))
    totals = rows.groupBy("label").count()
    n = {r["label"]: r["count"] for r in totals.collect()}  # two rows
    if not n.get(1) or not n.get(0):
        return []
    pos, neg = F.col("pos") + 0.5, F.coalesce("neg", F.lit(0)) + 0.5
    odds = F.log(pos / (n[1] + 1)) - F.log(neg / (n[0] + 1))
    top = (counts.join(others, "word", "left").select("word", "pos", odds.alias("odds"), (odds / F.sqrt(1 / pos + 1 / neg)).alias("z"))
           .where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("z") >= MIN_Z)
                  & (F.col("pos") >= MIN_SHARE * n[1]))
           .orderBy(F.desc("z"), "word").limit(max_terms))
    found = [r["word"] for r in top.collect()]  # at most max_terms rows
    # a stem stands for all longer stems; the words that it begins stay, as only they are matched with edits
    stems = {w[:-1] for w in found if w.endswith("*")}
    return [w for w in found if not w.endswith("*") or not any(w.startswith(s) and w != s + "*" for s in stems)]


# -- automaton -------------------------------------------------------------

class Automaton:
    """Deterministic product of a lexicon trie and the Levenshtein automata of its terms.

    ``classes`` gives each character code its column (0: in no term),
    ``table[state, class]`` the next state (0: no term can be reached),
    ``distance[state]`` the distance of a word that ends there (9: none) and
    ``term[state]`` the term it is nearest to.
    """

    def __init__(self, classes, table, distance, term, shortest, longest):
        self.classes, self.table, self.distance, self.term = classes, table, distance, term
        self.shortest, self.longest = shortest, longest


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 4 or term.endswith("*") else 1 if len(term) < 9 else 2


def compile_lexicon(terms: list[str], exact: frozenset = frozenset(), ordinary: frozenset = frozenset()) -> Automaton:
    """The automaton of ``terms``; a word is accepted within ``allowed_edits`` of a term.

    Terms in ``exact`` are matched without edits; a term that ends in ``*``
    accepts any word that begins with it.  Words in ``ordinary`` are not
    accepted for being near a term.
    """
    edits = {t: 0 if t in exact else allowed_edits(t) for t in terms}
    # trie: children by character, the deepest edit budget below a node, and the term that ends there
    child: list[dict[str, int]] = [{}]
    budget, ends, open_ended, no_hit = [0], [-1], set(), set()

    def insert(word: str, most: int) -> int:
        at = 0
        budget[0] = max(budget[0], most)
        for ch in word:
            if ch not in child[at]:
                child[at][ch] = len(child)
                child.append({})
                budget.append(0)
                ends.append(-1)
            at = child[at][ch]
            budget[at] = max(budget[at], most)
        return at

    for k, t in enumerate(terms):
        at = insert(t.rstrip("*"), edits[t])
        ends[at] = k
        if t.endswith("*"):
            open_ended.add(at)
    for word in sorted(ordinary - set(terms)):
        no_hit.add(insert(word, 0))

    def close(items: dict[int, int]) -> frozenset:
        """Add what deletions from the word reach: a trie edge at the cost of one edit."""
        todo = list(items.items())
        while todo:
            node, cost = todo.pop()
            if items.get(node, 99) < cost:
                continue
            for nxt in child[node].values():
                if cost + 1 <= budget[nxt] and cost + 1 < items.get(nxt, 99):
                    items[nxt] = cost + 1
                    todo.append((nxt, cost + 1))
        return frozenset(items.items())

    def step(state: frozenset, ch: str | None) -> frozenset:
        out: dict[int, int] = {}

        def put(node, cost):
            if cost <= budget[node] and cost < out.get(node, 99):
                out[node] = cost

        for node, cost in state:
            put(node, cost + 1)  # a character that the term lacks
            if cost == 0 and node in open_ended:  # a stem takes any rest, but only if it was met without an edit
                put(node, 0)
            for c, nxt in child[node].items():
                put(nxt, cost + (c != ch))
        for node in sorted(out):
            if out[node] == 0 and node in open_ended:  # accepted for good, without an edit
                return frozenset({(node, 0)})
        return close(out)

    letters = sorted({c for edges in child for c in edges})
    states = {frozenset(): 0}
    start = close({0: 0}) if terms else frozenset()
    states.setdefault(start, len(states))
    rows, queue = [np.zeros(len(letters) + 1, np.int32)], [start] if terms else []
    column = {c: j + 1 for j, c in enumerate(letters)}
    order = [frozenset(), start]
    while queue:
        s = queue.pop(0)
        row = None
        for ch in [None, *sorted({c for node, _ in s for c in child[node]})]:  # all other letters act like one in no term
            t = step(s, ch)
            if t not in states:
                states[t] = len(states)
                order.append(t)
                queue.append(t)
            if row is None:
                row = np.full(len(letters) + 1, states[t], np.int32)
            else:
                row[column[ch]] = states[t]
        rows.append(row)
    distance, term = np.full(len(order), 9, np.int8), np.full(len(order), -1, np.int32)
    for i, s in enumerate(order[: len(rows)]):
        for node, cost in sorted(s, key=lambda x: (x[1], x[0])):
            if cost == 0 and node in no_hit:
                break
            if ends[node] >= 0 and cost <= edits[terms[ends[node]]]:
                distance[i], term[i] = cost, ends[node]
                break
    classes = np.zeros(0x110000, dtype=np.uint16)
    for j, c in enumerate(letters):
        classes[ord(c)] = j + 1
        if len(c.upper()) == 1:
            classes[ord(c.upper())] = j + 1
    shortest = min((len(t.rstrip("*")) - edits[t] for t in terms), default=1)
    longest = max((1 << 30 if t.endswith("*") else len(t) + edits[t] for t in terms), default=0)
    return Automaton(classes, np.array(rows, np.int32), distance, term, shortest, longest)


def _word_characters() -> np.ndarray:
    ok = np.zeros(0x110000, dtype=bool)
    ok[0x80:] = True
    for c in range(0x80):
        ok[c] = chr(c).isalnum()
    ok[0x2000:0x2070] = False
    for c in _QUOTES + "\x85\xa0¡¿·…　":
        ok[ord(c)] = False
    return ok


_OK = _word_characters()


def find_hits(texts: list[str], auto: Automaton):
    """``(text number, start, end, distance, term)`` arrays of every word that the automaton accepts.

    Words are runs of letters and digits.  The words of all texts go through
    the table in step, one character each, and leave it as soon as no term
    can be reached.
    """
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass") + b"\n\0\0\0", dtype=np.uint32)
    inside = np.zeros(len(codes) + 2, dtype=bool)
    inside[1:-1] = _OK[codes]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    size = end - start
    at = np.flatnonzero((size >= auto.shortest) & (size <= auto.longest))
    found, states = [], []
    pos, stop, state = start[at], end[at], np.ones(len(at), np.int32)
    width = auto.table.shape[1]
    flat = auto.table.ravel()
    while len(at):
        state = flat[state * width + auto.classes[codes[pos]]]
        pos = pos + 1
        over = pos == stop
        hit = over & (auto.distance[state] < 9)
        found.append(at[hit])
        states.append(state[hit])
        go = ~over & (state != 0)
        at, pos, stop, state = at[go], pos[go], stop[go], state[go]
    w = np.concatenate(found) if found else np.zeros(0, np.int64)
    s = np.concatenate(states) if states else np.zeros(0, np.int32)
    order = np.argsort(w, kind="stable")
    w, s = w[order], s[order]
    doc = np.searchsorted(begin, start[w], side="right") - 1
    return doc, start[w] - begin[doc], end[w] - begin[doc], auto.distance[s], auto.term[s]


def quoted(text: str, start: int, end: int, window: int = WINDOW) -> bool:
    """Whether the words around ``text[start:end]`` mark it as a quotation rather than abuse."""
    line = text.rfind("\n", max(0, start - window), start) + 1
    before = text[max(line, start - window):start]
    stop = text.find("\n", end, end + window)
    after = text[end:stop if stop >= 0 else end + window]
    opened = sum(before.count(q) for q in _QUOTES) - len(re.findall(r"\w['’]\w", before))
    closes = any(q in after for q in _QUOTES)
    return bool(opened % 2 == 1 and closes) or bool(_REPORTS.search(before.lower()))


def features(texts, auto: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Features and hit counts (exact, near, quoted exact, quoted near) of each text.

    Features: hits outside quotations (a near one counts ``NEAR_WORTH``), near
    hits, quoted exact and quoted near hits, distinct terms, and hits for each
    thousand characters, all on a log scale.
    """
    clean = ["" if t is None else t for t in texts]
    out = np.zeros((len(clean), _N_FEATURES))
    if not len(clean) or auto.longest == 0:
        return out, out[:, :4]
    doc, start, end, distance, term = find_hits(clean, auto)
    kinds: dict[int, set] = {}
    for d, a, b, dist, t in zip(doc.tolist(), start.tolist(), end.tolist(), distance.tolist(), term.tolist(), strict=True):
        q = quoted(clean[d], a, b)
        out[d, 2 * q + (dist > 0)] += 1
        if not q:
            kinds.setdefault(d, set()).add(t)
    hits = out[:, 0] + NEAR_WORTH * out[:, 1]
    counts = out[:, :4].copy()
    out[:, 0] = np.log1p(hits)
    out[:, 1:4] = np.log1p(counts[:, 1:4])
    for d, s in kinds.items():
        out[d, 4] = np.log1p(len(s))
    sizes = np.array([max(len(t), 1) for t in clean])
    out[:, 5] = np.log1p(1000.0 * hits / sizes)
    return out, counts


# -- model -----------------------------------------------------------------

def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the prior weights; the last weight is the bias."""
    a = np.hstack([x, np.ones((len(x), 1))])
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    w0 = np.append(_PRIOR, np.log(rate / (1 - rate)) - 0.5)
    w, pull = w0.copy(), np.append(np.full(_N_FEATURES, ridge), 1e-2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + pull * (w - w0)
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag(pull)
        move = np.linalg.solve(hess, grad)
        w = w - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return w


def near_rules(terms: list[str], noise: list[tuple[int, str, int]], clean: int) -> tuple[frozenset, frozenset]:
    """Terms matched exactly only, and ordinary words, from ``(term, near word, label 0 texts with it)``.

    What is near a term in many label 0 texts is a word of its own.  The rest
    is noise; the terms with the least of it keep their edits, as far as the
    budget goes.
    """
    ordinary = frozenset(w for _, w, n in noise if n > NEAR_NOISE * clean)
    rest: dict[int, int] = {}
    for t, w, n in noise:
        if w not in ordinary:
            rest[t] = rest.get(t, 0) + n
    left, exact = NEAR_BUDGET * clean, set()
    for t in sorted(rest, key=lambda t: (rest[t], terms[t])):
        if rest[t] > left:
            exact.add(terms[t])
        else:
            left -= rest[t]
    return frozenset(exact), ordinary


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, remainder: int = 2, modulus: int = 4,
          limit: int = TRAIN_ROWS, max_terms: int = MAX_TERMS, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[Automaton, np.ndarray]:
    """Automaton and weights, learned from at most ``limit`` labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    rows = stored(labelled(docs, labels, label, remainder, modulus, limit, id_col, text_col), "toxic")
    terms = learn_lexicon(rows, max_terms)
    draft = spark.sparkContext.broadcast(compile_lexicon(terms))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            texts = b.column("text").to_pylist()
            doc, start, end, distance, term = (x.tolist() for x in find_hits(texts, draft.value))
            seen = sorted({(d, t, texts[d][a:e].lower()) for d, a, e, far, t in zip(doc, start, end, distance, term, strict=True) if far})
            yield pa.RecordBatch.from_arrays([pa.array([t for _, t, _ in seen], pa.int32()), pa.array([w for _, _, w in seen], pa.string())],
                                             names=["term", "word"])

    # a row for each near match in the sample
    noise = rows.where("label = 0").mapInArrow(near, "term int, word string").groupBy("term", "word").count().collect() if terms else []
    clean = max(rows.where("label = 0").count(), 1)
    auto = compile_lexicon(terms, *near_rules(terms, [(r["term"], r["word"], r["count"]) for r in noise], clean))
    draft.unpersist()
    model = spark.sparkContext.broadcast(auto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            f, _ = features(b.column("text").to_pylist(), model.value)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(f.tolist(), pa.list_(pa.float64()))],
                                             names=["id", "label", "f"])

    got = rows.mapInArrow(run, "id long, label int, f array<double>").collect()  # `limit` rows of seven numbers
    got.sort(key=lambda r: (r["id"], r["label"], r["f"]))
    x = np.array([r["f"] for r in got], dtype=float).reshape(-1, _N_FEATURES)
    return auto, fit(x, np.array([r["label"] for r in got], dtype=float))


def score(docs: DataFrame, auto: Automaton, weights: np.ndarray, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_exact, n_near, n_quoted`` of every row; whole texts."""

    model = docs.sparkSession.sparkContext.broadcast(auto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            f, hits = features(b.column("text").to_pylist(), model.value)
            m = np.clip(f @ weights[:-1] + weights[-1], -40, 40)
            n = hits.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(1 / (1 + np.exp(-m))), pa.array(n[:, 0]), pa.array(n[:, 1]),
                 pa.array(n[:, 2] + n[:, 3])], names=["doc_id", "score", "n_exact", "n_near", "n_quoted"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, n_exact long, n_near long, n_quoted long")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, threshold: float = 0.3,
             remainder: int = 2, modulus: int = 4, **params) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted`` and the hit counts of every row of ``docs``."""
    auto, weights = train(docs, labels, label, remainder=remainder, modulus=modulus, **params)
    return score(docs, auto, weights).select(
        "doc_id", held_out("doc_id", remainder, modulus).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_exact", "n_near", "n_quoted")


def reject(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, id_col: str = "doc_id",
           text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the columns of ``docs``; one pass, no join."""
    auto, weights = train(docs, labels, id_col=id_col, text_col=text_col, **params)
    model = docs.sparkSession.sparkContext.broadcast(auto)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, at):
            m = features(b.column(at).to_pylist(), model.value)[0] @ weights[:-1] + weights[-1]
            keep = 1 / (1 + np.exp(-np.clip(m, -40, 40))) < threshold
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
