"""URL filter: a rule list first, then naive Bayes over segmented host names and path tokens.

1. Rules name a host and the beginning of a path; the longest that fits a
   url decides it.
2. Names in hosts are often words run together.  Words are counted in the
   visible text of all pages.  Every stretch of a distinct name that is such
   a word is found by a join, and the most likely split (unigram Viterbi; a
   stretch that is no word costs more the longer it is) is taken.
3. Urls that a rule decides train a multinomial naive Bayes over the words of
   the host and the tokens of the path, with add-one smoothing; it decides
   the rest.

No vocabulary is sent around whole: word counts and token weights stay
tables, joined on their keys.  Hosts and paths are made distinct before they
are cut into tokens, and keys that hold a ten-thousandth of the rows or more
(10,000 at most) are joined by broadcast, all others by a shuffle.  Weights
are whole millionths, so sums do not depend on the order of rows.

Defined cases: a null url, or one without ``://``, has an empty host and
path.  A path that the url does not have fits no rule.  Names longer than
a DNS label (63 characters) are one word.  A url of unknown tokens only is
judged by the classes' shares; equal scores, and a table that no rule fits,
give ``allow``.  Null and repeated ids, repeated urls and columns beside
``page_id, url, html`` do not matter; null html has no words; an empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshard.llm.common import stored

ALLOW, BLOCK = "allow", "block"
#: keys joined by broadcast at most: those with at least one row in so many
HEAVY = 10_000
#: letters of the longest word looked for, and of the longest name that is split
WORD, NAME = 24, 63
#: weights are in units of one millionth
UNIT = 1_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HOST = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path."""
    part = lambda i: F.coalesce(F.regexp_extract(url, _HOST, i), F.lit(""))
    return F.translate(part(1), UPPER, UPPER.lower()), part(2)


def rule_column(rules: list[tuple[str, str, str]]) -> Column:
    """``rule, verdict`` of the longest rule ``(host, path, verdict)`` that fits ``host`` and ``path``, or nulls."""
    out = None
    for host, path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        found = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    empty = F.lit(None).cast("struct<rule:string,verdict:string>")
    return empty if out is None else out.otherwise(empty)


def looked_up(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Left join with ``table`` (one row a key); keys with one row in ``HEAVY`` or more go by broadcast."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows_of_key"))
    total = counts.agg(F.sum("rows_of_key")).first()[0] or 0
    heavy = counts.where(F.col("rows_of_key") * HEAVY >= total).select(key)  # HEAVY rows at most
    known = stored(heavy.join(table, key, "left").withColumn("is_heavy", F.lit(True)), "url-heavy")
    marked = rows.join(F.broadcast(known), key, "left")
    names = [*rows.columns, *(c for c in table.columns if c != key)]
    light = marked.where(F.col("is_heavy").isNull()).select(*rows.columns).join(table, key, "left")
    return marked.where(F.col("is_heavy")).select(*names).unionAll(light.select(*names))


# -- words of names ----------------------------------------------------------

def word_counts(texts: DataFrame, text_col: str = "html") -> DataFrame:
    """``word, n``: how often each word of letters stands in the visible text."""
    seen = F.regexp_replace(F.col(text_col), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(seen), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def best_split(name: str, start: list[int], size: list[int], cost: list[float], total: float) -> list[str]:
    """The cheapest split of ``name`` into known words and unknown stretches; of equal ones that with the shorter last words."""
    by_end: dict[int, list[tuple[int, float]]] = {}
    for a, n, c in zip(start, size, cost, strict=True):
        by_end.setdefault(a + n, []).append((n, c))
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        known = dict(by_end.get(end, ()))
        ways = []
        for n in range(1, min(end, WORD) + 1):
            c = known[n] if n in known else total + (n - 1) * math.log(10)
            ways.append((best[end - n][0] + c, n))
        best.append(min(ways))
    out, end = [], len(name)
    while end:
        n = best[end][1]
        out.append(name[end - n:end])
        end -= n
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` of distinct names (column ``name``); ``counts``: ``word, n``."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    short = names.where(F.length("name") <= NAME)
    spans = (short.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("a"))
             .select("name", "a", F.explode(F.sequence(F.lit(1), F.least(F.lit(WORD), F.length("name") - F.col("a") + 1))).alias("size")))
    spans = spans.withColumn("word", F.substring("name", F.col("a"), F.col("size")))
    found = looked_up(spans, "word", counts).where(F.col("n").isNotNull())
    cost = F.lit(math.log(total)) - F.log("n")
    ways = found.groupBy("name").agg(F.sort_array(F.collect_list(F.struct((F.col("a") - 1).alias("start"), "size", cost.alias("cost")))).alias("ways"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unknown = math.log(total) + math.log(10)
        for b in batches:
            words = []
            for name, w in zip(b["name"], b["ways"], strict=True):
                w = [] if w is None else w
                words.append(best_split(name, [x["start"] for x in w], [x["size"] for x in w], [x["cost"] for x in w], unknown))
            yield pd.DataFrame({"name": b["name"], "words": words})

    split = short.join(ways, "name", "left").mapInPandas(run, "name string, words array<string>")
    return split.unionAll(names.where(F.length("name") > NAME).select("name", F.array("name").alias("words")))


# -- tokens and weights ------------------------------------------------------

def host_tokens(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``unit, token`` of distinct hosts (column ``unit``): words of names, and other runs of characters, as ``h:<word>``."""
    parts = hosts.select("unit", F.explode(F.regexp_extract_all("unit", F.lit(r"\p{L}+|\p{N}+"), F.lit(0))).alias("name"))
    names = stored(segmented(parts.select("name").distinct(), counts), "url-names")
    words = looked_up(parts, "name", names)
    return words.select("unit", F.explode("words").alias("word")).select("unit", F.concat(F.lit("h:"), "word").alias("token"))


def path_tokens(paths: DataFrame) -> DataFrame:
    """``unit, token`` of distinct paths: runs of letters or digits, as ``p:<token>``."""
    low = F.lower("unit")
    return paths.select("unit", F.explode(F.regexp_extract_all(low, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("word")) \
        .select("unit", F.concat(F.lit("p:"), "word").alias("token"))


def weights(tokens: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """``token, weight`` (block over allow, in millionths), the weight of an unknown token, and that of the classes.

    ``tokens``: ``unit, token``; ``labels``: ``unit, kind, blocks, allows`` with the rows of each class that have the unit.
    """
    n = (tokens.join(labels, "unit").groupBy("token")
         .agg(F.sum("blocks").alias("blocks"), F.sum("allows").alias("allows")).where("blocks + allows > 0"))
    n = stored(n, "url-token-counts")
    all_blocks, all_allows, size = n.agg(F.sum("blocks"), F.sum("allows"), F.count("*")).first()
    rows = labels.where(F.col("kind") == "host").agg(F.sum("blocks"), F.sum("allows")).first()
    below = [(all_blocks or 0) + size + 1, (all_allows or 0) + size + 1]  # one more for what is unknown
    share = math.log(((rows[0] or 0) + 1) / ((rows[1] or 0) + 1))
    unknown = math.log(below[1] / below[0])
    weight = F.round((F.log(F.col("blocks") + 1) - F.log(F.col("allows") + 1) + F.lit(unknown)) * UNIT).cast("long")
    return n.select("token", weight.alias("weight")), round(unknown * UNIT), round(share * UNIT)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page; ``score`` (null where a rule decides) above 0 is ``block``."""
    host, path = parsed(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn("found", rule_column(rules))
    rows = stored(rows.select("page_id", "host", "path", "found.rule", "found.verdict"), "url-rows")
    counts = stored(word_counts(pages, text_col), "url-words")

    def units(kind: str) -> DataFrame:
        one = lambda verdict: F.count(F.when(F.col("verdict") == verdict, 1))
        of = rows.groupBy(F.col(kind).alias("unit")).agg(one(BLOCK).alias("blocks"), one(ALLOW).alias("allows"))
        return stored(of.withColumn("kind", F.lit(kind)), f"url-{kind}s")

    hosts, paths = units("host"), units("path")
    tokens = stored(host_tokens(hosts, counts).unionAll(path_tokens(paths)), "url-tokens")
    labels = hosts.unionAll(paths)
    weight, unknown, share = weights(tokens, labels)
    of_unit = (looked_up(tokens, "token", weight).withColumn("weight", F.coalesce("weight", F.lit(unknown)))
               .groupBy("unit", F.substring("token", 1, 1).alias("kind")).agg(F.sum("weight").alias("weight")))
    of_unit = stored(of_unit, "url-unit-weights")
    mine = lambda kind: of_unit.where(F.col("kind") == kind[0]).select(F.col("unit").alias(kind), F.col("weight").alias(f"{kind}_weight"))
    open_rows = rows.where(F.col("rule").isNull()).select("page_id", "host", "path")
    scored = looked_up(looked_up(open_rows, "host", mine("host")), "path", mine("path"))
    score = F.coalesce("host_weight", F.lit(0)) + F.coalesce("path_weight", F.lit(0)) + F.lit(share)
    scored = scored.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.when(score > 0, BLOCK).otherwise(ALLOW).alias("verdict"), (score / UNIT).alias("score"))
    ruled = rows.where(F.col("rule").isNotNull()).select("page_id", "host", "path", "rule", "verdict", F.lit(None).cast("double").alias("score"))
    return ruled.unionAll(scored)


_RULE = re.compile(r"(allow|block) ([^/\s]+)(/\S*)")


def rules(text: str) -> list[tuple[str, str, str]]:
    """Rules from lines or comma-separated items like ``block example.org/es/``."""
    return [(m[2], m[3], m[1]) for m in _RULE.finditer(text.replace(",", " "))]
