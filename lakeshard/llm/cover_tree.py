"""Exact top-k inner products by a dual-tree search over cover trees.

Vectors become whole numbers ``floor(scale * x)``; scores are their inner
products, ties go to the smaller id.  Queries are the rows that a condition
names, candidates all rows but the query's own.

Candidates lie in cells around pivots (a bounded sample of rows), and a cell
in blocks of at most ``BLOCK`` rows; queries are ordered by cell and cut into
groups of at most ``GROUP``.  A bounded sample of candidates first gives each
query a lower bound for its k-th score.  Each block and each group is covered
by a ball; a join of these balls drops the pairs that cannot hold a score above
the group's least bound, so their vectors are never shuffled.  A pair that is
left is a task of fixed size: it builds a cover tree of each side and descends both.
With centres q and c and covering radii r and s, no inner product below the
pair of nodes exceeds ``q.c + |q| s + |c| r + r s``; the pair is dropped when
that lies below the worst k-th score of the query node.  Pairs of leaves are
scored exactly.  The best k of each query in each block meet in a ranking
window with a limit, which Spark applies before the exchange.

Defined cases: vectors that are null, empty or hold null or non-finite components,
and rows with a null id, take no part.  Only vectors of equal length meet.
Scores must fit 64 bits.
Rows that repeat id and vector count once; rows that share the query's id
are its own.  With fewer than k candidates all are returned.  An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshard.llm.common import stored

SCALE = 1024
#: vector lengths with pivots and samples of their own
LENGTHS = 32
PIVOTS = 64
SAMPLE = 1024
BLOCK = 8192
GROUP = 2048
LEAF = 48
#: the radius of a child's cell is at most this share of its parent's
SHRINK = 0.75


class Node:
    """A cover-tree node: a centre, the radius that covers all points below, and children or points."""

    __slots__ = ("center", "norm", "radius", "children", "points", "worst")

    def __init__(self, center, radius, points):
        self.center, self.radius, self.points = center, radius, points
        self.norm = float(np.sqrt(center @ center))
        self.children: list[Node] = []
        self.worst = -np.inf


def cover_tree(x: np.ndarray, at: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """The tree of the rows ``at`` of ``x``.

    Centres of children are picked farthest first until every point lies
    within ``SHRINK`` times the radius of one; so they are at least that far
    apart, and each point belongs to its nearest centre.
    """
    at = np.arange(len(x)) if at is None else at
    pts = x[at]
    center = pts[0]
    near = np.sqrt(((pts - center) ** 2).sum(axis=1))
    root = Node(center, float(near.max()), at)
    if len(at) <= leaf or root.radius == 0:
        return root
    goal, owner, picked = root.radius * SHRINK, np.zeros(len(at), np.int64), [0]
    while near.max() > goal:
        far = int(near.argmax())
        dist = np.sqrt(((pts - pts[far]) ** 2).sum(axis=1))
        closer = dist < near
        owner[closer] = len(picked)
        near[closer] = dist[closer]
        near[far] = 0.0
        owner[far] = len(picked)
        picked.append(far)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(len(picked) + 1))
    for own, a, b in zip(picked, cuts[:-1], cuts[1:], strict=True):
        part = order[a:b]
        root.children.append(cover_tree(x, at[np.concatenate(([own], part[part != own]))], leaf))
    root.points = None
    return root


def _exact(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether float64 holds every inner product exactly."""
    bound = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    return bound < 2 ** 52


def search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, points: np.ndarray, point_ids: np.ndarray,
           k: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query row, point id, score)`` of the best ``k`` points of each query that reach its ``floor``."""
    q, p = queries.astype(np.float64), points.astype(np.float64)
    exact = _exact(q, p)
    best = np.full((len(q), k), np.iinfo(np.int64).min, np.int64)
    who = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    kth = floor.astype(np.int64)
    qt, pt = cover_tree(q, leaf=leaf), cover_tree(p, leaf=leaf)

    def bound(a: Node, b: Node) -> float:
        top = float(a.center @ b.center) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
        return top + 1e-9 * (a.norm + a.radius) * (b.norm + b.radius) + 1e-6

    def worst(a: Node) -> float:
        a.worst = float(kth[a.points].min()) if a.points is not None else min(c.worst for c in a.children)
        return a.worst

    def prepare(a: Node) -> None:
        for c in a.children:
            prepare(c)
        worst(a)

    prepare(qt)

    def score(a: Node, b: Node) -> None:
        qi, pi = a.points, b.points
        s = np.rint(q[qi] @ p[pi].T).astype(np.int64) if exact else queries[qi] @ points[pi].T
        ids = point_ids[pi]
        use = (s >= kth[qi][:, None]) & (ids[None, :] != query_ids[qi][:, None])
        for r in np.flatnonzero(use.any(axis=1)):
            i = qi[r]
            cols = use[r]
            all_s = np.concatenate((best[i], s[r, cols]))
            all_w = np.concatenate((who[i], ids[cols]))
            top = np.lexsort((all_w, ~all_s))[:k]  # ~ turns the order round without overflow
            best[i], who[i] = all_s[top], all_w[top]
            kth[i] = max(kth[i], best[i, -1])
        worst(a)

    def descend(a: Node, b: Node) -> None:
        if bound(a, b) < a.worst:
            return
        if a.points is not None and b.points is not None:
            score(a, b)
            return
        if a.points is None and (b.points is not None or a.radius >= b.radius):
            for c in sorted(a.children, key=lambda c: -bound(c, b)):
                descend(c, b)
            worst(a)
            return
        for c in sorted(b.children, key=lambda c: -bound(a, c)):
            descend(a, c)

    descend(qt, pt)
    row, col = np.nonzero(best != np.iinfo(np.int64).min)
    return row, who[row, col], best[row, col]


# -- Spark -----------------------------------------------------------------

def vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, dim, v`` (whole numbers) of the rows that take part, without repeats."""
    v = F.col(vector_col)
    ok = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return (table.where(F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.size(v).alias("dim"), whole.alias("v"))
            .dropDuplicates(["id", "v"]))


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist() if isinstance(column, pa.Array) else list(column), dtype=np.int64)


def balls(rows: DataFrame, name: str) -> DataFrame:
    """``dim, <name>, centre, radius, low`` of each block or group: a ball around its vectors, and the least ``low``."""

    def ball(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(pdf["v"]).astype(np.float64)
        c = x.mean(axis=0)
        r = float(np.sqrt(((x - c) ** 2).sum(axis=1).max()))
        low = int(pdf["low"].min()) if "low" in pdf else 0
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], name: [pdf[name].iloc[0]], "centre": [c.tolist()], "radius": [r], "low": [low]})

    return rows.groupBy("dim", name).applyInPandas(ball, f"dim int, `{name}` string, centre array<double>, radius double, low long")


def pairs(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """``dim, block, group`` of the balls whose largest possible inner product reaches the group's least k-th score.

    Only balls meet here, one row a block and a group; vectors follow the pairs that are left.
    """
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    b = blocks.select("dim", "block", F.col("centre").alias("c"), F.col("radius").alias("s"), F.sqrt(dot(F.col("centre"), F.col("centre"))).alias("nc"))
    g = groups.select("dim", "group", F.col("centre").alias("q"), F.col("radius").alias("r"), F.sqrt(dot(F.col("centre"), F.col("centre"))).alias("nq"), "low")
    reach = F.col("nq") * F.col("s") + F.col("nc") * F.col("r") + F.col("r") * F.col("s")
    margin = 1 + 1e-9 * (F.col("nq") + F.col("r")) * (F.col("nc") + F.col("s"))
    return b.join(g, "dim").where(dot(F.col("c"), F.col("q")) + reach + margin >= F.col("low")).select("dim", "block", "group")


def top_k(table: DataFrame, is_query: Column, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, pivots: int = PIVOTS, sample: int = SAMPLE, block: int = BLOCK, group: int = GROUP,
          leaf: int = LEAF) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every query; ``is_query``: a condition on ``id``."""
    spark = table.sparkSession
    rows = stored(vectors(table, id_col, vector_col, scale), "vectors")
    # bounded: `sample` rows of each of the LENGTHS commonest vector lengths; the first of them are the pivots
    order = Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id", F.xxhash64("v"))
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(LENGTHS).select("dim")
    few = rows.join(F.broadcast(common), "dim", "left_semi").select("dim", "id", "v", F.row_number().over(order).alias("n")).where(F.col("n") <= sample).collect()
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in sorted(few, key=lambda r: (r["dim"], r["n"])):
        known.setdefault(r["dim"], ([], []))
        known[r["dim"]][0].append(r["id"])
        known[r["dim"]][1].append(r["v"])
    known = {d: (np.array(i, np.int64), np.array(v, np.int64)) for d, (i, v) in known.items()}
    shared = spark.sparkContext.broadcast(known)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            cell = np.zeros(len(dims), np.int32)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) not in shared.value:
                    continue  # a rare length has one cell
                x = _matrix(b.column("v").take(pa.array(at))).astype(np.float64)
                c = shared.value[int(d)][1][:pivots].astype(np.float64)
                cell[at] = ((c ** 2).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("dim"), pa.array(cell), b.column("v")], names=["id", "dim", "cell", "v"])

    celled = stored(rows.mapInArrow(cells, "id long, dim int, cell int, v array<long>"), "cells")
    sizes = celled.groupBy("dim", "cell").agg(F.count("*").alias("n"))  # at most `pivots` rows a length
    parts = sizes.select(F.col("dim").alias("d"), F.col("cell").alias("c"), F.ceil(F.col("n") / (block * 0.8)).cast("int").alias("parts"))
    blocks = (celled.join(parts, (F.col("dim") == F.col("d")) & (F.col("cell") == F.col("c")))
              .withColumn("block", F.concat_ws("-", "dim", "cell", F.pmod(F.xxhash64("id", "v"), F.col("parts")))))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims = b.column("id").to_numpy(), b.column("dim").to_numpy()
            low = np.full(len(ids), np.iinfo(np.int64).min, np.int64)
            for i, (d, v) in enumerate(zip(dims.tolist(), b.column("v").to_pylist(), strict=True)):
                if d not in shared.value:
                    continue
                names, x = shared.value[d]
                s = (x[names != ids[i]] @ np.array(v, np.int64))
                if len(s) >= k:
                    low[i] = np.partition(s, len(s) - k)[len(s) - k]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "dim", "cell", "v")), pa.array(low)],
                                             names=["id", "dim", "cell", "v", "low"])

    asked = stored(celled.where(is_query).mapInArrow(floors, "id long, dim int, cell int, v array<long>, low long"), "queries")
    # groups of at most about `group` queries of neighbouring cells
    tally = asked.groupBy("dim", "cell").agg(F.count("*").alias("n"))
    running = Window.partitionBy("dim").orderBy("cell")
    share = tally.select(F.col("dim").alias("d"), F.col("cell").alias("c"), F.floor((F.sum("n").over(running) - F.col("n")) / group).alias("g"),
                         F.ceil(F.col("n") / group).cast("int").alias("parts"))
    groups = (asked.join(share, (F.col("dim") == F.col("d")) & (F.col("cell") == F.col("c")))
              .withColumn("group", F.concat_ws("-", "g", F.when(F.col("parts") > 1, F.concat_ws("/", "c", F.pmod(F.xxhash64("id", "v"), F.col("parts"))))))
              .select("id", "dim", "v", "low", "group"))
    groups = stored(groups, "groups")
    # a block and a group of one vector length meet unless their balls tell that no score can count
    blocks = stored(blocks.select("id", "dim", "v", "block"), "blocks")
    meeting = stored(pairs(balls(blocks, "block"), balls(groups, "group")), "pairs")
    left = blocks.join(meeting, ["dim", "block"]).select("id", "v", "block", "group")
    right = groups.join(meeting, ["dim", "group"]).select("id", "v", "low", "block", "group")

    def meet(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"query_id": [], "key": [], "vec_id": [], "score": []}).astype("int64")
        points, queries = points.sort_values("id", kind="stable"), queries.sort_values("id", kind="stable")
        q, ids = _matrix(queries["v"]), queries["id"].to_numpy()
        row, who, score = search(q, ids, queries["low"].to_numpy(), _matrix(points["v"]), points["id"].to_numpy(), k, leaf)
        return pd.DataFrame({"query_id": ids[row], "key": _fingerprint(q)[row], "vec_id": who, "score": score})

    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInPandas(
        meet, "query_id long, key long, vec_id long, score long")
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _fingerprint(q: np.ndarray) -> np.ndarray:
    """Tells apart queries that share an id."""
    with np.errstate(over="ignore"):
        weights = np.cumprod(np.full(q.shape[1], 0x9E3779B97F4A7C15, np.uint64))
        return (q.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)
