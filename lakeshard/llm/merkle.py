"""Merkle manifest of a table: a proof for every row, by a cogrouped exchange of subtrees.

A row's leaf is the SHA-256 of its fields.  The leaves of a source, in the
order of their ids, are hashed in runs of 16 until one node, the subroot,
remains; the subroots, in the order of their sources, give the root alike.

1. Leaves are made in the JVM; only ids, sources and digests travel from there.
2. Places within a source come from a range exchange and the counts of its
   partitions, so no task holds a whole source.
3. 16 * 16 * 16 neighbouring nodes are a superblock.  Superblocks are reduced
   to one node each, and so on over the few that remain, up to the root.
4. On the way down the nodes of a superblock are cogrouped with the siblings
   that its own top node has further up, one row a superblock.  One function
   finishes the local reduction, joins local and outer siblings to a proof and
   folds the leaf that was read (or tampered with) to a root.

Every group holds 4096 nodes at most, every step above has 4096 times fewer
rows, and all steps cut their lineage in the shared folder.

Defined cases: null fields count as ``-``, so null and empty texts differ; a
null id comes first in its source and is never tampered with; rows of one
source and id stand in the order of their leaves, and rows alike in all
fields are interchangeable.  A lone leaf is its subroot, a lone subroot the
root; an empty table gives no rows.  Columns beside the five fields do not
matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshard.llm.common import stored

#: children of a node; levels and nodes of a superblock
FAN = 16
LEVELS = 3
BLOCK = FAN**LEVELS
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NODES = "g string, pos long, n long, digest string"
_PATHS = "g string, pos long, name string, digest string, path array<string>, root string, subroot string"
_PROOFS = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaves(docs: DataFrame, tamper: int = 5) -> DataFrame:
    """``g, doc_id, digest, changed``: the digest of each row, and that of its changed form or null.

    ``g`` orders sources as bytes, with null first.  The text of rows whose
    crc32 of the id ``tamper`` divides is changed to lower case (A-Z).
    """
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper == 0
    digest = lambda text: F.sha2(F.concat(*map(field, [*row, text])), 256)
    return docs.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("g"),
                       F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"),
                       F.when(hit, digest(F.translate(F.col("text"), UPPER, UPPER.lower()))).alias("changed"))


def placed(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Add ``pos`` (the place of a row among those of its ``g``) and ``n`` (their number); the largest ``n``.

    Rows are dealt by ranges of ``(g, *order)``; a place is the rows of the
    ranges before plus the place within the range.
    """
    by = ["g", *order, "tie"]
    low = (1 << 33) - 1  # the id of Spark: partition number, then row number
    ranged = (rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
              .drop("tie").withColumn("at", F.monotonically_increasing_id())
              .withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit(low))))
    ranged = stored(ranged, name)
    w = Window.partitionBy("g")
    counts = (ranged.groupBy("g", "part").agg(F.count("*").alias("here"), F.min("at").alias("first"))
              .withColumn("n", F.sum("here").over(w))
              .withColumn("before", F.sum("here").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))))
    counts = stored(counts.select("g", "part", "n", (F.coalesce("before", F.lit(0)) - F.col("first")).alias("shift")), f"{name}-counts")
    widest = counts.agg(F.max("n")).first()[0] or 0
    out = ranged.join(counts, ["g", "part"]).withColumn("pos", F.col("at") + F.col("shift"))
    return out.drop("part", "at", "shift"), widest


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _reduced(digests: list[str], n: int) -> list[list[str]]:
    """All levels of a superblock, its top node last; ``n``: nodes of the whole tree at this height."""
    levels = [digests]
    while len(levels) <= LEVELS if n > BLOCK else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_hash("".join(last[a:a + FAN])) for a in range(0, len(last), FAN)])
    return levels


def _siblings(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """Of each node of each level but the top one, what stands left and right of it in its run."""
    out = []
    for nodes in levels[:-1]:
        runs = [nodes[a:a + FAN] for a in range(0, len(nodes), FAN)]
        out.append([("".join(r[:i]), "".join(r[i + 1:])) for r in runs for i in range(len(r))])
    return out


def _paths(levels: list[list[str]], outer: list[str]) -> Iterator[list[str]]:
    """Of each node of a superblock, the left and right siblings of every level up to the root."""
    around = _siblings(levels)
    for i in range(len(levels[0])):
        yield [s for k, at in enumerate(around) for s in at[i // FAN**k]] + outer


def fold(digest: str, path: list[str]) -> str:
    """The root that a node and its siblings give."""
    for k in range(0, len(path), 2):
        digest = _hash(path[k] + digest + path[k + 1])
    return digest


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).groupBy("g", "block")


def _top(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    n = int(nodes["n"].iloc[0])
    digest = _reduced(nodes["digest"].tolist(), n)[-1][0]
    return pd.DataFrame({"g": [key[0]], "pos": [key[1]], "n": [math.ceil(n / BLOCK)], "digest": [digest]})


def _tower(nodes: DataFrame, widest: int) -> list[DataFrame]:
    """The nodes, their superblocks, the superblocks of these, until every ``g`` has one node."""
    tower = [nodes]
    while widest > 1:
        above = _blocks(tower[-1].select("g", "pos", "n", "digest")).applyInPandas(_top, _NODES)
        tower.append(stored(above, "merkle-nodes"))
        widest = math.ceil(widest / BLOCK)
    return tower


def _proved(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Paths of the nodes of a superblock."""
    nodes, top = nodes.sort_values("pos"), above.iloc[0]
    levels = _reduced(nodes["digest"].tolist(), int(nodes["n"].iloc[0]))
    out = nodes[["g", "pos", "name", "digest"]].copy()
    out["path"] = list(_paths(levels, list(top["path"])))
    return out.assign(root=top["root"], subroot=top["subroot"])


def _folded(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proofs of the leaves of a superblock."""
    nodes, top = nodes.sort_values("pos"), above.iloc[0]
    levels = _reduced(nodes["digest"].tolist(), int(nodes["n"].iloc[0]))
    proof, folded = [], []
    for path, read in zip(_paths(levels, list(top["path"])), nodes["changed"].fillna(nodes["digest"]).tolist(), strict=True):
        proof.append(_hash("".join(path)))
        folded.append(fold(read, path))
    return pd.DataFrame({"doc_id": nodes["doc_id"], "leaf": nodes["digest"], "subroot": top["subroot"], "root": top["root"],
                         "proof_sha256": proof, "folded_root": folded})


def _down(tower: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the lowest nodes but one of ``tower`` from those of the topmost; one row a node."""
    for nodes in reversed(tower):
        if "name" not in nodes.columns:
            nodes = nodes.withColumn("name", F.lit(None).cast("string"))
        above = paths.select("g", F.col("pos").alias("block"), "path", "root", "subroot").groupBy("g", "block")
        paths = stored(_blocks(nodes).cogroup(above).applyInPandas(_proved, _PATHS), "merkle-paths")
    return paths


def manifest(docs: DataFrame, tamper: int = 5) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``proof_sha256`` digests the siblings from the leaf to the root; the
    proof is checked by folding the row (changed where ``tamper`` divides the
    crc32 of its id) with them: ``folded_root``, ``verified``.
    """
    rows, widest = placed(stored(leaves(docs, tamper), "merkle-leaves"), ["doc_id", "digest"], "merkle-placed")
    rows = stored(rows.withColumn("doc_id", F.col("doc_id").cast("string")), "merkle-rows")  # pandas has no null among integers
    tower = _tower(rows, widest)
    subroots = tower[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    sources, many = placed(subroots, ["name"], "merkle-sources")
    outer = _tower(stored(sources, "merkle-subroots"), many)
    root = outer[-1].select("g", "pos", F.array().cast("array<string>").alias("path"), F.col("digest").alias("root"),
                            F.lit(None).cast("string").alias("subroot"))
    # the topmost table holds the root alone, so paths begin below it
    known = _down(outer[:-1], root) if len(outer) > 1 else root.join(outer[0].select("g", "name", "digest"), "g")
    paths = known.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), "path", "root", F.col("digest").alias("subroot"))
    paths = _down(tower[1:-1], paths)
    above = paths.select("g", F.col("pos").alias("block"), "path", "root", "subroot").groupBy("g", "block")
    proofs = _blocks(rows).cogroup(above).applyInPandas(_folded, _PROOFS)
    return proofs.withColumns({"doc_id": F.col("doc_id").cast("long"), "verified": F.col("folded_root") == F.col("root")})
