"""N-gram Jaccard self-join with token-combination prefixes, and its connected components.

A text's set holds its distinct five-word shingles (A-Z in lower case).  Two
texts link when ``100 * |intersection| >= 80 * |union|``.  Texts with the same
set form a class and are represented by one row from the first pass on.

*Order and classes.*  The number of classes that hold a shingle, counted over
the whole corpus, puts shingles in order: those of one class only come first
(they can't be shared), then rare ones (up to ``FREQUENT`` classes), then
frequent ones; ties by hash.  Linked sets have their smallest common shingle
within the first ``n - ceil(0.8 n) + 1`` shingles of both.

*Signatures.*  If that shingle is rare, it alone is the signature.  If it is
frequent, so are all common shingles, and single ones would gather huge
buckets.  Then the prefix is extended: at most ``d = n / 4`` shingles of both
sets together are not common, each of which parts two common neighbours, so
among the first ``(k - 1) (d + 1) + 1`` common shingles, if there are as many,
``k`` follow each other in both sets' lists of frequent shingles.  Runs of
``k`` in that extended prefix are the signatures, so there are no more of them
than shingles.  At 80 % sets of 18 shingles or more have common shingles
enough for ``k = 4``, smaller ones for 3, 2 or 1 (``levels``); sets near the
border of two levels have the signatures of both.

*Pruning.*  A set with more than its prefix of unshared shingles has no
links at all.  A pair must have fitting sizes, and its symmetric difference
is at most ``(n1 + n2) / 9``.  Unshared shingles count towards that, and so
do the bits in which the parities of the sets' shared shingles differ.

*Verification in two rounds.*  Each bucket compares all members with its
member of the fewest unshared shingles.  The links found are contracted to
components; what is left are pairs of a bucket in different components, and
those are compared one by one.  Pairs within a component need no comparison,
so a group of near copies costs its size, not its square.  Verification
counts the intersection of the whole sets; a set travels once to each
``MEMBERS`` sets that it is compared with.

*Copies.*  Classes are told apart by 128 bits.  Rows of classes with more than
a thousandth of all rows (fewer than 1000 of them) get their component by a
broadcast join, so no task gathers a large group of copies.

*Counting without hot tasks.*  Blocks of texts send the distinct shingles of
each hash partition with the texts that hold them in packed arrays; a
shingle held by more than ``FREQUENT`` texts of one block is frequent as it
stands and travels as a mere count, so hot shingles are pre-aggregated.

Defined cases: null, empty and blank texts have no shingles, no links and
their own ``doc_id`` as component.  A text with one to four words has one
shingle.  Rows with null ids take part; a component's id is its smallest
id, null if there is none.  Rows with equal ids are texts of their own.  An
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshard.llm.common import pieces, release, stored
from lakeshard.llm.hashing import mix, shingles, word_hashes

SHINGLE = 5
#: similarity at which texts link, in hundredths
THRESHOLD = 80
#: a shingle of more classes is frequent
FREQUENT = 16
#: shingles that one hash partition holds, about
PARTITION = 800_000
#: bytes of text in a block
BLOCK = 4 << 20
#: most frequent shingles in one signature
COMBINE = 4
#: sets that are compared with one copy of another, about
MEMBERS = 64
#: a class with more than this share of all rows is joined by broadcast
HOT_SHARE = 1 / 1000
#: bytes of a class
_WIDE = 16


def class_of(s: np.ndarray) -> tuple[int, bytes]:
    """Size and 128-bit fingerprint of a set; the empty set has zero bytes."""
    if not len(s):
        return 0, bytes(_WIDE)
    with np.errstate(over="ignore"):
        key = np.array([s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64), mix(s + np.uint64(len(s))).sum(dtype=np.uint64)], np.uint64)
        return len(s), np.array([mix(key[:1] + mix(key[2:]))[0], mix(key[1:2] + mix(key[2:] + np.uint64(1)))[0]], np.uint64).tobytes()


def levels(threshold: int, combine: int = COMBINE) -> list[tuple[int, int, float]]:
    """``k, least, below``: sets of ``least <= n < below`` shingles have runs of ``k`` frequent shingles as signatures.

    Linked sets of ``s`` shingles together hold at most ``d = r s`` that are
    not common, ``r = (100 - t) / (100 + t)``, hence ``(s - d) / 2`` common
    ones.  A common run of ``k`` needs ``(k - 1) (d + 1) + 1`` of them, which
    ``s (1 - (2k - 1) r) >= 2k`` grants; ``least`` is half of that ``s``.  Two
    linked sets share the largest ``k`` whose ``least`` neither is below, as
    one of them is below the next ``least`` and the other no more than
    ``100 / t`` times as large.
    """
    rest, whole = 100 - threshold, 100 + threshold
    most = max(k for k in range(1, combine + 1) if k == 1 or (2 * k - 1) * rest < whole)
    least = {k: -(-k * whole // (whole - (2 * k - 1) * rest)) if k > 1 else 1 for k in range(1, most + 1)}
    return [(k, least[k], 100 * least[k + 1] / threshold if k < most else float("inf")) for k in least]


def _sets(texts, k: int):
    words, counts = word_hashes(texts, fold=True)
    at = 0
    for n in counts.tolist():
        yield shingles(words[at:at + n], k)
        at += n


def classes(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """``doc_id, n_shingles, class`` of every row; ``hashed`` adds ``text_hash``, which tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            got = [class_of(s) for s in _sets(b.column("text").to_pylist(), k)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, _ in got], pa.int64()), pa.array([c for _, c in got], pa.binary()), *b.columns[2:]],
                names=["doc_id", "n_shingles", "class", *b.schema.names[2:]])

    narrow, schema = _narrow(docs, id_col, text_col), "doc_id long, n_shingles long, class binary"
    if hashed:
        narrow, schema = narrow.withColumn("text_hash", F.xxhash64("text")), schema + ", text_hash long"
    return narrow.mapInArrow(run, schema)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


# -- shingles to signatures ------------------------------------------------

_PACKED = "key int, block long, kind int, ids binary, owner binary, count binary"


def _pack(key, block, kind, ids, owner, count):
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int32()), pa.array(block, pa.int64()), pa.array(kind, pa.int32()),
         *(pa.array([x.tobytes() for x in col], pa.binary()) for col in (ids, owner, count))],
        names=["key", "block", "kind", "ids", "owner", "count"])


def _send(k: int, parts: int, frequent: int):
    """Blocks of texts to packed rows.

    Kind 0: a block's classes (``ids``) and set sizes (``count``).  Kind 1:
    of one hash partition, shingles (``ids``), how many texts of the block
    hold each (``count``), and those texts (``owner``, nothing for a
    shingle above ``frequent``).  Kind 2: shingle and text of the latter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        block = 0
        for b in pieces(batches, limit=BLOCK):
            seen: dict[bytes, int] = {}
            sets, sizes = [], []
            for small in pieces(iter([b])):
                for s in _sets(small.column("text").to_pylist(), k):
                    n, c = class_of(s)
                    if n and c not in seen:
                        seen[c] = len(seen)
                        sets.append(s)
                        sizes.append(n)
            if not sets:
                continue
            name = (task << 32) + block
            block += 1
            sizes = np.array(sizes, np.int64)
            ids = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
            order = np.argsort(ids, kind="stable")
            ids, owner = ids[order], owner[order]
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            count = np.diff(np.append(first, len(ids)))
            loud = np.repeat(count > frequent, count)
            if len(sets) <= 1 << 16:
                owner = owner.astype(np.uint16)
            # hash partitions are ranges of the sorted shingles
            edge = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
            a = np.concatenate(([0], np.searchsorted(ids[first], edge), [len(first)]))
            f = np.append(first, len(ids))
            count = np.minimum(count, 0xFFFF).astype(np.uint16)
            rows = [(p, name, 1, ids[first[a[p]:a[p + 1]]], owner[f[a[p]]:f[a[p + 1]]][~loud[f[a[p]]:f[a[p + 1]]]],
                     count[a[p]:a[p + 1]]) for p in np.flatnonzero(np.diff(a)).tolist()]
            rows.append((int(mix(np.array([name], np.uint64))[0] % np.uint64(parts)), name, 0,
                         np.frombuffer(b"".join(seen), np.uint8), np.zeros(0, np.uint16), sizes))
            if loud.any():
                rows.append((rows[-1][0], name, 2, ids[loud], owner[loud], np.zeros(0, np.uint16)))
            for at in range(0, len(rows), 64):
                yield _pack(*zip(*rows[at:at + 64], strict=True))

    return run


def _shared(frequent: int):
    """A hash partition's rows of kind 1 to rows of shared shingles; other kinds pass."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rest, mine = pdf[pdf["kind"] != 1], pdf[pdf["kind"] == 1]
        out = [rest]
        if len(mine):
            ids = [np.frombuffer(x, np.uint64) for x in mine["ids"]]
            count = [np.frombuffer(x, np.uint16).astype(np.int64) for x in mine["count"]]
            uniq, where = np.unique(np.concatenate(ids), return_inverse=True)
            total = np.bincount(where, weights=np.concatenate(count))
            at, rows = 0, []
            for (block, raw), i, c in zip(zip(mine["block"], mine["owner"], strict=True), ids, count, strict=True):
                n = total[where[at:at + len(i)]]
                at += len(i)
                quiet = c <= frequent
                keep = np.repeat((n > 1)[quiet], c[quiet])
                owner = np.frombuffer(raw, np.uint16 if len(raw) == 2 * len(keep) else np.uint32)[keep]
                if len(owner):
                    rows.append((0, block, 1, np.repeat(i[quiet], c[quiet])[keep].tobytes(), owner.astype(np.uint32).tobytes(),
                                 np.repeat((n > frequent)[quiet], c[quiet])[keep].tobytes()))
            out.append(pd.DataFrame(rows, columns=list(pdf.columns)))
            del ids, count, uniq, where, total, rows
            release()
        return pd.concat(out, ignore_index=True)

    return run


#: longs of parity bits of a set's shared shingles
_BITS = 8
_SIGNED = "sig long, class binary, n long, unshared long, " + ", ".join(f"p{i} long" for i in range(_BITS))


def _sign(threshold: int, combine: int):
    """A block's rows to ``sig, class, n, unshared`` and, once a class, its parity bits."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["kind"] == 0].iloc[0]
        size = np.frombuffer(head["count"], np.int64)
        name = np.array([head["ids"][at:at + _WIDE] for at in range(0, _WIDE * len(size), _WIDE)], object)
        ids, owner, loud = [], [], []
        for kind, i, o, c in zip(pdf["kind"], pdf["ids"], pdf["owner"], pdf["count"], strict=True):
            if kind:
                i = np.frombuffer(i, np.uint64)
                ids.append(i)
                owner.append(np.frombuffer(o, np.uint16 if len(o) == 2 * len(i) else np.uint32).astype(np.int64))
                loud.append(np.frombuffer(c, bool) if kind == 1 else np.ones(len(i), bool))
        none = np.zeros(0, np.int64)
        sig, who, un, bits = none, none, none, np.zeros((0, _BITS), np.int64)
        if ids:
            ids, owner, loud = np.concatenate(ids), np.concatenate(owner), np.concatenate(loud)
            order = np.lexsort((ids, loud, owner))
            ids, owner, loud = ids[order], owner[order], loud[order]
            held = np.bincount(owner, minlength=len(name))
            unshared = size - held
            begin = np.cumsum(held) - held
            rank = np.arange(len(ids)) - begin[owner]
            prefix = size - -(-threshold * size // 100) + 1 - unshared  # what of the prefix is left for shared shingles
            rare = np.bincount(owner[~loud], minlength=len(name))
            single = ~loud & (rank < prefix[owner])
            sig, who = [ids[single]], [owner[single]]
            # the extended prefix, in frequent shingles; the rare and the unshared are no common ones then
            other = np.maximum(size * (100 - threshold) // threshold - unshared - rare, 0)
            place = rank - rare[owner]
            for k, least, below in levels(threshold, combine):
                room = prefix - 1 - rare + (k - 1) * (other + 1) + 1
                here = (prefix > rare) & (size >= least) & (size < below)
                run = np.flatnonzero(loud & here[owner] & (place + k <= room[owner]))
                run = run[run + k <= len(ids)]
                run = run[owner[run + k - 1] == owner[run]]
                joint = ids[run]
                with np.errstate(over="ignore"):
                    for step in range(1, k):
                        joint = mix(joint * np.uint64(0x9E3779B97F4A7C15) + mix(ids[run + step]))
                sig.append(joint)
                who.append(owner[run])
            sig, who = np.concatenate(sig).view(np.int64), np.concatenate(who)
            un = unshared[who]
            width = 64 * _BITS
            odd = np.bincount(owner * width + (mix(ids) % np.uint64(width)).astype(np.int64), minlength=len(name) * width) & 1
            parity = np.packbits(odd.astype(np.uint8).reshape(-1, width), axis=1).view(np.int64)
            order = np.lexsort((sig, who))
            sig, who, un = sig[order], who[order], un[order]
            first = np.concatenate(([True], who[1:] != who[:-1]))[: len(who)]
            bits = np.ma.MaskedArray(parity[who], np.repeat(~first[:, None], _BITS, axis=1))
        out = pd.DataFrame({"sig": sig, "class": name[who], "n": size[who], "unshared": un})
        for i in range(_BITS):
            column = bits[:, i]
            out[f"p{i}"] = pd.array(np.asarray(column), "Int64")
            out.loc[np.ma.getmaskarray(column), f"p{i}"] = pd.NA
        return out

    return run


def signatures(docs: DataFrame, known: DataFrame, *, k: int = SHINGLE, threshold: int = THRESHOLD, frequent: int = FREQUENT,
               partition: int = PARTITION, combine: int = COMBINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sig, class, n, unshared`` of all classes that may have links.  ``known``: the stored result of ``classes``."""
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(4, -(-total // partition))
    # one row of each class is enough; classes without ids keep all their rows, which does no harm
    first = known.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    other = (known.where("n_shingles > 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("again")).distinct()
             .join(first.select(F.col("first").alias("again")), "again", "left_anti"))
    spare = stored(other, "again")
    texts = _narrow(docs, id_col, text_col)
    texts = texts.join(spare, texts["doc_id"] == spare["again"], "left_anti")
    packed = texts.mapInArrow(_send(k, parts, frequent), _PACKED)
    shared = packed.groupBy("key").applyInPandas(_shared(frequent), _PACKED)
    return shared.groupBy("block").applyInPandas(_sign(threshold, combine), _SIGNED).distinct()


_PARITY = [f"p{i}" for i in range(_BITS)]


# -- pairs -----------------------------------------------------------------

def _fits(threshold: int):
    """Sizes and unshared shingles that a link allows, for columns ``n, unshared`` and ``n2, unshared2``."""
    t = F.lit(threshold)
    return ((F.least("n", "n2") * 100 >= F.greatest("n", "n2") * t)
            & ((F.col("unshared") + F.col("unshared2")) * (100 + t) <= (F.col("n") + F.col("n2")) * (100 - t)))


def verified(pairs: DataFrame, docs: DataFrame, known: DataFrame, *, k: int, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``pairs`` (``a, b``: classes) whose whole sets link."""
    need = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    rows = stored(known.groupBy("class").agg(F.min("doc_id").alias("doc")).join(need, "class", "left_semi"), "need")
    wanted = rows.where("doc IS NOT NULL").select(F.col("doc").alias("want")).distinct()
    texts = _narrow(docs, id_col, text_col)
    found = texts.join(wanted, texts["doc_id"] == wanted["want"], "left_semi")
    if not rows.where("doc IS NULL").isEmpty():  # classes whose rows all lack an id
        found = found.unionByName(texts.where("doc_id IS NULL"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            got = list(_sets(b.column("text").to_pylist(), k))
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s)[1] for s in got], pa.binary()),
                                              pa.array([s.tobytes() for s in got], pa.binary())], names=["class", "set"])

    sets = stored(found.mapInArrow(run, "class binary, set binary").groupBy("class").agg(F.any_value("set").alias("set")), "sets")

    # each set b goes once to every part of its partners, ahead of them
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    dealt = stored(pairs.join(many, "b").select("a", "b", F.pmod(F.xxhash64("a"), "parts").alias("part")), "dealt")
    ahead = dealt.select(F.lit(None).cast("binary").alias("a"), "b", "part").distinct().join(sets.withColumnRenamed("class", "b"), "b")
    after = dealt.join(sets.withColumnRenamed("class", "a"), "a")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, x = None, None
        for batch in batches:
            good = []
            for a, b, part, y in zip(*(batch.column(c) for c in ("a", "b", "part", "set")), strict=True):
                y, key = np.frombuffer(y.as_buffer(), np.uint64), (b.as_py(), part.as_py())
                if not a.is_valid:
                    at, x = key, y.copy()
                elif at != key:
                    raise RuntimeError("a pair lacks a set")
                else:
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * same >= threshold * (len(x) + len(y) - same))
                    continue
                good.append(False)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    rows = ahead.unionByName(after).select("a", "b", "part", "set")
    return (rows.repartition("b", "part").sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
            .mapInArrow(links, "a binary, b binary"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``); ``root`` is the smallest node reachable.

    Every node takes the smallest root among its own and its neighbours',
    then the root of that root, until nothing changes; each round is a join
    and a pre-aggregated minimum, stored in the shared folder.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    root = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        seen = both.join(root.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = root.join(seen, "node").select("node", F.least("root", "near").alias("root"))
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
        after = stored(step.join(jump, "root", "left").select("node", F.coalesce("far", "root").alias("root")), "roots")
        changed = after.join(root.select("node", F.col("root").alias("was")), "node").where("root <> was").isEmpty()
        root = after
        if changed:
            return root


def linked(docs: DataFrame, known: DataFrame, *, k: int = SHINGLE, threshold: int = THRESHOLD, frequent: int = FREQUENT,
           partition: int = PARTITION, combine: int = COMBINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``node, root`` of every class that links to another."""
    how = {"k": k, "threshold": threshold, "id_col": id_col, "text_col": text_col}
    sigs = stored(signatures(docs, known, frequent=frequent, partition=partition, combine=combine, **how), "signatures")
    centre = (sigs.groupBy("sig").agg(F.count("*").alias("size"), F.min(F.struct("unshared", "n", "class")).alias("c"))
              .where("size > 1").select("sig", F.col("c.class").alias("b"), F.col("c.n").alias("n2"), F.col("c.unshared").alias("unshared2")))
    centre = stored(centre, "centres")
    star = sigs.join(centre, "sig").where(F.col("class") != F.col("b")).where(_fits(threshold)).select(F.col("class").alias("a"), "b").distinct()
    star = stored(star, "star")
    edges = stored(verified(star, docs, known, **how), "links")
    root = components(edges)

    # members of a bucket outside its centre's component, against the bucket's members in other components
    name = root.select(F.col("node").alias("class"), "root")
    plain = sigs.drop(*_PARITY)
    member = (plain.join(centre.select("sig", F.col("b").alias("centre")), "sig").join(name, "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    member = stored(member, "members")
    home = member.where(F.col("class") == F.col("centre")).select("sig", F.col("root").alias("home"))
    placed = member.join(home, "sig")
    out = placed.where(F.col("root") != F.col("home"))
    # parity bits of the shared shingles bound the symmetric difference from below
    bits = stored(sigs.where("p0 IS NOT NULL").select("class", *_PARITY).distinct(), "parity")
    out = stored(out.join(bits, "class"), "open")
    other = (placed.join(out.select("sig").distinct(), "sig", "left_semi").join(bits, "class")
             .select("sig", F.col("class").alias("class2"), F.col("root").alias("root2"), F.col("home").alias("home2"), F.col("n").alias("n2"),
                     F.col("unshared").alias("unshared2"), *[F.col(p).alias(f"{p}_2") for p in _PARITY]))
    apart = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_2"))) for p in _PARITY), F.col("unshared") + F.col("unshared2"))
    once = (F.col("root2") == F.col("home2")) | (F.col("class") < F.col("class2"))
    fits = ((F.col("root") != F.col("root2")) & (F.col("class2") != F.col("centre")) & once & _fits(threshold)
            & (apart * (100 + threshold) <= (F.col("n") + F.col("n2")) * (100 - threshold)))
    late = (out.join(other, "sig").where(fits)
            .select(F.least("class", "class2").alias("a"), F.greatest("class", "class2").alias("b")).distinct())
    late = stored(late.join(star.select("a", "b").union(star.select("b", "a")), ["a", "b"], "left_anti"), "late")
    if late.isEmpty():
        return root
    more = stored(verified(late, docs, known, **how), "links")
    return components(edges.union(more)) if not more.isEmpty() else root


def _lowest(known: DataFrame, root: DataFrame, key) -> DataFrame:
    """``known`` with ``low``: of classes with shingles, the smallest ``key`` of their component's rows; else null."""
    smallest = known.where("n_shingles > 0").groupBy("class").agg(F.min(key).alias("low"), F.count("*").alias("copies"))
    named = smallest.join(root, F.col("class") == F.col("node"), "left").select("class", F.coalesce("root", "class").alias("root"), "low", "copies")
    # a component may hold many classes; its minimum is pre-aggregated
    low = named.groupBy("root").agg(F.min("low").alias("component_low"))
    names = stored(named.join(low, "root").select(F.col("class").alias("c"), F.col("component_low").alias("low"), "copies"), "components")
    # fewer than 1 / HOT_SHARE classes can be hot
    hot = names.where(F.col("copies") > HOT_SHARE * known.count()).select("c", F.struct("low").alias("hot"))
    marked = known.join(F.broadcast(hot), (F.col("class") == F.col("c")) & (F.col("n_shingles") > 0), "left").drop("c")
    cold = marked.where("hot IS NULL").drop("hot").join(
        names.select("c", "low"), (F.col("class") == F.col("c")) & (F.col("n_shingles") > 0), "left").drop("c")
    return marked.where("hot IS NOT NULL").withColumn("low", F.col("hot.low")).drop("hot").unionByName(cold)


def link_classes(docs: DataFrame, *, k: int = SHINGLE, threshold: int = THRESHOLD, frequent: int = FREQUENT, partition: int = PARTITION,
                 combine: int = COMBINE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    known = stored(classes(docs, k, id_col, text_col), "classes")
    root = linked(docs, known, k=k, threshold=threshold, frequent=frequent, partition=partition, combine=combine, id_col=id_col, text_col=text_col)
    return _lowest(known, root, F.col("doc_id")).select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, *, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One text of each component; rows without words stay.

    It is the one with the smallest id (null comes last), of several texts
    under that id the one with the smallest hash.  Rows go by id and text, so
    another text under a removed row's id stays; so do repeats of a kept row.
    """
    known = stored(classes(docs, k, id_col, text_col, hashed=True), "classes")
    root = linked(docs, known, k=k, id_col=id_col, text_col=text_col, **params)
    key = F.struct(F.col("doc_id").isNull().alias("lacks"), F.col("doc_id").alias("doc"), F.col("text_hash").alias("hash"))
    gone = (_lowest(known.where("n_shingles > 0"), root, key)
            .where(~(F.col("doc_id").eqNullSafe(F.col("low.doc")) & (F.col("text_hash") == F.col("low.hash"))))
            .select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_hash")).distinct())
    gone = stored(gone, "gone")
    rows = docs.withColumn("_text_hash", F.xxhash64(F.col(text_col)))
    same = rows[id_col].cast("long").eqNullSafe(gone["_gone"]) & (rows["_text_hash"] == gone["_gone_hash"])
    return rows.join(gone, same, "left_anti").drop("_text_hash")
