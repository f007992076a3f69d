"""Mixing sources to target weights over a time-varying curriculum (DataFrame functions).

Every source has a weight schedule: a piecewise linear function of training
time ``t`` in 0..1.  Its integral is the source's weight.  The mix takes
``budget_share`` of all words; the weights share them out, no source gives
more than ``max_epochs`` times its size, and the excess is reshared by weight
among the others until none is above (``targets``).

A source's documents stand in a fixed random order (a hash of the id), one
epoch after the other, and give its target words.  The source's demand up to
time ``t`` is its target times the share of the schedule's integral up to
``t``; the time at which the demand reaches a copy's middle word is that
copy's training position, found by inverting the integral in closed form.
The result is sorted by ranges of that position.

Offsets in a source are prefix sums in two levels: sums of the hash buckets of
each source, then a window inside each bucket.  There is a bucket for every
``BUCKET_ROWS`` rows of the table, so no task holds a source, however hot.
Sources are numbered and filled by running sums over ranges (``running``), so
there may be as many of them as the table has hosts.

Sizes count words ``[^\\x20\\x09-\\x0D]+``.  The last copy that a source gives
is cut at the target: ``taken`` words of it belong to the mix.

Defined cases: null text has size 0.  A null source is a source of its own,
last in order.  Null ids are ordered by their text instead.  Repeated rows
are documents of their own.  Documents without words, and sources without
words, take nothing.  An empty table gives an empty result.  Extra columns
stay with their documents in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshard.llm.common import stored
from lakeshard.operators.prefix import running

BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
#: hash buckets of a source: one for so many rows of the table, ``BUCKETS`` at least
BUCKET_ROWS = 100_000
BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"

Schedule = list[tuple[float, float]]

#: weights 5, 2 and 1: early, level and late in training; sources take them in turn
CURRICULUM: list[Schedule] = [[(0.0, 8.0), (1.0, 2.0)], [(0.0, 2.0), (1.0, 2.0)], [(0.0, 0.5), (0.5, 0.5), (1.0, 2.5)]]


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def _by_turn(turn: Column, values: list) -> Column:
    out = F.lit(values[-1])
    for k, v in list(enumerate(values))[-2::-1]:
        out = F.when(turn == k, F.lit(v)).otherwise(out)
    return out


def position(turn: Column, share: Column, schedules: list[Schedule]) -> Column:
    """Time at which a source has been asked for ``share`` (0..1) of its words."""
    out = F.lit(None).cast("double")
    for k, s in enumerate(schedules):
        area, at = share * F.lit(integral(s)), 0.0
        inverse = F.lit(s[-1][0])
        steps = []
        for (t0, w0), (t1, w1) in zip(s, s[1:]):
            steps.append((t0, t1, w0, (w1 - w0) / (t1 - t0), at, at + (t1 - t0) * (w0 + w1) / 2))
            at = steps[-1][-1]
        for t0, t1, w0, slope, low, high in reversed(steps):
            rest = area - F.lit(low)
            root = F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
            x = F.when(root > 0, F.lit(2.0) * rest / root).otherwise(F.lit(0.0))
            inverse = F.when(area < F.lit(high), F.least(F.lit(t0) + x, F.lit(t1))).otherwise(inverse)
        out = F.when(turn == k, inverse).otherwise(out)
    return out


def targets(sizes: DataFrame, schedules: list[Schedule], budget_share: float = BUDGET_SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, turn, target)`` from ``(source, source_size)``, one row a source.

    Sources are filled in the order of cap by weight: those whose cap lies
    below their share keep the cap, the others split the rest by weight.
    """
    weights = [float(integral(s)) for s in schedules]
    if min(weights) <= 0:
        raise ValueError("every schedule needs a positive integral")
    source = F.col("source").asc_nulls_last()
    ranked = running(sizes, [], [source], row_number="number").withColumn("turn", (F.col("number") - 1) % len(schedules))
    ranked = (ranked.withColumn("weight", _by_turn(F.col("turn"), weights))
              .withColumn("cap", F.col("source_size") * F.lit(max_epochs)).withColumn("rate", F.col("cap") / F.col("weight")))
    filled = stored(running(ranked, [], ["rate", source], sums={"cap_so_far": "cap", "weight_so_far": "weight"}), "mix-fill")
    words, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    before = F.col("cap_so_far") - F.col("cap")
    level = (F.lit(float(words or 0) * budget_share) - before) / (F.lit(weight or 0.0) - (F.col("weight_so_far") - F.col("weight")))
    # the first source whose cap lies above its share sets the level of all that follow
    free = filled.select(before.alias("before"), level.alias("level"), "rate").where("rate > level")
    fill = free.agg(F.min(F.struct("before", "level"))["level"]).first()[0]
    cap = F.col("cap").cast("double")
    return filled.select("source", "source_size", "turn", (
        cap if fill is None else F.least(cap, F.lit(fill) * F.col("weight"))).alias("target"))


def offsets(docs: DataFrame, schedules: list[Schedule], budget_share: float, max_epochs: int, id_col: str,
            text_col: str, source_col: str, payload: list[str]) -> DataFrame:
    """``row`` (the payload), ``size``, its offset in its source, and the source's size, turn and target."""
    buckets = max(BUCKETS, -(-docs.count() // BUCKET_ROWS))
    keyed = docs.select(
        F.struct(*payload).alias("row"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit("")).cast("binary")).alias("key"),
    ).withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / F.lit(float(1 << 32))))
    if text_col not in payload:  # narrow: count the words once
        keyed = stored(keyed, "mix")
    sums = stored(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-sums")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                         F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), schedules, budget_share,
                    max_epochs).withColumnRenamed("source", "g")
    plan = stored(starts.join(goals, F.col("s").eqNullSafe(F.col("g"))).drop("g"), "mix-plan")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "size", "id").rowsBetween(Window.unboundedPreceding, -1)
    return (keyed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
            .select("row", "size", (F.col("start") + F.col("before")).alias("offset"), "source_size", "turn", "target",
                    F.floor("target").alias("goal")))


def _copy_words(epoch: Column) -> Column:
    left = F.col("goal") - epoch * F.col("source_size") - F.col("offset")
    return F.greatest(F.least(F.col("size"), left), F.lit(0).cast("long"))


def _copy_position(epoch: Column, schedules: list[Schedule]) -> Column:
    middle = epoch * F.col("source_size") + F.col("offset") + _copy_words(epoch) / 2
    return F.when(_copy_words(epoch) > 0, position(F.col("turn"), middle / F.col("goal"), schedules))


def plan_mix(docs: DataFrame, schedules: list[Schedule] = CURRICULUM, *, budget_share: float = BUDGET_SHARE,
             max_epochs: int = MAX_EPOCHS, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, position`` of its first copy, in training order."""
    rows = offsets(docs, schedules, budget_share, max_epochs, id_col, text_col, source_col, [id_col])
    taken = sum((_copy_words(F.lit(e).cast("long")) for e in range(1, max_epochs)), _copy_words(F.lit(0).cast("long")))
    return (rows.select(F.col("row")[id_col].alias("doc_id"), "size", "source_size", "target", taken.alias("taken"),
                        _copy_position(F.lit(0).cast("long"), schedules).alias("position"))
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def mix(docs: DataFrame, schedules: list[Schedule] = CURRICULUM, *, budget_share: float = BUDGET_SHARE,
        max_epochs: int = MAX_EPOCHS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        ordered: bool = True) -> DataFrame:
    """The training set: the columns of ``docs``, a row for each copy, in training order.

    A copy of which the mix takes only part has its text cut after its last
    word taken; there is at most one such copy a source.
    """
    rows = offsets(docs, schedules, budget_share, max_epochs, id_col, text_col, source_col, docs.columns)
    copies = (rows.withColumn("epoch", F.explode(F.array(*[F.lit(e).cast("long") for e in range(max_epochs)])))
              .withColumn("taken", _copy_words(F.col("epoch"))).where("taken > 0")
              .withColumn("position", _copy_position(F.col("epoch"), schedules)))
    text = F.col("row")[text_col]
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # each one word and the space before it
    cut = F.when(F.col("taken") == F.col("size"), text).otherwise(F.array_join(F.slice(pieces, F.lit(1), F.col("taken").cast("int")), ""))
    out = [cut.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    if ordered:
        copies = copies.orderBy("position", F.col("row")[id_col], "epoch")
    return copies.select(*out)
