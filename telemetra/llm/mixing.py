"""Mix sources to target weights along a time-varying curriculum (native).

Every source has a weight schedule over the training time u in [0, 1]: a list
of knots (u, weight), linear in between.  The integral of the schedule is the
source's weight, which fixes its target in words; the schedule's shape says
when those words are wanted.  A document's words begin at some cumulative
demand of its source; inverting the integrated schedule there gives its
training position, and the mix is the documents sorted by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import SUB, ZONE, prefix_sums

WORD = r"[^\x20\x09-\x0D]+"
Schedule = tuple[tuple[float, float], ...]

#: Integrals 5, 2 and 1: steady, fading, and rising towards the end of training.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 5.0), (1.0, 5.0)), ((0.0, 3.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def weight_of(schedule: Schedule) -> float:
    """The integral of a schedule over [0, 1]."""
    return sum((u1 - u0) * (w0 + w1) / 2 for (u0, w0), (u1, w1) in zip(schedule, schedule[1:]))


def invert(schedule: Schedule, share: Column) -> Column:
    """The time u at which ``share`` of the schedule's integral has been demanded.

    On a segment from (u0, w0) with slope a, demand d is met after
    x = 2 d / (w0 + sqrt(w0^2 + 2 a d)), which also holds for a = 0.
    """
    total, done, out = weight_of(schedule), 0.0, None
    for (u0, w0), (u1, w1) in zip(schedule, schedule[1:]):
        area = (u1 - u0) * (w0 + w1) / 2
        if area <= 0:
            continue
        slope = (w1 - w0) / (u1 - u0)
        d = F.greatest(share * F.lit(total) - F.lit(done), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * d, F.lit(0.0)))
        at = F.lit(u0) + F.when(d > 0, F.lit(2.0) * d / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        out = at if out is None else F.when(share * F.lit(total) < F.lit(done), out).otherwise(at)
        done += area
    return F.least(out, F.lit(1.0))


def source_targets(sizes: DataFrame, schedules: tuple[Schedule, ...], epochs: float, max_repeats: float) -> DataFrame:
    """(src_null, src, source_size) -> target and schedule class per source.

    Sources share ``epochs`` times all words by weight; a target stops at
    ``max_repeats`` times its source, the rest is shared again.  In closed
    form, target = min(cap, level * weight): with sources in order of
    cap / weight, the level that caps exactly those before the k-th is
    (total - caps before) / (weights from k on), and the right one is the
    largest that stays within cap / weight of its own source.  The windows
    run over one row per source.
    """
    n = len(schedules)
    weights = F.array(*[F.lit(weight_of(s)) for s in schedules])
    rank = F.row_number().over(Window.orderBy("src_null", "src")) - 1
    out = sizes.withColumn("_rank", rank).withColumn("schedule", F.col("_rank") % n)
    out = out.withColumn("_weight", F.get(weights, F.col("schedule"))).withColumn("_cap", F.lit(float(max_repeats)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    everything = Window.partitionBy()
    out = out.withColumns({
        "_total": F.lit(float(epochs)) * F.sum("source_size").over(everything),
        "_capped": F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_open": F.sum("_weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    level = (F.col("_total") - F.col("_capped")) / F.col("_open")
    out = out.withColumn("_level", F.max(F.when(level <= F.col("_cap") / F.col("_weight"), level)).over(everything))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap")))
    return out.select("src_null", "src", "source_size", "schedule", target.alias("target"))


def mix(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, epochs: float = 1.5, max_repeats: float = 2.0) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source, any other columns) with its part in the mix.

    Adds ``size`` (words), ``source_size``, ``target``, ``taken`` (words the
    mix takes of the row, repeats counted), ``copies`` (whole copies a mix of
    whole documents holds: those whose middle falls before the target) and
    ``positions`` (training positions in [0, 1], one for each copy begun
    before the target; empty if none is).  Existing columns of these names
    are replaced.

    Documents of a source come in the order of md5(doc_id, text), so reruns
    agree.  Taken words of a source sum to the floor of its target: the last
    copy counts with the words up to the target.  A NULL text has no words,
    an empty one neither; they take no words.  A NULL source is a source of
    its own, ranked last.  Repeated rows count as often as they occur; an
    empty table gives no rows.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))))
    names = ("size", "source_size", "target", "taken", "copies", "positions", "schedule", "src", "src_null", "_key", ZONE, SUB)
    rows = docs.drop(*names).withColumns({
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "src_null": F.col("source").isNull(),
        "src": F.coalesce("source", F.lit("")),
        "_key": key,
    })
    rows = rows.withColumns({ZONE: F.substring("_key", 1, 3), SUB: F.substring("_key", 4, 1)})
    sources = source_targets(rows.groupBy("src_null", "src").agg(F.sum("size").alias("source_size")), schedules, epochs, max_repeats)
    rows = prefix_sums(rows, ["src_null", "src"], ["_key"], {"_before": F.col("size")}, per_group=sources)

    whole = F.floor("target").cast("long")
    starts = [F.col("_before") + F.lit(e) * F.col("source_size") for e in range(int(-(-max_repeats // 1)))]
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), whole - s)) for s in starts[1:]), F.greatest(F.lit(0), F.least(F.col("size"), whole - starts[0])))
    copies = sum((((whole > s) & (2 * (whole - s) >= F.col("size"))).cast("int") for s in starts[1:]), ((whole > starts[0]) & (2 * (whole - starts[0]) >= F.col("size"))).cast("int"))

    def position(start: Column) -> Column:
        share = start / F.col("target")
        at = invert(schedules[0], share)
        for k, schedule in enumerate(schedules[1:], 1):
            at = F.when(F.col("schedule") == k, invert(schedule, share)).otherwise(at)
        return F.when(whole > start, F.round(at, 6))

    rows = rows.withColumns({"taken": taken, "copies": copies, "positions": F.array_compact(F.array(*[position(s) for s in starts]))})
    return rows.drop("_before", "schedule", "src", "src_null", ZONE, SUB)


def in_training_order(mixed: DataFrame) -> DataFrame:
    """The result of ``mix`` range-sorted by first position; rows the mix
    does not take follow, spread by their key so that they share no range."""
    spread = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    at = F.coalesce(F.get("positions", F.lit(0)), 1.0 + spread)
    return mixed.withColumn("_at", at).repartitionByRange("_at", "_key").sortWithinPartitions("_at", "_key").drop("_at", "_key")


def emit(docs: DataFrame, ordered: bool = True, **params) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix holds it,
    with the columns of ``docs``; ``ordered`` range-sorts it by position."""
    # the columns of ``docs`` travel as one, whatever their names; ``mix`` sees what it reads
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "doc_id", "text", "source")
    mixed = mix(packed, **params).filter("copies > 0")
    copies = mixed.withColumn("_at", F.explode(F.slice("positions", F.lit(1), F.col("copies"))))
    if ordered:
        copies = copies.repartitionByRange("_at", "_key").sortWithinPartitions("_at", "_key")
    return copies.select("_doc.*")
