"""Mixing sources to token targets by entropy balancing.

Each source gets a target number of words (``source_targets``). Among all document rates between
0 and ``MOST`` that meet a source's target, the ones closest to taking every document once, by the
relative entropy of bounded rates, are exponentially tilted: ``rate = MOST * s / (1 + s)`` with
``s = exp(tilt * size / scale)``. The tilts solve the convex dual problem, one unknown for each
source's token constraint. The problem is separable, so one distributed Newton step for all sources
is one sum over the counts of documents by source and size; a bracket keeps steps safe.

Rates become whole copies by systematic rounding along each source's documents in order of size:
copies are steps of the running sum of rates, so a source's words miss its target by about its
largest document at most, and by a fraction of it with the best of ``STARTS`` starts of the sum. Documents of one source and size
share a rate and are numbered in the order of a hash, bucket after bucket, so no group is sorted in one task.

Null texts and texts without words have size 0 and are taken as their rate says, at no words. A null
source is a source of its own. Repeated rows count one by one. A source without words has the
target 0 and its documents 0 copies, as has every source of an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.graph import stored
from kerbside.llm.text import table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BUCKET_ROWS = 500
TOLERANCE = 1e-10
STEPS = 40
STARTS = 32
# Rates are whole multiples of 1 / UNIT, so running sums are exact in any order.
UNIT = 1 << 24

KEY = ["named", "source_name"]


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, size`` and a join key that tells a null source from an empty name."""
    return docs.select(
        "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col("source").isNotNull().alias("named"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_name"),
    )


def _before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` in ``order`` with ``place``, the rows before, and the sums over them.

    Rows are sorted by ranges; what the partitions before hold is one row a partition.
    """
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("at"), "*"), "sorted").withColumn("part", F.shiftright("at", 33))
    sums = {"place": F.lit(1).cast("long"), **sums}
    held = placed.groupBy("part").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).orderBy("part").collect()
    running, rows = dict.fromkeys(sums, 0), []
    for row in held:
        rows.append((row.part, *running.values()))
        running = {n: v + row[n] for n, v in running.items()}
    kinds = dict(placed.select(*[c.alias(n) for n, c in sums.items()]).dtypes)
    starts = df.sparkSession.createDataFrame(rows, ", ".join(["part long", *[f"from_{n} {kinds[n]}" for n in sums]]))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    found = placed.join(starts, "part").withColumns(
        {n: F.col(f"from_{n}") + F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()})
    return found.drop("at", "part", *[f"from_{n}" for n in sums])


def source_targets(counts: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``named, source_name, source_size, target`` from ``counts(named, source_name, size, n)``.

    Sources in code point order, null last, get the weights in turn. The targets are what is left
    when capped sources (``most`` times their words) have handed their excess on by weight: sorted by
    cap per weight, the first source that the others' share doesn't fill ends the capped ones.
    """
    # Order of strings is by bytes of UTF-8, which is the order of code points.
    sources = counts.groupBy(*KEY).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = _before(sources, [F.col("named").desc(), F.col("source_name")], {}).withColumn("turn", F.col("place") % len(weights))
    sources = sources.drop("place").withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("turn").cast("int")))
    cap, weight = most * F.col("source_size"), F.col("weight")
    order = [cap / weight, F.col("turn"), F.col("named").desc(), F.col("source_name")]
    sources = _before(sources, order, {"cap_before": cap, "weight_before": weight.cast("long")})
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left = F.lit(share * (whole.size or 0)) - F.col("cap_before")
    sources = sources.withColumn("level", left / (F.lit(whole.weight or 0) - F.col("weight_before")))
    ending = sources.where(weight * F.col("level") <= cap).agg(F.min(F.struct("place", "level")).alias("first")).first().first
    level = F.lit(float("inf") if ending is None else ending.level)
    return sources.select(*KEY, "source_size", F.least(cap.cast("double"), weight * level).alias("target"))


def _rate(tilt: Column, size: Column, scale: Column) -> Column:
    return MOST / (1 + F.exp(-tilt * size / scale))


def tilts(counts: DataFrame, targets: DataFrame, steps: int = STEPS) -> DataFrame:
    """``targets`` with ``scale`` and the ``tilt`` that meets each target, by Newton steps on the dual.

    Sources whose target is all they can give, or nothing, need no tilt: it is null.
    """
    scale = F.sum(F.col("size") * F.col("size") * F.col("n")) / F.sum(F.col("size") * F.col("n"))
    scales = counts.where("size > 0").groupBy(*KEY).agg(scale.alias("scale"))
    known = stored(targets.join(scales, KEY, "left"), "targets")
    open_ = known.where((F.col("target") > 0) & (F.col("target") < MOST * F.col("source_size")))
    now = open_.select(*KEY, "target", "scale", F.lit(0.0).alias("tilt"), F.lit(float("-inf")).alias("low"),
                       F.lit(float("inf")).alias("high"))
    for _ in range(steps):
        rate = _rate(F.col("tilt"), F.col("size"), F.col("scale"))
        words = F.col("size") * F.col("n")
        sums = counts.join(now, KEY).groupBy(*KEY, "target", "scale", "tilt", "low", "high").agg(
            (F.sum(words * rate) - F.first("target")).alias("miss"),
            F.sum(words * F.col("size") / F.col("scale") * rate * (1 - rate / MOST)).alias("slope"))
        low = F.when(F.col("miss") < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("miss") > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.col("miss") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > low) & (step < high)
        middle = (F.when(high == float("inf"), low + 4 + F.abs(low)).when(low == float("-inf"), high - 4 - F.abs(high))
                  .otherwise((low + high) / 2))
        now = stored(sums.select(
            *KEY, "target", "scale",
            F.when(F.col("miss") == 0, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
            low.alias("low"), high.alias("high"), (F.abs("miss") / F.col("target")).alias("off")), "tilt")
        off = now.agg(F.max("off")).first()[0]
        now = now.drop("off")
        if off is None or off < TOLERANCE:
            break
    return known.join(now.select(*KEY, "tilt"), KEY, "left")


def _starts(classes: DataFrame) -> DataFrame:
    """``start`` of each source's running sum of rates, of ``STARTS`` tried: the one that lands nearest its target."""
    tried = [(2 * k + 1) * UNIT // (2 * STARTS) for k in range(STARTS)]
    end = F.col("base") + F.col("n") * F.col("units")

    def miss(start: int) -> Column:
        copies = F.floor((end + start) / UNIT) - F.floor((F.col("base") + start) / UNIT)
        return F.abs(F.sum(copies * F.col("size")) - F.first("target"))

    misses = classes.groupBy(*KEY).agg(*[miss(start).alias(f"m{k}") for k, start in enumerate(tried)])
    # The middle start wins ties.
    ranked = [F.struct(F.round(f"m{k}", 3).alias("miss"), F.lit(abs(2 * k + 1 - STARTS)).alias("far"), F.lit(start).alias("start"))
              for k, start in enumerate(tried)]
    return misses.select(*KEY, F.least(*ranked)["start"].alias("start"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, rate`` for every row of ``docs``."""
    sized = stored(_keyed(docs), "sized")
    counts = stored(sized.groupBy(*KEY, "size").agg(F.count("*").alias("n")), "counts")
    solved = tilts(counts, source_targets(counts, weights, share))
    rate = F.when(F.col("target") <= 0, 0.0).when(F.col("tilt").isNull(), float(MOST)).otherwise(
        _rate(F.col("tilt"), F.col("size"), F.col("scale")))
    classes = counts.join(solved, KEY).withColumn("units", F.round(rate * UNIT).cast("long"))
    before = Window.partitionBy(*KEY).orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("base", F.coalesce(F.sum(F.col("units") * F.col("n")).over(before), F.lit(0)))
    classes = stored(classes.select(*KEY, "size", "n", "source_size", "target", "units", "base"), "classes")
    classes = classes.join(_starts(classes), KEY).withColumn("base", F.col("base") + F.col("start"))
    placed = sized.join(classes, [*KEY, "size"])
    # A class is numbered bucket after bucket, so that no task sorts all of a large one.
    buckets = F.ceil(F.col("n") / BUCKET_ROWS)
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64(F.lit(7), "doc_id"), buckets))
    held = placed.groupBy(*KEY, "size", "bucket").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy(*KEY, "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(*KEY, "size", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"))
    placed = placed.join(held, [*KEY, "size", "bucket"])
    within = F.row_number().over(Window.partitionBy(*KEY, "size", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id"))
    base, place = F.col("base"), F.col("earlier") + within
    end = base + place * F.col("units")
    copies = F.floor(end / UNIT) - F.floor((end - F.col("units")) / UNIT)
    return placed.select(
        "doc_id", "size", "source_size", "target",
        (copies * F.col("size")).cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
        (F.col("units") / UNIT).alias("rate"),
    )


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
