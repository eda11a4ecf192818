"""Mixing sources to target weights.

``plan_mix`` decides, ``apply_mix`` takes.  Targets come from capped water-filling: every
source gets its weight's share of the wanted words; a source whose share would exceed
``max_epochs`` times its own words is clamped there, and what it leaves is dealt out to
the others by weight, again and again until none is above.  A target of 1.3 times a source
is one whole repetition of each document plus a fraction: the documents in a seeded random
order up to the one that comes closest to 0.3 of the source's words.

The cut of that order is found without sorting a source.  A document's place has 56 bits,
32 by its id and 24 by its text; sums over its leading 8 bits find the one cell where the
fraction ends, sums over the next 8 bits find the cell in that cell, and so on until the
last cells hold few different documents, which are put in order.  A source with a third of
all rows costs three partial aggregations, like any other; ids that many documents share
cost up to four more.  Where the fraction ends among copies of one document, which have one
place, the plan says how many of them are still taken, and those are counted off by the
partitions that they lie in.

Only DataFrame functions run.  One row per source is what passes through single tasks.

Defined results: a null text has 0 words; a null source is a source; a null ``doc_id``
sorts before all others; of rows equal in id and text some may be taken more often than
others, which ones depends on how the table was written; an empty table gives an empty
mix; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Levels of 8 bits of a place: at least, and at most while a last cell holds many documents.
LEVELS, MOST_LEVELS, MANY = 3, 7, 10_000
BITS = 8 * MOST_LEVELS
LAST = 2**63 - 1
FIRST = -(2**63)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.SPACED_WORD)), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column, seed: str) -> Column:
    """A document's place in the seeded order: 32 bits of an MD5 of its id, then 24 of its
    text, which spread documents that share an id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    by_id = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.shiftleft(by_id, 24) + F.xxhash64(text).bitwiseAND(F.lit(2**24 - 1))


def water_fill(sources: DataFrame, wanted: float, max_epochs: float) -> DataFrame:
    """``sources`` (one row each: source, size, weight) with ``target`` added.

    Each round is one aggregation over the sources; only its sums reach the driver.
    """
    cap = F.col("size") * F.lit(float(max_epochs))
    level, before = None, None
    while level is None or level != before:
        before = level
        free = F.lit(True) if level is None else cap >= F.lit(level) * F.col("weight")
        full, weight = sources.agg(
            F.sum(F.when(~free, cap)).alias("full"), F.sum(F.when(free, F.col("weight"))).alias("weight")
        ).first()
        if not weight:
            break
        level = (wanted - (full or 0.0)) / weight
    return sources.withColumn("target", F.least(cap, F.lit(level or 0.0) * F.col("weight")))


def plan_mix(sized: DataFrame, weights: DataFrame, share: float, max_epochs: float, seed: str) -> DataFrame:
    """One row per source: size, target, whole repetitions and the end of the fraction.

    sized    written table of (doc_id, source, size, place), one row per document
    weights  (source, weight); weights above 0
    share    wanted words as a multiple of all words
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"))
    sources = totals.alias("t").join(weights.alias("w"), F.expr("t.source <=> w.source"))
    sources = common.stored(sources.select("t.source", "t.size", "w.weight"), "sources", 1)
    words = sources.agg(F.sum("size")).first()[0] or 0
    plan = water_fill(sources, words * share, max_epochs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("long"))
    plan = plan.withColumn("fraction", F.col("target") - F.col("whole") * F.col("size"))
    plan = plan.withColumns({"cell": F.lit(0).cast("long"), "before": F.lit(0).cast("long")})
    plan = common.stored(plan, "mix", 1)
    for level in range(1, MOST_LEVELS + 1):
        plan = common.stored(_refine(sized, plan, BITS - 8 * level), "mix", 1)
        inside = _inside(sized, plan, BITS - 8 * level)
        if level >= LEVELS and level < MOST_LEVELS:
            most = inside.groupBy("source").count().agg(F.max("count")).first()[0]
            if (most or 0) <= MANY:
                break
    # copies of a document stand together: ``rows`` of them, of which ``some`` are taken
    alike = inside.groupBy("source", "at", "size", "before", "fraction").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("source").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, -1)
    ran = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("rows")).over(order), F.lit(0))
    fit = F.floor((F.col("fraction") - ran) / F.col("size") + 0.5)
    fit = fit - F.when(2 * ran + (2 * fit - 1) * F.col("size") > 2 * F.col("fraction"), 1).otherwise(0)  # of rounding
    some = F.when(F.col("size") == 0, F.col("rows")).otherwise(F.least("rows", fit))
    picked = alike.withColumn("some", some.cast("long")).where("some > 0")
    ends = picked.groupBy("source").agg(F.max(F.struct("at", "size", "some", "rows")).alias("end"))
    first = F.struct((F.col("cell") * F.lit(2 ** (BITS - 8 * level)) - 1).alias("place"), F.lit(LAST).alias("id"))
    start = F.struct(first.alias("at"), F.lit(LAST).alias("size"), F.lit(0).cast("long").alias("some"), F.lit(0).cast("long").alias("rows"))
    joined = plan.alias("p").join(ends.alias("e"), F.expr("p.source <=> e.source"), "left")
    joined = joined.select("p.*", F.coalesce("e.end", start).alias("end"))
    return common.stored(joined.select("source", "size", "weight", "target", "whole", "end"), "mix", 1)


def _at() -> Column:
    return F.struct(F.col("d.place").alias("place"), F.coalesce(F.col("d.doc_id"), F.lit(FIRST)).alias("id"))


def _inside(sized: DataFrame, plan: DataFrame, shift: int) -> DataFrame:
    """The documents in the cell of their source, ``shift`` being the bits below it."""
    same = F.expr(f"d.source <=> p.source and shiftright(d.place, {shift}) = p.cell")
    rows = sized.alias("d").join(plan.alias("p"), same)
    return rows.select("d.source", "d.place", "d.size", _at().alias("at"), "p.before", "p.fraction")


def _refine(sized: DataFrame, plan: DataFrame, shift: int) -> DataFrame:
    """Each source's cell narrowed by 8 bits: to the first that passes the fraction, or the
    one after the last."""
    rows = _inside(sized, plan, shift + 8)
    digit = F.shiftright("place", shift).bitwiseAND(255).alias("digit")
    sums = rows.groupBy("source", digit, "before", "fraction").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("digit"))
    sums = sums.withColumn("upto", F.col("before") + upto)
    found = sums.where(F.col("upto") > F.col("fraction")).groupBy("source")
    found = found.agg(F.min(F.struct("digit", (F.col("upto") - F.col("size")).alias("before"))).alias("f"))
    joined = plan.alias("p").join(found.alias("f"), F.expr("p.source <=> f.source"), "left")
    kept = [c for c in plan.columns if c not in ("cell", "before")]
    return joined.select(
        *(f"p.{c}" for c in kept),
        F.expr("p.cell * 256 + coalesce(f.f.digit, 256)").alias("cell"),
        F.coalesce("f.f.before", "p.before").alias("before"),
    )


def take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows``, which have doc_id, source, size and place, with the source's figures and
    ``copies``, the times a document is taken."""
    joined = rows.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source"))
    key, end = F.struct(_at().alias("at"), F.col("d.size").alias("size")), F.struct("p.end.at", "p.end.size")
    part = F.col("p.target") > F.col("p.whole") * F.col("p.size")
    split = key.eqNullSafe(end) & (F.col("p.end.some") < F.col("p.end.rows")) & part
    joined = joined.select(
        "d.*",
        F.col("p.size").alias("source_size"),
        F.col("p.target").alias("target"),
        (F.col("p.whole") + F.when(part & (key <= end), 1).otherwise(0)).cast("long").alias("copies"),
        F.when(split, F.col("p.end.some")).alias("some"),
    )
    if not plan.where("end.some < end.rows").isEmpty():
        joined = joined.where("some is null").unionByName(_counted_off(joined.where("some is not null")))
    return joined.drop("some")


def _counted_off(copies: DataFrame) -> DataFrame:
    """Rows of which only ``some`` of each source are taken once more: written, numbered
    inside their partitions, with the numbers carried from partition to partition."""
    own = common.stored(copies.withColumn("number", F.monotonically_increasing_id()), "copies")
    own = own.withColumn("block", F.expr("number div 100000"))
    own = own.withColumn("inner", F.row_number().over(Window.partitionBy("source", "block").orderBy("number")))
    blocks = own.groupBy("source", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    both = own.alias("o").join(blocks.alias("b"), F.expr("o.source <=> b.source and o.block = b.block"))
    left_out = (F.col("o.inner") + F.col("b.ahead") > F.col("o.some")).cast("long")
    kept = [F.col(f"o.`{c}`") for c in copies.columns if c != "copies"]
    return both.select(*kept, (F.col("o.copies") - left_out).alias("copies"))


def measured(docs: DataFrame, seed: str) -> DataFrame:
    """The narrow written table that planning reads instead of the texts."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text"), seed).alias("place"))
    return common.stored(sized, "sizes")


def ranked_weights(sized: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """Weights of ``cycle``, repeating, for the sources by code point, null last."""
    names = sized.select("source").distinct()
    # one row per source: the order of all source names is what is asked for
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*(F.lit(w) for w in cycle))
    return names.select("source", F.get(listed, (number % len(cycle)).cast("int")).alias("weight"))


CYCLE, SHARE, MAX_EPOCHS, SEED = (3, 1, 2), 1.5, 2.0, "mix"


def mixed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The measured documents and their plan, with the parameters of the query."""
    sized = measured(docs, SEED)
    return sized, plan_mix(sized, ranked_weights(sized, CYCLE), SHARE, MAX_EPOCHS, SEED)


def repeat_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as taken, with the number of its ``repetition``
    from 1.  All columns of ``docs`` are carried along."""
    sized, plan = mixed(docs)
    common.drop_stored(sized)
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.struct(*own).alias("row"),
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        place(F.col("doc_id"), F.col("text"), SEED).alias("place"),
    )
    rows = take(rows, plan).where("copies > 0")
    rows = rows.select("row", F.explode(F.expr("sequence(1, cast(copies as int))")).alias("n"))
    taken = [c for c in docs.columns if c != "repetition"]
    return rows.select(*(F.col("row").getField(c).alias(c) for c in taken), F.col("n").alias("repetition"))


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    sized, plan = mixed(common.table(spark, folder, "documents"))
    return take(sized, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
