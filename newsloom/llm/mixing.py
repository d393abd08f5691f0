"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, up to ``max_epochs``
rounds of them. A document's virtual finish time is its source's cumulative
tokens divided by the source's weight. All documents are range-sorted by
finish time and the mix ends where the total budget is used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import WORD, materialise, prefix_sum

#: Weights dealt to the sources in order, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source of ``sizes`` (source, size): ``source, source_size, weight,
    target``.

    Sources by code point, null last, get ``weights`` in turn and share the
    sum of all sizes. A target stops at ``max_epochs`` times the source's
    size and the excess is shared again by weight until none is above: a
    source is full at the level ``max_epochs * size / weight``, so the full
    ones are those below the common level, found by ordering the sources by
    it. The table has one row per source; its two windows run over range
    partitions (``prefix_sum``), never over all sources in one task.
    """
    per = materialise(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                      .withColumn("_none", F.isnull("source").cast("int")).withColumn("_one", F.lit(1).cast("long")))
    ranked = prefix_sum(per, ["_none", "source"], "_one", out="_rank")
    dealt = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    per = (ranked.withColumn("weight", F.element_at(dealt, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
           .withColumn("_cap", F.col("source_size") * max_epochs)
           .withColumn("_level", F.col("_cap") / F.col("weight")))
    per = materialise(per)
    caps = prefix_sum(per, ["_level", "_rank"], "_cap", out="_caps")
    both = prefix_sum(caps, ["_level", "_rank"], "weight", out="_weights")
    total = per.agg(F.sum("source_size").alias("_total"), F.sum("weight").alias("_all"))
    row = total.first()
    budget, weight = int(row["_total"] or 0), int(row["_all"] or 0)
    # The level once this source and all lower ones are full; they are full
    # indeed where the level is not below their own.
    left = (F.lit(weight) - F.col("_weights")).cast("double")
    next_level = F.when(left > 0, (F.lit(budget) - F.col("_caps")).cast("double") / left)
    full = both.filter(next_level >= F.col("_level")).agg(
        F.max(F.struct("_weights", "_caps")).alias("m")).first()["m"]
    done_w, done_c = (int(full["_weights"]), int(full["_caps"])) if full else (0, 0)
    level = (budget - done_c) / float(weight - done_w) if weight > done_w else 0.0
    return both.select("source", "source_size", "weight", F.least(
        F.col("_cap").cast("double"), F.lit(float(level)) * F.col("weight")).alias("target"))


def fair_mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
             weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size,
    target, taken, copies``.

    The size is the number of white-space words (null text: 0). Documents of
    size 0 take part with nothing taken. Null is a source of its own. The
    shuffle is ``md5(seed:id)``, so a rerun agrees; rows repeating id and
    size are queued one after the other. Budget: the sum of all sizes; the
    document that crosses it is the first one left out.
    """
    sized = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
        _size(F.col(text)).alias("size")))
    targets = materialise(source_targets(sized, weights, max_epochs))
    shuffled = sized.filter("size > 0").withColumn(
        "_mix", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")))
    queued = prefix_sum(shuffled, ["_mix", "doc_id", "size"], "size", by=["source"], out="_queued")
    t = targets.select(F.col("source").alias("_s"), "source_size", "weight")
    items = (queued.join(t, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
             .withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
             .withColumn("_finish", (F.col("_queued") + F.col("_epoch") * F.col("source_size")).cast("double")
                         / F.col("weight"))
             .withColumn("_none", F.isnull("source").cast("int"))
             .select("doc_id", "source", "size", "_finish", "_none", "_mix", "_epoch"))
    budget = int(targets.agg(F.sum("source_size")).first()[0] or 0)
    line = prefix_sum(materialise(items), ["_finish", "_none", "source", "_mix", "doc_id", "_epoch"], "size", out="_mixed")
    took = (line.filter(F.col("_mixed") <= budget)
            .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("_copies")))
    rows = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("_rows"))
    # Rows that repeat id, source and size share what was taken, earlier ones first.
    shared = rows.join(took.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"),
                                   F.col("size").alias("_z"), "_copies"),
                       F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s"))
                       & (F.col("size") == F.col("_z")), "left").drop("_d", "_s", "_z")
    each = shared.withColumn("_copies", F.coalesce("_copies", F.lit(0).cast("long"))).withColumn(
        "_nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)))
    copies = F.floor(F.col("_copies") / F.col("_rows")) + F.when(
        F.col("_nth") < F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return (each.withColumn("copies", copies.cast("long"))
            .join(targets.select(F.col("source").alias("_s"), "source_size", "target"),
                  F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """The mixed rows of ``docs`` in all their columns: each as often as the
    mix takes it, those not taken left out. Rows repeating id, source and
    size share their copies evenly, so every source gets what
    :func:`fair_mix` gives it."""
    decided = fair_mix(docs, id_col, text, source, weights, max_epochs, seed)
    total = materialise(decided.groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z")).agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).filter("_copies > 0"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _size(F.col(f"`{text}`")).alias("_size"))
    own = packed.join(total, F.col("_row").getField(id_col).eqNullSafe(F.col("_d"))
                      & F.col("_row").getField(source).eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")))
    often = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n))
    first = own.filter("_rows = 1").withColumn("_i", often(F.col("_copies"))).select("_row.*")
    # Numbered over ranges of rows: an id that many rows repeat is not one task's.
    many = (own.filter("_rows > 1").withColumn("_hash", F.xxhash64("_row")).withColumn("_tie", F.monotonically_increasing_id())
            .withColumn("_one", F.lit(1)))
    again = (prefix_sum(many, ["_hash", "_tie"], "_one", by=["_d", "_s", "_z"], out="_nth")
             .withColumn("_n", F.floor(F.col("_copies") / F.col("_rows"))
                         + F.when(F.col("_nth") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0))
             .filter("_n > 0").withColumn("_i", often(F.col("_n").cast("long"))).select("_row.*"))
    return first.unionByName(again)


def _size(text) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
