"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

A document with quality weight w gets the key ``-ln(u) / w``, u uniform from a
hash of its id.  Ascending keys are a weighted sample without replacement.  A
source is first taken whole as often as its target holds it (complete epochs);
the rest of the budget goes to the documents in key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import uniform, with_text
from kpiloom.session import cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
LEAST_QUALITY = 0.25
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words separated by ASCII space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """Weight of a document from ``LEAST_QUALITY`` to 1: the share of lower-case letters in it."""
    whole = F.greatest(F.length(text), F.lit(1))
    lower = F.length(F.regexp_replace(text, r"[^\p{Ll}]+", ""))
    return F.coalesce(F.greatest(F.lit(LEAST_QUALITY), lower / whole), F.lit(LEAST_QUALITY))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target`` to one row per source with ``source_size``.

    Weights repeat over the sources by code point, null last.  No target
    exceeds ``most`` times its source; what is cut off is shared by weight
    among the others.  The fixed point is found at once: sources are capped in
    ascending order of cap over weight, up to the first whose share of what is
    left fits.  One row per source passes through these windows, not data.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    index = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (index + 1).cast("int"))
    capped = sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left_words = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = F.when(left_words / left_weight < F.col("cap") / F.col("w"), left_words / left_weight)
    ranked = capped.withColumn("level", level)
    return ranked.select("source", "source_size", "n", F.least(F.col("cap"), F.max("level").over(everything) * F.col("w")).alias("target"))


def mix(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 7,
    text_key: bool = False,
) -> DataFrame:
    """One row per document: ``ident``, ``size``, ``source_size``, ``target``, ``taken``, ``epochs``.

    ``taken`` counts the words the mix takes, ``epochs`` how often the whole
    document is taken.  The document at which the budget ends is taken if that
    brings the source nearer to its target, so a source misses it by at most
    half a document.  Null texts and texts without words have size 0 and are
    taken 0 times; null is a source like any other; rows that repeat count
    each; an empty table gives an empty mix.  ``text_key`` adds ``text_key``, a
    hash of the text, for joining back to rows whose ids repeat.
    """
    kept = with_text(docs, ident, text, source)
    read = kept.select(
        F.col(ident).alias("doc"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        F.xxhash64(text).alias("text_key"),
        (-F.log(uniform(seed, F.col(ident), F.xxhash64(text) if text_key else F.lit(0))) / quality_of(F.col(text))).alias("key"),
    )
    rows = cut(read)
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goals = cut(targets(sums, weights, share, most))
    # Buckets of about sqrt(n) documents in key order.  A key scaled by the least weight is at most four
    # times as dense anywhere as on average, so no bucket, and no list of a source's buckets, grows beyond that.
    joined = rows.alias("r").join(goals.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
    buckets = F.ceil(F.sqrt("n"))
    bucket = F.least(F.floor((1 - F.exp(-F.col("key") * LEAST_QUALITY)) * buckets), buckets - 1)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = joined.select("doc", "r.source", "size", "text_key", "key", "source_size", "target", bucket.alias("bucket"), whole.alias("whole"))
    per = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    with_offset = placed.join(per, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    budget = F.col("target") - F.col("whole") * F.col("source_size")
    extra = F.when((F.col("size") > 0) & (start + F.col("size") / 2 <= budget), 1).otherwise(0)
    epochs = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0).cast("long")
    out = with_offset.select(F.col("doc").alias(ident), "size", "source_size", "target", "text_key", epochs.alias("epochs"))
    return out.select(ident, "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"), "epochs", *["text_key"] * text_key)
