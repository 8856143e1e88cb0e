"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A spaced seed hashes the tokens at fixed offsets of a window and ignores the
others, so a substituted word at an ignored position leaves the hash unchanged.
The two masks below find a hit in every run of 13 aligned tokens with at most
two substitutions, and a shorter item gets masks of its own length that meet
every substitution its length allows (``tests/llm`` enumerates all of them).
Hits are verified on
the tokens around them: a document is contaminated by an item if some run of
``window`` aligned tokens agrees in at least ``similarity`` of its positions.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import with_text
from kpiloom.session import cut

WINDOW = 13
SIMILARITY = 0.8
MASKS = ((0, 3, 4, 6, 7, 8), (0, 1, 2, 3, 5, 8))
SHORTEST = 5
WEIGHT = 6  # tokens that a mask of a short item looks at, where its length allows as many
BROADCAST_SEEDS = 500_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; null has none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(words, "")


def short_masks(n: int, similarity: float = SIMILARITY) -> list[tuple[int, ...]]:
    """Masks over all of an item of ``n`` tokens, one of which misses any set of substitutions that ``similarity`` allows.

    With ``gone`` substitutions allowed, the positions are dealt to blocks and
    every choice of ``gone`` blocks is left out once.  As few blocks are taken
    as leave ``WEIGHT`` tokens to look at, else single positions.
    """
    gone = max(k for k in range(n) if n - k >= similarity * n)
    for blocks in range(gone + 1, n + 1):
        if n - sum(n // blocks + (b < n % blocks) for b in range(gone)) >= WEIGHT:
            break
    return [tuple(p for p in range(n) if p % blocks not in out) for out in itertools.combinations(range(blocks), gone)]


# A mask and the length of the items it is for; no length stands for all items of a whole window.
Masks = list[tuple[tuple[int, ...], int | None]]


def _seeds(words: Column, at: Column, masks: Masks, n: Column, window: int | None) -> Column:
    """The hashes of all masks at one position; null where a mask reaches beyond the end or, given ``window``, is not for the item."""

    def fits(mask: tuple[int, ...], length: int | None) -> Column:
        inside = at + mask[-1] < n
        if window is None:
            return inside
        return inside & ((n >= window) if length is None else (n == length) & (at == 0))

    return F.array(
        *[
            F.when(fits(mask, length), F.xxhash64(F.lit(k), *[F.element_at(words, at + off + 1) for off in mask]))
            for k, (mask, length) in enumerate(masks)
        ]
    )


def _positions(rows: DataFrame, masks: Masks, keep: list[str], window: int | None = None) -> DataFrame:
    """One row per position and mask.  The words stay a reference within one code-generated stage."""
    shortest = min(m[-1] for m, _ in masks)
    starts = F.when(F.col("n") > shortest, F.sequence(F.lit(0), F.col("n") - 1 - shortest))
    at = rows.select("*", F.explode_outer(starts).alias("at")).where("at is not null")
    seeds = _seeds(F.col("words"), F.col("at"), masks, F.col("n"), window)
    return at.select(*keep, "at", F.explode_outer(seeds).alias("seed")).where("seed is not null")


def _masks_for(items: DataFrame, window: int, similarity: float) -> Masks:
    """The fixed masks, and those of each length below ``window`` that some item has."""
    short = [r["n"] for r in items.where(F.col("n") < window).select("n").distinct().collect()]  # at most window - SHORTEST
    return [*[(m, None) for m in MASKS], *[(m, n) for n in sorted(short) for m in short_masks(n, similarity)]]


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Pairs ``(ident, item, matched, length)``: the best verified run of each document and item.

    Items shorter than ``window`` tokens must be met along their whole length,
    items of fewer than five tokens are too common to be evidence and match
    nothing.  Null texts have no tokens; repeated benchmark rows count once.
    """
    items = with_text(benchmark, item, item_text).select(F.col(item).alias("item"), tokens(F.col(item_text)).alias("words"))
    items = cut(items.distinct().select("*", F.size("words").alias("n")).where(F.col("n") >= SHORTEST))
    masks = _masks_for(items, window, similarity)
    item_seeds = cut(_positions(items, masks, ["item", "words", "n"], window))
    wanted = item_seeds.select("seed").distinct()
    small = wanted.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS

    corpus = with_text(docs, ident, text).select(F.col(ident).alias("doc"), tokens(F.col(text)).alias("words"))
    corpus = corpus.select("doc", "words", F.size("words").alias("n"))
    reach = window + max(m[-1] for m in MASKS)
    first = F.greatest(F.col("at") - reach, F.lit(0))
    around = F.slice("words", first + 1, 2 * reach + 1)
    local = ["doc", "seed", (F.col("at") - first).alias("before"), around.alias("near")]
    placed = _positions(corpus, masks, ["doc", "words"])
    if small:
        hits = placed.join(F.broadcast(wanted), "seed", "left_semi").select(*local)
    else:
        # Beyond the checked size both sides are shuffled: a position then carries the tokens around it, not its whole text.
        hits = placed.select(*local).join(wanted, "seed", "left_semi")

    sides = item_seeds.select("seed", "item", F.col("at").alias("item_at"), F.col("words").alias("item_words"), F.col("n").alias("item_n"))
    both = hits.join(sides, "seed")
    lead = F.least("before", "item_at")
    here = F.slice("near", F.col("before") - lead + 1, F.size("near"))
    there = F.slice("item_words", F.col("item_at") - lead + 1, 2 * reach + 1)
    length = F.least(F.size(here), F.size(there))
    same = F.zip_with(F.slice(here, F.lit(1), length), F.slice(there, F.lit(1), length), lambda a, b: F.when(a == b, 1).otherwise(0))
    both = both.select("doc", "item", F.least(F.lit(window), "item_n").alias("length"), same.alias("same"))
    run = lambda i: F.aggregate(F.slice("same", i, F.col("length")), F.lit(0), lambda s, x: s + x)
    matched = F.when(
        F.size("same") >= F.col("length"),
        F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - F.col("length") + 1), run)),
    )
    found = both.select("doc", "item", "length", matched.alias("matched")).where(F.col("matched") >= F.lit(similarity) * F.col("length"))
    best = found.groupBy("doc", "item").agg(F.max(F.struct("matched", "length")).alias("best"))
    return best.select(F.col("doc").alias(ident), F.col("item").alias(item), "best.matched", "best.length")


def decontaminate(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark; columns unchanged.

    Rows with a null id are kept: no overlap can be assigned to them.
    """
    # Written first: Spark then knows how few ids go and need not shuffle the texts before it finds out.
    bad = cut(overlaps(docs, benchmark, ident, **options).select(F.col(ident).alias("_leak")).distinct())
    return docs.join(bad, docs[f"`{ident}`"] == bad["_leak"], "left_anti")


def verdicts(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text", item: str = "item_id", **options) -> DataFrame:
    """One row per document row: ``ident``, ``contaminated``, ``n_items``, ``item_ids`` in ascending order."""
    found = overlaps(docs, benchmark, ident, text, item, **options).groupBy(ident).agg(F.sort_array(F.collect_set(item)).alias("_items"))
    found = found.select(F.col(ident).alias("_doc"), "_items")
    rows = docs.select(F.col(f"`{ident}`").alias(ident))
    items = F.coalesce("_items", F.array().cast(found.schema["_items"].dataType))
    out = rows.join(found, rows[ident] == found["_doc"], "left").select(ident, items.alias("item_ids"))
    return out.select(ident, (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"), "item_ids")
