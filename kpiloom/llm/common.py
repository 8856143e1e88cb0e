"""What several of the text operators need: held-out folds, stable fractions, word blocks, connected components."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.session import cut

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fold(ident: str, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n``; null ids give null."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % F.lit(n)


def in_fold(ident: str, n: int, k: int) -> Column:
    """Whether a row belongs to fold ``k``; rows without an id belong to none."""
    return F.coalesce(fold(ident, n) == k, F.lit(False))


def with_text(docs: DataFrame, ident: str, text: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that extra columns cannot clash with its own."""
    return docs.select(*[F.col(f"`{c}`").alias(c) for c in (ident, text, *more)])


def labelled_sample(docs: DataFrame, ident: str, text: str, marks: DataFrame, most: int, seed: int) -> pd.DataFrame:
    """About ``most`` documents of each label, chosen by a hash of the id: ``id, label, share, text`` in id order.

    ``marks`` has one row ``id, label`` per labelled document, ``share`` is the
    part of a label that was taken.  The sample of ids is broadcast only after
    its size has been checked, so that not all texts are shuffled for a few of them.
    """
    sizes = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}  # one entry per label
    shares = [x for label, n in sizes.items() for x in (F.lit(label), F.lit(min(1.0, most / n)))]
    empty = pd.DataFrame({"id": [], "label": [], "share": [], "text": []})
    if not shares:
        return empty
    share = F.element_at(F.create_map(*shares), F.col("label"))
    chosen = cut(marks.withColumn("share", share).where(uniform(seed, F.col("id")) < F.col("share")))
    limit = 2 * most * len(sizes)
    small = chosen.limit(limit + 1).count() <= limit
    texts = with_text(docs, ident, text).where(F.col(text).isNotNull()).select(F.col(ident).alias("id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(chosen) if small else chosen, "id").select("id", "label", "share", "text").toPandas()
    return rows.sort_values(["id", "text"], ignore_index=True) if len(rows) else empty


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on the values alone (52 bits of an MD5)."""
    joined = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def word_blocks(raw: bytes, overlap: int, block: int = 1 << 20):
    """Lists of words of a text; consecutive lists share ``overlap`` words.

    ``bytes.split`` separates at exactly the six ASCII space characters.  A
    list comes from about ``block`` bytes, so a very long text never becomes
    one list.  A text of at most ``overlap`` words is one list.
    """
    if len(raw) <= block:
        yield raw.split()
        return
    carried: list[bytes] = []
    at, yielded = 0, False
    while at < len(raw):
        found = _SPACE.search(raw, min(at + block, len(raw)))
        end = found.start() if found else len(raw)
        words = carried + raw[at:end].split()
        if len(words) > overlap:
            yield words
            yielded = True
            carried = words[len(words) - overlap :] if overlap else []
        else:
            carried = words
        at = end + 1
    if carried and not yielded:
        yield carried


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected graph: ``(node, component)``, component = least node reachable.

    Alternates large-star and small-star steps.  Every step is a join with a
    pre-aggregated minimum, so a hub with very many neighbours is never
    gathered, and the number of rounds grows with the logarithm of the
    longest path.  Nodes without an edge are not returned.
    """
    first = F.greatest(a, b), F.least(a, b)
    links = cut(edges.where(F.col(a) != F.col(b)).select(first[0].alias("u"), first[1].alias("v")).distinct())
    print_of = lambda df: df.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
    state = print_of(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        links = cut(small.where("u != v").distinct())
        previous, state = state, print_of(links)
        if state == previous:
            break
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
