"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts of up to ``order`` bytes.  A symbol
seen in a context costs ``-log2(count / (n + distinct))`` bits; an unseen one
costs the escape ``-log2(distinct / (n + distinct))`` and is coded in the next
shorter context, down to 256 equal symbols.  The statistics are frozen after
fitting, so the cost of a symbol depends on its last bytes alone and the whole
escape chain can be worked out per context beforehand.  Texts are then scored
by array look-ups: the exact code length of every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import in_fold, uniform, with_text

ORDER = 3  # bytes of context; a start mark of as many zero bytes precedes each text
SAMPLE_DOCS = 2000  # expected documents per language to fit on, chosen by a hash of the id
LEAST_COUNT = 8  # a context seen less often has no node of its own
UNDETERMINED = "und"
FOREIGN_BITS = 6.0  # bits a byte beyond which a text is in no learned language; learned ones take some two or three
FOREIGN_SLACK = 64.0
_PIECE = 1 << 20


@dataclass
class ContextTrees:
    """Frozen trees of all languages in one table.

    ``pair[two bytes] -> p``, ``node[p, byte] -> row``: the longest context that
    any language holds.  ``cost[row, symbol, language]`` is in bits.
    """

    languages: list[str]
    pair: np.ndarray
    node: np.ndarray
    symbol: np.ndarray
    cost: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        pad = b"\0" * ORDER
        group: list[tuple[int, bytes]] = []
        held = 0
        for k, raw in enumerate(texts):
            for at in range(0, len(raw), _PIECE):
                before = pad if at == 0 else raw[at - ORDER : at]
                group.append((k, before + raw[at : at + _PIECE]))
                held += len(group[-1][1])
                if held >= _PIECE:
                    self._add(out, group)
                    group, held = [], 0
        if group:
            self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bytes]]) -> None:
        data = np.frombuffer(b"".join(piece for _, piece in group), np.uint8)
        two = (data[:-3].astype(np.int32) << 8) | data[1:-2]
        row = self.node[self.pair[two], data[2:-1]]
        cost = self.cost[row, self.symbol[data[3:]]]
        sizes = np.array([len(piece) for _, piece in group])
        ends = np.cumsum(sizes)
        bounds = np.stack([ends - sizes, ends - ORDER], axis=1).ravel()  # the start marks in between are not coded
        sums = np.add.reduceat(np.vstack([cost, np.zeros((1, cost.shape[1]), cost.dtype)]), np.minimum(bounds, len(cost)), axis=0, dtype=np.float64)[::2]
        np.add.at(out, [k for k, _ in group], sums)


def normalised(text: str | None) -> bytes:
    return b"" if text is None else text.lower().encode("utf-8", "replace")


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of all (context, symbol) strings of ``ORDER + 1`` bytes, combined within a batch of texts."""
    pad = b"\0" * ORDER
    for batch in batches:
        for lang, part in batch.groupby("lang"):
            for lo in range(0, len(part), 64):
                codes = []
                for text in part["text"].iloc[lo : lo + 64]:
                    data = np.frombuffer(pad + normalised(text), np.uint8).astype(np.uint32)
                    if len(data) > ORDER:
                        codes.append((data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:])
                if codes:
                    gram, n = np.unique(np.concatenate(codes), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": gram.astype(np.int64), "n": n.astype(np.int64)})


def sample(docs: DataFrame, text: str, lang: str, ident: str, most: int, seed: int = 11) -> DataFrame:
    """About ``most`` documents of each language, by a hash of their ids; all of a language that has fewer."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(ident).alias("doc"))
    # One entry per language, as in the model itself; a join would gather the texts of a language.
    shares = [x for r in known.groupBy("lang").count().collect() for x in (F.lit(r["lang"]), F.lit(float(most) / r["count"]))]
    if not shares:
        return known.select("lang", "text")
    share = F.element_at(F.create_map(*shares), F.col("lang"))
    return known.where(uniform(seed, F.col("doc")) < share).select("lang", "text")


def build(counts: pd.DataFrame, least: int = LEAST_COUNT) -> ContextTrees:
    """The cost table from counts ``(lang, gram, n)``."""
    languages = sorted(counts["lang"].unique())
    grams = {lang: (part["gram"].to_numpy(np.int64), part["n"].to_numpy(np.int64)) for lang, part in counts.groupby("lang")}
    symbols = np.unique(np.concatenate([g & 255 for g, _ in grams.values()]))
    symbol = np.full(256, len(symbols), np.int64)  # symbols no language has seen share the last column
    symbol[symbols] = np.arange(len(symbols))
    width, n_lang = len(symbols) + 1, len(languages)

    def level(lang: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts of ``k`` bytes, the symbol after each, and the count, for one language."""
        gram, n = grams[lang]
        keys, at = np.unique(gram & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        return keys >> 8, symbol[keys & 255], np.bincount(at, weights=n)

    def coded(contexts: np.ndarray, lang: str, k: int, shorter: np.ndarray) -> np.ndarray:
        """Costs in the given contexts; ``shorter`` holds each one's costs one byte shorter."""
        context, sym, n = level(lang, k)
        at = np.searchsorted(contexts, context)
        hit = (at < len(contexts)) & (contexts[np.minimum(at, len(contexts) - 1)] == context)
        at, sym, n = at[hit], sym[hit], n[hit]
        total, distinct = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
        own = total >= least if k else total > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = -np.log2(distinct / (total + distinct))
            out = np.where(own[:, None], escape[:, None] + shorter, shorter)
            seen = own[at]
            out[at[seen], sym[seen]] = -np.log2(n[seen] / (total + distinct)[at[seen]])
        return out

    held = []
    for k in range(ORDER + 1):
        keys = []
        for lang in languages:
            context, _, n = level(lang, k)
            values, at = np.unique(context, return_inverse=True)
            keys.append(values[np.bincount(at, n) >= least] if k else values)
        held.append(np.unique(np.concatenate(keys)) if k != 1 else np.arange(256))
    starts = np.cumsum([0, 256, *[len(held[k]) for k in range(2, ORDER + 1)]])
    cost = np.empty((starts[-1], width, n_lang), np.float32)
    for j, lang in enumerate(languages):
        root = coded(np.zeros(1, np.int64), lang, 0, np.full((1, width), 8.0))
        below = coded(held[1], lang, 1, np.repeat(root, 256, axis=0))
        cost[:256, :, j] = below
        for k in range(2, ORDER + 1):
            # A context whose shorter form no language holds takes the next shorter one.
            tail = held[k] & ((1 << 8 * (k - 1)) - 1)
            if k == 2:
                shorter = cost[tail, :, j]
            else:
                at = np.minimum(np.searchsorted(held[2], tail), len(held[2]) - 1)
                shorter = np.where((held[2][at] == tail)[:, None], cost[256 + at, :, j], cost[tail & 255, :, j])
            cost[starts[k - 1] : starts[k], :, j] = coded(held[k], lang, k, shorter)

    two, three = held[2], held[3]
    heads = np.unique(three >> 8)
    pair = np.tile(np.arange(256), 256).astype(np.int32)  # without a longer context only the last byte counts
    pair[heads] = 256 + np.arange(len(heads))
    node = np.tile(np.arange(256, dtype=np.int32), (256 + len(heads), 1))
    last = np.concatenate([np.arange(256), heads & 255])
    want = (last[:, None] << 8) | np.arange(256)[None, :]
    at = np.minimum(np.searchsorted(two, want), len(two) - 1)
    node = np.where(two[at] == want, 256 + at, node).astype(np.int32)
    where = np.searchsorted(heads, three >> 8)
    node[256 + where, three & 255] = starts[2] + np.arange(len(three))
    return ContextTrees(languages, pair, node, symbol.astype(np.int32), cost)


def fit(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> ContextTrees | None:
    """Trees of every language in ``docs``; None if no row has both a text and a language.

    The table collected holds distinct strings of four bytes of the sample, so
    its size is bounded by ``sample_docs`` and not by the corpus.
    """
    rows = sample(with_text(docs, ident, text, lang), text, lang, ident, sample_docs)
    grams = rows.mapInPandas(_count_grams, "lang string, gram long, n long")
    counts = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return build(counts) if len(counts) else None


def _posterior(bits: np.ndarray) -> np.ndarray:
    odds = np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0))
    return odds / odds.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, trees: ContextTrees | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, the posterior of the language at equal priors, and ``excess``.

    ``excess`` are the bits by which the language's code of the text is longer than
    ``FOREIGN_BITS`` a byte and ``FOREIGN_SLACK`` in all would allow; a text in none of the languages exceeds it.
    Null texts and texts without a letter are ``und`` with score 0, as is
    everything when there are no trees.
    """
    held = docs.sparkSession.sparkContext.broadcast(trees and vars(trees))  # plain arrays: workers need no copy of this module

    @F.pandas_udf("lang_pred string, score double, excess double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = ContextTrees(**held.value) if held.value else None
        for texts in batches:
            out = pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0, "excess": 0.0})
            known = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            if model is not None and known:
                raws = [normalised(texts.iloc[k]) for k in known]
                bits = model.bits(raws)
                share = _posterior(bits)
                best = share.argmax(axis=1)
                allowed = FOREIGN_BITS * np.array([len(r) for r in raws]) + FOREIGN_SLACK
                out.loc[known, "excess"] = bits[np.arange(len(best)), best] - allowed
                out.loc[known, "lang_pred"] = np.array(model.languages, dtype=object)[best]
                out.loc[known, "score"] = share[np.arange(len(best)), best]
            yield out

    return docs.withColumn("_guess", guess(F.col(f"`{text}`"))).select(*[F.col(f"`{c}`") for c in docs.columns], "_guess.lang_pred", "_guess.score", "_guess.excess")


def identify(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held_out: int = 2, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per document: ``ident``, ``held_out``, ``lang_pred``, ``score``; trees are fitted outside the held-out fold."""
    rows = with_text(docs, ident, text, lang)
    trees = fit(rows.where(~in_fold(ident, folds, held_out)), ident, text, lang, sample_docs)
    scored = predict(rows.select(ident, in_fold(ident, folds, held_out).alias("held_out"), text), trees, text)
    return scored.select(ident, "held_out", "lang_pred", "score")


def known_language(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` in one of the learned languages; columns unchanged.

    A document goes if it has no letter, or if even the best language's trees need
    more than ``FOREIGN_BITS`` bits a byte for it (and ``FOREIGN_SLACK`` bits, so that few unusual bytes
    decide nothing): it is in none of them.  Null and empty texts go; repeated rows fare alike; without any
    learned language, and in an empty table, nothing is kept.
    """
    trees = fit(docs.where(~in_fold(ident, 4, 2)), ident, text, lang)
    names = docs.columns
    inner = docs.toDF(*[f"c{k}" for k in range(len(names))])
    kept = predict(inner, trees, f"c{names.index(text)}").where((F.col("lang_pred") != UNDETERMINED) & (F.col("excess") <= 0))
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
