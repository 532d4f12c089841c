"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

Every language has a character model of order ``ORDER``. The models share one sorted
array of n-gram hashes per order; beside each hash lie the log probabilities of the
n-gram's last character in every language, so one binary search serves all languages.
An n-gram that no language has is backed off by the weights of its context. A text gets
the language of the least cross-entropy per character, and is rejected when even that
lies far above what texts of its length reach in the learned rows.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import limit_batches, materialize
from .tables import fold, map_arrow, quoted, row_keys, slices, unused_name, whole_text

ORDER = 4
UNKNOWN = "und"
# The models are fitted on at most so many rows of each language, those of the least id hash.
ROWS_PER_LANG = 1500
# Characters worked on at a time: some 200 bytes for each are held meanwhile.
SLICE_CHARS = 1 << 18
# Rejected: above the mean cross-entropy by a bit a symbol and so many standard deviations.
REJECT_BITS, REJECT_Z = 1.0, 12.0
MULTIPLY = np.uint64(0x100000001B3)


def letter_table() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x10000)])


def symbols(texts: list[str], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and of each text its first place and number of letters.

    Letters are lower-cased; everything between two letters is one space; a text
    begins and ends with a space, and texts without letters have no symbols.
    """
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    lowered = [t.lower() for t in texts]
    for i, t in enumerate(lowered):
        size[i] = len(t)
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    low = code < 0x10000
    good = letter[np.where(low, code, 0)]
    if not low.all():
        good = good & low
        far = np.flatnonzero(~low)
        good[far] = [unicodedata.category(chr(c))[0] == "L" for c in code[far].tolist()]
    doc = np.repeat(np.arange(len(texts)), size)
    where = np.flatnonzero(good)
    doc, code = doc[where], code[where]
    letters = np.bincount(doc, minlength=len(texts))
    # A space stands before a letter that does not follow another, and at the end of a text.
    gap = np.ones(len(where), bool)
    gap[1:] = (np.diff(where) > 1) | (np.diff(doc) > 0)
    last = np.ones(len(where), bool)
    last[:-1] = np.diff(doc) > 0
    width = 1 + gap.astype(np.int64) + last
    at = np.cumsum(width) - width + gap
    out = np.full(int(width.sum()), 32, np.uint32)
    out[at] = code
    length = np.bincount(doc, weights=width, minlength=len(texts)).astype(np.int64)
    return out, np.cumsum(length) - length, length


def gram_hashes(code: np.ndarray, order: int) -> list[np.ndarray]:
    """hashes[n-1][i]: hash of the n symbols that end at place i (short at the very start)."""
    out = [(code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)]
    for _ in range(order - 1):
        before = np.concatenate([np.zeros(1, np.uint64), out[-1][:-1]])
        h = (before ^ (before >> np.uint64(29))) * MULTIPLY + out[0]
        out.append(h)
    return out


def usable(start: np.ndarray, length: np.ndarray, total: int) -> np.ndarray:
    """Number of symbols of the same text up to each place."""
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) - np.repeat(start[length > 0], length[length > 0]) + 1


def count_grams(rows: DataFrame, order: int) -> pd.DataFrame:
    """lang, n, gram, context, suffix (the gram without its first symbol), c: counts in the sample."""

    def run(batch: pa.RecordBatch):
        letter = letter_table()
        langs, texts = batch.column("lang").to_pylist(), batch.column("t").to_pylist()
        for lang in sorted(set(langs)):
            own = [t for t, x in zip(texts, langs) if x == lang]
            for i, j in slices([len(t) for t in own], SLICE_CHARS):
                code, start, length = symbols(own[i:j], letter)
                h = gram_hashes(code, order)
                room = usable(start, length, len(code))
                for n in range(1, order + 1):
                    end = np.flatnonzero(room >= n)
                    g, first, c = np.unique(h[n - 1][end], return_index=True, return_counts=True)
                    end = end[first]
                    zero = np.zeros(len(end), np.uint64)
                    context = h[n - 2][end - 1] if n > 1 else zero
                    suffix = h[n - 2][end] if n > 1 else zero
                    columns = [pa.array([lang] * len(g)), pa.array(np.full(len(g), n)), *(pa.array(x.view(np.int64)) for x in (g, context, suffix)), pa.array(c)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "n", "gram", "context", "suffix", "c"])

    counted = map_arrow(rows, run, "lang string, n long, gram long, context long, suffix long, c long")
    return counted.groupBy("lang", "n", "gram", "context", "suffix").agg(F.sum("c").alias("c")).toPandas()


@dataclass
class Models:
    langs: list[str]
    grams: list[np.ndarray]  # per order: sorted hashes
    logp: list[np.ndarray]  # per order: log2 probability of the last symbol, (grams, languages)
    contexts: list[np.ndarray]  # per order above the first: sorted hashes of its contexts
    backoff: list[np.ndarray]  # log2 weight of the lower order, 0 where the language lacks the context
    floor: float  # log2 probability of a symbol that no language has
    mean: np.ndarray  # cross-entropy of each language in its learned rows
    spread: np.ndarray  # its standard deviation times the square root of the length

    def look_up(self, keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return at, keys[at] == h

    def entropy(self, code: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Bits of each text under each language (texts, languages)."""
        order, n_lang = len(self.grams), len(self.langs)
        h = gram_hashes(code, order)
        room = usable(start, length, len(code))
        logp = np.zeros((len(code), n_lang), np.float32)
        todo = np.arange(len(code))
        for n in range(order, 0, -1):
            fit = room[todo] >= n
            rest, todo = todo[~fit], todo[fit]
            at, found = self.look_up(self.grams[n - 1], h[n - 1][todo])
            logp[todo[found]] += self.logp[n - 1][at[found]]
            todo = todo[~found]
            if n > 1 and len(todo):
                at, found = self.look_up(self.contexts[n - 2], h[n - 2][todo - 1])
                logp[todo[found]] += self.backoff[n - 2][at[found]]
            elif n == 1:
                logp[todo] += self.floor
            todo = np.concatenate([rest, todo])
        some = np.flatnonzero(length)
        bits = np.zeros((len(length), n_lang))
        if len(some):
            bits[some] = -np.add.reduceat(logp.astype(np.float64), start[some], axis=0)
        return bits


def kneser_ney(counts: pd.DataFrame, order: int) -> Models:
    """Interpolated Kneser-Ney: raw counts at the highest order, numbers of different left symbols below."""
    langs = sorted(counts["lang"].unique())
    counts = counts.assign(lang=counts["lang"].map({x: i for i, x in enumerate(langs)}))
    by_order = [counts[counts["n"] == n] for n in range(1, order + 1)]
    for n in range(order - 1):
        left = by_order[n + 1].groupby(["lang", "suffix"]).size().rename("left").reset_index()
        own = by_order[n].merge(left, left_on=["lang", "gram"], right_on=["lang", "suffix"], how="left", suffixes=("", "_l"))
        # What only begins a text has no symbol to its left: it counts once.
        by_order[n] = own.assign(c=own["left"].fillna(1))
    n_lang, unique = len(langs), lambda x: np.unique(x.to_numpy().view(np.uint64))
    vocabulary = len(unique(by_order[0]["gram"])) + 1
    lower = np.full((1, n_lang), 1.0 / vocabulary)
    grams, logp, contexts, backoff = [], [], [], []
    for n, own in enumerate(by_order, 1):
        lang = own["lang"].to_numpy()
        g, ctx, suf = (own[k].to_numpy().view(np.uint64) for k in ("gram", "context", "suffix"))
        c = own["c"].to_numpy(np.float64)
        once, twice = np.bincount(lang, c == 1, n_lang), np.bincount(lang, c == 2, n_lang)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
        keys, keys_ctx = np.unique(g), np.unique(ctx)
        row, row_ctx = np.searchsorted(keys, g), np.searchsorted(keys_ctx, ctx)
        total, kinds = np.zeros((len(keys_ctx), n_lang)), np.zeros((len(keys_ctx), n_lang))
        np.add.at(total, (row_ctx, lang), c)
        np.add.at(kinds, (row_ctx, lang), 1)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        # The same gram has the same context and suffix in every language.
        ctx_of, suf_of = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.uint64)
        ctx_of[row], suf_of[row] = row_ctx, suf
        below = lower if n == 1 else lower[np.searchsorted(grams[-1], suf_of)]
        p = weight[ctx_of] * below
        np.add.at(p, (row, lang), np.maximum(c - discount[lang], 0) / total[row_ctx, lang])
        grams.append(keys)
        logp.append(np.log2(p).astype(np.float32))
        if n > 1:
            contexts.append(keys_ctx)
            backoff.append(np.log2(weight).astype(np.float32))
        lower = p
    return Models(langs, grams, logp, contexts, backoff, float(-np.log2(vocabulary)) - 8, np.zeros(n_lang), np.ones(n_lang))


def calibrate(models: Models, rows: DataFrame) -> None:
    """Mean and spread of the cross-entropy that each language's learned rows have in their own model."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(models))

    def run(batch: pa.RecordBatch):
        m, letter = Models(**shared.value), letter_table()
        lang = np.array([m.langs.index(x) for x in batch.column("lang").to_pylist()])
        texts = batch.column("t").to_pylist()
        for i, j in slices([len(t) for t in texts], SLICE_CHARS):
            code, start, length = symbols(texts[i:j], letter)
            bits = m.entropy(code, start, length)[np.arange(j - i), lang[i:j]]
            some = length > 0
            yield pa.RecordBatch.from_arrays([pa.array(lang[i:j][some]), pa.array(bits[some]), pa.array(length[some])], ["lang", "bits", "n"])

    e = map_arrow(rows, run, "lang long, bits double, n long").groupBy("lang").agg(
        F.sum("bits").alias("b"), F.sum("n").alias("n"), F.count("*").alias("rows"),
        F.sum(F.expr("bits * bits / n")).alias("bb"),
    )
    for r in e.collect():
        mean = r.b / r.n
        models.mean[r.lang] = mean
        # Sum over rows of n (ce - mean)^2, per row: the variance of one symbol's bits.
        models.spread[r.lang] = np.sqrt(max(r.bb - mean * r.b, 0) / r.rows) + 0.5


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held: int, rows_per_lang: int, order: int) -> Models | None:
    """Models from a bounded sample of the learned rows; None if no row can be learned from."""
    rows = docs.where((fold(id_col, folds) != held) & F.col(lang_col).isNotNull())
    key = F.xxhash64(F.col(id_col).cast("long"))
    # About twice as many of each language as are taken go on to the ranking, so that it stays small. The
    # sizes are one row a language, far less than the models that every task gets later; broadcast, they
    # leave the rows where they are until the share is taken.
    lang = F.col(lang_col).cast("string").alias("lang")
    sizes = rows.groupBy(lang).agg(F.least(F.lit(1.0), F.lit(2.0 * rows_per_lang) / F.count("*")).alias("share"))
    ids = rows.select(lang, key.alias("h"), *row_keys(id_col, text_col)).join(F.broadcast(sizes), "lang")
    ids = ids.where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    ids = ids.withColumn("nth", F.expr("row_number() OVER (PARTITION BY lang ORDER BY h, k_text)")).where(F.col("nth") <= rows_per_lang)
    wanted = ids.select("lang", "k_id", "k_text").distinct()
    texts = rows.select(F.col(lang_col).cast("string").alias("lang"), *row_keys(id_col, text_col), whole_text(text_col).alias("t"))
    sample = materialize(texts.join(wanted, ["lang", "k_id", "k_text"], "left_semi").select("lang", "t"), "language-sample")
    counts = count_grams(sample, order)
    if not len(counts):
        return None
    models = kneser_ney(counts, order)
    calibrate(models, sample)
    return models


ADDED = ["held_out", "lang_pred", "score", "cross_entropy", "rejected"]


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held: int = 1,
    rows_per_lang: int = ROWS_PER_LANG, order: int = ORDER, names: list[str] = ADDED,
) -> DataFrame:
    """The rows of ``docs`` with held_out, lang_pred, score, cross_entropy (bits a symbol) and rejected added.

    Learned from rows whose crc32(id) mod ``folds`` is not ``held`` and whose language
    is given; ids and languages are never inputs of a prediction. A text that is null
    or has no letter gets ``und``, score 0, and is rejected. Other texts get the
    language of the least cross-entropy (ties: the first in order); score is its share
    of the probability, tempered by length, and rejected tells that the cross-entropy
    exceeds the learned mean by more than ``REJECT_BITS`` and ``REJECT_Z`` deviations. If no row can be
    learned from, every text is ``und`` and rejected. A null id is neither learned from
    nor held out. The added columns, called ``names``, replace columns of those names.
    """
    limit_batches(docs.sparkSession)
    models = fit(docs, id_col, text_col, lang_col, folds, held, rows_per_lang, order)
    out = docs.drop(*names).withColumn(names[0], F.coalesce(fold(id_col, folds) == held, F.lit(False)))
    if models is None:
        values = [F.lit(UNKNOWN), F.lit(0.0), F.lit(None).cast("double"), F.lit(True)]
        return out.withColumns(dict(zip(names[1:], values)))
    shared = docs.sparkSession.sparkContext.broadcast(vars(models))
    position = out.columns.index(text_col)
    kinds = [T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*out.schema.fields, *(T.StructField(n, k) for n, k in zip(names[1:], kinds))])
    columns = schema.names

    def run(parts):
        m, letter = None, None
        for batch in parts:
            if m is None:
                m, letter = Models(**shared.value), letter_table()
            texts = [t or "" for t in batch.column(position).to_pylist()]
            for i, j in slices([len(t) for t in texts], SLICE_CHARS):
                code, start, length = symbols(texts[i:j], letter)
                ce = m.entropy(code, start, length) / np.maximum(length, 1)[:, None]
                best = ce.argmin(axis=1)
                least = ce[np.arange(len(ce)), best]
                share = 1 / np.exp2(-(ce - least[:, None]) * np.sqrt(np.maximum(length, 1))[:, None]).sum(axis=1)
                none = length == 0
                worst = m.mean[best] + REJECT_BITS + REJECT_Z * m.spread[best] / np.sqrt(np.maximum(length, 1))
                pred = np.where(none, UNKNOWN, np.array(m.langs, object)[best])
                new = [
                    pa.array(pred.tolist(), pa.string()), pa.array(np.where(none, 0.0, share)),
                    pa.array(least, mask=none), pa.array(none | (least > worst)),
                ]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, *new], columns)

    return out.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The rows that :func:`identify` does not reject, with the columns of ``docs`` and nothing else."""
    names = [unused_name(docs, n) for n in ADDED]
    return identify(docs, names=names, **options).where(F.col(names[-1]) == F.lit(False)).select(*quoted(docs))
