"""Hidden Markov language model over words, with Baum-Welch training and exact likelihoods.

A state emits a word class and the class emits the word. Words with at least one in
``1 / own_class`` of all training tokens are classes of their own; all others share the
class of their last two bytes, in which a word's probability is its smoothed share.
So states and transitions are learned from every training token while the tables stay
of a fixed size, and a text's likelihood is still one over whole words:
forward recursion over the classes, times the word's share in its class.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .tables import binary_list, fold, map_arrow, row_keys, slices, whole_text

END = b""  # no word is empty
ADD = 0.1
STATES = 8
SHARED_CLASSES = 2048
OWN_CLASS = 2000  # a word is a class of its own from 1/2000 of the tokens: at most 2000 such classes
LISTED = 100_000  # words with 1/100000 of all tokens are sent to every task: at most 100000
START_ROWS = 1024  # training rows that the first parameters are fitted on
START_ROUNDS, FULL_ROUNDS = 12, 2
SLICE_TOKENS = 600_000
SLICE_BYTES = 2 << 20  # text that is coded at once


def words(text: bytes) -> list[bytes]:
    return text.lower().split()  # on bytes: A-Z, and the six ASCII spaces


def shared_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SHARED_CLASSES


def count_words(docs: DataFrame) -> DataFrame:
    """word, n (all tokens), c (training tokens) from rows (train, t); counted per batch before the shuffle."""

    def run(batch: pa.RecordBatch):
        every, train = Counter(), Counter()

        def out():
            names = list(every)
            c = pa.array([train[w] for w in names], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(list(every.values()), pa.int64()), c], ["word", "n", "c"])

        for t, learn in zip(binary_list(batch.column("t")), batch.column("train").to_pylist()):
            toks = words(t)
            toks.append(END)
            every.update(toks)
            if learn:
                train.update(toks)
            if len(every) > 400_000:
                yield out()
                every, train = Counter(), Counter()
        yield out()

    rows = map_arrow(docs.select("train", "t"), run, "word binary, n long, c long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task knows of the words: the listed ones, and totals of the shared classes."""

    total: int  # training tokens
    distinct: int
    listed: dict[bytes, int]  # word -> code; any other word has the code len(listed) + shared class
    count: np.ndarray  # training count of each listed word
    cls: np.ndarray  # class of each code
    n_classes: int
    log_share: np.ndarray  # log10 of what divides a word's count in its class; 0 for a class of one word

    @property
    def base_divisor(self) -> float:
        return np.log10(self.total + ADD * (self.distinct + 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct, every = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("n")).first()
    total, every = total or 0, every or 0
    rows = counts.where(F.col("n") * LISTED >= every).orderBy("word").collect()  # at most LISTED
    listed = {bytes(r.word): i for i, r in enumerate(rows)}
    count = np.array([r.c for r in rows], np.int64)
    own = (count * OWN_CLASS >= total) & (count > 0)

    def run(batch: pa.RecordBatch):
        n, v = np.zeros(SHARED_CLASSES, np.int64), np.zeros(SHARED_CLASSES, np.int64)
        at = np.array([shared_class(w) for w in binary_list(batch.column("word"))])
        np.add.at(n, at, batch.column("c").to_numpy())
        np.add.at(v, at, 1)
        some = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(v[some])], ["k", "n", "v"])

    shared = map_arrow(counts.where((F.col("c") > 0) & (F.col("c") * OWN_CLASS < total)).select("word", "c"), run, "k long, n long, v long")
    divisor = np.full(SHARED_CLASSES, ADD)  # room for words that were never seen
    for r in shared.groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        divisor[r.k] = r.n + ADD * (r.v + 1)
    cls = np.array([shared_class(w) for w in listed], np.int64) if listed else np.zeros(0, np.int64)
    cls[own] = SHARED_CLASSES + np.arange(own.sum())
    cls = np.concatenate([cls, np.arange(SHARED_CLASSES)])
    share = np.concatenate([np.log10(divisor), np.zeros(own.sum())])
    return Vocabulary(total, distinct or 0, listed, count, cls, SHARED_CLASSES + int(own.sum()), share)


def encode(docs: DataFrame, voc: Vocabulary) -> DataFrame:
    """Per row: classes (two bytes a token), what the listed words add, and the other words with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(voc))

    def run(batch: pa.RecordBatch):
        voc = Vocabulary(**shared.value)
        n = len(voc.listed)

        class Codes(dict):
            def __missing__(self, word):
                return n + shared_class(word)

        codes = Codes(voc.listed)
        log_c = np.log10(voc.count + ADD)
        in_shared = voc.cls[:n] < SHARED_CLASSES
        texts = binary_list(batch.column("t"))
        for first, end in slices(list(map(len, texts)), SLICE_BYTES):
            out: list[list] = [[] for _ in range(5)]
            other, tf, ends = [], [], [0]
            for t in texts[first:end]:
                toks = words(t)
                toks.append(END)
                code = np.fromiter(map(codes.__getitem__, toks), np.int64, len(toks))
                known = code < n
                at = code[known]
                rest = Counter([toks[i] for i in np.flatnonzero(~known).tolist()])
                row = (voc.cls[code].astype("<u2").tobytes(), len(toks), int((voc.count[at] > 0).sum()), float(log_c[at].sum()), float(log_c[at][in_shared[at]].sum()))
                for o, v in zip(out, row):
                    o.append(v)
                other += rest
                tf += rest.values()
                ends.append(len(other))
            rest = pa.StructArray.from_arrays([pa.array(other, pa.binary()), pa.array(tf, pa.int64())], ["word", "tf"])
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            arrays = [batch.column(i).slice(first, end - first) for i in range(4)] + [pa.array(o, k) for o, k in zip(out, kinds)]
            names = ["doc_id", "k_id", "k_text", "train", "classes", "n_tokens", "n_listed", "base_listed", "share_listed", "rest"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)], names)

    schema = "doc_id long, k_id long, k_text long, train boolean, classes binary, n_tokens long, n_listed long, base_listed double, share_listed double"
    return map_arrow(docs, run, schema + ", rest array<struct<word:binary,tf:bigint>>")


@dataclass
class Model:
    start: np.ndarray  # (states)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (states, classes)


def batches(sequences: list[np.ndarray]):
    """Sequences of about SLICE_TOKENS tokens, the longest first, laid out by time step."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    for i, j in slices([len(sequences[k]) for k in order], SLICE_TOKENS):
        part = order[i:j]
        size = np.array([len(sequences[k]) for k in part])
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # sequences longer than t
        begin = np.cumsum(active) - active
        flat = np.empty(size.sum(), np.int64)
        for row, k in enumerate(part):
            flat[begin[: size[row]] + row] = sequences[k]
        yield part, size, active, begin, flat


def forward(model: Model, active, begin, emitted, keep: bool):
    """Natural log of the scale of every step, in time-major layout; alphas too if they are kept."""
    move = model.move.astype(emitted.dtype)
    ones = np.ones((len(move), 1), emitted.dtype)
    scale = np.empty((len(emitted), 1), emitted.dtype)
    alphas = np.empty_like(emitted) if keep else None
    alpha = model.start.astype(emitted.dtype)[None, :]
    for t, (b, n) in enumerate(zip(begin.tolist(), active.tolist())):
        alpha = (alpha[:n] @ move if t else alpha) * emitted[b : b + n]
        c = alpha @ ones
        alpha = alpha / c
        scale[b : b + n] = c
        if keep:
            alphas[b : b + n] = alpha
    return scale, alphas


def log_likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each class sequence, by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    table = np.ascontiguousarray(model.emit.T)
    for part, size, active, begin, flat in batches(sequences):
        scale, _ = forward(model, active, begin, table[flat], False)
        logs = np.log10(scale[:, 0])
        total = np.zeros(len(part))
        for b, n in zip(begin.tolist(), active.tolist()):
            total[:n] += logs[b : b + n]
        out[part] = total
    return out


def expected_counts(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of starts, moves and emissions."""
    k, classes = model.emit.shape
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((k, classes))
    table = np.ascontiguousarray(model.emit.T, np.float32)
    step = np.ascontiguousarray(model.move.T, np.float32)
    for part, size, active, begin, flat in batches(sequences):
        emitted = table[flat]
        scale, alphas = forward(model, active, begin, emitted, True)
        beta = np.ones((len(part), k), np.float32)
        pairs = np.zeros((k, k))
        for t in range(len(active) - 1, 0, -1):
            b, n, before = begin[t], active[t], begin[t - 1]
            ahead = emitted[b : b + n] * beta[:n] / scale[b : b + n]
            alphas[b : b + n] *= beta[:n]  # alpha times beta is the posterior
            pairs += alphas[before : before + n].T @ ahead
            beta[:n] = ahead @ step
        alphas[: active[0]] *= beta
        move += pairs * model.move
        start += alphas[: active[0]].sum(axis=0)
        for s in range(k):
            emit[s] += np.bincount(flat, alphas[:, s], classes)
    return start, move, emit


def refit(start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
    """Parameters from expected counts; emissions are smoothed by the share of the class in all states."""
    k, classes = emit.shape
    prior = (emit.sum(axis=0) + ADD) / (emit.sum() + ADD * classes)
    emit = emit + k * prior
    start, move = start + ADD, move + ADD
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def first_model(sequences: list[np.ndarray], k: int, classes: int) -> Model:
    """Sticky states around rows that differ most from each other, then Baum-Welch on the sample."""
    sequences = [s for s in sequences if len(s) > 1]
    if not sequences:
        return refit(np.zeros(k), np.zeros((k, k)), np.zeros((k, classes)))
    bags = np.stack([np.bincount(s, minlength=classes) / len(s) for s in sequences[:256]])
    bags = np.sqrt(bags)
    chosen = [int(np.argmax([len(s) for s in sequences[:256]]))]
    while len(chosen) < k:
        chosen.append(int(np.argmin((bags @ bags[chosen].T).max(axis=1))))
    model = refit(np.ones(k), np.eye(k) * 200 + 1, bags[chosen] ** 2 * 500)
    for _ in range(START_ROUNDS):
        model = refit(*expected_counts(model, sequences))
    return model


def train(rows: DataFrame, n_rows: int, classes: int, states: int, rounds: int) -> Model:
    """Baum-Welch: first parameters from START_ROWS of the n_rows training rows, then counts of all of them in each round."""
    spark = rows.sparkSession
    learn = rows.where("train")
    h = F.pmod(F.xxhash64("k_id", "k_text"), F.lit(1 << 30))
    few = learn.where(h < int((1 << 30) * min(1.0, 2 * START_ROWS / max(n_rows, 1))))  # about twice as many as are taken
    sample = few.orderBy(h, "k_id").limit(START_ROWS).select(F.col("classes").alias("c"))
    model = first_model([np.frombuffer(bytes(r.c), "<u2").astype(np.int64) for r in sample.collect()], states, classes)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(vars(model))

        def run(parts):
            total = None
            for batch in parts:
                seqs = [np.frombuffer(c, "<u2").astype(np.int64) for c in batch.column("classes").to_pylist()]
                counts = expected_counts(Model(**shared.value), seqs)
                total = counts if total is None else tuple(a + b for a, b in zip(total, counts))
            if total is not None:
                flat = np.concatenate([x.ravel() for x in total])
                some = np.flatnonzero(flat)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], ["i", "v"])

        sums = learn.select("classes").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        flat = np.zeros(states + states * states + states * classes)
        flat[sums["i"].to_numpy(np.int64)] = sums["v"].to_numpy(np.float64)
        model = refit(flat[:states], flat[states : states + states**2].reshape(states, states), flat[states + states**2 :].reshape(states, classes))
    return model


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, states: int = STATES, rounds: int = FULL_ROUNDS
) -> DataFrame:
    """Every row scored by the model of the rows whose crc32(id) mod ``folds`` is not 0.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams with
    add-0.1) and score (log10 probability under the hidden Markov model). A null text is
    empty: one token, the end. A row with a null id is scored and neither learned from
    nor held out. Repeated rows count as often as they occur. Without any row to learn
    from every probability comes from the smoothing alone. Other columns are ignored.
    """
    rest = fold(id_col, folds)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), *row_keys(id_col, text_col),
        F.coalesce(rest != 0, F.lit(False)).alias("train"), whole_text(text_col).alias("t"),
    )
    counts = materialize(count_words(rows), "word-counts")
    voc = vocabulary(counts)
    coded = materialize(encode(rows, voc), "classes")
    n_rows = int(voc.count[voc.listed[END]]) if END in voc.listed else 0
    model = train(coded, n_rows, voc.n_classes, states, rounds)

    # Words outside the list: their counts come by a join; none has more than 1/LISTED of all tokens.
    other = coded.select("k_id", "k_text", F.explode("rest").alias("r")).select("k_id", "k_text", "r.word", "r.tf")
    other = other.join(counts.select("word", "c"), "word").groupBy("k_id", "k_text").agg(
        F.sum(F.expr(f"tf * log10(c + {ADD})")).alias("logs"), F.sum(F.expr("IF(c > 0, tf, 0)")).alias("known")
    )
    copies = coded.where(F.size("rest") > 0).groupBy("k_id", "k_text").agg(F.count("*").alias("copies"))
    other = other.join(copies, ["k_id", "k_text"])
    shared = docs.sparkSession.sparkContext.broadcast((vars(model), voc.log_share))

    def run(batch: pa.RecordBatch):
        model, share = shared.value
        seqs = [np.frombuffer(c, "<u2").astype(np.int64) for c in batch.column("classes").to_pylist()]
        inside = np.array([share[s].sum() for s in seqs])
        keep = [batch.column(c) for c in names[:-1]]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(log_likelihood(Model(**model), seqs) - inside)], names)

    names = ["doc_id", "k_id", "k_text", "n_tokens", "n_listed", "base_listed", "share_listed", "path"]
    schema = "doc_id long, k_id long, k_text long, n_tokens long, n_listed long, base_listed double, share_listed double, path double"
    scored = map_arrow(coded.select("classes", *names[:-1]), run, schema)
    logs = F.coalesce(F.col("logs") / F.col("copies"), F.lit(0.0))
    return scored.join(other, ["k_id", "k_text"], "left").select(
        "doc_id",
        F.coalesce(fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_listed") + F.coalesce((F.col("known") / F.col("copies")).cast("long"), F.lit(0))).alias("n_known"),
        F.lit(voc.total).cast("long").alias("train_tokens"),
        (F.col("base_listed") + logs - F.col("n_tokens") * float(voc.base_divisor)).alias("base_score"),
        (F.col("path") + F.col("share_listed") + logs).alias("score"),
    )
