"""Text quality: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import binary_list, fold, map_arrow, whole_text

BITS = 18
# The classifier is fitted on at most so many labelled rows, those of the least id hash.
TRAIN_ROWS = 20_000
# Each round trains the shards side by side from the mean weights of the round before.
SHARDS, ROUNDS = 4, 5
ALPHA, BETA, L1, L2 = 0.2, 1.0, 1e-4, 1e-3
THRESHOLD = 0.3
TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+")


def share_mark(name: bytes, part: int, whole: int) -> int:
    """A feature for the tenth (finer near 0) in which a share lies."""
    x = part / whole if whole else 0.0
    return zlib.crc32(b"<%s %d>" % (name, int(10 * x) if x >= 0.1 else -1 - int(100 * x)))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed one- and two-word features of a whole text with unit length each kind, and marks of its make-up.

    Words are runs of letters and digits, or of signs. The marks are features of the
    same table: length, share of different words, of capitals, of signs, of lines.
    """
    toks = TOKEN.findall(text)
    n = len(toks)
    mask = np.uint32((1 << BITS) - 1)
    one = np.fromiter(map(zlib.crc32, toks), np.uint32, n)
    kinds = [one]
    if n > 1:
        two = one[:-1] * np.uint32(0x9E3779B1) + one[1:]
        kinds.append(two ^ (two >> np.uint32(15)))
    index, value = [], []
    for h in kinds:
        if len(h):
            u, c = np.unique(h & mask, return_counts=True)
            index.append(u)
            value.append(c / np.sqrt((c.astype(np.float64) ** 2).sum()))
    data = np.frombuffer(text, np.uint8)
    capital = int(((data >= 65) & (data <= 90)).sum())
    letter = capital + int((((data >= 97) & (data <= 122)) | (data >= 128)).sum())
    blank = int(((data == 32) | ((data >= 9) & (data <= 13))).sum())
    marks = [
        zlib.crc32(b"<words %d>" % n.bit_length()),
        share_mark(b"different", len(np.unique(one)), n),
        share_mark(b"different pairs", len(np.unique(kinds[-1])), len(kinds[-1])),
        share_mark(b"capital", capital, letter),
        share_mark(b"sign", len(data) - letter - blank, len(data)),
        share_mark(b"line", text.count(b"\n"), n),
        zlib.crc32(b"<letters a word %d>" % (letter // n if n else -1)),
        zlib.crc32(b"<bias>"),
    ]
    index.append(np.array(marks, np.uint32) & mask)
    value.append(np.full(len(marks), 0.5))
    return np.concatenate(index).astype(np.int64), np.concatenate(value)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Leader:
    """FTRL-proximal state of every weight."""

    def __init__(self, start: np.ndarray | None = None):
        self.n = np.zeros(1 << BITS)
        # z such that the weights begin at ``start`` before any gradient is seen.
        self.z = np.zeros(1 << BITS) if start is None else -start * (BETA / ALPHA + L2) - np.sign(start) * L1

    def weights(self, i) -> np.ndarray:
        z = self.z[i]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[i])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, i: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(i)
        g = (sigmoid(w @ x) - label) * x
        more = self.n[i] + g * g
        self.z[i] += g - (np.sqrt(more) - np.sqrt(self.n[i])) / ALPHA * w
        self.n[i] = more


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, rows: int) -> np.ndarray:
    """The mean weights of the shards, after all rounds; zero if there is nothing to learn from."""
    spark = docs.sparkSession
    lab = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    lab = lab.where("id IS NOT NULL AND label IN (0, 1)").where(fold("id", folds) != 0)
    # Written: at most ``rows`` short rows, whose file size lets the texts stay where they are.
    lab = materialize(lab.withColumn("h", F.xxhash64("id")).orderBy("h", "id", "label").limit(rows), "quality-labels")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t"))

    def run(batch: pa.RecordBatch):
        out: list[list] = [[], []]
        for t in binary_list(batch.column("t")):
            i, x = features(t)
            out[0].append(i.astype("<i4").tobytes())
            out[1].append(x.astype("<f4").tobytes())
        arrays = [batch.column("h"), batch.column("label"), *(pa.array(o, pa.binary()) for o in out)]
        yield pa.RecordBatch.from_arrays(arrays, ["h", "label", "i", "x"])

    sample = map_arrow(texts.join(lab, "id").select("h", "label", "t"), run, "h long, label int, i binary, x binary")
    sample = materialize(sample.withColumn("shard", F.pmod("h", F.lit(SHARDS))), "quality-sample")
    mean = np.zeros(1 << BITS, np.float32)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(mean)

        def trained(model, n):
            w = model.weights(slice(None)).astype("<f4").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([n]), pa.array([w], pa.binary())], ["n", "w"])

        def train(batches):
            model, own, n = None, None, 0
            for batch in batches:
                for shard, label, i, x in zip(*(batch.column(k).to_pylist() for k in ("shard", "label", "i", "x"))):
                    if shard != own:  # a task may have several shards, or none
                        if n:
                            yield trained(model, n)
                        model, own, n = Leader(shared.value.astype(np.float64)), shard, 0
                    model.learn(np.frombuffer(i, "<i4"), np.frombuffer(x, "<f4").astype(np.float64), label)
                    n += 1
            if n:
                yield trained(model, n)

        sharded = sample.repartition(SHARDS, "shard").sortWithinPartitions("shard", "h", "label").select("shard", "label", "i", "x")
        parts = sharded.mapInArrow(train, "n long, w binary").collect()  # at most SHARDS rows
        if parts:
            total = sum(r.n for r in parts)
            mean = sum(np.frombuffer(bytes(r.w), "<f4") * np.float32(r.n / total) for r in parts)
    return mean


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5,
    rows: int = TRAIN_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted of every row.

    Learned from labelled rows whose crc32(id) mod ``folds`` is not 0: at most ``rows``
    of them, of the least id hash. Ids, labels and other columns are never inputs of a
    score. A null or empty text has the marks of an empty text only. Repeated rows and
    repeated labels count as often as they occur; labels other than 0 and 1 are
    ignored. A null id is neither learned from nor held out. Without labels to learn
    from the score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, folds, rows))

    def run(batch: pa.RecordBatch):
        w = shared.value
        score = []
        for t in binary_list(batch.column("t")):
            i, x = features(t)
            score.append(float(w[i] @ x))
        s = sigmoid(np.array(score))
        predicted = pa.array((s >= threshold).astype(np.int32))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(s), predicted], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold(id_col, folds) == 0, F.lit(False)).alias("held_out")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), held, whole_text(text_col).alias("t"))
    return map_arrow(texts, run, "doc_id long, held_out boolean, score double, predicted int")
