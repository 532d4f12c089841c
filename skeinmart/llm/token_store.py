"""Token ids of documents in ORC files, in order of the documents' ids.

ORC holds the ids as a list column whose integers are run-length encoded by stripe, with
a row index and a Bloom filter on the document id. Stripes are read in parallel; a
lookup by document id skips files, stripes and row groups by their statistics and filters.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import fresh_dir
from .tables import map_arrow, slices, whole_text

END_ID = 2
# Bytes of text that are encoded at once, and pieces whose ids a worker remembers.
BATCH_BYTES, REMEMBERED = 4 << 20, 1 << 20
# Pieces that are encoded in one string.
JOINED = 64
# Text of a file, before encoding: it sets the number of range partitions.
FILE_BYTES = 64 << 20
# A vocabulary travels to the executors whole; a larger one is refused.
MOST_VOCABULARY = 64 << 20
STRIPE_BYTES, INDEX_ROWS, BLOOM_RATE = 16 << 20, 1000, 0.01
# One row a document: its place among the documents (part, seq), the ids before it in its part, its own ids.
FILE_SCHEMA = "doc_id long, part int, seq long, part_start long, n_tokens long, ids array<int>"

# What the pattern of byte-level BPE takes for white space, and at least that, as a class of RE2.
_BLANK = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_MARKS = ("\x00", "\x01", "\x02", "\x03")


def _mostly(texts: pa.StringArray, odd: pa.BooleanArray, plain: Callable, careful: Callable) -> pa.StringArray:
    """The texts changed by ``plain``, and the odd ones by ``careful``."""
    if not pc.any(odd).as_py():
        return plain(texts)
    return pc.replace_with_mask(plain(texts), odd, careful(texts.filter(odd)))


def pieces(texts: pa.StringArray) -> pa.ListArray:
    """Each text cut where encoding the pieces gives the ids of the whole.

    Byte-level BPE never merges over the borders of its pattern, and these are borders
    whatever stands around them: before a blank that a sign follows, and on both sides of
    a line end between two signs. A text that has all the marks used to cut stays whole.
    """
    mark = next((m for m in _MARKS if not pc.any(pc.match_substring(texts, m)).as_py()), None)
    if mark is None:
        if len(texts) == 1:
            return pa.ListArray.from_arrays(pa.array([0, 1], pa.int32()), texts)
        half = len(texts) // 2
        return pa.concat_arrays([pieces(texts.slice(0, half)), pieces(texts.slice(half))])
    # Most texts have no other blanks and line ends than such: for them a plain replacement does.
    odd = pc.match_substring_regex(texts, f" ([{_BLANK}]|$)")
    cut = _mostly(texts, odd, lambda t: pc.replace_substring(t, " ", f"{mark} "), lambda t: pc.replace_substring_regex(t, f" ([^{_BLANK}])", f"{mark} \\1"))
    other = f"([^{_BLANK}\\x{ord(mark):02x}])"
    odd = pc.match_substring_regex(texts, f"(^|[{_BLANK}])\n|\n([{_BLANK}]|$)")
    cut = _mostly(
        cut, odd, lambda t: pc.replace_substring(t, "\n", f"{mark}\n{mark}"),
        lambda t: pc.replace_substring_regex(t, f"{other}\n{other}", f"\\1{mark}\n{mark}\\2"),
    )
    return pc.split_pattern(cut, mark)


def _strings(texts: pa.StringArray) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of texts; every different piece is encoded once as long as it is remembered."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(vocabulary)
        # Bytes that an id stands for: a byte-level vocabulary writes each as one sign.
        self.bytes = np.zeros(self.model.get_vocab_size(), np.int64)
        for sign, i in self.model.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = len(sign)
        for i, token in self.model.get_added_tokens_decoder().items():
            self.bytes[i] = len(token.content.encode())
        # Of each piece its place, and by place: where its ids begin, how many it has, whether another batch had it.
        self.place: dict[str, int] = {}
        self.ids, self.first, self.count, self.used = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def forget(self) -> None:
        """Keep only pieces that a later batch had again, if those are at most half of what may be remembered."""
        keep = np.flatnonzero(self.used) if 2 * self.used.sum() <= REMEMBERED else np.zeros(0, np.int64)
        n = self.count[keep]
        shift = np.repeat(self.first[keep] - (np.cumsum(n) - n), n)
        words = list(self.place)  # in order of their places
        self.place = {words[i]: k for k, i in enumerate(keep.tolist())}
        self.ids, self.count = self.ids[shift + np.arange(len(shift))], n
        self.first, self.used = np.cumsum(n) - n, np.zeros(len(n), bool)

    def singly(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and how many each has."""
        found = [e.ids for i in range(0, len(new), 4096) for e in self.model.encode_batch_fast(new[i : i + 4096], add_special_tokens=False)]
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(n.sum())), n

    def joined(self, new: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of ``size`` bytes that begin with a blank and a sign, many in one string.

        Ids of byte-level BPE stand for bytes, so their lengths tell where the pieces end.
        """
        ids, _ = self.singly(["".join(new[i : i + JOINED]) for i in range(0, len(new), JOINED)])
        ends = np.cumsum(size)
        upto = np.cumsum(self.bytes[ids])
        at = np.searchsorted(upto, ends)
        if len(at) and (at[-1] + 1 != len(ids) or (upto[at] != ends).any()):
            return self.singly(new)  # not a byte-level vocabulary
        return ids, np.diff(at, prepend=-1)

    def learn(self, new: pa.StringArray) -> np.ndarray:
        """Encode and remember pieces; returns their places."""
        plain = pc.match_substring_regex(new, f"^ [^{_BLANK}]").to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        words, n, known = _strings(new.take(pa.array(order))), int(plain.sum()), len(self.count)
        size = pc.binary_length(new).to_numpy()[plain].astype(np.int64)
        parts = [(self.ids, self.count), self.joined(words[:n], size), self.singly(words[n:])]
        self.place.update(zip(words, range(known, known + len(words))))
        self.ids, self.count = (np.concatenate(x) for x in zip(*parts))
        self.first = np.cumsum(self.count) - self.count
        self.used = np.append(self.used, np.zeros(len(words), bool))
        places = np.empty(len(words), np.int64)
        places[order] = np.arange(known, known + len(words))
        return places

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if len(self.place) > REMEMBERED:
            self.forget()
        cut = pieces(texts)
        coded = cut.flatten().dictionary_encode()
        place = np.fromiter(map(self.place.get, _strings(coded.dictionary), repeat(-1)), np.int64, len(coded.dictionary))
        new = np.flatnonzero(place < 0)
        self.used[place[place >= 0]] = True
        if len(new):
            place[new] = self.learn(coded.dictionary.take(pa.array(new)))
        at = place[coded.indices.to_numpy()]
        n = self.count[at]
        ends = np.cumsum(n)
        shift = np.repeat(self.first[at] - (ends - n), n)
        ids = self.ids[shift + np.arange(len(shift))]
        total = np.append(0, ends)
        borders = np.append(0, np.cumsum(cut.value_lengths().to_numpy()))
        return ids, np.diff(total[borders])


_kept: dict[str, Encoder] = {}


def _encoder(run: str, vocabulary: str) -> Encoder:
    """The encoder of this worker for one run, which the worker's tasks share; that of an earlier run goes."""
    if run not in _kept:
        _kept.clear()
        _kept[run] = Encoder(vocabulary)
    return _kept[run]


def _vocabulary(path: str) -> str:
    if os.path.getsize(path) > MOST_VOCABULARY:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Rows (doc_id, text) dealt by range of the id and sorted: null ids first, then by a hash of the text.

    Rows that agree in both are dealt by their place in the input, so that no id, however
    many rows it has, fills one partition.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // FILE_BYTES))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("doc_id"), "h", "nth"]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")


def encode(rows: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """FILE_SCHEMA rows of the documents of an ordered frame, each partition a part."""
    # The vocabulary is of bounded size (MOST_VOCABULARY); workers then need no file of their own.
    sent = rows.sparkSession.sparkContext.broadcast(_vocabulary(vocabulary))
    name = uuid.uuid4().hex

    def run(batches):
        from pyspark import TaskContext

        part, seq, before, known = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            for a, b in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                known = known or _encoder(name, sent.value)
                ids, n = known.encode(texts.slice(a, b - a))
                ends, m = np.cumsum(n + 1), b - a
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, m),
                        pa.array(np.full(m, part, np.int32)),
                        pa.array(np.arange(seq, seq + m)),
                        pa.array(before + ends - n - 1),
                        pa.array(n + 1),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(0, ends).astype(np.int32)), pa.array(np.insert(ids, np.cumsum(n), end_id).astype(np.int32))
                        ),
                    ],
                    ["doc_id", "part", "seq", "part_start", "n_tokens", "ids"],
                )
                seq, before = seq + m, before + int(ends[-1])

    return rows.mapInArrow(run, FILE_SCHEMA)


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, parts: int | None = None, mode: str = "errorifexists",
) -> None:
    """Encode whole texts (null: empty) and write them to ORC files under ``path``, sorted by document id.

    Every file is one range of ids: the files in order of ``part``, and the rows in order of
    ``seq``, are the documents in ascending order of the id (null ids first; rows of equal
    id by a hash of the text; rows equal in both stay rows of their own). Ids after each
    text end with ``end_id``. An empty table gives a folder without rows. Other columns are ignored.
    """
    encoded = encode(ordered(docs, id_col, text_col, parts), vocabulary, end_id)
    options = {
        "compression": "zstd", "orc.stripe.size": STRIPE_BYTES, "orc.create.index": True, "orc.row.index.stride": INDEX_ROWS,
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": BLOOM_RATE, "orc.dictionary.key.threshold": 0,
    }
    encoded.write.mode(mode).options(**{k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """FILE_SCHEMA rows; large files are read stripe by stripe, by many tasks."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some documents; the ids go down to the reader, which skips what cannot hold them."""
    return read_token_files(spark, path).where(F.col("doc_id").isin(*doc_ids))


def part_starts(files: DataFrame) -> DataFrame:
    """part, before: the number of ids in all earlier parts. One row a file."""
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the documents in token files, as the files hold them.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the CRC of the ids as
    little-endian unsigned 32-bit integers.
    """

    def run(batch: pa.RecordBatch):
        column = batch.column("ids")
        ends, ids = column.offsets.to_numpy(), column.values.to_numpy().astype("<u4", copy=False)
        crc = [zlib.crc32(ids[i:j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
        n = pa.array(np.diff(ends).astype(np.int64))
        names = ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("part_start"), n, pa.array(crc, pa.int64())], names)

    rows = map_arrow(files.select("doc_id", "part", "part_start", "ids"), run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    starts = part_starts(files)
    return rows.join(starts, "part").select("doc_id", (F.col("part_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def store_and_digest(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Write the documents to new token files in the shared folder, and :func:`digests` of those."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "token-files")
    write_token_files(docs, path, vocabulary, id_col, text_col, parts=parts)
    return digests(read_token_files(spark, path))
