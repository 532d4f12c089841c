"""Removal of repeated passages by hash-compared suffix sort.

A passage is repeated when a string of ``length`` bytes starts at two places. Every
window of that length owns the leftmost k-gram of the least hash in it, so equal
windows own equal k-grams at equal offsets, and only these anchors (about one per 170
bytes) are shuffled. An anchor whose whole context (all bytes of the windows that own
it) occurs again is settled by a hash of the context. The other anchors of a k-gram are
suffix-sorted: prefix polynomial hashes and binary search give the common extension
of two suffixes, so a comparison in the mergesort takes logarithmic time. The longest
extensions of the neighbours to the right and to the left say which windows can repeat
at all; those are matched by hash and verified by their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import binary_list, map_arrow, row_keys, slices, starts, whole_groups, whole_text

LENGTH = 400
GRAM = 64
# k-grams with more different contexts than this are settled by window hashes alone.
HOT_CONTEXTS = 4096
HEAVY = 1000
# Bytes worked on at a time. The place in a slice shares a word with the hash.
SLICE_BYTES = 2 << 20
PLACE_BITS = 22
# Windows matched at a time, unless one k-gram has more.
SLICE_WINDOWS = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
BASE_2 = np.uint64(0xD6E8FEB86659FD93)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class PrefixHash:
    """Polynomial hashes modulo 2**64 of any range of a byte array, from prefix sums."""

    def __init__(self, data: np.ndarray, base: np.uint64 = BASE):
        n = len(data) + 1
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, n)[:-1], out=self.sums[1:])
        self.back = powers(np.uint64(pow(int(base), -1, 1 << 64)), n)

    def __call__(self, start: np.ndarray, n) -> np.ndarray:
        return (self.sums[start + n] - self.sums[start]) * self.back[start]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the polynomial hash over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def window_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """Least value of every run of ``w`` values: suffix minima of one block meet prefix minima of the next."""
    n = len(h)
    pad = -n % w
    full = np.concatenate([h, np.full(pad, np.iinfo(h.dtype).max, h.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors_of(text: bytes, length: int, gram: int, piece: int = SLICE_BYTES) -> tuple[np.ndarray, ...]:
    """Of each anchor of a text: its place, its k-gram's hash, and the first and last window that own it."""
    w = length - gram + 1
    mask = np.uint64((1 << PLACE_BITS) - 1)
    out: list[tuple] = []
    for at in range(0, len(text) - length + 1, piece):  # the windows that begin in this piece
        data = np.frombuffer(text, np.uint8, min(len(text) - at, piece + length - 1), at)
        h = mixed(PrefixHash(data)(np.arange(len(data) - gram + 1), gram))
        # Least hash, then leftmost: both in one word.
        low = window_minimum((h & ~mask) | np.arange(len(h), dtype=np.uint64), w)
        first = starts(low)
        place = (low[first] & mask).astype(np.int64)
        last = np.append(first[1:], len(low)) - 1
        out.append((place + at, h[place], first + at, last + at))
    if not out:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    place, h, first, last = (np.concatenate(x) for x in zip(*out))
    own = starts(place)  # an anchor may own windows on both sides of a piece's end
    return place[own], h[own], first[own], last[np.append(own[1:], len(place)) - 1]


def anchors(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    """k_id, k_text, pos, left, right, gram, context: the bytes before and from pos in the windows that own it."""

    def run(batch: pa.RecordBatch):
        ids, texts = (batch.column(i).to_numpy() for i in (0, 1))
        out: list[list] = [[] for _ in range(7)]
        for k, t in enumerate(binary_list(batch.column(2))):
            where, h, first, last = anchors_of(t, length, gram)
            if not len(where):
                continue
            left, right = where - first, last + length - where
            context = [
                xxhash.xxh64_intdigest(t[p - a : p + b], a << 16 | b)
                for p, a, b in zip(where.tolist(), left.tolist(), right.tolist())
            ]
            n = len(where)
            columns = (np.full(n, ids[k]), np.full(n, texts[k]), where, left, right, h.view(np.int64))
            for o, c in zip(out, (*columns, np.array(context, np.uint64).view(np.int64))):
                o.append(c)
        if out[0]:
            kinds = [np.int64, np.int64, np.int64, np.int32, np.int32, np.int64, np.int64]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o).astype(k)) for o, k in zip(out, kinds)], NAMES)

    rows = docs.select(*row_keys(id_col, text_col), whole_text(text_col).alias("t"))
    return map_arrow(rows, run, "k_id long, k_text long, pos long, left int, right int, gram long, context long")


def packed(rows: DataFrame) -> DataFrame:
    """The frame with its texts (column t) compressed one by one, for the shuffle."""

    def run(batch: pa.RecordBatch):
        squeeze = zstandard.ZstdCompressor(level=6).compress
        t = pa.array([squeeze(x) for x in binary_list(batch.column("t"))], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], t], batch.schema.names)

    fields = ", ".join(f"{n} {k}" for n, k in rows.dtypes[:-1])
    return map_arrow(rows, run, f"{fields}, t binary")


NAMES = ["k_id", "k_text", "pos", "left", "right", "gram", "context"]


class Suffixes:
    """Suffixes of one byte array, each with an end, compared through prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.hash = PrefixHash(data)

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at a and b, by binary search."""
        lo, hi = np.zeros_like(most), most.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self.hash(a, mid) == self.hash(b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def before(self, a, a_len, b, b_len) -> np.ndarray:
        """-1, 0, 1 as the suffix at a is less than, equal to or greater than that at b."""
        most = np.minimum(a_len, b_len)
        n = self.common(a, b, most)
        top = len(self.data) - 1
        x = self.data[np.minimum(a + n, top)].astype(np.int16)
        y = self.data[np.minimum(b + n, top)].astype(np.int16)
        return np.where(n < most, np.sign(x - y), np.sign(a_len - b_len))

    def sort(self, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order that sorts the suffixes inside each group (rows of a group lie together).

        Bottom-up mergesort: a suffix's place in the merged run is its place in its own
        run plus its rank in the sibling run, which binary search finds.
        """
        n = len(at)
        order = np.arange(n)
        first = starts(group)
        count = np.diff(np.append(first, n))
        begin = np.repeat(first, count)
        stop = begin + np.repeat(count, count)
        index = np.arange(n) - begin
        width = 1
        while width < count.max(initial=0):
            run = index // width
            lo = np.minimum(begin + (run ^ 1) * width, stop)
            hi = np.minimum(lo + width, stop)
            sibling = lo.copy()
            mine = order
            tie = np.where(run % 2 == 0, 0, 1)  # equal suffixes keep their order
            act = np.flatnonzero(lo < hi)
            while len(act):
                mid = (lo[act] + hi[act]) >> 1
                other = order[mid]
                c = self.before(at[other], size[other], at[mine[act]], size[mine[act]])
                up = c < tie[act]
                lo[act[up]] = mid[up] + 1
                hi[act[~up]] = mid[~up]
                act = act[lo[act] < hi[act]]
            place = begin + (run >> 1) * 2 * width + index % width + (lo - sibling)
            order = np.empty_like(order)
            order[place] = mine
            width *= 2
        return order

    def longest(self, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Of each suffix, the longest common extension with any other suffix of its group."""
        order = self.sort(at, size, group)
        a, b = order[:-1], order[1:]
        n = np.where(group[a] == group[b], self.common(at[a], at[b], np.minimum(size[a], size[b])), 0)
        best = np.zeros(len(at), np.int64)
        best[a] = n
        best[b] = np.maximum(best[b], n)
        return best


def repeats(parts: list[bytes], left: np.ndarray, group: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(context, least offset, greatest offset) of windows that occur in another context of the group.

    A window begins ``offset`` bytes before the anchor. Contexts of a group differ.
    """
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8)
    base = np.cumsum(size) - size
    anchor = base + left
    right = Suffixes(data).longest(anchor, size - left, group)
    back = Suffixes(data[::-1]).longest(len(data) - anchor, left, group)
    least = np.maximum(length - right, 0)
    number = np.maximum(back - least + 1, 0)
    found: list[tuple[int, int, int]] = []
    h1, h2 = PrefixHash(data), PrefixHash(data, BASE_2)
    edges = np.append(starts(group), len(parts))
    per_group = np.add.reduceat(number, edges[:-1]).tolist()
    for i, j in slices(per_group, SLICE_WINDOWS):
        i, j = edges[i], edges[j]
        of = np.repeat(np.arange(i, j), number[i:j])
        if not len(of):
            continue
        offset = least[of] + np.arange(len(of)) - np.repeat(np.cumsum(number[i:j]) - number[i:j], number[i:j])
        window = anchor[of] - offset
        salt = group[of].astype(np.uint64) * np.uint64(1024) + offset.astype(np.uint64)
        key, check = mixed(h1(window, length) ^ mixed(salt)), h2(window, length)
        order = np.lexsort((check, key))
        first = starts(key[order], check[order])
        count = np.diff(np.append(first, len(order)))
        many = np.repeat(count, count) > 1
        partner = np.empty(len(of), np.int64)
        partner[order] = np.repeat(of[order[first]], count)
        lone = np.empty(len(of), bool)
        lone[order] = ~many
        # The first of a class is held against the second.
        second = order[first[count > 1] + 1]
        partner[order[first[count > 1]]] = of[second]
        hit = np.flatnonzero(~lone)
        if not len(hit):
            continue
        run = starts(of[hit], partner[hit], offset[hit] - np.arange(len(hit)))
        for s, e in zip(run.tolist(), np.append(run[1:], len(hit)).tolist()):
            c, p, o1, o2 = of[hit[s]], partner[hit[s]], offset[hit[s]], offset[hit[e - 1]]
            verify(found, parts, left, int(c), int(p), int(o1), int(o2), length)
    return found


def group_slices(table: pa.Table):
    """Tables of whole k-grams with about SLICE_BYTES / 2 of context, since the hashes need many times that."""
    size = pc.binary_length(table.column("bytes")).to_numpy()
    edges = np.append(starts(table.column("gram").to_numpy()), table.num_rows)
    for i, j in slices(np.add.reduceat(size, edges[:-1]).tolist(), SLICE_BYTES // 2):
        yield table.slice(edges[i], edges[j] - edges[i])


def verify(found, parts, left, c, p, o1, o2, length) -> None:
    """Add a run of matched windows if its bytes agree; else those of its windows that do."""
    x = parts[c][left[c] - o2 : left[c] - o1 + length]
    y = parts[p][left[p] - o2 : left[p] - o1 + length]
    if x == y:
        found.append((c, o1, o2))
    elif o1 < o2:
        for o in range(o1, o2 + 1):
            verify(found, parts, left, c, p, o, o, length)


def repeated_spans(
    docs: DataFrame, id_col: str, text_col: str, length: int, gram: int = GRAM, hot: int = HOT_CONTEXTS
) -> DataFrame:
    """k_id, k_text, start, stop: byte ranges made of repeated strings; ranges may overlap."""
    found = materialize(anchors(docs, id_col, text_col, length, gram), "anchors")
    grams = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("x"), F.max("context").alias("y"))
    # Written, so that Spark can split the join of a k-gram that very many anchors have.
    grams = materialize(grams.where("n > 1").select("gram", F.expr("x = y").alias("one")), "shared-grams")
    shared = materialize(found.join(grams, "gram"), "shared-anchors")
    mixed_rows = shared.where("NOT one")
    where = F.struct("k_id", "k_text", "pos", "left", "right")
    contexts = mixed_rows.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(where).alias("at"))
    contexts = materialize(contexts.select("gram", "context", "n", (F.col("n") > 1).alias("settled"), "at.*"), "contexts")
    # Pairs that more than 1/HEAVY of the rows have are fewer than HEAVY: their rows need no shuffle.
    pair, total = ["gram", "context"], contexts.agg(F.sum("n")).scalar()
    repeated = contexts.where("settled").withColumn("heavy", F.col("n") * HEAVY > total)
    heavy = F.broadcast(repeated.where("heavy").select(*pair))
    rest = mixed_rows.join(heavy, pair, "left_anti").join(repeated.where("NOT heavy").select(*pair), pair, "left_semi")
    settled = shared.where("one").unionByName(mixed_rows.join(heavy, pair, "left_semi")).unionByName(rest)
    settled = settled.select("k_id", "k_text", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("stop"))

    sizes = contexts.groupBy("gram").agg((F.count("*") > hot).alias("hot"))
    wanted = contexts.join(sizes, "gram").groupBy("k_id", "k_text").agg(
        F.collect_list(F.struct("gram", "context", "pos", "left", "right", "settled", "hot")).alias("list")
    )
    texts = packed(docs.select(*row_keys(id_col, text_col), whole_text(text_col).alias("t")))
    cut = texts.join(wanted, ["k_id", "k_text"]).select("k_id", "k_text", "t", "list")
    names = ["gram", "context", "k_id", "k_text", "pos", "left", "settled", "hot", "bytes"]

    def extract(batch: pa.RecordBatch):
        rows: list[list] = [[] for _ in names]
        raw, unpack = batch.column(2), zstandard.ZstdDecompressor().decompress
        for k in range(batch.num_rows):
            t, i, x = unpack(raw[k].as_py()), batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
            for a in batch.column(3)[k].as_py():
                value = (a["gram"], a["context"], i, x, a["pos"], a["left"], a["settled"], a["hot"],
                         t[a["pos"] - a["left"] : a["pos"] + a["right"]])
                for r, v in zip(rows, value):
                    r.append(v)
            if k + 1 == batch.num_rows or len(rows[0]) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(r, s) for r, s in zip(rows, kinds)], names)
                rows = [[] for _ in names]

    kinds = [pa.int64()] * 5 + [pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
    schema = "gram long, context long, k_id long, k_text long, pos long, left int, settled boolean, hot boolean, bytes binary"
    cut = materialize(map_arrow(cut, extract, schema), "context-bytes", compression="zstd")
    spans = "k_id long, k_text long, start long, stop long"

    def match(batches):
        for t in (part for table in whole_groups(batches, ["gram"], 5_000) for part in group_slices(table)):
            gram_of, context = t.column("gram").to_numpy(), t.column("context").to_numpy()
            t = t.take(pa.array(starts(gram_of, context)))  # repeats of a row bring the same context again
            gram_of, parts = t.column("gram").to_numpy(), t.column("bytes").to_pylist()
            left = t.column("left").to_numpy().astype(np.int64)
            group = np.cumsum(np.isin(np.arange(len(parts)), starts(gram_of)))
            found = repeats(parts, left, group, length)
            if not found:
                continue
            c, o1, o2 = (np.array(v, np.int64) for v in zip(*found))
            pos = t.column("pos").to_numpy()[c]
            out = pa.Table.from_arrays(
                [t.column("k_id").take(pa.array(c)), t.column("k_text").take(pa.array(c)), pa.array(pos - o2), pa.array(pos - o1 + length)],
                ["k_id", "k_text", "start", "stop"],
            ).filter(pa.array(~t.column("settled").to_numpy()[c]))
            yield from out.combine_chunks().to_batches()

    usual = cut.where("NOT hot").repartition("gram").sortWithinPartitions("gram", "context").mapInArrow(match, spans)

    def windows(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            b, a = row["bytes"], row["left"]
            o = range(max(0, length - len(b) + a), a + 1)
            n = len(o)
            h = np.array([(xxhash.xxh3_64_intdigest(w := b[a - x : a - x + length], x), xxhash.xxh64_intdigest(w, x)) for x in o], np.uint64)
            h = h.reshape(-1, 2).view(np.int64)
            keep = [pa.array(np.full(n, row[k], d)) for k, d in (("context", np.int64), ("k_id", np.int64), ("k_text", np.int64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), *keep, pa.array(row["pos"] - np.array(o, np.int64))],
                ["h", "g", "context", "k_id", "k_text", "start"],
            )

    every = map_arrow(cut.where("hot"), windows, "h long, g long, context long, k_id long, k_text long, start long")
    twice = every.groupBy("h", "g").agg((F.min("context") < F.max("context")).alias("two")).where("two").select("h", "g")
    crowded = every.join(twice, ["h", "g"], "left_semi").select("k_id", "k_text", "start", (F.col("start") + length).alias("stop"))
    return settled.unionByName(usual).unionByName(crowded).distinct()


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT_CONTEXTS
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of every row.

    Texts are UTF-8 bytes; null is empty, and matches do not cross rows. Every byte is
    removed that a string of ``length`` bytes covers which also starts elsewhere, in
    this row or any other; repeated rows repeat each other's strings. Removal may cut a
    multi-byte character. Rows keep their ids, nulls included; other columns are ignored.
    """
    spans = repeated_spans(docs, id_col, text_col, length, gram, hot)
    spans = spans.groupBy("k_id", "k_text").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    rows = packed(docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_keys(id_col, text_col), whole_text(text_col).alias("t")))
    rows = rows.join(spans, ["k_id", "k_text"], "left").select("doc_id", "t", "spans")

    def run(batch: pa.RecordBatch):
        out: list[list] = [[] for _ in range(5)]
        spans = batch.column("spans")
        unpack = zstandard.ZstdDecompressor().decompress
        for k, t in enumerate(map(unpack, batch.column("t").to_pylist())):
            merged: list[list[int]] = []
            for s in spans[k].as_py() or ():
                if merged and s["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["stop"])
                else:
                    merged.append([s["start"], s["stop"]])
            bounds = [0, *(x for m in merged for x in m), len(t)]
            kept = b"".join(t[i:j] for i, j in zip(bounds[::2], bounds[1::2]))
            for o, v in zip(out, (len(t), len(t) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept)):
                o.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        arrays = [batch.column("doc_id"), *(pa.array(o, k) for o, k in zip(out, kinds))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return map_arrow(rows, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
