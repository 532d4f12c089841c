"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A benchmark item of m bytes that occurs in a text with at most k edits shares at least
m - q + 1 - k q of its q-grams with it, and all of those lie within k diagonals of each
other. So the shared q-grams of a text are counted in bands of diagonals twice that
wide, each overlapping half of the next; a band below the bound cannot hold the item;
the others are verified by an alignment that stays inside the band.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import quoted, row_keys, slices, unused_name, whole_text

Q = 8  # bytes: a q-gram is one 64-bit word
EDITS = 0.08  # edit budget, per byte of the item
MIN_BYTES = 24  # shorter items match exactly and between word bounds only
# The items are sent to the tasks in blocks of at most so many bytes (an item stands alone
# if it is longer); each block is held against all texts.
BLOCK_BYTES = 2 << 20
SLICE_BYTES = 4 << 20
TABLE_BITS = 22
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
# Bytes that a short item must not have for neighbours: digits, letters, and parts of other signs.
IN_WORD = np.array([chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 128 for c in range(256)])


def normal(text: str) -> bytes:
    """Lower case; blanks of any length and kind are one space; UTF-8."""
    return " ".join(text.lower().split()).encode()


def budget(m: int) -> int:
    """Edits allowed for an item of m bytes; few enough that the lemma's bound stays above zero."""
    return max(0, min(int(m * EDITS), (m - Q) // Q))


def grams(data: bytes) -> np.ndarray:
    """All q-grams of the bytes, each as one word."""
    n = len(data) - Q + 1
    return np.ndarray((max(n, 0),), "<u8", data, 0, (1,)) if n > 0 else np.zeros(0, np.uint64)


def slot(g: np.ndarray) -> np.ndarray:
    return (g * MULTIPLY) >> np.uint64(64 - TABLE_BITS)


class Items:
    """Sorted q-grams of a block of items, with a small table that most other q-grams miss."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = items
        size = np.array([len(t) for _, t in items])
        self.edits = np.array([budget(m) if m >= MIN_BYTES else 0 for m in size])
        self.longest = int(size.max())
        self.least = size - Q + 1 - self.edits * Q
        g = [grams(t) for _, t in items]
        every = np.concatenate(g)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.arange(len(g)), [len(x) for x in g])[order]
        self.place = np.concatenate([np.arange(len(x)) for x in g])[order]
        self.keys, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[slot(self.keys)] = True
        self.short: dict[int, dict[int, list[int]]] = {}  # length -> item as a number -> its places in the block
        for i, (_, t) in enumerate(items):
            if len(t) < Q:
                self.short.setdefault(len(t), {}).setdefault(int.from_bytes(t, "little"), []).append(i)

    def alone(self, data: bytes) -> set[tuple[int, int]]:
        """(place in the data, item) of the items under Q bytes that stand between word bounds."""
        found: set[tuple[int, int]] = set()
        if not self.short or not data:
            return found
        padded, n = data + b"\n" * Q, len(data)
        free = ~IN_WORD[np.frombuffer(padded, np.uint8)]
        g = np.ndarray((n,), "<u8", padded, 0, (1,))
        for size, known in self.short.items():
            begins = free[size : size + n].copy()
            begins[1:] &= free[: n - 1]
            at = np.flatnonzero(begins)
            key = g[at] & np.uint64((1 << 8 * size) - 1)
            some = np.isin(key, np.array(list(known), np.uint64))
            found.update((p, i) for p, k in zip(at[some].tolist(), key[some].tolist()) for i in known[k])
        return found

    def hits(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the data, item and place in the item of every shared q-gram."""
        g = grams(data)
        at = np.flatnonzero(self.table[slot(g)])
        key = g[at]
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        real = self.keys[i] == key
        at, i = at[real], i[real]
        n = self.count[i]
        each = np.repeat(self.first[i], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.owner[each], self.place[each]


def alignment(item: bytes, text: bytes, shift: int, width: int, most: int) -> int:
    """Least edits that turn ``item`` into a part of ``text``, over the diagonals shift .. shift + width; above ``most``: most + 1."""
    m, w = len(item), width + 1
    far = most + 1
    t = np.frombuffer(text, np.uint8)
    p = np.frombuffer(item, np.uint8)
    step = np.arange(w)
    # Cell j of row i stands before text place i + shift + j.
    place = shift + step
    row = np.where((place >= 0) & (place <= len(t)), 0, far)
    for i in range(1, m + 1):
        place = i + shift + step
        inside = (place >= 0) & (place <= len(t))
        char = t[np.clip(place - 1, 0, max(len(t) - 1, 0))] if len(t) else np.zeros(w, np.uint8)
        change = np.where((place >= 1) & (char == p[i - 1]), 0, 1) + row
        change[place < 1] = far
        drop = np.append(row[1:] + 1, far)
        new = np.where(inside, np.minimum(change, drop), far)
        # Insertions run along the row.
        new = np.minimum.accumulate(new - step) + step
        row = np.where(inside, np.minimum(new, far), far)
        if row.min() > most:
            return far
    return int(row.min())


def stands_alone(item: bytes, text: bytes) -> bool:
    """Whether the text holds the item with no letter or digit next to it."""
    return re.search(rb"(?<![0-9a-z\x80-\xff])" + re.escape(item) + rb"(?![0-9a-z\x80-\xff])", text) is not None


def leaks(texts: list[bytes], items: Items) -> list[tuple[int, int, int]]:
    """(text, item, least edits) of the items that texts hold within their budgets."""
    data = b"\n".join(texts)  # no normalised text has a line break, so no q-gram crosses two
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size + 1) - size - 1
    alone = {(int(np.searchsorted(begin, p, "right")) - 1, i, 0) for p, i in items.alone(data)}
    at, item, place = items.hits(data)
    doc = np.searchsorted(begin, at, "right") - 1
    pair = doc * len(items.items) + item
    enough = np.bincount(pair, minlength=len(texts) * len(items.items)) if len(pair) else np.zeros(0)
    keep = enough[pair] >= items.least[item] if len(pair) else np.zeros(0, bool)
    at, item, place, doc, pair = at[keep], item[keep], place[keep], doc[keep], pair[keep]
    if not len(at):
        return list(alone)
    diagonal = at - begin[doc] - place + items.longest  # above zero
    step = items.edits[item] + 1
    band = diagonal // step
    # A band holds two steps; so each q-gram counts in the band that begins at its step and in the one before.
    pair, band = np.concatenate([pair, pair]), np.concatenate([band, band - 1])
    place = np.concatenate([place, place])
    order = np.lexsort((place, band, pair))
    pair, band, place = pair[order], band[order], place[order]
    # The bound is on q-grams of the item, so one that meets several of the text's counts once.
    fresh = np.ones(len(pair), bool)
    fresh[1:] = (pair[1:] != pair[:-1]) | (band[1:] != band[:-1]) | (place[1:] != place[:-1])
    pair, band = pair[fresh], band[fresh]
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])))
    count = np.diff(np.append(first, len(pair)))
    pair, band = pair[first], band[first]
    own = pair % len(items.items)
    good = count >= items.least[own]
    best: dict[tuple[int, int], int] = {}
    tried: set[tuple[int, int]] = set()
    for pr, b, it in zip(pair[good].tolist(), band[good].tolist(), own[good].tolist()):
        d = pr // len(items.items)
        if best.get((d, it)) == 0:
            continue
        k, (_, text) = int(items.edits[it]), items.items[it]
        if len(text) < MIN_BYTES:
            if (d, it) not in tried and stands_alone(text, texts[d]):
                best[d, it] = 0
            tried.add((d, it))
            continue
        shift = b * (k + 1) - items.longest
        region = texts[d][max(shift, 0) : shift + 2 * k + 2 + len(text)]
        e = 0 if text in region else alignment(text, texts[d], shift, 2 * k + 1, k)
        if e <= k:
            best[d, it] = min(e, best.get((d, it), e))
    return [*alone, *((d, it, e) for (d, it), e in best.items())]


def item_blocks(benchmark: DataFrame, item_id: str, text_col: str):
    """The usable items in blocks of bounded size, each block read from the table on its own."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), whole_text(text_col).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-2 * total // BLOCK_BYTES))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(n)) == b).distinct().orderBy("item_id", "t")
        block = [(r.item_id, normal(r.t)) for r in part.collect()]
        block = [(i, t) for i, t in block if t]
        if block:
            yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """doc_id, item_id, edits, k_id, k_text of every row and item where the row's text holds the item within its edit budget.

    Texts and items are compared as the UTF-8 bytes of lower case with blanks
    collapsed; null is empty. The budget is ``EDITS`` an item byte. Items under
    ``MIN_BYTES`` after that match exactly, between word bounds; empty ones
    match nothing, nor do empty texts. A pair is
    reported once for each repeat of the row, items that are repeated in id and text
    once; ids may be null. Without items or texts the result is empty.
    """
    names = ["doc_id", "k_id", "k_text", "item_id", "edits"]
    schema = "doc_id long, k_id long, k_text long, item_id long, edits long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_keys(id_col, text_col), whole_text(text_col).alias("t"))
    found = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            items = None
            for batch in batches:
                items = items or Items(shared.value)
                texts = [normal(t) for t in batch.column("t").to_pylist()]
                for i, j in slices([len(t) for t in texts], SLICE_BYTES):
                    hits = leaks(texts[i:j], items)
                    if hits:
                        at = pa.array([i + d for d, _, _ in hits])
                        own = [pa.array([items.items[it][0] for _, it, _ in hits], pa.int64()), pa.array([e for *_, e in hits], pa.int64())]
                        yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in range(3)] + own, names)

        found = found.unionByName(rows.mapInArrow(run, schema))
    return found


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose texts hold no benchmark item, with all their columns."""
    names = [unused_name(docs, n) for n in ("leak_id", "leak_text")]
    bad = find_leaks(docs, benchmark, id_col, text_col, **options).select("k_id", "k_text").distinct().toDF(*names)
    keyed = docs.withColumns(dict(zip(names, row_keys(id_col, text_col))))
    return keyed.join(bad, names, "left_anti").select(*quoted(docs))
