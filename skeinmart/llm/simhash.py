"""SimHash near-duplicates: fingerprints, blocks that no link escapes, pivot distance tables, exact verification."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .tables import binary_list, map_arrow, quoted, row_keys, starts, union, unused_name, whole_groups, whole_text

SEED = 42
MAX_BITS = 3
# Two fingerprints that differ in at most 3 bits agree in at least two of five blocks.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
# Reference fingerprints of the distance table: XXH64 of their numbers.
N_PIVOTS = 16
PIVOTS = np.array([xxhash.xxh64_intdigest(bytes([i]), SEED) for i in range(N_PIVOTS)], np.uint64)
# A block value with more fingerprints than this is dealt out in pairs of chunks.
CHUNK = 2048


def majority(h: bytes) -> int:
    """The bits that are set in over half of some big-endian 64-bit hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8 << 15):
        part = np.frombuffer(h, np.uint8, min(8 << 15, len(h) - at), at).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(16 * ones > len(h)).tobytes(), "big")


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 of all word shingles; zero without words."""
    words = text.lower().split()  # bytes: A-Z, and exactly the six ASCII spaces
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist()
    digest = xxhash.xxh64_digest
    return majority(b"".join([digest(line[i:j], SEED) for i, j in zip(first, last)]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, k_id and k_text (see ``row_keys``), fp (the fingerprint as a signed long)."""

    def run(batch: pa.RecordBatch):
        fps = np.array([fingerprint(t, shingle) for t in binary_list(batch.column("t"))], np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))], ["doc_id", "k_id", "k_text", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_keys(id_col, text_col), whole_text(text_col).alias("t"))
    return map_arrow(rows, run, "doc_id long, k_id long, k_text long, fp long")


def near_forest(group: np.ndarray, fp: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each group, as two arrays of fingerprints.

    ``side`` is 0 where all pairs of a group count; otherwise only pairs of side 1
    with side 2. Pairs are walked in order of the first pivot's distance, dropped when
    any pivot's distances differ by more than the bound, and verified last.
    """
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], group))
    group, fp, side, table = group[order], fp[order], side[order], table[order]
    parent = np.arange(len(fp))
    left = np.arange(len(fp))
    step = 0
    while True:
        step += 1
        left = left[left + step < len(fp)]
        right = left + step
        near = (group[left] == group[right]) & (table[right, 0] - table[left, 0] <= max_bits)
        left, right = left[near], right[near]
        if not len(left):
            break
        a, b = left, right
        keep = (side[a] == 0) | (side[a] != side[b])
        a, b = a[keep], b[keep]
        keep = (np.abs(table[a] - table[b]) <= max_bits).all(axis=1)
        a, b = a[keep], b[keep]
        keep = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        union(parent, a[keep], b[keep])
    child = np.flatnonzero(parent != np.arange(len(fp)))
    return fp[child], fp[parent[child]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps.fp`` that connect all that are near."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the blocks find links of at most {MAX_BITS} bits")
    value = lambda at, n: f"(shiftrightunsigned(fp, {at}) & {(1 << n) - 1}L)"
    keys = [
        f"{i}L * {1 << 26}L + {value(*x)} * {1 << y[1]}L + {value(*y)}" for i, (x, y) in enumerate(combinations(BLOCKS, 2))
    ]
    blocks = fps.select("fp", F.explode(F.array(*map(F.expr, keys))).alias("key"))
    sizes = blocks.groupBy("key").agg(F.ceil(F.count("*") / chunk).alias("g")).where("g > 1")
    dealt = (
        blocks.join(sizes, "key", "left")
        .withColumn("g", F.coalesce("g", F.lit(1)))
        .withColumn("c", F.expr("pmod(xxhash64(fp), g)"))
        .withColumn("with", F.explode(F.expr("sequence(0L, g - 1)")))
        .select("key", "fp", F.least("c", "with").alias("lo"), F.greatest("c", "with").alias("hi"),
                F.expr("CASE WHEN c = with THEN 0 WHEN c < with THEN 1 ELSE 2 END").cast("byte").alias("side"))
    )
    names = ["key", "lo", "hi"]

    def run(batches):
        for t in whole_groups(batches, names):
            group = np.zeros(t.num_rows, np.int64)
            group[starts(*(t.column(k).to_numpy() for k in names))[1:]] = 1
            group = np.cumsum(group)
            many = np.bincount(group)[group] > 1
            fp = t.column("fp").to_numpy().view(np.uint64)
            a, b = near_forest(group[many], fp[many], t.column("side").to_numpy()[many], max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, "a long, b long").distinct()


def _roots(spark_rows: DataFrame, max_bits: int) -> DataFrame:
    """root of each linked fingerprint."""
    groups = components(links(spark_rows.select("fp").distinct(), max_bits))
    return groups.select(F.col("node").alias("fp"), F.col("component").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, k_id, k_text.

    Words are what ASCII spaces separate, A-Z lower-cased; a text of fewer words than
    a shingle is one shingle; without words (null, empty, blank) the fingerprint is
    zero, which links like any other. component_id is the least non-null doc_id
    reachable over links (null if there is none). Repeated rows and ids stay rows of
    their own; other columns are ignored; an empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    found = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = found.join(_roots(found, max_bits), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    found = materialize(found, "fingerprint-roots")
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "k_id", "k_text"
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` with one of each group of near duplicates: the least id, then the least text hash.

    All columns are kept. Of rows repeated in id and text one stays. Blank texts are
    one group. Null ids come after all others.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return one_of_each(docs, rows, "fp", _roots(rows, max_bits), id_col, text_col)


def one_of_each(docs: DataFrame, rows: DataFrame, key: str, roots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` with one of each root: the least id, then the least text hash.

    ``rows`` has doc_id, k_id, k_text and ``key`` of every row; ``roots`` the root of each key that has one.
    """
    order = F.struct(F.col("doc_id").isNull().alias("n"), "k_id", "k_text")
    best = rows.groupBy(key).agg(F.min(order).alias("best"))
    best = best.join(roots, key, "left").groupBy(F.coalesce("root", key).alias("root"))
    keep = best.agg(F.min("best").alias("b")).select("b.k_id", "b.k_text")
    names = [unused_name(docs, n) for n in ("keep_id", "keep_text", "keep_n")]
    keep = keep.toDF(*names[:2])
    keyed = docs.withColumns(dict(zip(names, row_keys(id_col, text_col))))
    kept = keyed.join(keep, names[:2], "left_semi")
    nth = F.expr(f"row_number() OVER (PARTITION BY `{names[0]}`, `{names[1]}` ORDER BY 1)")
    return kept.withColumn(names[2], nth).where(F.col(names[2]) == 1).select(*quoted(docs))
