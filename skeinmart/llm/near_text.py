"""Near-duplicate texts: SimHash with pivot tables, verified by exact Jaccard similarity; then the links that SimHash can't see.

Every set of word shingles has a SimHash fingerprint of 64 bits. Blocks of bits bring near
fingerprints together, the pivot table and the bits themselves drop pairs (``simhash.links``), and
the pairs left are verified on the whole sets. That joins most near copies, but sets that
agree in just 4/5 often differ in more bits, so an exact search follows, between sets that are
still in different groups.

Two sets that agree in 4/5 of their union share a shingle among the first
n - ceil(4n/5) + 1 of each, whatever the order of all shingles is. So only these prefixes
are shuffled, ordered by hash, with shingles that are frequent in a sample last (the
sample decides the work, not the links). First every set is held against the least
one that shares a shingle; then, between sets that this leaves in different groups, all
candidates that sizes and places allow.

For this search each shingle of a set toggles one bit of a row of twice to four times as many
bits as the set has shingles. Two such rows never differ in more bits than the sets have shingles of their
own, which for similar sets are at most a ninth of both sizes. So a pair is dropped, without
losing a link, where the distances to any reference row differ by more (the pivot table), or the
rows themselves do. Only what is left is verified on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import limit_batches, materialize
from .components import components
from .simhash import SEED, links, majority, one_of_each
from .tables import binary_list, map_arrow, row_keys, starts, whole_groups, whole_text

SHINGLE = 5
# Texts whose shingles are counted for the order, and how many frequent ones go last.
SAMPLE_ROWS, FREQUENT = 20_000, 100_000
# Sampled shingles that a task counts at a time.
COUNTED = 1 << 21
# A shingle that more sets share is dealt out in pairs of chunks, and first in so many shares if it is frequent.
CHUNK, SHARES = 2048, 64
# Reference rows of the pivot table; the first is the empty set's.
N_PIVOTS = 8
# Bits of the filter that keeps texts of sets that no pair needs out of a shuffle: 4 MB, whatever the input.
FILTER_BITS = 1 << 25
# Sets that are held against one other set in one task.
PARTNERS = 1024
# Words of 64 bits of the fingerprint that goes with a row to its candidates; a longer one is folded to that.
CODE_WORDS = 16
# Of shingles that more sets share, a set is drawn for the others to be held against before all pairs are.
DRAWN = 8


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the different word shingles; a shorter text is one shingle, a blank one has none."""
    words = text.lower().split()  # bytes: A-Z, and exactly the six ASCII spaces
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.append(0, end[:-1] + 1)[: max(1, len(words) - size + 1)].tolist()
    last = end[min(size, len(words)) - 1 :].tolist()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(line[i:j], SEED) for i, j in zip(first, last)), np.uint64, len(first)))


def node_of(own: np.ndarray) -> int:
    """Name of a set of shingles."""
    return xxhash.xxh64_intdigest(own.tobytes(), SEED)


def simhash_of(own: np.ndarray) -> int:
    """SimHash of a set of shingles; zero for none."""
    return majority(own.astype(">u8").tobytes())


def similar(a: int, b: int, shared: int) -> bool:
    """Whether shared / (a + b - shared) is at least 4/5."""
    return 9 * shared >= 4 * (a + b)


def signed(x: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64))


def bit_row(own: np.ndarray) -> np.ndarray:
    """Packed bits, each toggled by the shingles whose hash ends in its number; the width is a power of two."""
    width = 1 << max(6, (2 * len(own) - 1).bit_length())
    return np.packbits((np.bincount(own & np.uint64(width - 1), minlength=width) & 1).astype(np.uint8), bitorder="little")


def fold(row: np.ndarray) -> np.ndarray:
    """The row of half the width."""
    half = len(row) // 2
    return row[:half] ^ row[half:]


def code_of(row: bytes) -> bytes:
    """The row folded to at most CODE_WORDS words: two of those never differ in more bits than the rows."""
    own = np.frombuffer(row, np.uint8)
    while len(own) > 8 * CODE_WORDS:
        own = fold(own)
    return own.tobytes()


def code_distances(words: np.ndarray, width: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the codes of rows a[i] and b[i] differ, the wider of two folded to the other's ``width``."""
    out = np.zeros(len(a), np.int64)
    w = np.stack([width[a], width[b]])
    for own, other in np.unique(w, axis=1).T.tolist():
        some = np.flatnonzero((w[0] == own) & (w[1] == other))
        least = min(own, other)
        x, y = (np.bitwise_xor.reduce(words[i[some], :n].reshape(len(some), n // least, least), axis=1) for i, n in ((a, own), (b, other)))
        out[some] = np.bitwise_count(x ^ y).sum(axis=1)
    return out


class Pivots:
    """Distances of bit rows to reference rows of the same width."""

    def __init__(self) -> None:
        self.rows: dict[int, np.ndarray] = {}

    def distances(self, row: np.ndarray) -> np.ndarray:
        size = len(row)
        if size not in self.rows:
            made = np.random.default_rng([SEED, size]).integers(0, 256, (N_PIVOTS, size), np.uint8)
            made[0] = 0
            self.rows[size] = made
        return np.bitwise_count(self.rows[size] ^ row).sum(axis=1, dtype=np.int32)

    def table(self, row: np.ndarray) -> bytes:
        """Distances at the row's own width and at half of it; similar sets are at most one width apart."""
        return self.distances(row).tobytes() + self.distances(fold(row) if len(row) > 8 else row).tobytes()


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, k_id, k_text of every row, and of its set: node (its name), n, fp (its SimHash), bits and pivots (their line of the table)."""

    def run(batch: pa.RecordBatch):
        pivots = Pivots()
        node, size, fp, bits, table = [], [], [], [], []
        for t in binary_list(batch.column(3)):
            own = shingles(t)
            row = bit_row(own)
            for o, v in zip((node, size, fp, bits, table), (node_of(own), len(own), simhash_of(own), row.tobytes(), pivots.table(row))):
                o.append(v)
        made = [signed(node), pa.array(size, pa.int32()), signed(fp), pa.array(bits, pa.binary()), pa.array(table, pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], ["doc_id", "k_id", "k_text", "node", "n", "fp", "bits", "pivots"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_keys(id_col, text_col), whole_text(text_col).alias("t"))
    return map_arrow(rows, run, "doc_id long, k_id long, k_text long, node long, n int, fp long, bits binary, pivots binary")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes by SimHash: the least node of a fingerprint with its others, and with those of near fingerprints."""
    some = nodes.where("n > 0").select("node", "fp")
    fps = materialize(some.groupBy("fp").agg(F.min("node").alias("least")), "fingerprints")
    near = links(fps.select("fp")).join(fps.toDF("a", "x"), "a").join(fps.toDF("b", "y"), "b")
    across = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    same = some.join(fps, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    return same.unionByName(across).distinct()


def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different groups so far."""
    for x in "ab":
        pairs = pairs.join(groups.toDF(x, f"part_{x}"), x, "left")
    return pairs.where("coalesce(part_a, a) <> coalesce(part_b, b)").select("a", "b")


def frequent_shingles(rows: DataFrame, total: int) -> np.ndarray:
    """Shingles of many sampled texts, sorted; at most FREQUENT. A task leaves out what it met once in COUNTED."""
    n = max(1, total // SAMPLE_ROWS)

    def count(held):
        s, c = np.unique(np.concatenate(held), return_counts=True)
        some = c > 1
        return pa.RecordBatch.from_arrays([signed(s[some]), pa.array(c[some])], ["s", "c"])

    def run(batches):
        held, total = [], 0
        for batch in batches:
            for t in binary_list(batch.column(0)):
                held.append(shingles(t))
                total += len(held[-1])
                if total >= COUNTED:
                    yield count(held)
                    held, total = [], 0
        if held:
            yield count(held)

    some = rows.where(F.pmod(F.xxhash64("t"), F.lit(n)) == 0)
    counted = some.mapInArrow(run, "s long, c long").groupBy("s").agg(F.sum("c").alias("c")).where("c > 8")
    top = counted.orderBy(F.desc("c"), "s").limit(FREQUENT).select("s").collect()
    return np.sort(np.array([r.s for r in top], np.int64).view(np.uint64))


def prefixes(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """s, share, node, n, pos: the prefix shingles of the sets with their places in the order.

    ``share`` is -1, and of frequent shingles a part of the nodes. A task gives a set once, however many copies it has.
    """
    last = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        top, known = last.value, set()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for t in binary_list(batch.column(0)):
                own = shingles(t)
                n, node = len(own), node_of(own)
                if not n or node in known:
                    continue
                known.add(node)
                often = np.zeros(n, bool)
                if len(top):
                    often = top[np.minimum(np.searchsorted(top, own), len(top) - 1)] == own
                p = n + 4 * n // -5 + 1
                rank = np.concatenate([own[~often], own[often]])[:p]
                share = np.where(np.arange(p) >= n - often.sum(), node % SHARES, -1).astype(np.int32)
                for o, c in zip(out, (rank, share, np.full(p, node, np.uint64), np.full(p, n, np.int32), np.arange(p, dtype=np.int32))):
                    o.append(c)
            if out[0]:
                s, share, node, n, pos = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays([signed(s), pa.array(share), signed(node), pa.array(n), pa.array(pos)], ["s", "share", "node", "n", "pos"])

    return rows.mapInArrow(run, "s long, share int, node long, n int, pos int")


def may_be_similar(n1: np.ndarray, pos1: np.ndarray, n2: np.ndarray, pos2: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes with a common shingle at these places can agree in 4/5 of their union."""
    most = np.minimum(pos1, pos2) + np.minimum(n1 - pos1, n2 - pos2)
    return 9 * most >= 4 * (n1 + n2)


def shared_shingles(found: DataFrame) -> DataFrame:
    """The prefix rows, once each, of shingles that different nodes share, with the least such node (lead).

    ``near`` tells whether the row's set can be similar to the lead's. A frequent shingle has a
    lead in each of its shares, and all its rows are kept. Rows stream by: no group is held.
    """
    names = ["s", "share", "node", "n", "pos"]

    def run(batches):
        lead, held, last = None, False, None  # first row of the group that the rows so far end in, whether it is still to be given out; last row
        for batch in batches:
            if not batch.num_rows:
                continue
            s, share, node, n, pos = (batch.column(k).to_numpy() for k in names)
            own = starts(s, share, node)
            if last == (s[0], share[0], node[0]):
                own = own[1:]
            if not len(own):
                continue
            s, share, node, n, pos = (c[own] for c in (s, share, node, n.astype(np.int64), pos.astype(np.int64)))
            last = s[-1], share[-1], node[-1]
            goes_on = lead is not None and lead[:2] == (s[0], share[0])
            if goes_on:
                s, share, node, n, pos = (np.append(v, c) for v, c in zip(lead, (s, share, node, n, pos)))
            first = starts(s, share)
            count = np.diff(np.append(first, len(s)))
            head, size = np.repeat(first, count), np.repeat(count, count)
            give = (size > 1) | (share >= 0)
            given = goes_on and not held
            if given:
                give[0] = False
            at = first[-1]
            lead = tuple(c[at] for c in (s, share, node, n, pos))
            held = not give[at] and not (given and at == 0)
            keep = np.flatnonzero(give)
            if len(keep):
                h = head[keep]
                near = may_be_similar(n[keep], pos[keep], n[h], pos[h]) & (node[keep] != node[h])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s[keep]), pa.array(share[keep]), pa.array(node[keep]), pa.array(n[keep].astype(np.int32)), pa.array(pos[keep].astype(np.int32)), pa.array(node[h]), pa.array(near)],
                    ["s", "share", "node", "n", "pos", "lead", "near"],
                )

    dealt = found.repartition("s", "share").sortWithinPartitions("s", "share", "node")
    return dealt.mapInArrow(run, "s long, share int, node long, n int, pos int, lead long, near boolean")


def leader_pairs(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of each set with the lead of its shingle, and of the leads of a frequent shingle's shares with the least of them."""
    pairs = shared.where("near").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    leads = shared.where("share >= 0 AND node = lead").select("s", "node", "n", "pos")  # at most SHARES a shingle
    least = leads.groupBy("s").agg(F.min(F.struct("node", "n", "pos")).alias("l"))
    most = F.expr("least(pos, l.pos) + least(n - pos, l.n - l.pos)")
    near = (F.col("node") != F.col("l.node")) & (9 * most >= 4 * (F.col("n") + F.col("l.n")))
    return pairs.unionByName(leads.join(least, "s").where(near).select(F.col("l.node").alias("a"), F.col("node").alias("b"))).distinct()


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that neither the pivot table nor the fingerprints rule out."""
    side = lambda x: nodes.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "bits", "pivots")))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batch: pa.RecordBatch):
        n = [batch.column(f"n_{x}").to_numpy().astype(np.int64) for x in "ab"]
        bits = [binary_list(batch.column(f"bits_{x}")) for x in "ab"]
        tables = [np.frombuffer(b"".join(binary_list(batch.column(f"pivots_{x}"))), np.int32).reshape(-1, 2, N_PIVOTS) for x in "ab"]
        size = [np.fromiter(map(len, b), np.int64, len(b)) for b in bits]
        most = (n[0] + n[1]) // 9  # shingles that similar sets have each for itself
        # The wider row is compared at half its width.
        line = [t[np.arange(len(t)), (own > other).astype(int)] for t, own, other in zip(tables, size, size[::-1])]
        good = (np.maximum(*size) <= 2 * np.minimum(*size)) & (np.abs(line[0] - line[1]).max(axis=1, initial=0) <= most)
        for i in np.flatnonzero(good).tolist():
            x, y = (np.frombuffer(b[i], np.uint8) for b in bits)
            x, y = (fold(x) if len(x) > len(y) else x), (fold(y) if len(y) > len(x) else y)
            good[i] = np.bitwise_count(x ^ y).sum() <= most[i]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good))

    return materialize(map_arrow(both, run, "a long, b long"), "plausible")


def sets_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, own: the whole sets of some nodes, from the texts that a filter of fixed size lets through."""
    keys = nodes.join(wanted, "node").select("key.k_id", "key.k_text", "node")
    keys = materialize(keys, "wanted-sets")
    place = F.pmod("k_text", F.lit(FILTER_BITS))
    marks = keys.groupBy(F.floor(place / 32768).alias("i")).agg(F.bitmap_construct_agg(place % 32768).alias("bits"))
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for r in marks.collect():  # at most FILTER_BITS / 32768 rows of 4 KB
        bits[r.i] = np.frombuffer(r.bits, np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(bits.ravel())

    def run(batch: pa.RecordBatch):
        at = batch.column(1).to_numpy() % FILTER_BITS
        some = batch.filter(pa.array((sent.value[at >> 3] >> (at & 7) & 1).astype(bool)))
        own = pa.array([shingles(t).tobytes() for t in binary_list(some.column(2))], pa.binary())
        yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), own], ["k_id", "k_text", "own"])

    texts = docs.select(*row_keys(id_col, text_col), whole_text(text_col).alias("t"))
    sets = map_arrow(texts, run, "k_id long, k_text long, own binary")
    return materialize(sets.join(keys, ["k_id", "k_text"]).select("node", "own").dropDuplicates(["node"]), "shingle-sets")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. Set b goes to each of its pairs, set a once to at most PARTNERS of them."""
    pairs = plausible(pairs, nodes)
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, docs, id_col, text_col)
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("g"))
    part = F.expr("pmod(xxhash64(b), g)").alias("c")
    right = pairs.join(shares, "a").select("a", "b", part).join(sets.toDF("b", "own"), "b").select("a", "c", "b", "own")
    left = shares.join(sets.toDF("a", "own"), "a").select("a", F.explode(F.expr("sequence(0L, g - 1)")).alias("c"), F.lit(None).cast("long").alias("b"), "own")

    def hold(batches):
        own = None
        for batch in batches:
            a, b, keep = batch.column("a"), batch.column("b").to_pylist(), []
            for other, value in zip(b, binary_list(batch.column("own"))):
                x = np.frombuffer(value, np.uint64)
                if other is None:  # sorted first: the set that those after it are held against
                    own = x
                keep.append(other is not None and similar(len(own), len(x), len(np.intersect1d(own, x, True))))
            yield pa.RecordBatch.from_arrays([a, batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    dealt = left.unionByName(right).repartition("a", "c").sortWithinPartitions("a", "c", F.asc_nulls_first("b"))
    return materialize(dealt.mapInArrow(hold, "a long, b long"), "similar")


def in_parts(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """s, node, n, pos, part: the group that a node is in so far."""
    rows = shared.select("s", "node", "n", "pos").join(groups.toDF("node", "part"), "node", "left")
    return rows.withColumn("part", F.coalesce("part", "node"))


def drawn_pairs(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs (a, b) of each set with one drawn by hash for every shingle that more than DRAWN sets share, between groups.

    A large group of which no set is similar to most others is joined by these, as many as it has rows, and not by all its pairs.
    """
    rows = in_parts(shared, groups)
    drawn = F.min(F.struct(F.xxhash64("node", "s").alias("h"), "node", "n", "pos", "part")).alias("l")
    leads = rows.groupBy("s").agg(drawn, F.count("*").alias("c"), (F.min("part") < F.max("part")).alias("open"))
    leads = leads.where(F.col("open") & (F.col("c") > DRAWN)).select("s", "l")
    most = F.expr("least(pos, l.pos) + least(n - pos, l.n - l.pos)")
    near = (F.col("part") != F.col("l.part")) & (9 * most >= 4 * (F.col("n") + F.col("l.n")))
    ends = [f("node", "l.node").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]
    return rows.join(leads, "s").where(near).select(*ends).distinct()


def candidates(shared: DataFrame, groups: DataFrame, nodes: DataFrame, chunk: int) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that share a prefix shingle, as far as sizes, places and folded fingerprints allow."""

    def code(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([code_of(x) for x in binary_list(batch.column(1))], pa.binary())], ["node", "code"])

    rows = in_parts(shared, groups)
    sizes = rows.groupBy("s").agg(F.ceil(F.count("*") / chunk).alias("g"), (F.min("part") < F.max("part")).alias("open"))
    codes = map_arrow(nodes.select("node", "bits"), code, "node long, code binary")
    dealt = (
        rows.join(sizes.where("open").drop("open"), "s")
        .join(codes, "node")
        .withColumn("c", F.expr("pmod(xxhash64(node), g)"))
        .withColumn("with", F.explode(F.expr("sequence(0L, g - 1)")))
        .select("s", "node", "part", "n", "pos", "code", F.least("c", "with").alias("lo"), F.greatest("c", "with").alias("hi"),
                F.expr("CASE WHEN c = with THEN 0 WHEN c < with THEN 1 ELSE 2 END").cast("byte").alias("side"))
    )
    names = ["s", "lo", "hi"]

    def run(batches):
        for t in whole_groups(batches, names, 20_000):
            col = {k: t.column(k).to_numpy() for k in ("node", "part", "side")}
            n, pos = (t.column(k).to_numpy().astype(np.int64) for k in ("n", "pos"))
            sent = t.column("code").to_pylist()
            width = np.fromiter(map(len, sent), np.int64, len(sent)) // 8
            words = np.frombuffer(b"".join(x.ljust(8 * CODE_WORDS, b"\0") for x in sent), np.uint64).reshape(-1, CODE_WORDS)
            edges = np.append(starts(*(t.column(k).to_numpy() for k in names)), t.num_rows)
            end = np.repeat(edges[1:], np.diff(edges))
            left, step = np.arange(t.num_rows), 0
            while True:
                step += 1
                left = left[left + step < end[left]]
                if not len(left):
                    break
                a, b = left, left + step
                keep = (col["part"][a] != col["part"][b]) & may_be_similar(n[a], pos[a], n[b], pos[b])
                keep &= (col["side"][a] == 0) & (col["side"][b] == 0) | (col["side"][a] != col["side"][b])
                a, b = a[keep], b[keep]
                # Similar sets have at most a ninth of both sizes each for itself.
                close = code_distances(words, width, a, b) <= (n[a] + n[b]) // 9
                x, y = col["node"][a[close]], col["node"][b[close]]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, "a long, b long").distinct()


def groups_of(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, chunk: int = CHUNK) -> DataFrame:
    """node, root: the least node that each linked node reaches over links of similarity 4/5 or more."""
    key = F.struct("k_id", "k_text")
    nodes = rows.groupBy("node").agg(F.min(key).alias("key"), *(F.first(c).alias(c) for c in ("n", "fp", "bits", "pivots")))
    nodes = materialize(nodes, "sets")
    near = verified(materialize(simhash_pairs(nodes), "simhash-pairs"), nodes, docs, id_col, text_col)
    texts = docs.select(whole_text(text_col).alias("t"))
    found = prefixes(texts, frequent_shingles(texts, rows.count()))
    shared = materialize(shared_shingles(found), "shared-shingles")
    pairs = materialize(apart(leader_pairs(shared), components(near)), "leaders")
    led = materialize(near.unionByName(verified(pairs, nodes, docs, id_col, text_col)), "led")
    drawn = materialize(drawn_pairs(shared, components(led)), "drawn")
    led = materialize(led.unionByName(verified(drawn, nodes, docs, id_col, text_col)), "led")
    rest = materialize(candidates(shared, components(led), nodes, chunk), "candidates")
    found = led.unionByName(verified(rest, nodes, docs, id_col, text_col))
    return components(found).toDF("node", "root")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs`` with one of each group of near duplicates: the least id, then the least text hash.

    Texts are linked, by SimHash first, whose sets of five-word shingles (words as in
    ``simhash.fingerprint``) have a Jaccard similarity of at least 0.8; a group is what links connect. All
    columns are kept. Of rows repeated in id and text one stays. A text of fewer than five
    words is one shingle; blank texts are one group. Null ids come after all others.
    """
    limit_batches(docs.sparkSession)
    rows = materialize(named(docs, id_col, text_col), "shingle-nodes")
    return one_of_each(docs, rows, "node", groups_of(docs, rows, id_col, text_col, chunk), id_col, text_col)
