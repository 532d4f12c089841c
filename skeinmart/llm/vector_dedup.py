"""Near-duplicate vectors: rotated sign codes with a correction factor choose the pairs whose cosine is computed exactly.

A unit vector o is rotated at random and kept as its signs, a unit vector x, with the
factor f = <x, o>. For a unit vector q, <x, q> / f estimates <o, q> without bias over
the rotation, and since the part of x outside o has length sqrt(1 - f^2), the estimate
is never off by more than sqrt((1 - f^2) (1 - <o, q>^2)) / f. So a pair whose estimate
lies below what the threshold allows cannot be a link; only the others are recomputed
in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .tables import starts, union, whole_groups

THRESHOLD = 0.98
# Different vectors of a label that meet in one task are two chunks of about this many.
CHUNK = 2048
STRIP = 256
# Room for the rounding of the single-precision estimate.
SLACK = 1e-4


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their packed sign bits and correction factors."""
    turned = unit @ rotation(unit.shape[1])
    factor = np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])
    return turned.astype(np.float32), np.packbits(turned >= 0, axis=1), factor


def near_pairs(unit: np.ndarray, side: np.ndarray, threshold: float):
    """Index pairs with a cosine of at least the threshold, strip by strip; sides as in the chunks."""
    dim = unit.shape[1]
    turned, bits, f = codes(unit)
    lowest = f * threshold - np.sqrt(np.maximum(1 - f * f, 0) * max(1 - threshold**2, 0)) - SLACK
    ones, twos = (np.flatnonzero(side == 1), np.flatnonzero(side == 2)) if side.any() else (np.arange(len(unit)),) * 2
    query = np.ascontiguousarray(turned[twos].T)
    for at in range(0, len(ones), STRIP):
        i = ones[at : at + STRIP]
        sign = (np.unpackbits(bits[i], axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
        a, b = np.nonzero(sign @ query >= lowest[i].astype(np.float32)[:, None])
        a, b = i[a], twos[b]
        if not side.any():
            a, b = a[a < b], b[a < b]
        for s in range(0, len(a), 1 << 16):
            x, y = a[s : s + (1 << 16)], b[s : s + (1 << 16)]
            exact = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            if exact.any():
                yield x[exact], y[exact]


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Rows are compared if their labels and dimensions are equal, label not null. A
    vector that is null, empty or zero, or holds a null or a value that is not finite,
    links with nothing, and so does any row with a null label: it is its own component
    and kept. Repeated vectors are links of each other; they are compared once and
    counted by their number. component_id is the least non-null vec_id reachable;
    a row with a null id links as others do, but is never kept. Other columns are ignored.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    distinct = rows.where(sound).groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    distinct = distinct.withColumn("class", F.xxhash64("label", "v"))
    distinct = materialize(distinct.withColumn("dim", F.size("v")), "distinct-vectors")

    sizes = distinct.groupBy("label", "dim").agg(F.ceil(F.count("*") / chunk).alias("g"))
    dealt = (
        distinct.join(sizes, ["label", "dim"])
        .withColumn("c", F.expr("pmod(class, g)"))
        .withColumn("with", F.explode(F.expr("sequence(0L, g - 1)")))
        .select(F.xxhash64("label", "dim", F.least("c", "with"), F.greatest("c", "with")).alias("pair"),
                F.expr("CASE WHEN c = with THEN 0 WHEN c < with THEN 1 ELSE 2 END").cast("byte").alias("side"), "class", "n", "v")
    )

    def compare(batches):
        for t in whole_groups(batches, ["pair"], 4096):
            pair, side, name, n = (t.column(c).to_numpy() for c in ("pair", "side", "class", "n"))
            values = t.column("v").combine_chunks()
            edges = np.append(starts(pair), len(pair)).tolist()
            for i, j in zip(edges[:-1], edges[1:]):
                unit = values[i:j].flatten().to_numpy().reshape(j - i, -1)
                unit = unit / np.abs(unit).max(axis=1, keepdims=True)
                unit = unit / np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
                parent, linked = np.arange(j - i), np.zeros(j - i, np.int64)
                for a, b in near_pairs(unit, side[i:j], threshold):
                    np.add.at(linked, a, n[i:j][b])
                    np.add.at(linked, b, n[i:j][a])
                    union(parent, a, b)
                some = np.flatnonzero(linked)
                if len(some):
                    own = name[i:j]
                    yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(own[parent[some]]), pa.array(linked[some])], ["a", "b", "n"])

    found = dealt.repartition("pair").sortWithinPartitions("pair").mapInArrow(compare, "a long, b long, n long")
    found = materialize(found, "vector-links")
    groups = components(found.select("a", "b").where("a <> b"))
    counts = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("linked"))
    classes = distinct.join(counts, "class", "left").join(groups.withColumnRenamed("node", "class"), "class", "left")
    classes = classes.withColumn("component", F.coalesce("component", "class"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "component").select(
        "label", "v", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    own = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where(sound).join(classes, ["label", "v"]).select("vec_id", "n_links", "component_id").unionByName(own)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
