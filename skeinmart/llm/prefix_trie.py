"""Prefix trie of conversations, summed from the leaves to the root in bands of fixed height.

A node is a sequence of turns; its key is the XOR of hashes of (place, turn), 128 bits of
them, so a conversation's whole path comes from one running XOR. Numbers are rolled up
in bands of HEIGHT depths: a node explodes only to its ancestors within its band. The
tops of the bands then form a trie that is HEIGHT times as low, which is rolled up in the
same way; their completed totals go to the ancestors in the band above. So a node is
exploded to at most HEIGHT ancestors in each of two steps, and the rounds grow with the logarithm of the
depth.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .tables import starts

HEIGHT = 8
# A conversation begins with turns of the first one of its group of ids, fewer than HEADS of them.
GROUP, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"


def _scan(rows: DataFrame, order: list[Column | str], kind: str, **running: str) -> DataFrame:
    """Adds the sums or XORs (``kind``) of columns up to each row of a conversation, and ``last``.

    Rows are dealt by range of (conv_id, order), so a conversation of any length is spread
    over tasks; what the earlier tasks hold of it is then added from one row a task.
    """
    total = {"sum": F.sum, "xor": F.bit_xor}[kind]
    add = {"sum": lambda x, y: x + y, "xor": lambda x, y: x.bitwiseXOR(y)}[kind]
    dealt = rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    block = Window.partitionBy("part", "conv_id")
    upto = block.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = {out: total(value).over(upto) for out, value in running.items()}
    local |= {"nth": F.count("*").over(upto), "in_block": F.count("*").over(block)}
    local = materialize(dealt.withColumns(local), "trie-scan")
    sums = local.groupBy("conv_id", "part").agg(*(total(value).alias(f"sum_{out}") for out, value in running.items()))
    parts = Window.partitionBy("conv_id").orderBy("part")
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "conv_id", "part", *(total(f"sum_{out}").over(earlier).alias(f"before_{out}") for out in running),
        F.row_number().over(parts).alias("block"), F.lead("part").over(parts).isNull().alias("final"),
    ).where("block > 1 OR NOT final")
    carried = materialize(carried, "trie-carried")  # at most two rows a task
    whole = (add(F.col(out), F.coalesce(f"before_{out}", F.lit(0))).alias(out) for out in running)
    last = (F.col("nth") == F.col("in_block")) & F.coalesce("final", F.lit(True))
    return local.join(carried, ["conv_id", "part"], "left").select(*rows.columns, *whole, last.alias("last"))


def _heads() -> Column:
    """Turns that a conversation takes from the first one of its group."""
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, words) of the rebuilt conversations, and (conv_id) of those without a turn.

    ``turns`` has conv_id, turn, digest, words. Only the first HEADS - 1 turns of the first
    conversation of each group are copied.
    """
    rows = turns.withColumns({"one": F.lit(1).cast("long"), "tie": F.monotonically_increasing_id()})
    ranked = _scan(rows, [F.asc_nulls_first("turn"), "digest", "tie"], "sum", pos="one").select("conv_id", "pos", "digest", "words")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    convs = ranked.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = materialize(convs.select("conv_id", "n", base.alias("base"), _heads().alias("h")), "trie-convs")
    lent = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(lent, "base", "left").withColumn("copied", F.least("h", F.coalesce("n_base", F.lit(0))))
    heads = ranked.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    first = convs.where("copied > 0").join(heads, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "digest", "words")
    # Places move up where the first conversation has fewer turns than are left out.
    short = convs.where("copied < h").select("conv_id", (F.col("h") - F.col("copied")).alias("lost"))
    own = ranked.where(F.col("pos") > _heads()).join(short, "conv_id", "left")
    own = own.select("conv_id", (F.col("pos") - F.coalesce("lost", F.lit(0))).alias("depth"), "digest", "words")
    return own.unionByName(first), convs.where("copied = 0 AND n <= h").select("conv_id")


def members_of(turns: DataFrame, turnless: DataFrame) -> DataFrame:
    """conv_id, level, a, b (the node), up_a, up_b (its parent), words, last: every node that a conversation begins with.

    The root, at level 0, has the key (0, 0).
    """
    hashed = turns.withColumns({"ha": F.xxhash64("depth", "digest"), "hb": F.xxhash64("digest", "depth")}).drop("digest")
    path = _scan(hashed, ["depth"], "xor", a="ha", b="hb")
    up = [F.col("a").bitwiseXOR(F.col("ha")).alias("up_a"), F.col("b").bitwiseXOR(F.col("hb")).alias("up_b")]
    path = path.select("conv_id", F.col("depth").alias("level"), "a", "b", *up, "words", "last")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("level", "a", "b", "up_a", "up_b", "words")]
    begun = path.where("level = 1").select("conv_id", *zeros, F.lit(False).alias("last"))
    return path.unionByName(begun).unionByName(turnless.select("conv_id", *zeros, F.lit(True).alias("last")))


def _explode(path: DataFrame, nodes: DataFrame, above: int, height: int) -> DataFrame:
    """level, a, b, conv_id, leaves, saved: what each node gives to its ancestors in a band.

    The band is the node's own (above = 0; the node gives to itself too, with its
    conv_id) or the one above it (1). A group is one conversation's path through a band.
    """
    band = lambda c: F.floor(c / height)
    there = path.select("conv_id", band(F.col("level")).alias("band"), F.struct("level", "a", "b").alias("at"), F.lit(None).alias("node"))
    node = F.struct("level", "leaves", "saved")
    given = nodes.select("conv_id", (band(F.col("level")) - above).alias("band"), F.lit(None).alias("at"), node.alias("node"))
    groups = there.unionByName(given).groupBy("conv_id", "band").agg(F.collect_list("at").alias("at"), F.collect_list("node").alias("node"))
    each = groups.where(F.size("node") > 0).select("conv_id", "at", F.explode("node").alias("node"))
    pairs = each.select("conv_id", "node", F.explode(F.filter("at", lambda x: x["level"] <= F.col("node.level"))).alias("at"))
    own = F.when(F.col("at.level") == F.col("node.level"), F.col("conv_id"))
    return pairs.select("at.level", "at.a", "at.b", own.alias("conv_id"), "node.leaves", "node.saved")


def roll_up(path: DataFrame, nodes: DataFrame, depth: int, height: int = HEIGHT) -> DataFrame:
    """level, a, b, conv_id, leaves, saved of each node, summed over its subtree.

    ``path`` holds conv_id, level, a, b for every node of every conversation; ``nodes`` each
    node once, with one of its conversations and its own leaves and saved; ``depth`` is the largest level.
    """
    sums = [F.max("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    key = ["level", "a", "b"]
    within = _explode(path, nodes, 0, height).groupBy(*key).agg(*sums)
    if depth < height:
        return materialize(within, "trie-sums")
    within = materialize(within, "trie-bands")
    top = F.col("level") % height == 0
    higher = F.floor(F.col("level") / height).alias("level")
    tops = within.where(top).select(higher, "a", "b", "conv_id", "leaves", "saved")
    done = roll_up(path.where(top).select("conv_id", higher, "a", "b"), tops, depth // height, height)
    down = done.where("level > 0").withColumn("level", F.col("level") * height)
    given = _explode(path, down, 1, height).withColumn("conv_id", F.lit(None).cast("long"))
    return materialize(within.unionByName(given).groupBy(*key).agg(*sums), "trie-sums")


def end_digests(ends: DataFrame) -> DataFrame:
    """level, a, b, ends_sha256: SHA-256 of the comma-joined conv_ids of a node, ascending.

    The ids are sorted by range over all tasks and joined there, some thousands a string;
    a node's strings then run through one hash, in order, held one batch at a time.
    """

    def join(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            level, a, b = (batch.column(k).to_numpy() for k in ("level", "a", "b"))
            ids = batch.column("conv_id").cast(pa.string()).to_pylist()
            at = starts(level, a, b)
            ends = np.append(at[1:], len(ids))
            text = [",".join(ids[i:j]) for i, j in zip(at.tolist(), ends.tolist())]
            order = np.arange(seq, seq + len(at))
            columns = [level[at], a[at], b[at], np.full(len(at), part, np.int32), order]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(text)], ["level", "a", "b", "part", "seq", "text"])
            seq += len(at)

    def digest(batches):
        now = state = None
        for batch in batches:
            out = []
            level, a, b, text = (batch.column(k).to_pylist() for k in ("level", "a", "b", "text"))
            for *node, t in zip(level, a, b, text):
                if node == now:
                    state.update(b"," + t.encode())
                    continue
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256(t.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())], names)

    names, key = ["level", "a", "b", "ends_sha256"], ["level", "a", "b"]
    sort = [*key, "conv_id"]
    strings = ends.select(*sort).repartitionByRange(*sort).sortWithinPartitions(*sort)
    strings = strings.mapInArrow(join, "level long, a long, b long, part int, seq long, text string")
    dealt = strings.repartition(*key).sortWithinPartitions(*key, "part", "seq")
    return dealt.mapInArrow(digest, "level long, a long, b long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    height: int = HEIGHT,
) -> DataFrame:
    """One row a node of the trie of rebuilt conversations.

    Turns are ordered by ``turn``, null first; turns of equal number by the MD5 of role and
    text, and repeated rows are turns of their own. Null role or text is empty; rows
    without a conversation are left out; an empty table has no node. Other columns are ignored.
    Conversation c is rebuilt from the first h turns of conversation c - c % 20 (all if
    it has fewer) and c's own turns after its first h; h is crc32(c as text) % 4. A node is a
    distinct sequence of the first turns of rebuilt conversations, the root the empty one.

    conv_id: least member; depth; parent_conv_id: the parent's (root: null); n_convs:
    members; n_children; n_leaves: nodes of the subtree without children; saved_tokens:
    summed over the subtree, (n_convs - 1) times the words of a node's last text;
    ends_sha256: SHA-256 of the ids of members that end here, ascending, comma-joined.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    ).where("conv_id IS NOT NULL")
    members = materialize(members_of(*rebuilt(turns)), "trie-members")
    key = ["level", "a", "b"]
    nodes = members.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"),
        F.max("words").alias("words"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"),
    )
    # A node is a leaf if all its members end there.
    leaf = (F.col("n_convs") == F.col("n_ends")).cast("long")
    nodes = materialize(nodes.withColumns({"leaves": leaf, "saved": (F.col("n_convs") - 1) * F.col("words")}), "trie-nodes")
    depth = nodes.agg(F.max("level")).first()[0] or 0
    sums = roll_up(members.select("conv_id", *key), nodes.select("conv_id", *key, "leaves", "saved"), depth, height)
    zero = F.lit(0).cast("long")
    given = sums.select(*key, "leaves", "saved", zero.alias("children"))
    given = given.unionByName(nodes.where("level > 0").select(
        (F.col("level") - 1).alias("level"), F.col("up_a").alias("a"), F.col("up_b").alias("b"),
        zero.alias("leaves"), zero.alias("saved"), F.lit(1).cast("long").alias("children"),
    ))
    totals = given.groupBy(*key).agg(*(F.sum(c).alias(f"all_{c}") for c in ("leaves", "saved", "children")))
    ends = end_digests(members.where("last").select(*key, "conv_id"))
    full = nodes.join(totals, key).join(ends, key, "left")
    parent = nodes.select((F.col("level") + 1).alias("level"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return materialize(full, "trie-full").join(parent, ["level", "up_a", "up_b"], "left").select(
        "conv_id", F.col("level").alias("depth"), "parent_conv_id", "n_convs", F.col("all_children").alias("n_children"),
        F.col("all_leaves").alias("n_leaves"), F.col("all_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


# The CRC of the digits of an id, bit by bit.
_CRC = """xor(list_reduce(list_transform(range(1, strlen(CAST({c} AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST({c} AS VARCHAR), i, 1)) AS BIGINT)),
  lambda crc, byte: list_reduce([CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
  CAST(4294967295 AS BIGINT)), 4294967295)"""

TRIE_SQL = f"""
WITH said AS (
  SELECT conv_id AS c, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), digest AS (
  SELECT c, turn, md5(length(role) || ':' || role || text) AS m, len(regexp_extract_all(text, '[^ \\t-\\r]+')) AS words FROM said
), ranked AS (
  SELECT c, m, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, m) AS pos FROM digest
), convs AS (
  SELECT c, c - c % {GROUP} AS base, {_CRC.format(c="c")} % {HEADS} AS h FROM (SELECT DISTINCT c FROM ranked)
), lent AS (
  SELECT v.c, v.h, (SELECT COUNT(*) FROM ranked r WHERE r.c = v.base AND r.pos <= v.h) AS copied FROM convs v
), turns AS (
  SELECT v.c, r.pos AS d, r.m, r.words FROM convs v JOIN ranked r ON r.c = v.base AND r.pos <= v.h
  UNION ALL
  SELECT v.c, r.pos - v.h + v.copied, r.m, r.words FROM lent v JOIN ranked r ON r.c = v.c AND r.pos > v.h
), path AS (
  SELECT c, d, string_agg(m, '') OVER (PARTITION BY c ORDER BY d) AS k, words, lead(d) OVER (PARTITION BY c ORDER BY d) IS NULL AS last FROM turns
), members AS (
  SELECT * FROM path
  UNION ALL
  SELECT c, 0, '', 0, c NOT IN (SELECT c FROM turns) FROM convs
), nodes AS (
  SELECT d, k, MIN(c) AS conv_id, COUNT(*) AS n_convs, (COUNT(*) - 1) * MAX(words) AS saved, bool_and(last) AS leaf,
    sha256(COALESCE(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM members GROUP BY d, k
), below AS (
  SELECT m.d, m.k, COUNT(*) FILTER (n.leaf) AS n_leaves, SUM(n.saved) AS saved_tokens, COUNT(*) FILTER (n.d = m.d + 1) AS n_children
  FROM nodes n JOIN members m ON m.c = n.conv_id AND m.d <= n.d GROUP BY m.d, m.k
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.k = n.k LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = substr(n.k, 1, 32 * (CAST(n.d AS INTEGER) - 1))
"""
