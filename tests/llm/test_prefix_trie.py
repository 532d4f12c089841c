"""The conversation trie against a plain one made of prefixes, and against its SQL."""

import collections
import hashlib
import os
import random
import re
import zlib

import duckdb
import pytest

from skeinmart.llm import prefix_trie

KINDS = "conv_id long, turn long, role string, text string, digest string, level string, a string, part string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows):
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in turns.items()}
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = tuple(own.get(base, [])[:h] + mine[h:])
    nodes = {p[:d] for p in full.values() for d in range(len(p) + 1)}
    members = {n: [c for c, p in full.items() if p[: len(n)] == n] for n in nodes}
    kids = collections.Counter(n[:-1] for n in nodes if n)
    for n in nodes:
        below = [m for m in nodes if m[: len(n)] == n]
        saved = sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m)
        ends = sorted(c for c in members[n] if len(full[c]) == len(n))
        yield (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), kids[n],
            sum(not kids[m] for m in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def planted(seed):
    rng = random.Random(seed)
    said = ["", None, "a b", "a  b\tc", "hello there", "x", "é ü\n", "\x0bq"]
    rows = []
    for c in [*range(-45, 70, 3), *range(100, 160), 10**12, 10**12 + 1]:
        n = rng.choice([1, 2, 3, 5, 9, 20])
        for t in range(n):
            turn = None if rng.random() < 0.05 else t if rng.random() < 0.9 else 1
            rows.append((c, turn, rng.choice(["user", "bot", None, "us"]), rng.choice(said[: 2 + c % 7])))
    rows += [(120, t, "u", "deep %d" % (t // 2)) for t in range(70)]  # deeper than a band of bands
    rows += [(121, t, "u", "deep %d" % (t // 2)) for t in range(66)]
    rows += [(c, t, "u", "same") for c in range(200, 290) for t in range(3)]  # copies
    rows += [(None, 1, "u", "nobody"), rows[0], rows[0]]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "q", "r", "s") for r in rows], KINDS).repartition(4)


@pytest.mark.parametrize("height", [8, 2])
def test_trie(spark, height, tmp_path):
    rows = planted(height)
    got = prefix_trie.prefix_trie(frame(spark, rows), height=height)
    assert got.columns == NAMES
    mine = sorted((tuple(r) for r in got.collect()), key=repr)
    assert mine == sorted(plain(rows), key=repr)
    if height == 8:
        path = os.path.join(tmp_path, "c.parquet")
        frame(spark, rows).coalesce(1).write.parquet(path)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
        cursor = con.execute(prefix_trie.TRIE_SQL)
        assert [x[0] for x in cursor.description] == NAMES
        assert sorted(cursor.fetchall(), key=repr) == mine


def test_one_conversation_over_many_tasks(spark):
    rows = [(20, t, "u", "w %d" % (t % 7)) for t in range(900)] + [(21, t, "u", "w %d" % (t % 7)) for t in range(700)] + [(39, 5, "u", "alone")] * 300
    got = {(r.conv_id, r.depth): r for r in prefix_trie.prefix_trie(frame(spark, rows)).collect()}
    copied = zlib.crc32(b"39") % 4  # turns that conversation 39 takes from 20
    assert got[20, 0].n_convs == 3 and got[20, 0].saved_tokens == 2 * (700 + copied)
    assert got[20, 700].n_convs == 2 and got[20, 900].n_leaves == 1 and max(d for _, d in got) == 900
    assert got[20, 700].ends_sha256 == hashlib.sha256(b"21").hexdigest()
    assert got[20, 1].n_leaves == got[20, 700].n_leaves


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "u", "x")])).collect() == []
