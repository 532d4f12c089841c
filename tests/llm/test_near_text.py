"""Near-duplicate texts of the pipeline against all pairs compared one by one."""

import random

import corpus_pipeline as pipeline
import numpy as np
import pytest
from test_operators import words

from skeinmart.llm import near_text

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("chunk", [near_text.CHUNK, 2])
def test_stage_links_all_pairs_of_four_fifths(spark, chunk, monkeypatch):
    rng = random.Random(11)
    texts = [None, "", " \t ", "One two", "one  TWO", "one three"]
    common = words(rng, 12)
    for _ in range(12):
        base = (words(rng, rng.randint(5, 90)) + " " + common + " " + words(rng, 30)).split()
        texts.append(" ".join(base))
        for cuts in (1, 2, 3, 4):
            new = list(base)
            for i in rng.sample(range(len(new)), cuts):
                new[i] = words(rng, 1)
            texts.append(" ".join(new))
            base = new if cuts == 2 else base  # chains
        texts.append(" ".join(base + words(rng, rng.randint(1, 25)).split()))
    texts.append(texts[6])
    n = len(texts)
    sets = [shingle_set(t) for t in texts]
    group = list(range(n))
    for i in range(n):
        for j in range(i):
            either = len(sets[i] | sets[j])
            if 5 * len(sets[i] & sets[j]) >= 4 * either and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    want = sorted(set(group))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], KINDS).repartition(3)
    monkeypatch.setattr(near_text.groups_of, "__defaults__", (chunk,))
    monkeypatch.setattr(near_text.deduplicate, "__defaults__", ("doc_id", "text", chunk))
    assert sorted(r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, "").collect()) == want
    assert 6 < len(want) < n
    monkeypatch.setattr(near_text, "frequent_shingles", lambda rows, total: near_text.shingles(common.encode()))
    assert sorted(r.doc_id for r in near_text.deduplicate(docs, chunk=chunk).collect()) == want
    assert near_text.deduplicate(docs.limit(0)).count() == 0


def test_fingerprints_and_pivots_lose_no_link():
    rng = np.random.default_rng(4)
    pivots = near_text.Pivots()
    for n in (1, 2, 7, 31, 32, 33, 64, 500, 1025):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        for kept in {n, max(1, 9 * n // 10), max(1, 4 * n // 5)}:
            b = np.concatenate([a[:kept], rng.integers(0, 2**63, min(n // 10, n - kept), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            x, y = near_text.bit_row(a), near_text.bit_row(b)
            apart = len(np.setxor1d(a, b))
            if len(x) > len(y):
                x = near_text.fold(x)
            assert len(x) == len(y) and np.bitwise_count(x ^ y).sum() <= apart
            assert np.abs(pivots.distances(x) - pivots.distances(y)).max() <= apart


def test_folded_codes_lose_no_link():
    rng = np.random.default_rng(6)
    sets, own = [], []
    for n in (1, 5, 31, 33, 120, 130, 700, 3000):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        sets += [np.unique(a), np.unique(np.append(a[: max(1, 9 * n // 10)], rng.integers(0, 2**63, n // 5, dtype=np.uint64)))]
    codes = [near_text.code_of(near_text.bit_row(s).tobytes()) for s in sets]
    width = np.array([len(c) // 8 for c in codes])
    assert width.min() == 1 and width.max() == near_text.CODE_WORDS
    words = np.frombuffer(b"".join(c.ljust(8 * near_text.CODE_WORDS, b"\0") for c in codes), np.uint64).reshape(len(codes), -1)
    a, b = (x.ravel() for x in np.indices((len(sets), len(sets))))
    got = near_text.code_distances(words, width, a, b)
    for i, j, d in zip(a.tolist(), b.tolist(), got.tolist()):
        x, y = (np.frombuffer(codes[k], np.uint8) for k in (i, j))
        while len(x) != len(y):
            x, y = (near_text.fold(x), y) if len(x) > len(y) else (x, near_text.fold(y))
        assert d == np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_copies_ids_and_long_texts(spark):
    rng = random.Random(12)
    long = words(rng, 30_000)
    base = words(rng, 40)
    rows = [(5, base), (5, base), (5, base + " " + words(rng, 3)), (None, base), (None, None), (None, None), (7, long), (3, long + " end"), (9, "one"), (8, "ONE")]
    rows += [(100 + i, base) for i in range(300)]
    kinds = "doc_id long, text string, node string, n string, `k_id` string, `odd name` string, share string"
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], kinds).repartition(4)
    kept = near_text.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, (r.text or "")[:9]) for r in kept.collect()), key=repr) == sorted([(5, base[:9]), (3, long[:9]), (8, "ONE"), (None, "")], key=repr)


def test_hot_shingles_stream(spark, monkeypatch):
    """Rows of one shingle in many batches: leads, shares and repeated rows as in one go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(s, -1, node, 10, 0) for s in range(6) for node in range(s * 3) for _ in range(1 + node % 2)]
        rows += [(50, share, node, 10, 9) for share in range(2) for node in range(share, 7, 2)] + [(60, 1, 1, 10, 0), (70, -1, 5, 10, 0)]
        found = spark.createDataFrame(rows, "s long, share int, node long, n int, pos int").repartition(3)
        got = sorted((r.s, r.node, r.lead, r.near) for r in near_text.shared_shingles(found).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [(s, node, 0, node > 0) for s in range(6) for node in range(s * 3) if s * 3 > 1]
    want += [(50, node, node % 2, node > 1) for node in range(7)] + [(60, 1, 1, False)]
    assert got == sorted(want)


def test_few_pairs_are_verified(spark, monkeypatch):
    rng = random.Random(13)
    shared = words(rng, 30)
    texts = [words(rng, 60) + " " + shared + " " + words(rng, 60) for _ in range(60)]
    texts += [t + " more" for t in texts[:10]]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], KINDS)
    seen, original = [], near_text.plausible
    monkeypatch.setattr(near_text, "plausible", lambda pairs, nodes: (lambda out: seen.append((pairs.count(), out.count())) or out)(original(pairs, nodes)))
    assert near_text.deduplicate(docs).count() == 60
    assert sum(n for _, n in seen) == 10, "of the pairs that share a shingle only the links are left"


def test_simhash_joins_near_copies_before_the_exact_search(spark):
    rng = random.Random(12)
    base = [words(rng, 300).split() for _ in range(4)]
    texts = [" ".join(b) for b in base]
    for b in base:
        texts += [" ".join(b), " ".join(b + [words(rng, 1)]), " ".join([words(rng, 1)] + b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate([None, " ", *texts])], KINDS).repartition(3)
    rows = near_text.named(docs, "doc_id", "text")
    nodes = rows.groupBy("node").agg(*(near_text.F.first(c).alias(c) for c in ("n", "fp")))
    pairs = near_text.simhash_pairs(nodes)
    linked = {r.node: r.component for r in near_text.components(pairs).collect()}
    of = {r.doc_id: linked.get(r.node, r.node) for r in rows.collect()}
    assert len({of[2 + i] for i in range(4)}) == 4, "different texts stay apart"
    joined = sum(of[2 + 4 + 3 * i + k] == of[2 + i] for i in range(4) for k in range(3))
    assert joined >= 10, "one word more at an end changes few bits"
    assert of[0] == of[1] and near_text.simhash_of(near_text.shingles(b"")) == 0
    own = near_text.shingles(texts[0].encode())
    assert near_text.simhash_of(own) == near_text.majority(b"".join(int(x).to_bytes(8, "big") for x in own))
    assert near_text.apart(pairs, near_text.components(pairs)).count() == 0, "nothing is verified twice"
