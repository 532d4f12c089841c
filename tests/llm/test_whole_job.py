"""Cases that the operators once left out."""

import hashlib
import random

from pyspark.sql import functions as F
from test_operators import rows_of, words

from skeinmart.llm import decontam, pii, registry, suffix_dedup


def test_rows_of_one_id_whose_32_bit_hashes_agree(spark):
    rng = random.Random(4)
    shared, own = words(rng, 30), words(rng, 30)
    base = spark.range(200_000)
    both = [base.select(F.concat(F.lit(t + " "), F.col("id")).alias("t")).withColumn("h", F.hash("t")) for t in (shared, own)]
    x, y = both[0].toDF("x", "h").join(both[1].toDF("y", "h"), "h").orderBy("x", "y").select("x", "y").first()
    docs = spark.createDataFrame([(None, x), (None, y), (1, shared)], "doc_id long, text string")
    got = {bytes(r.kept): r.n_removed for r in suffix_dedup.remove_repeats(docs, length=60, gram=20).collect()}
    assert got[y.encode()] == 0, "nothing of it repeats"
    assert sum(n > 0 for n in got.values()) == 2


def test_short_and_very_long_items_leak(spark):
    rng = random.Random(5)
    long = words(rng, 240_000)
    assert len(long) > 1 << 20
    bench = spark.createDataFrame([(1, "Who wrote it"), (2, long), (3, "red house")], "item_id long, text string")
    rows = [(1, "a: who  WROTE it?"), (2, "x " + long + " y"), (3, "infrared houses"), (4, "who wrote"), (5, "red house"), (6, "red houses, a red house")]
    found = decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert rows_of(found, "doc_id", "item_id", "edits") == [(1, 1, 0), (2, 2, 0), (5, 3, 0), (6, 3, 0)]


def luhn_number(rng, n):
    d = [4] + [rng.randrange(10) for _ in range(n - 2)]
    total = sum(x if k % 2 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
    return "".join(map(str, [*d, -total % 10]))


def test_spans_that_no_base_pattern_has(spark):
    rng = random.Random(6)
    rows, real = [], {}
    for i in range(2000):
        v6 = ":".join("%x" % rng.randrange(1, 1 << 16) for _ in range(8))
        phone = "1 555 %03d %04d" % (rng.randrange(1000), rng.randrange(10000))
        kind, before, span = [
            ("email", "write to ", f"{words(rng, 1)} (at) {words(rng, 1)} [dot] org"), ("ip", "host ", v6), ("card", "card ", luhn_number(rng, 13)),
            ("phone", "call ", phone if i % 10 < 5 else "+" + phone), (None, "at ", "%02d:%02d:%02d:%02d" % tuple(rng.randrange(10, 60) for _ in range(4))),
            (None, "part ", "7%012d" % (10 * rng.randrange(10**11))), (None, "sizes ", "%d (at) %d" % (i, i)),
        ][i % 7]
        rows.append((i, f"{before}{span}, seen"))
        if kind and not (kind == "phone" and span[0] == "+"):
            real[i] = f"{kind}:{len(before)}:{len(before) + len(span)}"
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = {i: r.spans for i, r in got.items() if r.spans and not r.n_phone}
    right = sum(real.get(i) == s for i, s in added.items())
    assert right >= 0.98 * len(added), "precision"
    for kind in pii.KINDS:
        own = {i for i, s in real.items() if s.startswith(kind)}
        assert sum(added.get(i) == real[i] for i in own) >= 0.95 * len(own), kind


def test_passages_are_cut_from_400_bytes_on_whatever_their_words(spark):
    rng = random.Random(9)

    def letters(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz" + 10 * " ") for _ in range(n))

    planted = {n: letters(n) for n in (320, 399, 400, 401)}
    assert all(len(p.split()) > 50 for p in planted.values())
    # Signs of its own on both sides of a passage, so that no copy goes on past it.
    rows = [(10 * k + c, letters(700) + "<[{"[c] + p + ">]}"[c] + letters(500), n) for k, (n, p) in enumerate(planted.items()) for c in range(3)]
    rows += [(100 + k, letters(1500), 0) for k in range(5)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = rows_of(suffix_dedup.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans")
    assert got == sorted(((i, len(t), n * (n >= 400), int(n >= 400)) for i, t, n in rows), key=repr)


def test_the_query_gives_the_text_that_is_left(spark, tmp_path):
    rng = random.Random(10)
    passage = words(rng, 90)
    assert len(passage) >= 400
    own = [words(rng, 300) for _ in range(5)]
    # The last byte of these two letters agrees, so that the passage takes half of a letter along.
    rows = [(1, own[0] + "<" + passage + ">" + own[1]), (2, own[2] + "[" + passage + "]" + own[3]), (3, own[4]), (4, None), (5, "x\u00e9" + passage), (6, "y\u0169" + passage)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = registry.op7_suffix_dedup(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    got = {r.doc_id: r for r in found.collect()}
    left = {1: own[0] + "<>" + own[1], 2: own[2] + "[]" + own[3], 3: own[4], 4: "", 5: "x\ufffd", 6: "y\ufffd"}
    assert {i: r.text for i, r in got.items()} == left
    assert all(got[i].kept_sha256 == hashlib.sha256(left[i].encode()).hexdigest() for i in (1, 2, 3, 4))
    assert got[5].kept_sha256 == hashlib.sha256(b"x\xc3").hexdigest() and got[5].n_removed == len(passage) + 1
