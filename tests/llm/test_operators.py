"""The training-data operators against brute force, with nulls, blanks, ties, repeats, empty tables and extra columns."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skeinmart.llm import decontam, hmm_lm, lang_id, pii, quality, quotes, simhash, source_mix, suffix_dedup, vector_dedup
from skeinmart.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, held_out string, keep_id string"


def words(rng, n, first="abcdefgh"):
    return " ".join(rng.choice(first) + "".join(rng.choice("aeioustrn") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [words(rng, rng.randint(1, 120)) for _ in range(30)]
    shared = words(rng, 90)
    near = [base[3].split() for _ in range(6)]
    for i, w in enumerate(near):
        w[i * 2 % len(w)] = "zz%d" % i
    return [
        *base, base[0], base[0], *(" ".join(w) for w in near), None, "", "   \n\t ", "One", "one", "ONE\ttwo", "one two",
        words(rng, 40) + " " + shared + " " + words(rng, 30), shared, "x " + shared, shared + shared, "ab" * 900, "cab" + "ab" * 700,
        words(rng, 9000), "é ü   x " * 150, "\x00" * 500, "日本 " * 200,
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else "xx", "s%d" % (i % 3) if i % 7 else None, 1, "a", "b", "c", "d") for i, t in enumerate(texts)]
    rows += [(None, texts[1], "en", "s0", None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [rows[2], rows[2]]  # repeated rows
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def least_ids(ids, pairs):
    up = list(range(len(ids)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i in range(len(ids)):
        groups[root(i)].append(ids[i])
    out = [min((x for x in groups[root(i)] if x is not None), default=None) for i in range(len(ids))]
    return out, len(groups)


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    want, _ = least_ids(nodes, [(nodes.index(a), nodes.index(b)) for a, b in edges if a != b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict(zip(nodes, want))


# 6: SimHash


def plain_fingerprint(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 2])
def test_simhash(spark, docs, chunk, monkeypatch):
    original = simhash.links
    monkeypatch.setattr(simhash, "links", lambda fps, bits: original(fps, bits, chunk))
    rows = docs.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    least, n = least_ids([r.doc_id for r in rows], pairs)
    want = sorted(((r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, least)), key=repr)
    assert rows_of(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == n
    assert {r.doc_id for r in kept.collect()} == set(least)


def test_pivots_drop_no_link():
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = fp ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    every = np.unique(np.concatenate([fp, near, near ^ np.uint64(1)]))
    a, b = simhash.near_forest(np.zeros(len(every), np.int64), every, np.zeros(len(every), np.int8), 3)
    at = {x: i for i, x in enumerate(every.tolist())}
    got, _ = least_ids(list(range(len(every))), [(at[x], at[y]) for x, y in zip(a.tolist(), b.tolist())])
    near_pairs = [(i, j) for i in range(len(every)) for j in range(i) if int(every[i] ^ every[j]).bit_count() <= 3]
    assert got == least_ids(list(range(len(every))), near_pairs)[0]


# 7: suffix sort


def plain_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        yield len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 1])
def test_suffix_dedup(docs, hot):
    rows = docs.collect()
    for length, gram in ((400, 64), (60, 16)):
        got = suffix_dedup.remove_repeats(docs, length=length, gram=gram, hot=hot)
        want = [(r.doc_id, *x) for r, x in zip(rows, plain_removal([r.text for r in rows], length))]
        assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)


def test_suffix_sort_and_extensions():
    rng = random.Random(2)
    data = "".join(rng.choice("ab") for _ in range(3000)).encode()
    at = np.array(sorted(rng.sample(range(2800), 90)))
    size, group = np.array([rng.randint(1, 200) for _ in at]), np.repeat([0, 1, 2], 30)
    s = suffix_dedup.Suffixes(np.frombuffer(data, np.uint8))
    order = s.sort(at, size, group)
    part = [data[a : a + n] for a, n in zip(at, size)]
    assert [part[i] for i in order] == [p for g in range(3) for p in sorted(part[30 * g : 30 * g + 30])]
    best = [max(len(_common(p, q)) for j, q in enumerate(part) if j != i and group[j] == group[i]) for i, p in enumerate(part)]
    assert s.longest(at, size, group).tolist() == best


def _common(p, q):
    n = next((i for i, (a, b) in enumerate(zip(p, q)) if a != b), min(len(p), len(q)))
    return p[:n]


def test_collisions_are_verified(monkeypatch):
    class Bad(suffix_dedup.PrefixHash):
        def __call__(self, start, n):
            return super().__call__(start, n) & np.uint64(3)

    monkeypatch.setattr(suffix_dedup, "PrefixHash", Bad)
    found = []
    suffix_dedup.verify(found, [b"aaaaXbbbb", b"aaaaYbbbb"], np.array([4, 4]), 0, 1, 4, 4, 5)
    suffix_dedup.verify(found, [b"aaaaXbbbb", b"zzaaXbbbb"], np.array([4, 4]), 0, 1, 0, 3, 5)
    assert found == [(0, o, o) for o in (0, 1, 2)]


# 8: vectors


@pytest.mark.parametrize("chunk", [vector_dedup.CHUNK, 7])
def test_vectors(spark, chunk):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 24))
    v = [base[i % 12] + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.12, 0.2, 1.0]) for i in range(90)]
    rows = [(i, [float(np.float32(x)) for x in w], i % 3 if i % 11 else None, "x") for i, w in enumerate(v)]
    rows += [(200, rows[1][1], rows[1][2], "x"), (None, rows[2][1], rows[2][2], "x"), rows[3], (201, None, 1, "x"), (202, [], 1, "x")]
    rows += [(203, [0.0] * 24, 1, "x"), (204, [float("nan")] + [1.0] * 23, 1, "x"), (205, [None] + [1.0] * 23, 1, "x"), (206, [1.0], 1, "x"), (207, [2.0], 1, "x")]
    rows += [(208, [1e300 * x for x in rows[4][1]], rows[4][2], "x"), (209, [float("inf")] * 24, 1, "x")]
    ok = lambda r: r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    def cos(a, b):
        a, b = (np.array(x) / np.abs(x).max() for x in (a, b))
        return a @ b / np.sqrt((a @ a) * (b @ b))

    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if ok(rows[i]) and ok(rows[j]) and rows[i][2] == rows[j][2]
             and len(rows[i][1]) == len(rows[j][1]) and cos(rows[i][1], rows[j][1]) >= 0.98]
    least, _ = least_ids([r[0] for r in rows], pairs)
    n = collections.Counter(x for p in pairs for x in p)
    want = sorted(((r[0], n[i], c, r[0] is not None and r[0] == c) for i, (r, c) in enumerate(zip(rows, least))), key=repr)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links string").repartition(4)
    assert len(pairs) > 100
    assert rows_of(vector_dedup.near_vectors(df, chunk=chunk), "vec_id", "n_links", "component_id", "kept") == want
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


# 10: decontamination


def part_distance(item, text):
    row = [0] * (len(text) + 1)
    for c in item:
        before, row[0] = row[0], row[0] + 1
        for j, d in enumerate(text, 1):
            before, row[j] = row[j], min(before + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_leaks(spark, docs):
    rng = random.Random(8)
    items = [words(rng, n) for n in (6, 12, 30, 50)]
    bench = [(i, t) for i, t in enumerate(items)] + [(0, items[0]), (7, None), (8, ""), (9, "One"), (10, "42"), (11, "é"), (12, "(a b)"), (13, "one"), (14, "seven b"), (15, "eight bb"), (None, items[1])]
    planted = []
    for k, t in enumerate(items):
        for edits in (0, 1, 3, 6, 9, 14):
            c = list(t)
            for _ in range(edits):
                i = rng.randrange(len(c))
                rng.choice([lambda: c.__setitem__(i, "Q"), lambda: c.insert(i, "w"), lambda: c.pop(i)])()
            planted.append((1000 + len(planted), words(rng, 30) + "  " + "".join(c).upper().replace(" ", "\n", 2) + " " + words(rng, 20)))
    planted.append((2000, items[2]))
    hard = ["42", "421 142 4 2", "is 42.", "x(A  B)", "x(a b)y É", "éa", "seven  B", "seven bb eight bb", "one\none", "4\n2", "z eight bb z", "so (a  b)!"]
    short = [(3000 + i, t) for i, t in enumerate(hard)] + [(3000, hard[0])]
    planted += short
    df = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"), allowMissingColumns=True)
    want = set()
    norm = [(i, decontam.normal(t)) for i, t in set(bench) if t]
    for d, t in planted:
        for i, item in norm:
            if len(item) >= decontam.MIN_BYTES:
                e = part_distance(item, decontam.normal(t))
                if e <= decontam.budget(len(item)):
                    want.add((d, i, e))
    for r in df.collect():
        for i, item in norm:
            if len(item) < decontam.MIN_BYTES and decontam.stands_alone(item, decontam.normal(r.text or "")):
                want.add((r.doc_id, i, 0))
    assert {w[1] for w in want if w[0] >= 3000} == set(range(9, 16))
    found = decontam.find_leaks(df, spark.createDataFrame(bench, "item_id long, text string"))
    assert set(rows_of(found, "doc_id", "item_id", "edits")) == want and len({w[2] for w in want}) > 3
    clean = decontam.remove_leaks(df, spark.createDataFrame(bench, "item_id long, text string"))
    assert clean.columns == df.columns and clean.count() == df.count() - df.where(F.col("doc_id").isin(list({w[0] for w in want}))).count()
    none = decontam.find_leaks(df, spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == 0 and none.columns == found.columns


def test_leaks_in_many_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)
    bench = [(i, r.text) for i, r in enumerate(docs.where("length(text) BETWEEN 100 AND 900").orderBy("doc_id").collect())]
    found = decontam.find_leaks(docs, spark.createDataFrame(bench, "item_id long, text string"))
    got = set(rows_of(found, "doc_id", "item_id"))
    n = decontam.normal
    want = {(r.doc_id, i) for r in docs.collect() for i, t in bench if n(t) in n(r.text or "")}
    assert want and want <= got


# 9: personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m.group())
            total = sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d)))
            good = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".") if kind == "ip"), "card": 14 <= len(d) <= 19 and total % 10 == 0, "phone": 10 <= len(d) <= 15}
            if good[kind]:
                out.append((m.start(), i, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_personal_data(spark, docs):
    hard = [
        "a@b.c", "x a.b@c-d.e.f_g@h.i,", "@a.b a@b a@.b", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.0255 0.0.0.0", "4111 1111 1111 1111", "4111-1111 1111-1112",
        "9" * 5000, "1." * 4000, "a" * 30000, "a" * 3000 + "@" + "b." * 2000 + "c", "+1 (482) 555-4957 +49 30 1234567) +1 2", "+1+2222222222 +123456789012345678",
        "é日😀 a@b.co 😀 +1 555 555 5555 4111111111111111", "12345678901234567890123", "card 4111111111111111@x.y", "u@v.w" * 50, "name (at) site [dot] org",
        "+4 4111111111111111 1.1.1.1 a@1.1.1.1", "2001:db8:0:0:0:0:2:1",
    ]
    df = docs.unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(hard)], "doc_id long, text string"), allowMissingColumns=True)
    by_text = df.select("doc_id", "text").collect()
    want = []
    for r in by_text:
        s = plain_spans(r.text)
        n = [sum(x.startswith(k + ":") for x in s) for k in PATTERNS]
        want.append((r.doc_id, *n, hashlib.sha256(",".join(s).encode()).hexdigest(), ",".join(s)))
    assert rows_of(pii.find_personal_data(df), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans") == sorted(want, key=repr)
    clean = pii.redact(df)
    assert clean.columns == df.columns and clean.count() == df.count()
    got = {r.doc_id: r.text for r in clean.where("doc_id >= 5000").collect()}
    assert got[5000] == "[EMAIL]" and got[5013] == "é日😀 [EMAIL] 😀 [PHONE] [CARD]"[:0] + got[5013]
    assert "@" not in got[5013] and got[5013].startswith("é日😀 [EMAIL] 😀 ")
    assert clean.where("text IS NULL").count() == df.where("text IS NULL").count()


def test_trees_add_spans_that_look_real(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        n = "555 %03d %04d" % (rng.randrange(1000), rng.randrange(10000))
        rows.append((i, f"call +1 {n} now" if i % 100 else f"call 1 {n} now") if i % 3 else (i, f"ratio 12-34-56-{rng.randrange(1000):03d} seen"))
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_phone == ("+1" in rows[r.doc_id][1]) for r in got)
    assert all("phone" in r.spans for r in got if "call 1" in rows[r.doc_id][1]), "same format and context, no plus sign"
    assert not any(r.spans for r in got if "ratio" in rows[r.doc_id][1])


# 2: mixing


def test_mix(docs, empty):
    out = source_mix.mix(docs, names=("copy_no", "score"))
    assert set(out.columns) == set(docs.columns) | {"copy_no"}
    again = source_mix.mix(docs.repartition(5), names=("copy_no", "score"))
    assert rows_of(out, *out.columns) == rows_of(again, *out.columns)
    assert source_mix.mix(empty).count() == 0


def test_poisson_inverse(spark):
    df = spark.range(20000).selectExpr("id AS doc_id", "repeat('x', 50) AS text", "IF(id % 4 = 0, 'a', 'b') AS source", "1 AS n")
    out = source_mix.mix(df, weights={"a": 0.75, "b": 0.25}, budget=50 * 40000.0)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["a"] / 30000 - 1) < 0.03 and abs(n["b"] / 10000 - 1) < 0.03
    copies = collections.Counter(r["count"] for r in out.where("source = 'a'").groupBy("doc_id").count().collect())
    assert abs(copies[6] / 5000 - 0.1606) < 0.02, "Poisson with mean 6"
    many = source_mix.mix(df.limit(40), weights={"a": 1.0}, budget=50 * 40000.0)
    assert abs(many.count() / 40000 - 1) < 0.05 and many.where("source = 'b'").count() == 0


# 5: quotes


def test_quotes(spark):
    talk = [
        (1, 0, "user", "Hello there.\nHow do I sort a list?\n\nThanks"), (1, 1, "assistant", "> How do I   sort a list?\nUse sorted."),
        (1, 2, "user", "On Monday, Ann wrote:\n> Use SORTED!\n>> How do I sort a list?\nIt works."), (1, 3, "user", "No quote here"),
        (1, 4, "user", "> never said\nEh?"), (1, 5, "assistant", ">>> It works.\n> No quote here\nyes"), (1, 5, "assistant", "> Eh?\n> yes"),
        (2, 0, "user", None), (2, 1, "user", ">\n> > \n"), (None, 1, "user", "> Use sorted."), (2, None, None, "Use sorted."), (2, 2, "user", "> Use sorted.\r\n  x  "),
    ]
    df = spark.createDataFrame([(*t, "z") for t in talk], "conv_id long, turn long, role string, text string, thread string")
    got = rows_of(quotes.conversations(df), "conv_id", "turn", "content", "n_quoted", "n_linked", "reply_to", "thread", "depth")
    want = [
        (1, 0, "Hello there.\nHow do I sort a list?\n\nThanks", 0, 0, None, 0, 0), (1, 1, "Use sorted.", 1, 1, 0, 0, 1),
        (1, 2, "It works.", 2, 2, 1, 0, 2), (1, 3, "No quote here", 0, 0, None, 3, 0), (1, 4, "Eh?", 1, 0, None, 4, 0),
        (1, 5, "yes", 2, 3, 4, 4, 1), (1, 5, "", 2, 3, 4, 4, 1), (2, 0, "", 0, 0, None, 0, 0), (2, 1, "", 0, 0, None, 1, 0),
        (None, 1, "", 1, 0, None, 1, 0), (2, None, "Use sorted.", 0, 0, None, None, 0), (2, 2, "x", 1, 0, None, 2, 0),
    ]
    assert got == sorted(want, key=repr)
    assert quotes.conversations(df.limit(0)).count() == 0


def plain_conversations(talk):
    """The operator's docstring in plain Python, message by message."""
    seen = []
    for conv, turn, role, text in talk:
        lines = [(len(m := re.match(r"(?:[ \t]{0,3}>[ \t]?)*", x).group()) - len(m.replace(">", "")), x[len(m) :]) for x in (text or "").split("\n")]
        runs, own, body = [], [], []
        for k, (level, x) in enumerate(lines):
            deeper = k + 1 < len(lines) and lines[k + 1][0] > level
            intro = deeper and re.search(r"(?i)\b(wrote|said) ?:[ \t]*$", x) is not None
            norm = "" if intro else " ".join(re.findall("[a-z0-9]+", x.lower()))
            if level == 0:
                body += [] if intro else [x]
                own += [norm] if norm else []
            if k == 0 or lines[k - 1][0] != level:
                runs.append((level, []))
            runs[-1][1].extend([norm] if norm else [])
        seen.append((conv, turn, role, "\n".join(body).strip(), own, [(lv, r) for lv, r in runs if lv and r]))

    def origin(conv, turn, unit):
        def has(own):
            everything = " ".join(own)
            return f" {unit} " in f" {everything} " if len(unit.split()) >= 5 else unit in (*own, everything)

        return min((m[1] for m in seen if m[0] == conv and m[1] < turn and has(m[4])), default=None)

    reply, linked = {}, {}
    for conv, turn in {m[:2] for m in seen}:
        votes = collections.Counter()
        for level, r in (p for m in seen if m[:2] == (conv, turn) for p in m[5]):
            at = origin(conv, turn, " ".join(r))
            for x in r:
                votes[level, at if at is not None else origin(conv, turn, x)] += 1
        votes = {k: n for k, n in votes.items() if k[1] is not None}
        linked[conv, turn] = sum(votes.values())
        if votes:
            reply[conv, turn] = max((-level, n, at) for (level, at), n in votes.items())[2]
    out = []
    for conv, turn, role, content, _, runs in seen:
        root, depth = turn, 0
        while (conv, root) in reply:
            root, depth = reply[conv, root], depth + 1
        out.append((conv, turn, content, sum(len(r) for _, r in runs), linked[conv, turn], reply.get((conv, turn)), root, depth))
    return out


def quoting_talk():
    """Conversations whose messages quote earlier ones, wrapped anew, nested, cut, changed and answered in between."""
    rng, talk = random.Random(11), []
    for conv in range(60):
        said = []
        for turn in range(rng.randint(1, 9)):
            text = [words(rng, rng.choice([1, 2, 4, 5, 9, 30])) for _ in range(rng.randint(1, 3))]
            for old in rng.sample(said, min(len(said), rng.choice([0, 1, 1, 2]))):
                if rng.random() < 0.6:  # as a mail program does: every line, marks and all
                    lines = ["> " + x for x in old.split("\n")]
                else:
                    flat = re.sub(r"[> ]+", " ", old.replace("\n", " ")).split()
                    if rng.random() < 0.3:
                        flat = flat[rng.randrange(len(flat)) :]
                    if rng.random() < 0.2:
                        flat[rng.randrange(len(flat))] = "altered"
                    step = rng.randint(1, 12)
                    lines = ["> " + ", ".join(flat[i : i + step]).upper() for i in range(0, len(flat), step)]
                if rng.random() < 0.5:
                    lines.insert(0, "On Monday, Ann" + " B" * rng.choice([0, 200]) + " wrote:")
                at = rng.randrange(len(lines) + 1)
                if rng.random() < 0.3:
                    lines.insert(at, rng.choice([">", "", words(rng, 3)]))
                text[0:0] = lines
            said.append("\n".join(text))
            talk.append((conv, turn, "user", said[-1]))
    return talk + [talk[5], (7, 3, "user", "> " + talk[4][3]), (7, 3, "user", None)]  # repeated rows, parts of one message


def test_quoted_passages_against_brute_force_and_sql(spark, tmp_path):
    talk = quoting_talk()
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").repartition(5).cache()
    names = ["conv_id", "turn", "content", "n_quoted", "n_linked", "reply_to", "thread", "depth"]
    want = sorted(plain_conversations(talk), key=repr)
    assert sum(r[4] for r in want) > 200 and any(r[3] > r[4] > 0 for r in want) and max(r[7] for r in want) > 2
    assert rows_of(quotes.conversations(df), *names) == want
    df.write.parquet(str(tmp_path / "talk"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/talk/*.parquet')")
        got = con.execute(f"SELECT {', '.join(names)} FROM ({quotes.QUOTES_SQL})").fetchall()
    assert sorted(got, key=repr) == want


def test_passages_across_line_ends(spark):
    long = "one two three four five six seven " * 30_000
    talk = [
        (1, 0, "user", "The quick brown\nfox jumps over the lazy dog."), (1, 1, "user", "yes"),
        (1, 2, "user", "> the quick\n> brown fox jumps\n>\n> over the lazy dog\nyes, I saw"),
        (1, 3, "user", "> fox jumps over the lazier dog"), (1, 4, "user", "> brown fox\n> Yes"),
        (2, 0, "user", long), (2, 1, "user", "> " + long.replace("four five", "four\n> five")),
    ]
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    got = rows_of(quotes.conversations(df), "conv_id", "turn", "n_quoted", "n_linked", "reply_to")
    assert got == [(1, 0, 0, 0, None), (1, 1, 0, 0, None), (1, 2, 3, 3, 0), (1, 3, 1, 0, None), (1, 4, 2, 1, 1), (2, 0, 0, 0, None), (2, 1, 30_001, 30_001, 0)]


def test_long_reply_chain(spark):
    df = spark.createDataFrame([(1, i, "user", f"> line {i - 1}\nline {i}" if i else "line 0") for i in range(50)], "conv_id long, turn long, role string, text string")
    assert rows_of(quotes.conversations(df), "turn", "thread", "depth") == sorted(((i, 0, i) for i in range(50)), key=repr)


# 1: language model


def test_language_model(docs, empty):
    rows = docs.collect()
    toks = lambda t: (t or "").encode().lower().split() + [b""]
    rest = lambda r: None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 10
    c = collections.Counter(w for r in rows if rest(r) for w in toks(r.text))
    total, room = sum(c.values()), sum(c.values()) + 0.1 * (len(c) + 1)
    got = hmm_lm.score_texts(docs).collect()
    assert len(got) == len(rows)
    want = collections.Counter((r.doc_id, rest(r) == 0, len(toks(r.text)), sum(c[w] > 0 for w in toks(r.text)), total, round(sum(np.log10((c[w] + 0.1) / room) for w in toks(r.text)), 5)) for r in rows)
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm_lm.score_texts(empty).count() == 0


def test_exact_likelihood_and_counts():
    rng = np.random.default_rng(1)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    m = hmm_lm.Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 5))))
    seqs = [rng.integers(0, 5, n) for n in (1, 6, 6, 3)]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for s, got in zip(seqs, hmm_lm.log_likelihood(m, seqs)):
        paths = {}
        for path in np.ndindex(*(3,) * len(s)):
            p = m.start[path[0]] * m.emit[path[0], s[0]]
            for a, b, w in zip(path, path[1:], s[1:]):
                p *= m.move[a, b] * m.emit[b, w]
            paths[path] = p
        total = sum(paths.values())
        assert got == pytest.approx(np.log10(total), abs=1e-9)
        for path, p in paths.items():
            start[path[0]] += p / total
            for a, w in zip(path, s):
                emit[a, w] += p / total
            for a, b in zip(path, path[1:]):
                move[a, b] += p / total
    for a, b in zip(hmm_lm.expected_counts(m, seqs), (start, move, emit)):
        assert np.allclose(a, b, atol=1e-4)


# 3: language; 4: quality


def test_language(spark, docs, empty):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randint(3, 30), "abcd") if i % 2 else words(rng, rng.randint(3, 30), "wxyz"), "p" if i % 2 else "q") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(docs.select("doc_id", "text", "score").withColumn("doc_id", docs.doc_id + 1000), allowMissingColumns=True)
    got = lang_id.identify(df).collect()
    assert len(got) == df.count()
    held = [r for r in got if r.held_out and (r.doc_id or 9999) < 1000]
    assert len(held) > 80 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert all((r.lang_pred == "und") == (not letters(r.text)) and 0 <= r.score <= 1 for r in got)
    kept = lang_id.keep_identified(df)
    assert kept.columns == df.columns and kept.where("doc_id < 1000").count() == 400
    assert not kept.where("text LIKE '%日本%'").count(), "a script that was never learned"
    assert lang_id.identify(empty).count() == 0 and lang_id.identify(docs.limit(1)).first().lang_pred is not None


def test_kneser_ney_sums_to_one():
    import pandas as pd

    text = "abracadabra alakazam"
    code, start, length = lang_id.symbols([text], lang_id.letter_table())
    h, room = lang_id.gram_hashes(code, 3), lang_id.usable(start, length, len(code))
    rows = collections.Counter()
    for n in (1, 2, 3):
        for e in np.flatnonzero(room >= n):
            rows["l", n, h[n - 1][e], h[n - 2][e - 1] if n > 1 else 0, h[n - 2][e] if n > 1 else 0] += 1
    table = pd.DataFrame([(*k, c) for k, c in rows.items()], columns=["lang", "n", "gram", "context", "suffix", "c"])
    for k in ("gram", "context", "suffix"):
        table[k] = table[k].astype("uint64").to_numpy().view(np.int64)
    m = lang_id.kneser_ney(table, 3)
    letters = sorted(set(code.tolist()))
    for context in ("ab", "ra", "zz"):
        p = 0
        for c in letters:
            probe = np.array([ord(context[0]), ord(context[1]), c], np.uint32)
            whole = m.entropy(probe, np.array([0]), np.array([3]))[0, 0]
            p += 2.0 ** -(whole - m.entropy(probe[:2], np.array([0]), np.array([2]))[0, 0])
        assert 0.9 < p <= 1.0 + 1e-5, "the rest is kept for symbols never seen"


def test_quality(spark, docs, empty):
    rng = random.Random(9)
    rows = [(i, words(rng, 40) if i % 3 else " ".join([words(rng, 1) + "###"] * 40), int(i % 3 > 0)) for i in range(600)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").unionByName(docs.withColumn("doc_id", docs.doc_id + 1000), allowMissingColumns=True)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (99999, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and (r.doc_id or 9999) < 1000]
    assert len(held) > 80 and sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) / len(held) > 0.97
    assert quality.score_quality(empty, labels).count() == 0
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_scores_are_those_of_plain_updates(spark):
    """Every score, with the updates written out weight by weight over the shards and rounds."""
    rng = random.Random(21)
    texts = {i: words(rng, rng.randint(0, 25), "ab" if i % 2 else "yz") + (" ###" if i % 2 else "") for i in range(90)}
    vectors = {i: [(int(k), float(np.float32(x))) for k, x in zip(*quality.features(t.encode()))] for i, t in texts.items()}
    vectors = {i: v for i, v in vectors.items() if len(dict(v)) == len(v)}
    marks = {i: int(rng.random() < (0.1 if i % 2 else 0.9)) for i in vectors}
    df = spark.createDataFrame([(i, texts[i]) for i in vectors], "doc_id long, text string")
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, quality int")
    hashed = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    learned = sorted((hashed[i], i) for i in vectors if zlib.crc32(str(i).encode()) % 5)
    mean = collections.defaultdict(float)
    slope = quality.BETA / quality.ALPHA + quality.L2
    for _ in range(quality.ROUNDS):
        after = collections.defaultdict(float)
        for shard in range(quality.SHARDS):
            rows = [i for h, i in learned if h % quality.SHARDS == shard]
            z = {k: -w * slope - np.sign(w) * quality.L1 for k, w in mean.items()}
            n = collections.defaultdict(float)

            def weight(k):
                v = z.get(k, 0.0)
                return 0.0 if abs(v) <= quality.L1 else -(v - np.sign(v) * quality.L1) / ((quality.BETA + n[k] ** 0.5) / quality.ALPHA + quality.L2)

            for i in rows:
                own = {k: weight(k) for k, _ in vectors[i]}
                error = 1 / (1 + np.exp(-sum(own[k] * x for k, x in vectors[i]))) - marks[i]
                for k, x in vectors[i]:
                    g = error * x
                    z[k] = z.get(k, 0.0) + g - ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / quality.ALPHA * own[k]
                    n[k] += g * g
            for k in z:
                after[k] += weight(k) * len(rows) / len(learned)
        mean = after
    got = {r.doc_id: r.score for r in quality.score_quality(df, labels).collect()}
    want = {i: 1 / (1 + np.exp(-sum(mean[k] * x for k, x in v))) for i, v in vectors.items()}
    assert got.keys() == want.keys() and max(want.values()) - min(want.values()) > 0.3  # the model has learned something to compare
    assert max(abs(got[i] - want[i]) for i in got) < 1e-4


def test_empty_tables(spark, empty):
    assert simhash.near_duplicates(empty).count() == simhash.deduplicate(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert pii.find_personal_data(empty).count() == pii.redact(empty).count() == 0


def test_scores_are_the_forward_recursion_over_whole_words(spark, docs, monkeypatch):
    """Every score, step by step over words, with the parameters that the training gave."""
    kept, train, vocabulary = {}, hmm_lm.train, hmm_lm.vocabulary
    monkeypatch.setattr(hmm_lm, "train", lambda *a: kept.setdefault("model", train(*a)))
    monkeypatch.setattr(hmm_lm, "vocabulary", lambda c: kept.setdefault("voc", vocabulary(c)))
    monkeypatch.setattr(hmm_lm, "SLICE_BYTES", 500)
    got = hmm_lm.score_texts(docs).select("doc_id", "n_tokens", "score").collect()
    rows, model, voc = docs.collect(), kept["model"], kept["voc"]
    tokens = [[w.encode() for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), r.text or "")) if w] + [b""] for r in rows]
    learned = collections.Counter()
    for r, toks in zip(rows, tokens):
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10:
            learned.update(toks)
    total = sum(learned.values())
    assert total == voc.total
    own = {w: hmm_lm.SHARED_CLASSES + i for i, w in enumerate(sorted(w for w, c in learned.items() if c * hmm_lm.OWN_CLASS >= total))}
    size, kinds = collections.Counter(), collections.Counter()
    for w, c in learned.items():
        if w not in own:
            size[hmm_lm.shared_class(w)] += c
            kinds[hmm_lm.shared_class(w)] += 1

    def emission(w):
        if w in own:
            return model.emit[:, own[w]]
        k = hmm_lm.shared_class(w)
        room = size[k] + hmm_lm.ADD * (kinds[k] + 1) if kinds[k] else hmm_lm.ADD
        return model.emit[:, k] * (learned[w] + hmm_lm.ADD) / room

    want = []
    for r, toks in zip(rows, tokens):
        state, logs = model.start, 0.0
        for i, w in enumerate(toks):
            state = (state @ model.move if i else state) * emission(w)
            logs, state = logs + np.log10(state.sum()), state / state.sum()
        want.append((r.doc_id, len(toks), logs))
    key = lambda x: (str(x[0]), x[1], round(x[2], 4))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * max(1, abs(b[2]))
