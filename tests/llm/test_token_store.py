"""Token files against the tokenizer alone, one document at a time."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeinmart.llm import token_store
from skeinmart.llm.registry import public_tokenizer

KINDS = "doc_id long, text string, part string, seq string, ids string, h string"
BITS = [
    *" \n\t\x00\x01\x02\x03\x0b\x1c\x85 　", "  ", "\n\n", "\r\n", "a", "foo", "Bar", "'s", "'ll", "12", "é", "é", "日本", ".", ",",
    "<|endoftext|>", "🙂", "--", "​",
]


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizer())


def plain(model, rows):
    start = 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        yield i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], KINDS).repartition(5)


def test_pieces_encode_as_the_whole(model):
    with open(public_tokenizer()) as f:
        encoder = token_store.Encoder(f.read())
    rng = random.Random(1)
    for _ in range(60):
        texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(40)]
        ids, n = encoder.encode(pa.array(texts))
        want = [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
    assert len(token_store.pieces(pa.array(["\x00\x01\x02\x03 a b"]))[0]) == 1, "no mark is left"


def test_forgetting_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(token_store, "REMEMBERED", 3)
    with open(public_tokenizer()) as f:
        encoder = token_store.Encoder(f.read())
    for text in ("one two three four", "two three five", "six one"):
        assert encoder.encode(pa.array([text]))[0].tolist() == model.encode(text, add_special_tokens=False).ids


def test_pieces_are_few_and_shared_by_the_tasks_of_a_run(model, monkeypatch):
    with open(public_tokenizer()) as f:
        vocabulary = f.read()
    texts = ["one two\na\nb\nc", "two  blanks \n\n x\ny", " ", "", "end \n", "é\u3000\nä ö"]
    assert token_store.pieces(pa.array(texts[:1])).to_pylist() == [["one", " two", "\n", "a", "\n", "b", "\n", "c"]]
    assert ["".join(p) for p in token_store.pieces(pa.array(texts)).to_pylist()] == texts
    encoder = token_store._encoder("run 1", vocabulary)
    assert token_store._encoder("run 1", vocabulary) is encoder, "the next task of the worker has its pieces"
    monkeypatch.setattr(token_store, "REMEMBERED", 6)
    for text in ("one two three four five six", "two seven six", "six two one", "seven two eight one", *texts):
        assert encoder.encode(pa.array([text]))[0].tolist() == model.encode(text, add_special_tokens=False).ids
        if text.startswith("six"):
            assert {" two", " six"} <= set(encoder.place) and " three" not in encoder.place, "what comes again stays"
    assert token_store._encoder("run 2", vocabulary) is not encoder and list(token_store._kept) == ["run 2"]
    token_store._kept.clear()


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_digests(spark, model, parts):
    rng = random.Random(2)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 400))) for _ in range(50)]
    texts += [None, "", "long " * 60_000, "a" * 30_000, "x\n" * 5000]
    rows = [(i * 3 - 20, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = token_store.store_and_digest(frame(spark, rows), public_tokenizer(), parts=parts)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(model, rows))


def test_repeated_and_null_ids(spark, model):
    rows = [(None, "null id"), (5, "same id"), (5, "same id"), (5, "other text"), (6, "after"), (None, None)] + [(9, "hot")] * 400
    got = sorted((tuple(r) for r in token_store.store_and_digest(frame(spark, rows), public_tokenizer(), parts=6).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 5, 5, 5, 6, *[9] * 400]
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    want = {(i, n, crc) for i, _, n, crc in plain(model, rows)}
    assert {(r[0], r[2], r[3]) for r in got} == want


def test_empty_table(spark):
    assert token_store.store_and_digest(frame(spark, []), public_tokenizer()).collect() == []


def test_files_are_sorted_orc_with_filters(spark, model, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "INDEX_ROWS", 1000)
    path = str(tmp_path / "ids")
    texts = [f"document number {i} " * 3 for i in range(6000)]
    token_store.write_token_files(frame(spark, [(2 * i, t) for i, t in enumerate(texts)]), path, public_tokenizer(), parts=3)
    back = token_store.read_token_files(spark, path)
    ids = {r.doc_id: r.ids for r in back.where("doc_id < 40").collect()}
    assert ids == {2 * i: [*model.encode(texts[i], add_special_tokens=False).ids, 2] for i in range(20)}
    found = token_store.lookup(spark, path, [400, 401])
    assert [r.doc_id for r in found.collect()] == [400]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id, [400,401])" in plan or "pushed" in plan.lower()

    def read_rows(doc_id):  # rows that the scan let through
        q = token_store.lookup(spark, path, [doc_id])
        q.collect()
        node = q._jdf.queryExecution().executedPlan()
        stack, out = [node], None
        while stack:
            n = stack.pop()
            if n.nodeName().startswith("AdaptiveSparkPlan"):
                stack.append(n.executedPlan())
                continue
            if "Scan orc" in n.nodeName():
                out = n.metrics().apply("numOutputRows").value()
            kids = n.children()
            stack += [kids.apply(i) for i in range(kids.size())]
        return out

    assert 0 < read_rows(400) <= 1000, "one row group of one file"
    assert read_rows(401) == 0, "inside the range of a row group, but not in its Bloom filter"
    order = back.select("doc_id", "part", "seq", F.input_file_name().alias("f")).collect()
    by_place = [r.doc_id for r in sorted(order, key=lambda r: (r.part, r.seq))]
    assert by_place == sorted(by_place) and len({(r.part, r.f) for r in order}) == 3


def test_vocabulary_is_bounded(monkeypatch):
    monkeypatch.setattr(token_store, "MOST_VOCABULARY", 10)
    with pytest.raises(ValueError, match="larger"):
        token_store._vocabulary(public_tokenizer())
