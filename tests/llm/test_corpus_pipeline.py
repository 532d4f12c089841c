"""The pipeline's stages, and the whole of it, on planted documents, against plain versions of each stage."""

import collections
import math
import os
import random
import tracemalloc

import corpus_pipeline as pipeline
import duckdb
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from test_near_text import shingle_set
from test_operators import words

from skeinmart.llm import lang_id, near_text, pii, source_mix
from skeinmart.llm.tables import slices

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = {"en": "abcdefgh", "xx": "mnopqrst"}


def plain_groups(texts):
    """Least row of each group of texts whose five-word shingles agree in 4/5."""
    sets = [shingle_set(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return sorted(set(group))


def ids(df):
    assert df.columns == pipeline.COLUMNS
    return sorted(r.doc_id for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], KINDS + ", copy_no string").repartition(3)


def write_benchmark(spark, sf_dir, item):
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.mode("overwrite").parquet(f"{sf_dir}/benchmark.parquet")


def test_stages(spark, tmp_path):
    rng = random.Random(3)
    clean = [words(rng, 60) for _ in range(12)]
    item = words(rng, 20)
    mail = clean[5] + " write to jane.roe@example.org today"
    texts = [*clean, clean[0], clean[0], words(rng, 30) + " " + item + " " + words(rng, 30), mail, None, ""]
    docs = frame(spark, [(i, t, "en", "s%d" % (i % 2), None) for i, t in enumerate(texts)])
    sf_dir = str(tmp_path)
    write_benchmark(spark, sf_dir, item)
    assert ids(pipeline.drop_near_duplicates(spark, docs, sf_dir)) == plain_groups(texts)
    leak = next(i for i, t in enumerate(texts) if t and item in t)
    assert ids(pipeline.drop_benchmark_leaks(spark, docs, sf_dir)) == [i for i in range(len(texts)) if i != leak]
    redacted = pipeline.redact_personal_data(spark, docs, sf_dir)
    got = {r.doc_id: r.text for r in redacted.collect()}
    assert got == {i: t and t.replace("jane.roe@example.org", "[EMAIL]") for i, t in enumerate(texts)}
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "simhash_dedup", "decontamination", "personal_data", "source_mix"]


def corpus(rng, item):
    """Documents of two invented languages, with copies, near copies, a leak, an address, rows without letters, and nulls."""
    texts = [(words(rng, rng.randint(40, 90), LETTERS[lang]), lang) for lang in LETTERS for _ in range(40)]
    near = texts[3][0].split()
    near[10] = "abba"
    texts += [texts[0], texts[0], (" ".join(near), "en"), (texts[1][0] + " " + item, "en"), (texts[2][0] + " mail bo.li@example.org", "en")]
    texts += [("", "en"), (None, None), ("12 34 " * 30, "en")]
    return [(i, t, lang, ("big", "small", None)[min(i % 5, 2)], None) for i, (t, lang) in enumerate(texts)]


def mixed(tmp_path, rows):
    """doc_id -> copies, by the mixing SQL over the rows of the stage before."""
    con = duckdb.connect()
    con.execute("CREATE TABLE kept (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO kept VALUES (?, ?, ?, ?, ?)", rows)
    found = con.execute(source_mix.MIX_SQL.format(docs="kept"))
    names = [d[0] for d in found.description]
    return collections.Counter(r[names.index("doc_id")] for r in found.fetchall())


def test_identify_language_keeps_what_is_not_rejected(spark):
    rng = random.Random(8)
    rows = corpus(rng, words(rng, 12))
    docs = frame(spark, rows)
    found = {r.doc_id: r.lang_pred for r in lang_id.identify(docs.select(*pipeline.COLUMNS)).collect()}
    kept = pipeline.identify_language(spark, docs, "")
    assert ids(kept) == sorted(i for i, lang in found.items() if lang != "und")
    clean = {i for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    assert len(clean - set(ids(kept))) <= 2 and not set(ids(kept)) - clean


def test_mix_sources_follows_its_sql(spark, tmp_path):
    rng = random.Random(9)
    rows = corpus(rng, words(rng, 12))
    got = pipeline.mix_sources(spark, frame(spark, rows), "")
    assert got.columns == [*pipeline.COLUMNS, "copy_no", "shuffle_key"]
    assert collections.Counter(r.doc_id for r in got.collect()) == mixed(tmp_path, rows)


def test_run_is_the_stages_one_after_another(spark, tmp_path):
    rng = random.Random(10)
    item = words(rng, 12)
    rows = corpus(rng, item)
    sf_dir = str(tmp_path)
    write_benchmark(spark, sf_dir, item)
    docs = frame(spark, rows)
    docs.drop("copy_no").coalesce(1).write.parquet(os.path.join(sf_dir, "documents.parquet"))
    named = {r.doc_id for r in lang_id.identify(docs.select(*pipeline.COLUMNS)).where("lang_pred <> 'und'").collect()}
    left = [r for r in rows if r[0] in named]
    left = [left[i] for i in plain_groups([r[1] for r in left])]
    left = [r for r in left if not (r[1] and item in r[1])]
    left = [(r[0], r[1] and r[1].replace("bo.li@example.org", "[EMAIL]"), *r[2:]) for r in left]
    out = pipeline.run(spark, sf_dir).collect()
    assert collections.Counter(r.doc_id for r in out) == mixed(tmp_path, left)
    assert {(r.doc_id, r.text) for r in out} <= {(r[0], r[1]) for r in left}
    assert not any(item in r.text or pii.KINDS and "@" in r.text for r in out) and math.isfinite(len(out))


def test_workers_get_batches_of_bounded_size(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('word', id, ' '), 1200)").alias("text"), F.lit("en").alias("lang")).repartition(1)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    for stage, before, most in ((lang_id.keep_identified, "64m", 5 << 20), (lang_id.keep_identified, "1m", 2 << 20), (near_text.deduplicate, "64m", 5 << 20)):
        spark.conf.set(key, before)
        try:
            stage(docs.limit(0))
            got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        finally:
            spark.conf.unset(key)
        assert sum(got) > 20 << 20 and max(got) <= most, (stage, before)


def test_slices_bound_the_memory_of_a_language_worker():
    rows = [("a", n, n, n - 1, n - 1, 1) for n in range(1, lang_id.ORDER + 1)]
    m = lang_id.kneser_ney(pd.DataFrame(rows, columns=["lang", "n", "gram", "context", "suffix", "c"]), lang_id.ORDER)
    letter, texts = lang_id.letter_table(), ["some words " * 300] * 1500
    tracemalloc.start()
    for i, j in slices([len(t) for t in texts], lang_id.SLICE_CHARS):
        m.entropy(*lang_id.symbols(texts[i:j], letter))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 << 20
