"""The corpus pipeline stage by stage, against what the operators decide."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline as C
import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from stationqc.llm import langid, mixing, pieces
from tests.llm.test_free import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_are_those_dealt():
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "ngram_join", "mixing", "sentencepiece"]


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = C.known_language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
    exact = C.distinct_texts(spark, kept, SF)
    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    first = {}
    for i, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        first[n] = min(i, first.get(n, i))
    got = [tuple(r) for r in exact.select("doc_id", "text").collect()]
    assert exact.columns == docs.columns and sorted(i for i, _ in got) == sorted(first.values())
    near = C.distinct_contents(spark, exact, SF)
    want = sorted(i for i, _, c in brute_components(got) if i == c)
    assert near.columns == docs.columns and sorted(r[0] for r in near.select("doc_id").collect()) == want
    mix = C.mixed(spark, near, SF)
    taken = {r.doc_id: -(-r.taken // r.size) for r in mixing.mix(near).collect() if r.size}
    assert mix.columns == docs.columns
    assert Counter(r[0] for r in mix.select("doc_id").collect()) == Counter({k: v for k, v in taken.items() if v})
    out = C.tokenized(spark, mix, SF)
    assert out.count() == mix.count() and out.filter("n_tokens < 2").count() == 0


def test_odd_rows_pass_the_stages(spark):
    rows = [(1, "the and of the in a " * 9, "en", "s", 1), (1, "the and of the in a " * 9, "en", "s", 1), (2, None, None, None, None),
            (3, "", "en", "s", 0), (None, "of the and to a in", "en", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert C.distinct_texts(spark, docs, SF).count() == 3
    assert C.distinct_contents(spark, docs, SF).count() == 5
    assert C.mixed(spark, docs, SF).filter(F.col("text").isNull()).count() == 0
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0


NAMES = ("score", "times", "accepted", "lang_pred", "_id", "_sha", "_copy", "row", "id", "sha", "size", "n", "d", "s", "keep", "col", "kept")


def test_columns_of_any_name_pass_unchanged(spark):
    """Every column keeps its value through the stages, whatever it is called; a very long text passes too."""
    words = "the and of in a to is that it for on with as was at by".split()
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(words, k=40)), "en", f"s{i % 2}", i) for i in range(30)]
    rows += [(30, " ".join(rnd.choices(words, k=60_000)), "en", "s0", 30), (31, rows[0][1], "en", "s0", 31)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    texts = {r[0]: r[1] for r in rows}
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *NAMES], name
        got = docs.collect()
        assert got and all(r.text == texts[r.doc_id] and r.n_chars == r.doc_id for r in got), name
        assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in NAMES), name
        assert 30 in {r.doc_id for r in got} and (name == "language_id" or 31 not in {r.doc_id for r in got})


def test_first_and_last_stage_against_plain_python(spark):
    odd = [(-1, None, None, None, 0), (-2, "", "en", "s", 0), (-3, "1 2 3", "en", "s", 5), (None, "of the and to a in the of that", "en", None, 1)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).checkpoint()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = langid.fit(docs.filter(~langid.held_out()))

    def sure(text):
        if not any(c.isalpha() for c in text or ""):
            return False
        counts = langid.gram_counts(text)
        z = (counts @ model["matrix"] / counts.sum() + model["bias"]) * model["scale"]
        return 1 / np.exp(z - z.max()).sum() >= model["threshold"]
    kept = C.known_language(spark, docs, SF)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in rows if sure(t))
    sp = pieces.processor(P.path("piece_bpe_32k.model"))
    some = docs.filter("doc_id is null or doc_id < 40").checkpoint()
    out = {r.doc_id: r for r in C.tokenized(spark, some, SF).collect()}
    for i, t in ((r.doc_id, r.text) for r in some.collect()):
        ids = [sp.bos_id(), *sp.encode(t or ""), sp.eos_id()]
        assert (out[i].n_tokens, out[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert out[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_run(spark):
    assert C.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
