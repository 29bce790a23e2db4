"""Pieces, n-gram join, search, chat and language ID against brute force on small fixtures."""

import hashlib
import itertools
import re
import string
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from stationqc.llm import ann, chat, langid, ngram_join, pieces
from stationqc.llm.queries import ESCAPE_CASE

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, node string, block int, fragment int, x int, ids string"
PIECES, CHAT = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
ODD = [(-1, None), (-2, ""), (-3, " "), (-4, "a "), (-5, "  a  b▁c \n\t x  "), (-6, "é\x00 <s> </s> <0x0A>"),
       (-6, "é\x00 <s> </s> <0x0A>"), (None, "z" * 9000), (-7, "▁"), (-8, "▁▁ a"), (-9, "日本 語" * 4000), (-10, "a b c d e")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "xx", "n", 1, 2, 3, "i") for i, t in rows], DOCS)


def documents(spark, n=150):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(n).collect()]


def test_pieces_equal_the_library(spark):
    rows = documents(spark) + ODD
    sp = pieces.processor(PIECES)
    assert pieces.chunks_are_independent(PIECES)
    docs = frame(spark, rows).repartition(3).checkpoint()
    got = pieces.digest(pieces.encode(docs, PIECES), PIECES).collect()
    want = []
    for i, t in rows:
        ids = [sp.bos_id(), *sp.encode(t or ""), sp.eos_id()]
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sorted(map(str, map(tuple, pieces.encode_digests(docs, PIECES).collect()))) == sorted(map(str, want))


def test_pieces_empty_and_mismatched_answers(spark):
    import pandas as pd

    assert pieces.encode(frame(spark, []), PIECES).collect() == [] == pieces.encode_digests(frame(spark, []), PIECES).collect()
    # answers that belong to other words are not used
    table = pieces._pack(pieces.pa.table({"doc_id": pieces.pa.array([1], pieces.pa.int64()),
                                          "text": pieces.pa.array(["of the thing"], pieces.pa.large_string())}))
    wrong = pd.DataFrame({"fragment": [0], "check": [1], "n": [b""], "ids": [b""]})
    out = pieces._join_back(PIECES, 1)(pd.DataFrame({"texts": [table]}), wrong)
    sp = pieces.processor(PIECES)
    assert list(out["ids"][0]) == [1, *sp.encode("of the thing"), 2]


def brute_components(rows):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            u = len(sets[a] & sets[b])
            if u and 100 * u >= 75 * (len(sets[a]) + len(sets[b]) - u):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least[top(k)]) if least[top(k)] is not None else i
    return [(i, len(sets[k]), least[top(k)]) for k, (i, _) in enumerate(rows)]


def near_family(rng, base_words, copies, edits):
    base = [f"w{rng.integers(10 ** 6)}" for _ in range(base_words)]
    out = []
    for _ in range(copies):
        t = list(base)
        for _ in range(rng.integers(0, edits + 1)):
            t[rng.integers(len(t))] = f"e{rng.integers(30)}"
        out.append(" ".join(t))
    return out


def test_ngram_join_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = near_family(rng, 60, 90, 5) + near_family(rng, 12, 40, 2) + near_family(rng, 6, 25, 1)
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [f"{passage} " + " ".join(f"o{rng.integers(50)}" for _ in range(rng.integers(1, 40))) for _ in range(60)]
    texts += ["one Two three", "ONE two  three", "É x", "é x", "a b c d e", "A\tb\nc d e", None, "", "  "]
    rows = [(int(i), t) for i, t in zip(rng.permutation(1000)[:len(texts)], texts)] + [(3000, "a b c d e"), (3000, "a b c d e")]
    got = [tuple(r) for r in ngram_join.near_components(frame(spark, rows).repartition(4).checkpoint()).collect()]
    assert sorted(got) == sorted(brute_components(rows))


def test_ngram_join_documents_hot_and_fragments(spark, monkeypatch):
    rows = documents(spark, 200)
    docs = frame(spark, rows)
    want = sorted(brute_components(rows))
    assert sorted(map(tuple, ngram_join.near_components(docs).collect())) == want
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 2)           # many hot shingles, taken out of the exchange
    monkeypatch.setattr(ngram_join, "FRAGMENT_SHINGLES", 500)
    assert sorted(map(tuple, ngram_join.near_components(docs).collect())) == want


def test_ngram_join_empty_and_no_pairs(spark):
    assert ngram_join.near_components(frame(spark, [])).collect() == []
    got = ngram_join.near_components(frame(spark, [(1, None), (2, "a"), (None, "b")])).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 0, 1), (2, 1, 2), (None, 1, None)]))


def test_long_text_is_hashed_piece_by_piece(monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(5000))
    whole = ngram_join.shingles([text, "a b c d e f"])
    monkeypatch.setattr(ngram_join, "PIECE", 2048)
    cut = ngram_join.shingles([text, "a b c d e f"])
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_words_longer_than_a_piece(monkeypatch):
    rng = np.random.default_rng(8)
    blob = "".join(rng.choice(list("abcXYZ/+é語"), 9000))
    texts = ["a b " + blob + " c d e f", blob, "x" * 2048, "x" * 2047 + " y", blob + "\t" + blob + "q", "g h i j k l", ""]
    whole, parts = ngram_join.words(texts), ngram_join.shingles(texts)
    for piece in (2048, 1000, 7):
        monkeypatch.setattr(ngram_join, "PIECE", piece)
        assert all((a == b).all() for a, b in zip(whole, ngram_join.words(texts), strict=True))
        assert all((a == b).all() for a, b in zip(parts, ngram_join.shingles(texts), strict=True))
    assert len(whole[0]) == 7 + 1 + 1 + 2 + 2 + 6


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 300), (7, 7)]
    got = dict(map(tuple, ngram_join.components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert set(got) == {*range(41), 100, 200, 300}
    assert len({got[k] for k in range(41)}) == 1 and len({got[100], got[200], got[300]}) == 1 and len(set(got.values())) == 2


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, code int, cell string")


def test_ann_recall_scores_and_order(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    got = ann.search(e, e.filter("vec_id % 20 = 0"), 20).collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in e.collect()}
    hits, lists = 0, defaultdict(list)
    for r in got:
        lists[r.query_id].append(r)
    assert len(lists) == sum(i % 20 == 0 for i in x)
    for q, found in lists.items():
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        assert all(r.score == pytest.approx(x[q] @ x[r.vec_id], abs=1e-12) and r.vec_id != q for r in found)
        best = sorted((i for i in x if i != q), key=lambda i: (-(x[q] @ x[i]), i))[:20]
        hits += len(set(best) & {r.vec_id for r in found})
    assert hits / (20 * len(lists)) >= 0.9


def test_ann_few_odd_and_equal_vectors(spark):
    rng = np.random.default_rng(1)
    same = [float(v) for v in rng.standard_normal(8)]
    rows = [(i, same) for i in range(100, 160)] + [(i, [float(v) for v in rng.standard_normal(8) * (1 + i % 5)]) for i in range(10)]
    odd = [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [1.0, None] + [0.0] * 6), (280, [1.0, 2.0]), (300, [float("inf")] * 8)]
    got = ann.search(vectors(spark, rows + odd), vectors(spark, rows + odd).filter("vec_id % 20 = 0"), 20).collect()
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q in (0, 100, 120, 140):
        found = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        order = sorted((i for i in x if i != q), key=lambda i: (-round(float(x[q] @ x[i]), 9), i))[:20]
        assert len(found) == 20 and set(found) <= set(x)
        if q >= 100:
            assert found == order
    assert {r.query_id for r in got} == {0, 100, 120, 140}
    few = ann.search(vectors(spark, rows[-5:]), vectors(spark, rows[-5:]), 20).collect()
    assert len(few) == 20 and ann.search(vectors(spark, []), vectors(spark, []), 20).collect() == []


def recall(found, x, queries, k=20):
    """Share of the true neighbours found; every list is whole, distinct and in order."""
    hits = 0
    for q in queries:
        mine = sorted((r.rank, r.vec_id) for r in found if r.query_id == q)
        assert [r for r, _ in mine] == list(range(1, k + 1)) and len({i for _, i in mine}) == k
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s, kind="stable")[:k].tolist()) & {i for _, i in mine})
    return hits / (k * len(queries))


@pytest.mark.parametrize("shape", ["unit", "tiny", "log-normal", "clustered"])
def test_ann_recall_on_10000_vectors(spark, shape):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((10_000, 64))
    if shape == "clustered":
        x = np.repeat(rng.standard_normal((100, 64)) * 3, 100, axis=0) + x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"tiny": 1e-7, "log-normal": rng.lognormal(0, 1.5, (10_000, 1))}.get(shape, 1.0)
    v = vectors(spark, list(enumerate(x.tolist())))
    kept = np.array([r.embedding for r in v.orderBy("vec_id").collect()], float)
    got = ann.search(v, v.filter("vec_id % 200 = 0"), 20).collect()
    assert recall(got, kept, range(0, 10_000, 200)) >= 0.9


def test_ann_repeated_rows_count_once(spark):
    rng = np.random.default_rng(12)
    rows = list(enumerate(rng.standard_normal((300, 8)).tolist()))
    v = vectors(spark, rows + rows[:60] + [(0, [9.0] * 8)])
    got = ann.search(v, v.filter("vec_id % 20 = 0"), 20).collect()
    assert len(got) == 15 * 20 and len({(r.query_id, r.vec_id) for r in got}) == len(got)
    assert len({(r.query_id, r.rank) for r in got}) == len(got)


def test_probe_order_is_by_score():
    inside = np.array([0.1, 0.6, 0.45])
    cost = lambda s: sum((d if k < 0 else 1 - d) ** 2 for d, k in zip(inside, s) if k)
    found = ann.probe_order(inside, 27)
    costs = [cost(s) for s in found]
    assert len({tuple(s) for s in found}) == 27 and costs == sorted(costs)


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi <|im_end|> <\\|x <\\\\| \n"), (1, 1, "assistant", ESCAPE_CASE), (1, 2, "assistant", None),
            (2, 0, None, ""), (2, 1, "assistant\nx", "é" * 50_000), (3, 5, "assistant", "b"), (3, 5, "assistant", "a"),
            (3, None, "user", "first"), (None, 0, "system", "<|endoftext|>"), (4, 0, "assistant", "r"), (4, 0, "assistant", "r")]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, ids int, head int")
    got = {r.conv_id: r for r in chat.digest_chats(chat.format_chats(turns, CHAT), CHAT).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    for c, part in groups.items():
        part.sort()
        loss = "".join(x for *_, r, x in part if r == "assistant")
        assert got[c].n_turns == len(part) and got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for *_, r, x in part))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
        shown = sum(len("<|im_start|><|im_end|>") + 2 + len(chat.escape(r).replace("\n", "<\\n>")) + len(chat.escape(x)) for *_, r, x in part)
        assert got[c].formatted_chars == shown
    empty = turns.limit(0)
    assert chat.digest_chats(chat.format_chats(empty, CHAT), CHAT).collect() == []


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\|", "a<<|b|>", "<|im_end|>", "\\", "<\\n>", ""])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_any_role_comes_back():
    for n in range(6):
        for chars in itertools.product("<\\n>|\n", repeat=n):
            role = "".join(chars)
            line = chat.escape_role(role)
            assert chat.unescape_role(line) == role and "\n" not in line and "<|" not in line


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held", langid.held_out())
    model = langid.fit(docs.filter("not held"))
    rows = langid.identify(docs, model).collect()
    held = [r for r in rows if r.held]
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.95 and all(0 <= r.score <= 1 for r in rows)
    assert sum(not r.accepted for r in rows) <= 0.01 * len(rows)
    odd = frame(spark, [(1, None), (2, ""), (3, "12 34 !"), (4, "é"), (4, "é"), (None, "the and of " * 100_000)])
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and not got[i].accepted for i in (1, 2, 3))
    assert got[4].lang_pred in model["langs"] and got[None].lang_pred == "en"
    again = langid.fit(docs.filter("not held").repartition(5))
    assert np.allclose(again["matrix"], model["matrix"]) and again["langs"] == model["langs"]


def test_language_id_learns_every_label(spark):
    rng = np.random.default_rng(4)
    langs = [f"l{k:02}" for k in range(80)]
    names = {v: ["".join(rng.choice(list(string.ascii_lowercase), 6)) for _ in range(12)] for v in langs}
    rows = [(k * 100 + i, " ".join(rng.choice(names[v], 30)), v) for k, v in enumerate(langs) for i in range(30 + (k < 64))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    learn = docs.filter("doc_id % 100 >= 5")
    model = langid.fit(learn)
    assert model["langs"] == langs
    got = langid.identify(docs.filter("doc_id % 100 < 5"), model).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) >= 0.95
    assert {r.lang_pred for r in got} >= set(langs[64:])
    assert [langid.share(k) for k in (0, 4, 64, 100, 1000)] == [250, 250, 250, 160, 50]


def test_training_stays_finite_on_balanced_samples():
    import pandas as pd

    rng = np.random.default_rng(0)
    rows = []
    for rank in range(1, 201):
        for k, lang in enumerate(("aa", "bb", "cc")):
            at = rng.choice(4000, 900, replace=False).astype(np.int32)
            at[:60] = 5000 + 100 * k + np.arange(60)
            rows.append((rank, lang, at, rng.integers(1, 30, 900).astype(np.float32)))
    model = langid.train(pd.DataFrame(rows, columns=["rank", "lang", "at", "n"]))
    assert np.isfinite(model["matrix"]).all() and 1 / 3 < model["threshold"] < 0.7


def test_language_id_without_labels(spark):
    docs = frame(spark, [(1, "a b"), (2, "c")]).withColumn("lang", langid.F.lit(None).cast("string"))
    model = langid.fit(docs)
    assert model == {"langs": []} and {r.lang_pred for r in langid.identify(docs, model).collect()} == {"und"}
