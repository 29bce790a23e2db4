"""Language identification by averaged hashed subword embeddings.

A text is the bag of the hashed character 1- to 4-grams of its lower-cased words.
Each n-gram has an embedding; their mean passes a linear softmax.  Embeddings and
softmax are trained together by stochastic gradient descent in numpy on a bounded
sample of the labelled rows (``per_lang`` documents of every language, fewer where
many languages share ``BUDGET``, the smallest by a hash of the identifier; whole texts, counted in the tasks, so that one task trains
on count vectors of bounded size and only the model reaches the driver).  A part of the sample is kept back to calibrate:
a temperature by least log-loss, and the rejection threshold as the confidence
that all but ``reject_share`` of the kept-back documents exceed.

The trained model is one small matrix (buckets x languages: the embeddings times
the softmax weights), shipped with the task; prediction is a map over whole texts.

Defined results: text that is null or has no letter gets ``und`` with score 0 and
is rejected; null languages are not learned; without any labelled row everything
is ``und``; ties go to the smallest language name; repeated rows get equal results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationqc.llm.blocks import release, released

BUCKETS = 1 << 14
DIM = 16
ORDERS = (1, 2, 3, 4)
#: Bounds of the training sample: documents of a language, and documents of all, which the languages share.
#: Every language is learned, from LEAST documents at least, however many there are.
PER_LANG = 250
BUDGET = 16_000
LEAST = 50
STEPS = 800                  # updates, as many on a small sample
BATCH = 32
RATE = 0.05
CALIBRATE = 5               # one document in five is kept back
REJECT_SHARE = 0.002
#: Characters handled at once; longer texts are counted piece by piece.
PIECE = 1 << 18


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character n-grams of a whole text."""
    total = np.zeros(BUCKETS, np.int64)
    overlap = max(ORDERS) - 1
    for start in range(0, len(text), PIECE):
        piece = text[max(0, start - overlap):start + PIECE].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        # all that is not a letter (ASCII rule) marks a word edge
        edge = (codes < 65) | ((codes > 90) & (codes < 97)) | ((codes > 122) & (codes < 170))
        codes = np.where(edge, np.uint64(32), codes)
        # runs of edges count once
        codes = codes[~(edge & np.concatenate(([False], edge[:-1])))]
        h, slots = np.zeros(len(codes), np.uint64), []
        for n in range(1, max(ORDERS) + 1):
            if len(codes) < n:
                break
            h = (h[:len(codes) - n + 1] + codes[n - 1:]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if n in ORDERS:
                slots.append((h >> np.uint64(40)).astype(np.int64) % BUCKETS)
        if slots:
            total += np.bincount(np.concatenate(slots), minlength=BUCKETS)
    return total


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        at, n = [], []
        for text in pdf["text"]:
            counts = gram_counts(text)
            at.append(np.flatnonzero(counts).astype(np.int32))
            n.append(counts[at[-1]].astype(np.float32))
        yield pd.DataFrame({"rank": pdf["rank"], "lang": pdf["lang"], "at": at, "n": n})


def share(langs: int, per_lang: int = PER_LANG) -> int:
    """Documents that each of so many languages gives to the sample."""
    return min(per_lang, max(LEAST, BUDGET // max(1, langs)))


def training_sample(labelled: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """(rank, lang, at, n): sparse counts of at most BUDGET documents, or LEAST of every language if these are more."""
    per_lang = share(labelled.agg(F.countDistinct("lang")).first()[0], per_lang)
    keyed = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    # first the smallest of each of 64 parts of a language, then the smallest of those
    for part in (["lang", F.pmod("h", F.lit(64))], ["lang"]):
        w = Window.partitionBy(*part).orderBy("h", "doc_id")
        keyed = keyed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= per_lang)
    chosen = keyed
    # at most BUDGET rows, or LEAST of every language
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("rank").alias("rank"))
    rows = (labelled.join(F.broadcast(chosen), ["doc_id", "lang"])
            .dropDuplicates(["doc_id", "lang"]).select("rank", "lang", "text"))
    return rows.mapInPandas(_features, "rank int, lang string, at array<int>, n array<float>")


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(sample: pd.DataFrame, reject_share: float = REJECT_SHARE, seed: int = 11) -> dict:
    """Model: langs, matrix (buckets x langs), bias, scale (inverse temperature), threshold."""
    sample = sample[np.array([len(a) > 0 for a in sample["at"]], bool)].sort_values(["lang", "rank"], kind="stable")
    langs = sorted(sample["lang"].unique(), key=lambda s: s.encode())
    if not langs:
        return {"langs": []}
    y = np.array([langs.index(v) for v in sample["lang"]])
    at, n = list(sample["at"]), list(sample["n"])

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for i, r in enumerate(rows):
            x[i, at[r]] = np.asarray(n[r]) / np.sum(n[r])
        return x

    held = sample["rank"].to_numpy() % CALIBRATE == 0
    if not held.any() or held.all():
        held = np.zeros(len(y), bool)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    learn = np.flatnonzero(~held)
    # steps shrink with the gradients seen so far (per weight), so no step can run away
    seen_emb, seen_out, seen_bias = np.full_like(emb, 1e-8), np.full_like(out, 1e-8), np.full_like(bias, 1e-8)
    batches = max(1, len(learn) // BATCH)
    for _ in range(-(-STEPS // batches)):
        for part in np.array_split(rng.permutation(learn), batches):
            x = dense(part)
            cols = np.flatnonzero(x.any(axis=0))
            x = x[:, cols]
            mean = x @ emb[cols]
            err = _softmax(mean @ out + bias)
            err[np.arange(len(part)), y[part]] -= 1
            err /= len(part)
            g_emb, g_out, g_bias = x.T @ (err @ out.T), mean.T @ err, err.sum(axis=0)
            seen_out += g_out ** 2
            seen_bias += g_bias ** 2
            seen_emb[cols] += g_emb ** 2
            out -= RATE * g_out / np.sqrt(seen_out)
            bias -= RATE * g_bias / np.sqrt(seen_bias)
            emb[cols] -= RATE * g_emb / np.sqrt(seen_emb[cols])
    if not (np.isfinite(emb).all() and np.isfinite(out).all()):
        raise ArithmeticError("language model: training left the finite numbers")
    matrix = (emb @ out).astype(np.float64)
    probe = np.flatnonzero(held) if held.any() else learn
    z = np.concatenate([dense(part) @ matrix for part in np.array_split(probe, max(1, len(probe) // BATCH))]) + bias
    loss = lambda k: -np.log(_softmax(z * k)[np.arange(len(probe)), y[probe]] + 1e-12).mean()
    scale = min((2.0 ** e for e in np.arange(-4, 4.25, 0.25)), key=loss)
    # half way from a blind guess to the confidence that all but reject_share of the documents exceed
    floor = 1.0 / len(langs)
    low = np.quantile(_softmax(z * scale).max(axis=1), reject_share)
    return {"langs": langs, "matrix": matrix, "bias": bias.astype(np.float64), "scale": float(scale),
            "threshold": float(floor + (low - floor) / 2)}


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        per_lang: int = PER_LANG) -> dict:
    """Train on the rows whose language is known; ``docs`` holds only rows that may be learned from."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.filter("lang is not null and text is not null and doc_id is not null")
    kernel = lambda sample: pd.DataFrame({"model": [pickle.dumps(train(sample))]})
    # a bounded sample: one task trains on it, and only the model reaches the driver
    found = (training_sample(rows, per_lang).groupBy(F.lit(0).alias("all"))
             .applyInPandas(released(kernel), "model binary").collect())
    return pickle.loads(found[0]["model"]) if found else {"langs": []}


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and accepted."""
    langs = model["langs"]

    def one(text: str | None) -> tuple[str, float, bool]:
        if not langs or text is None or not has_letter(text):
            return "und", 0.0, False
        counts = gram_counts(text)
        z = (counts @ model["matrix"] / counts.sum() + model["bias"]) * model["scale"]
        p = _softmax(z[None, :])[0]
        k = int(np.argmax(p))
        return langs[k], float(p[k]), bool(p[k] >= model["threshold"])

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score", "accepted"])
        release()
        return found

    found = docs.withColumn("_found", predict(F.col(text_col)))
    return (found.withColumn("lang_pred", F.col("_found.lang_pred")).withColumn("score", F.col("_found.score"))
            .withColumn("accepted", F.col("_found.accepted")).drop("_found"))


def held_out(id_col: str = "doc_id"):
    """The fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
