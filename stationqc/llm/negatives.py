"""Hard negatives by anchor-clustered shared lists (in the manner of MAXIMUS).

Anchors are clustered by direction.  With theta the widest angle between a cluster's
direction c and its members, no member u can score a candidate x above
|u| |x| cos(max(0, angle(x, c) - theta)): an upper bound that all members share but
for |u|.  The candidates are sorted by it once per cluster, and every member walks
that list until what follows cannot enter any of its results, which is certified by
the bound of the next candidate.

Spark holds the lists in pieces: candidates are dealt into parts of at most ``PART``
rows, clusters into groups of at most ``GROUP`` anchors, and one task sorts one part
for the clusters of one group.  A first pass over some parts gives each member a
score that its last result is sure to reach; the walks of all other parts begin with
that floor and so end early.  Each part hands over its best few per member; windows
rank them.

Two passes: the anchor's best rows of its own label (positives), then, per positive
with score p, the best rows of other labels with a score between low and high per
cent of p.

Scores are inner products of whole vectors floor(scale * component), so ties are
exact and go to the smaller identifier.

Defined results: rows whose identifier or label is null, or whose vector is null,
holds a null or non-finite component or has another length than most, take no part;
components beyond ``vectors.limit`` are clipped; of rows that repeat an identifier the
least (by label, then packed vector) takes part; a positive score below zero leaves
no window, one of zero the score zero; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationqc.llm.common import shuffle_partitions, stored
from stationqc.llm.vectors import exact_dots, matrix, packed, unpacked, whole_vectors

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
#: Candidates of a part, anchors of a group, members scored together, candidates scored together.
PART, GROUP, SLAB, STEP = 16384, 8192, 512, 1024
#: Anchors that the cluster directions are fitted on (the smallest hashes of their identifiers), clusters at most.
SAMPLE, CLUSTERS, ANCHORS_EACH = 8192, 128, 32
#: One part in so many gives the floors.
SEED_SHARE = 16
NONE = -2 ** 62


def directions(x: np.ndarray, clusters: int, steps: int = 10) -> np.ndarray:
    """Unit vectors of the clusters: spherical k-means from evenly spread rows."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    unit = x / np.where(norm > 0, norm, 1.0)
    centre = unit[np.linspace(0, len(unit) - 1, clusters).astype(int)]
    for _ in range(steps):
        at = (unit @ centre.T).argmax(1)
        sums = np.stack([unit[at == c].sum(0) if (at == c).any() else centre[c] for c in range(clusters)])
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(size > 0, sums / np.where(size > 0, size, 1.0), centre)
    return centre


def angles(x: np.ndarray, norm: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of each row to a direction; 0 for zero rows."""
    cos = (x @ centre) / np.where(norm > 0, norm, 1.0)
    return np.where(norm > 0, np.arccos(np.clip(cos, -1.0, 1.0)), 0.0)


def shared_bounds(x: np.ndarray, norm: np.ndarray, centre: np.ndarray, theta: float) -> np.ndarray:
    """|x| cos(max(0, angle - theta)), a little raised against rounding."""
    gap = np.maximum(0.0, angles(x, norm, centre) - theta)
    return norm * (np.cos(gap) + 1e-9)


class Best:
    """The k best (score, smaller identifier first) per member and window; scores below the floor are not sought."""

    def __init__(self, members: int, windows: int, k: int):
        self.k = k
        self.score = np.full((members, windows, k), NONE, np.int64)
        self.ident = np.full((members, windows, k), np.iinfo(np.int64).max, np.int64)

    def absorb(self, rows: np.ndarray, w: int, scores: np.ndarray, idents: np.ndarray, fits: np.ndarray, floor: np.ndarray) -> None:
        k, old = self.k, self.score[rows, w]
        bar = np.maximum(old[:, -1], floor)
        scores = np.where(fits, scores, NONE)
        if scores.shape[1] > k and (bar == NONE).any():
            bar = np.maximum(bar, np.partition(scores, -k, axis=1)[:, -k])
        r, at = np.nonzero((scores >= bar[:, None]) & (scores > NONE))
        if not len(r):
            return
        row = np.concatenate([r, np.repeat(np.arange(len(rows)), k)])
        score = np.concatenate([scores[r, at], old.ravel()])
        ident = np.concatenate([idents[at], self.ident[rows, w].ravel()])
        order = np.lexsort((ident, -score, row))
        row, score, ident = row[order], score[order], ident[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        first = rank < k
        self.score[rows[row[first]], w, rank[first]] = score[first]
        self.ident[rows[row[first]], w, rank[first]] = ident[first]


def walk(anchors: pd.DataFrame, cands: tuple, centres: np.ndarray, k: int, same: bool) -> tuple[pd.DataFrame, int]:
    """Best candidates of each anchor and window within one part, and the number of scores computed.

    anchors: anchor_id, cluster, label, x (ints), lo, hi, floor (arrays, one item per window);
    cands: identifiers (ascending), labels, vectors.
    """
    ids, labels, x = cands
    norm = np.sqrt((x.astype(float) ** 2).sum(1))
    frames, work = [], 0
    for cluster, members in anchors.groupby("cluster"):
        m = np.stack(members["x"].to_list())
        size = np.sqrt((m.astype(float) ** 2).sum(1))
        theta = float(angles(m.astype(float), size, centres[cluster]).max())
        bound = shared_bounds(x.astype(float), norm, centres[cluster], theta)
        order = np.argsort(-bound, kind="stable")             # the list that all members share
        own, own_label = members["anchor_id"].to_numpy(), members["label"].to_numpy()
        lo, hi, floor = (np.array(members[c].to_list(), np.int64) for c in ("lo", "hi", "floor"))
        for at in range(0, len(m), SLAB):
            slab = slice(at, min(len(m), at + SLAB))
            best = Best(slab.stop - at, lo.shape[1], k)
            for start in range(0, len(order), STEP):
                reach = size[slab] * bound[order[start]] * (1 + 1e-9) + 1e-6
                least = np.maximum(np.maximum(best.score[:, :, -1], floor[slab]), lo[slab])
                going = np.flatnonzero(((reach[:, None] >= least) & (lo[slab] <= hi[slab])).any(axis=1))
                if not len(going):
                    break                                     # certified: nothing that follows can enter
                piece = order[start:start + STEP]
                scores = exact_dots(m[slab][going], x[piece])
                work += scores.size
                kin = own_label[slab][going][:, None] == labels[piece][None, :]
                kin = kin & (own[slab][going][:, None] != ids[piece][None, :]) if same else ~kin
                for w in range(lo.shape[1]):
                    fits = kin & (scores >= lo[slab][going, w, None]) & (scores <= hi[slab][going, w, None])
                    best.absorb(going, w, scores, ids[piece], fits, floor[slab][going, w])
            i, w, r = np.nonzero(best.score > NONE)
            frames.append(pd.DataFrame({"anchor_id": own[slab][i], "slot": w.astype(np.int32), "vec_id": best.ident[i, w, r],
                                        "score": best.score[i, w, r]}))
    return pd.concat(frames), work


_FOUND = "anchor_id long, slot int, vec_id long, score long"


def _search(anchors: DataFrame, cands: DataFrame, parts: range, dim: int, centres: np.ndarray, groups: int, k: int,
            same: bool) -> DataFrame:
    """Rows of ``_FOUND``: every group of clusters walks each of the parts."""
    def run(members: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(part):
            return pd.DataFrame({"anchor_id": [], "slot": [], "vec_id": [], "score": []}).astype(
                {"anchor_id": "int64", "slot": "int32", "vec_id": "int64", "score": "int64"})
        # ties go to the smaller identifier; of a repeated one the first row takes part
        part = part.sort_values(["vec_id", "label", "x"]).drop_duplicates("vec_id")
        rows = part["vec_id"].to_numpy(), part["label"].to_numpy(), unpacked(part["x"], dim)
        members = members.assign(x=list(unpacked(members["x"], dim)))
        return walk(members, rows, centres, k, same)[0]

    spread = anchors.withColumn("part", F.explode(F.sequence(F.lit(parts[0]), F.lit(parts[-1]))))
    listed = cands.filter(F.col("part").between(parts[0], parts[-1])).withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return spread.groupBy("part", "grp").cogroup(listed.groupBy("part", "grp")).applyInPandas(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _all_parts(anchors: DataFrame, cands: DataFrame, parts: int, dim: int, centres: np.ndarray, groups: int, k: int,
               same: bool) -> DataFrame:
    """Ranked results over all parts: some parts give the floors, the others are walked with them."""
    seed = max(1, parts // SEED_SHARE)
    args = (dim, centres, groups, k, same)
    first = stored(_ranked(_search(anchors, cands, range(seed), *args), k).drop("rank"))
    if seed == parts:
        return _ranked(first, k)
    full = (first.groupBy("anchor_id", "slot").agg(F.min("score").alias("s"), F.count("*").alias("n")).filter(F.col("n") == k)
            .groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "s"))).alias("seen")))  # a few windows each
    floors = F.transform("floor", lambda f, i: F.coalesce(F.greatest(f, F.element_at("seen", i.cast("int"))), f))
    primed = anchors.join(full, "anchor_id", "left").withColumn("floor", floors).drop("seen")
    rest = _search(primed, cands, range(seed, parts), *args)
    return _ranked(first.unionByName(rest), k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``vec_id``; a negative's score lies between
    ``low`` and ``high`` per cent of its positive's.
    """
    spark = rows.sparkSession
    picked = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    whole, dim = whole_vectors(picked.filter("vec_id is not null and label is not null"), "v", scale)
    kind = dict(whole.dtypes)["label"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(packed(matrix(b.column("x"), dim)), pa.binary())],
                                             names=["vec_id", "label", "x"])
    table = stored(whole.select("vec_id", "label", "x").mapInArrow(pack, f"vec_id long, label {kind}, x binary"))
    parts = max(shuffle_partitions(spark), -(-table.count() // PART))
    cands = table.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    anchors = table.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    x = unpacked([r["x"] for r in sample], dim).astype(float)
    centres = directions(x, max(1, min(CLUSTERS, len(x) // ANCHORS_EACH)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(cluster=(unpacked(b["x"], dim).astype(float) @ centres.T).argmax(1).astype(np.int32))
    placed = stored(anchors.mapInPandas(place, f"vec_id long, label {kind}, x binary, cluster int"))
    # clusters in order fill groups of GROUP anchors; a larger cluster takes several groups
    begin, spans = 0, {}
    for r in placed.groupBy("cluster").count().orderBy("cluster").collect():          # at most CLUSTERS rows
        spans[r["cluster"]] = (begin // GROUP, (begin + r["count"] - 1) // GROUP - begin // GROUP + 1)
        begin += r["count"]
    groups = -(-begin // GROUP)
    first, width = (F.create_map(*[F.lit(v) for c, span in spans.items() for v in (c, span[k])])[F.col("cluster")] for k in (0, 1))
    grp = (first + F.pmod(F.xxhash64("vec_id"), width)).cast("int")

    def one(v: int) -> Column:
        return F.array(F.lit(v).cast("long"))
    member = placed.select(F.col("vec_id").alias("anchor_id"), "cluster", "label", "x", grp.alias("grp"))
    args = (cands, parts, dim, centres, groups)
    best = stored(_all_parts(member.select("*", one(NONE + 1).alias("lo"), one(2 ** 62).alias("hi"), one(NONE).alias("floor")),
                             *args, positives, True))
    # lo <= 100 * score / p <= hi in whole numbers: ceil(low p / 100), floor(high p / 100)
    wide = F.col("score").cast("decimal(20,0)")
    lo, hi = F.ceil(wide * low / 100).cast("long"), F.floor(wide * high / 100).cast("long")
    windows = (best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", lo.alias("lo"), hi.alias("hi")))).alias("w"),
                                             F.count("*").alias("n"))                  # at most ``positives`` items
               .select("anchor_id", *[F.concat(F.col("w")[c],
                                               F.array_repeat(F.lit(fill).cast("long"), positives - F.col("n").cast("int"))).alias(c)
                                      for c, fill in (("lo", 1), ("hi", 0))])
               .withColumn("floor", F.array_repeat(F.lit(NONE).cast("long"), positives)))
    found = _all_parts(member.join(windows, "anchor_id"), *args, negatives, False)
    pairs = best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                        (F.col("rank") - 1).alias("slot"))
    return (found.withColumnRenamed("score", "negative_score").withColumnRenamed("vec_id", "negative_id").join(pairs, ["anchor_id", "slot"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
