"""Product codes of vectors: Lloyd rounds on whole numbers with norm-of-sum bounds.

A vector is cut into equal consecutive parts; each part position has a codebook of
at most 256 entries, which starts as that part of the vectors with the smallest
identifiers.  A round assigns every part to its nearest entry (squared Euclidean
distance, ties to the lower index) and replaces each entry by the componentwise
floor(sum / count) of its parts.

Bounds.  The entries of a codebook are cut into groups.  For each vector, part and
group a row keeps a lower bound on the distance to every entry of the group other
than its own, with the stamp of the round in which it was computed.  The codebooks of
all rounds are retained, so at round t a bound of round s loses only
max ||c_t - c_s|| over the group: the norm of the sum of an entry's moves, its true
net displacement, and not the sum of the norms of its moves.  A group is scanned
exactly only if what remains does not exceed the distance to the vector's own entry;
distances are integers, so results are those of a full scan.

Spark holds the vectors: every round is a map over the stored rows (vector, own
entries, bounds, stamps), written to the shared folder, and an aggregation of partial
sums per (part, entry).  Only codebooks (parts x 256 entries) reach the driver and,
with the history of at most a few rounds, the tasks.

Defined results: vectors that are null, hold a null or non-finite component or have
another length than most take no part; components beyond ``vectors.limit`` are
clipped; a length that the parts do not divide is filled up with zeros; rows that
repeat an identifier are separate rows (the codebook takes them in order of
identifier, then vector; null identifiers last); with fewer rows than entries the
codebook has as many entries as rows; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.llm.common import stored
from stationqc.llm.vectors import matrix, packed, unpacked, whole_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Groups of entries per codebook: one lower bound each.
GROUPS = 16
#: Slack of comparisons of floating-point bounds with exact distances.
REL, ABS = 1e-9, 1e-6


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the integer rows of x to those of c."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * most * most * x.shape[1] < 2 ** 53:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(1)).astype(np.int64)
    return np.stack([((x.astype(np.int64) - row.astype(np.int64)) ** 2).sum(1) for row in c], axis=1)


def entry_groups(book: np.ndarray, groups: int = GROUPS) -> list[np.ndarray]:
    """Entries that lie together, as ascending index arrays: a few Lloyd steps over the codebook."""
    k = min(groups, len(book))
    centre = book[np.linspace(0, len(book) - 1, k).astype(int)].astype(float)
    at = np.zeros(len(book), int)
    for _ in range(5):
        at = ((book[:, None, :] - centre[None]) ** 2).sum(2).argmin(1)
        for g in range(k):
            if (at == g).any():
                centre[g] = book[at == g].mean(0)
    return [np.flatnonzero(at == g) for g in range(k) if (at == g).any()]


def net_moves(history: list[np.ndarray], groups: list[np.ndarray]) -> np.ndarray:
    """(round, group): the largest net displacement of a group's entries since that round."""
    now = history[-1].astype(float)
    moved = [np.sqrt(((now - then) ** 2).sum(1)) for then in history]
    return np.array([[m[g].max() for g in groups] for m in moved]) * (1 + REL)


def reassign(x: np.ndarray, own: np.ndarray, low: np.ndarray, stamp: np.ndarray, history: list[np.ndarray],
             groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """One part position: (own entry, its squared distance, bounds, stamps, distances computed).

    ``own`` (rows), ``low`` and ``stamp`` (rows x groups) come from the last round.
    """
    book, now = history[-1], len(history) - 1
    diff = x.astype(np.int64) - book[own]
    dist = (diff * diff).sum(1)                               # exact distance to the own entry
    left = low.astype(np.float64) - net_moves(history, groups)[stamp, np.arange(len(groups))]
    scan = left <= np.sqrt(dist)[:, None] * (1 + REL) + ABS
    best, at = dist.copy(), own.copy()
    first, second = np.zeros(low.shape), np.zeros(low.shape)  # least and next distance within scanned groups
    work = len(x)
    for g, entries in enumerate(groups):
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        d = squares(x[rows], book[entries])
        work += d.size
        place = d.argmin(1)                                   # entries ascend: ties to the lower index
        least = d[np.arange(len(rows)), place]
        first[rows, g] = least
        d[np.arange(len(rows)), place] = np.iinfo(np.int64).max
        second[rows, g] = d.min(1)
        closer = (least < best[rows]) | ((least == best[rows]) & (entries[place] < at[rows]))
        best[rows[closer]], at[rows[closer]] = least[closer], entries[place[closer]]
    group_of = np.zeros(len(book), int)
    for g, entries in enumerate(groups):
        group_of[entries] = g
    mine = group_of[at][:, None] == np.arange(len(groups))
    bound = np.sqrt(np.where(mine, second, first))
    new_low = np.where(scan, bound, low)
    new_stamp = np.where(scan, now, stamp)
    # a row that left its entry: the old entry now counts in its group's bound
    gone = np.flatnonzero((at != own) & ~scan[np.arange(len(x)), group_of[own]])
    if len(gone):
        g = group_of[own[gone]]
        new_low[gone, g] = np.minimum(left[gone, g], np.sqrt(dist[gone]))
        new_stamp[gone, g] = now
    down = np.nextafter(new_low.astype(np.float32), np.float32(-np.inf))
    return at, best, np.where(scan | (new_stamp != stamp), down, low), new_stamp, work


_STATE = "x binary, own binary, low binary, stamp binary, error long, scanned long"


def _assign(rows: DataFrame, keep: str, dim: int, history: list[list[np.ndarray]], groups: list[list[np.ndarray]]) -> DataFrame:
    """One round over the stored rows: own entries, bounds and stamps renewed."""
    parts, width = len(groups), dim // len(groups)
    sizes = [len(g) for g in groups]
    edges = np.cumsum([0, *sizes])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pick = {name: batch.column(name).to_pylist() for name in ("x", "own", "low", "stamp")}
            x = unpacked(pick["x"], dim)
            own = unpacked(pick["own"], parts, "u1").astype(int)
            low, stamp = unpacked(pick["low"], edges[-1], "<f4"), unpacked(pick["stamp"], edges[-1], "u1").astype(int)
            at, lows, stamps = np.zeros(own.shape, "u1"), np.zeros(low.shape, "<f4"), np.zeros(low.shape, "u1")
            error, scanned = np.zeros(len(x), np.int64), 0
            for p in range(parts):
                s = slice(edges[p], edges[p + 1])
                at[:, p], d, lows[:, s], stamps[:, s], work = reassign(
                    x[:, p * width:(p + 1) * width], own[:, p], low[:, s], stamp[:, s], [h[p] for h in history], groups[p])
                error += d
                scanned += work
            done = np.zeros(len(x), np.int64)
            done[0] = scanned
            names = ["x", "own", "low", "stamp"]
            new = [batch.column("x"), *[pa.array([r.tobytes() for r in np.ascontiguousarray(m)], pa.binary()) for m in (at, lows, stamps)]]
            rest = [n for n in batch.schema.names if n not in (*names, "error", "scanned")]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in rest] + new + [pa.array(error), pa.array(done)],
                                             names=rest + names + ["error", "scanned"])
    return rows.mapInArrow(run, f"{keep}, {_STATE}")


def _sums(rows: DataFrame, dim: int, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, s0, s1, ...): counts and component sums, one row per task and used entry, then merged."""
    parts, width = len(books), dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(b), np.int64) for b in books]
        s = [np.zeros((len(b), width), np.int64) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpacked(batch.column("x").to_pylist(), dim)
            own = unpacked(batch.column("own").to_pylist(), parts, "u1")
            for p in range(parts):
                n[p] += np.bincount(own[:, p], minlength=len(books[p]))
                np.add.at(s[p], own[:, p], x[:, p * width:(p + 1) * width])
        for p in range(parts):
            used = np.flatnonzero(n[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[p][used]),
                 *[pa.array(s[p][used, j]) for j in range(width)]],
                names=["part", "entry", "n", *[f"s{j}" for j in range(width)]])
    names = [f"s{j}" for j in range(width)]
    sums = rows.select("x", "own").mapInArrow(run, "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names))
    return sums.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)])


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all components in decimal by part, entry, position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
          id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"):
    """(rows with vec_id, label, own entries (one byte per part), error, scanned; the final codebooks)."""
    whole, dim = whole_vectors(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                                              F.col(vec_col).alias("v")), "v", scale)
    fill = -dim % parts
    if fill:
        whole, dim = whole.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), fill))), dim + fill
    whole = whole.select("vec_id", "label", "x")
    start = np.array([r["x"] for r in whole.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()], np.int64)
    if not len(start) or not dim:
        return whole.select("vec_id", "label", F.lit(b"").alias("own"), F.lit(0).cast("long").alias("error")).limit(0), []
    books = [np.ascontiguousarray(p) for p in np.split(start, parts, axis=1)]
    groups = [entry_groups(b) for b in books]
    n_groups = sum(len(g) for g in groups)
    keep = ", ".join(f"{name} {kind}" for name, kind in whole.dtypes if name != "x")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            zero = np.zeros(n, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(packed(matrix(b.column("x"), dim)), pa.binary()),
                 pa.array([bytes(parts)] * n, pa.binary()), pa.array([bytes(4 * n_groups)] * n, pa.binary()),
                 pa.array([bytes(n_groups)] * n, pa.binary()), pa.array(zero), pa.array(zero)],
                names=["vec_id", "label", "x", "own", "low", "stamp", "error", "scanned"])

    state, history = whole.mapInArrow(pack, f"{keep}, {_STATE}"), [books]
    for r in range(rounds + 1):
        state = stored(_assign(state, keep, dim, history, groups))
        if r < rounds:
            books = [b.copy() for b in books]
            for row in _sums(state, dim, books).collect():    # at most parts * entries rows
                books[row["part"]][row["entry"]] = [row[f"s{j}"] // row["n"] for j in range(dim // parts)]
            history = [*history, books]
    return state, books


def compress(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    rows, books = train(vectors, **options)
    out = rows.select("vec_id", "label", F.lower(F.hex("own")).alias("code"), "error")
    # one row per label meets the rows: a hot label is summed before the shuffle and its join can be split
    labels = out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    return (out.join(labels, F.col("label").eqNullSafe(F.col("of_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")))
