"""N-gram Jaccard self-join with vertical partitioning of the global n-gram order.

The global order of shingles is rarest first (document frequency, then hash).

1. Blocks of documents send their shingles to hash fragments, one packed row per
   (block, fragment).  A fragment sees all documents' shingles of its hash range,
   counts document frequencies and answers each block with the shingles that occur
   more than once; all others cannot be in any intersection.  Very frequent shingles
   are found first (heavy hitters of the blocks, a table of fixed size) and left out
   of the exchange, so no shingle fills a fragment.
2. A block assembles each document's prefix (its first ``n - ceil(0.75 n) + 1``
   shingles in the global order; linked documents share one) and its shared
   shingles, cut into vertical fragments of the order by document frequency.
   Equal sets become one class.
3. Documents that share a prefix shingle are compared with that list's pivot, its
   member with the fewest unshared shingles: one comparison a member.  The overlap of
   a pair is counted per vertical fragment and summed.  Linked members join the
   pivot's component, so a large group of near copies costs one comparison each and
   not one for each pair.
4. What is left are pairs around a pivot of which one member is in another component.
   Overlaps with the pivot bound theirs: |x n y| <= min(|x n p|, |y n p|) + min of
   what each shares beyond p, per fragment.  Pairs that can still reach the threshold
   are compared in the same way.

Every pair that links is compared or already in one component, so components are
those of all links.  Components come from contraction rounds over the links (each
node adopts its least neighbour), never on the driver.

Defined results: null text, and text without words, has an empty set and no link;
a text of fewer than five words is one shingle; repeated rows and equal sets are one
class; null identifiers lose to others as component ids; empty tables give no rows.
The input is read several times and has to be the same each time (a stored table).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.llm.blocks import blocks, map_blocks, released
from stationqc.llm.common import settle, stored

N = 5
#: Threshold as a share of 100: 100 * intersection >= 75 * union.
PERCENT = 75
BLOCK_CHARS = 4_000_000
#: Characters hashed at once: bounds the numpy arrays of a task.
PIECE = 1 << 20
#: Shingles a fragment handles, by which their number is chosen.
FRAGMENT_SHINGLES = 1 << 21
#: Heavy hitters: a shingle with this many documents of one block counts there, and
#: the HOT_MAX with the most such documents stay out of the exchange.
HOT_IN_BLOCK, HOT_LEAST, HOT_MAX = 4, 256, 1 << 16
#: Vertical fragments of the order: shingles of at most, and of more than, so many documents.
RARE_DF = 8
REST_BITS = 40

_rng = np.random.default_rng(5)
_BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(PIECE + 1, int(_ODD))
_DOWN = _powers(PIECE + 1, pow(int(_ODD), -1, 2 ** 64))


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word in at most PIECE bytes: a polynomial over byte codes, from prefix sums."""
    low = _LOWER[data]
    space = _SPACE[low]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    first, stop = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[low] * _UP[:len(low)], dtype=np.uint64)))
    poly = (sums[stop] - sums[first]) * _DOWN[first]
    return _mix(poly + (stop - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), first


def _hash_long(b: bytes, at: int) -> tuple[np.ndarray, int]:
    """Hash of the one word at ``at``, of any length, and where it ends: its sum is carried from piece to piece."""
    total, n = 0, 0
    while at < len(b):
        low = _LOWER[np.frombuffer(b, np.uint8, min(PIECE, len(b) - at), at)]
        space = np.flatnonzero(_SPACE[low])
        if len(space):
            low = low[:space[0]]
        part = int((_BYTE[low] * _UP[:len(low)]).sum(dtype=np.uint64))
        total = (total + part * pow(int(_ODD), n, 2 ** 64)) % 2 ** 64
        n, at = n + len(low), at + len(low)
        if len(space):
            break
    return _mix(np.array([total], np.uint64) + np.array([n], np.uint64) * np.uint64(0xD6E8FEB86659FD93)), at


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every word of some documents."""
    hashes, owner = [], []
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    group: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        if group:
            starts = np.cumsum([0, *[len(b) + 1 for _, b in group]])[:-1]
            h, first = _hash_piece(np.frombuffer(b" ".join(b for _, b in group), np.uint8))
            hashes.append(h)
            owner.append(np.array([d for d, _ in group])[np.searchsorted(starts, first, "right") - 1])
            group.clear()

    for d, b in enumerate(raw):
        at = 0
        while at < len(b):
            stop = len(b)
            if stop - at >= PIECE:                     # cut a very long text before a word
                stop = at + PIECE - 1
                while stop > at and not _SPACE[b[stop - 1]]:
                    stop -= 1
                if stop == at:                         # a word longer than a piece
                    flush()
                    size = 0
                    h, at = _hash_long(b, at)
                    hashes.append(h)
                    owner.append(np.array([d]))
                    continue
            part = b[at:stop]
            if size + len(part) + 1 > PIECE:
                flush()
                size = 0
            group.append((d, part))
            size += len(part) + 1
            at = stop
    flush()
    none = np.zeros(0, np.int64)
    return np.concatenate([none.astype(np.uint64), *hashes]), np.concatenate([none, *owner])


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, ordered by both."""
    w, d = words(texts)
    q = _powers(N + 1, 0xD1342543DE82EF95)
    h, o = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(w) >= N:
        m = len(w) - N + 1
        whole = d[:m] == d[N - 1:]
        total = np.zeros(m, np.uint64)
        for k in range(N):
            total += w[k:k + m] * q[k]
        h, o = _mix(total + q[N])[whole], d[:m][whole]
    count = np.bincount(d, minlength=len(texts))
    start = np.cumsum(count) - count
    for i in np.flatnonzero((count > 0) & (count < N)):
        part = w[start[i]:start[i] + count[i]]
        one = (part * q[:len(part)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(part))
        h, o = np.append(h, _mix(one)), np.append(o, i)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])))
        h, o = h[new], o[new]
    return o, h


def _sets(h: np.ndarray, o: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and 128-bit name (two integers) of every document's set."""
    size = np.bincount(o, minlength=docs)
    stop = np.cumsum(size)
    names = np.zeros((docs, 2), np.int64)
    for i in np.flatnonzero(size):
        names[i] = np.frombuffer(hashlib.blake2b(h[stop[i] - size[i]:stop[i]].tobytes(), digest_size=16).digest(), np.int64)
    return size, names[:, 0], names[:, 1]


def _shingled(batches: Iterator[pa.RecordBatch]):
    for block, ids, texts in blocks(batches, BLOCK_CHARS):
        o, h = shingles(texts)
        yield block, ids, o, h


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, name): the set of every document; node is null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for _, ids, o, h in _shingled(batches):
            size, node, name = _sets(h, o, len(ids))
            yield pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "n_shingles": size,
                                "node": pd.array(np.where(size > 0, node, 0), "Int64").copy(), "name": name})
    rows = map_blocks(docs, run, "doc_id long, n_shingles long, node long, name long")
    return rows.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node")))


def heavy_hitters(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Sorted hashes of very frequent shingles (at most HOT_MAX), and the number of all shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for _, _, o, h in _shingled(batches):
            value, count = np.unique(h, return_counts=True)
            often = count >= HOT_IN_BLOCK
            yield pd.DataFrame({"h": pd.array(np.append(value[often].astype(np.int64), 0), "Int64"),
                                "n": np.append(count[often], len(h)),
                                "total": np.append(np.zeros(often.sum(), bool), True)})
    found = settle(map_blocks(docs, run, "h long, n long, total boolean")
                   .groupBy("h", "total").agg(F.sum("n").alias("n")))
    top = found.filter(~F.col("total") & (F.col("n") >= HOT_LEAST)).orderBy(F.desc("n"), "h").limit(HOT_MAX).collect()
    total = found.filter("total").agg(F.sum("n")).first()[0] or 0
    return np.sort(np.array([r["h"] for r in top], np.int64).astype(np.uint64)), total


def _is_hot(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
    return hot[at] == h


def _send(bits: int, hot: np.ndarray):
    """Packed shingles of a block, one row per fragment: hash rest (40 bits, two planes) and document."""
    shift = np.uint64(64 - bits - REST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for block, _, o, h in _shingled(batches):
            cold = ~_is_hot(h, hot)
            name, doc = h[cold] >> shift, o[cold].astype(np.uint16)
            order = np.argsort(name, kind="stable")
            name, doc = name[order], doc[order]
            cut = np.searchsorted(name >> np.uint64(REST_BITS), np.arange((1 << bits) + 1, dtype=np.uint64))
            rows = [(f, block, (name[a:b] >> np.uint64(32)).astype(np.uint8).tobytes(),
                     name[a:b].astype(np.uint32).tobytes(), doc[a:b].tobytes())
                    for f, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
            yield pd.DataFrame(rows, columns=["fragment", "block", "hi", "lo", "doc"])
    return run


def _count_fragment(group: pd.DataFrame) -> pd.DataFrame:
    """Shingles of more than one document, back to the blocks they came from."""
    fragment = np.int64(group["fragment"].iloc[0])
    lo = [np.frombuffer(x, np.uint32) for x in group["lo"]]
    rest = (np.concatenate([np.frombuffer(x, np.uint8) for x in group["hi"]]).astype(np.int64) << 32) | np.concatenate(lo)
    doc = np.concatenate([np.frombuffer(x, np.uint16) for x in group["doc"]])
    owner = np.repeat(np.arange(len(lo)), [len(x) for x in lo])
    order = np.argsort(rest, kind="stable")
    s = rest[order]
    new = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    df = np.repeat(np.diff(np.append(new, len(s))), np.diff(np.append(new, len(s))))
    keep = np.empty(len(s), np.int64)
    keep[order] = df
    rows = []
    shared = keep > 1
    stop = np.cumsum([len(x) for x in lo])
    for k, block in enumerate(group["block"]):
        part = slice(stop[k] - len(lo[k]), stop[k])
        m = shared[part]
        if m.any():
            rows.append((block, ((fragment << REST_BITS) | rest[part][m]).tobytes(),
                         np.minimum(keep[part][m], 2 ** 31 - 1).astype(np.int32).tobytes(), doc[part][m].tobytes()))
    return pd.DataFrame(rows, columns=["block", "shingle", "df", "doc"])


def _block_sets(bits: int, hot: np.ndarray):
    """One row per block: its documents' sets, and their hot shingles."""
    shift = np.uint64(64 - bits - REST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for block, ids, o, h in _shingled(batches):
            size, node, name = _sets(h, o, len(ids))
            m = _is_hot(h, hot)
            yield pd.DataFrame({"block": [block], "size": [size.astype(np.int32).tobytes()], "node": [node.tobytes()],
                                "name": [name.tobytes()], "hot": [(h[m] >> shift).astype(np.int64).tobytes()],
                                "hot_doc": [o[m].astype(np.uint16).tobytes()]})
    return run


HOT_DF = np.int64(2 ** 31)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - -(-PERCENT * n // 100) + 1


def _assemble(sets: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Prefix and shared shingles of every document of a block that shares a prefix shingle."""
    out: dict = {c: [] for c in ("node", "name", "n", "shared", "prefix", "rare", "common")}
    for _, row in sets.iterrows():
        size = np.frombuffer(row["size"], np.int32).astype(np.int64)
        node, name = np.frombuffer(row["node"], np.int64), np.frombuffer(row["name"], np.int64)
        hot = np.frombuffer(row["hot"], np.int64)
        sid = np.concatenate([hot, *[np.frombuffer(x, np.int64) for x in answers["shingle"]]])
        df = np.concatenate([np.full(len(hot), HOT_DF), *[np.frombuffer(x, np.int32).astype(np.int64) for x in answers["df"]]])
        doc = np.concatenate([np.frombuffer(row["hot_doc"], np.uint16), *[np.frombuffer(x, np.uint16) for x in answers["doc"]]])
        if len(doc) and doc.max() >= len(size):
            raise RuntimeError("the input was not read the same way twice; store it first")
        order = np.lexsort((sid, df, doc))
        sid, df, doc = sid[order], df[order], doc[order]
        have = np.bincount(doc, minlength=len(size))
        if (have > size).any():
            raise RuntimeError("the input was not read the same way twice; store it first")
        stop = np.cumsum(have)
        # unshared shingles are the rarest: they fill the prefix first
        room = prefix_length(size) - (size - have)
        for i in np.flatnonzero((have > 0) & (room > 0)):
            part = slice(stop[i] - have[i], stop[i])
            s, rare = sid[part], df[part] <= RARE_DF
            for c, v in zip(out, (node[i], name[i], size[i], have[i], s[:room[i]], np.sort(s[rare]), np.sort(s[~rare]))):
                out[c].append(v)
    return pd.DataFrame({c: pd.Series(v, dtype=object if c in ("prefix", "rare", "common") else "int64")
                         for c, v in out.items()})


_SETS = "node long, name long, n long, shared long, prefix array<long>, rare array<long>, common array<long>"


def prefix_classes(docs: DataFrame) -> DataFrame:
    """One row per distinct set that shares a prefix shingle with another document."""
    hot, total = heavy_hitters(docs)
    bits = min(16, max(4, math.ceil(math.log2(max(total, 1) / FRAGMENT_SHINGLES + 1))))
    sent = map_blocks(docs, _send(bits, hot), "fragment int, block long, hi binary, lo binary, doc binary")
    answers = sent.groupBy("fragment").applyInPandas(released(_count_fragment), "block long, shingle binary, df binary, doc binary")
    sets = map_blocks(docs, _block_sets(bits, hot),
                      "block long, size binary, node binary, name binary, hot binary, hot_doc binary")
    rows = sets.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(released(_assemble), _SETS)
    classes = settle(rows.groupBy("node").agg(F.min("name").alias("name"), F.max("name").alias("other"),
                                              *[F.first(c).alias(c) for c in ("n", "shared", "prefix", "rare", "common")]))
    if not classes.filter("name != other").isEmpty():
        raise RuntimeError("two sets share a 64-bit name; change the seed of the hash")
    return classes.drop("name", "other")


def overlaps(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) with partial overlaps counted per vertical fragment and summed per pair."""
    segments = classes.select("node", F.explode(F.array(*[
        F.struct(F.lit(k).alias("v"), F.col(c).alias("ids")) for k, c in enumerate(("rare", "common"))])).alias("s"))
    segments = segments.select("node", "s.v", "s.ids").filter(F.size("ids") > 0)
    left = segments.select(F.col("node").alias("a"), "v", F.col("ids").alias("ids_a"))
    right = segments.select(F.col("node").alias("b"), "v", F.col("ids").alias("ids_b"))
    part = (pairs.select("a", "b").join(left, "a").join(right, ["b", "v"])
            .select("a", "b", "v", F.size(F.array_intersect("ids_a", "ids_b")).alias("common")))
    both = part.groupBy("a", "b").agg(F.sum(F.when(F.col("v") == 0, F.col("common")).otherwise(0)).alias("o_rare"),
                                      F.sum(F.when(F.col("v") == 1, F.col("common")).otherwise(0)).alias("o_common"))
    return (pairs.join(both, ["a", "b"], "left")
            .withColumn("o_rare", F.coalesce("o_rare", F.lit(0))).withColumn("o_common", F.coalesce("o_common", F.lit(0))))


def _linked(n_a: str, n_b: str):
    o = F.col("o_rare") + F.col("o_common")
    return 100 * o >= PERCENT * (F.col(n_a) + F.col(n_b) - o)


def _sizes_fit(n_a: str, n_b: str):
    return (100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): rounds of contraction to the least neighbour.

    Least by a hash of the name: whatever the names, chains of ever smaller
    neighbours are short then, and the links left shrink quickly from round to round.
    """
    by_hash = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    tidy = lambda e: (e.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = stored(tidy(links))
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    first = True
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        up = stored(both.groupBy("a").agg(F.least(F.min(by_hash("b")), F.first(by_hash("a")))["v"].alias("up")))
        roots = stored(up.select(F.col("a").alias("node"), F.col("up").alias("root")) if first else
                       roots.join(up, roots["root"] == up["a"], "left").select("node", F.coalesce("up", "root").alias("root")))
        first = False
        to_b = up.select(F.col("a").alias("b"), F.col("up").alias("up_b"))
        links = stored(tidy(links.join(up, "a").join(to_b, "b").select(F.col("up").alias("a"), F.col("up_b").alias("b"))))
    return roots


def class_links(classes: DataFrame) -> DataFrame:
    """(a, b): links between distinct sets that span the components of all links."""
    members = classes.select("node", "n", "shared", F.explode("prefix").alias("shingle"))
    # a list's pivot: least share of unshared shingles, then smallest name
    score = F.struct(((F.col("n") - F.col("shared")) / F.col("n")).alias("lack"), "node", "n")
    lists = (members.groupBy("shingle").agg(F.count("*").alias("size"), F.min(score).alias("p")).filter("size > 1")
             .select("shingle", F.col("p.node").alias("b"), F.col("p.n").alias("n_b")))
    around = (members.select(F.col("node").alias("a"), "n", "shared", "shingle").join(lists, "shingle")
              .groupBy("a", "b").agg(F.first("n").alias("n_a"), F.first("shared").alias("s_a"), F.first("n_b").alias("n_b")))
    around = settle(overlaps(around, classes))
    first = settle(around.filter((F.col("a") != F.col("b")) & _linked("n_a", "n_b")).select("a", "b"))
    roots = components(first)

    # pairs around a pivot, one of them outside the pivot's component
    root = lambda c, name: roots.select(F.col("node").alias(c), F.col("root").alias(name))
    g = (around.join(root("a", "r"), "a", "left").join(root("b", "rp"), "b", "left")
         .join(classes.select(F.col("node").alias("a"), F.size("rare").alias("rare"), F.size("common").alias("common")), "a")
         .filter("a != b")
         .select(F.col("b").alias("p"), F.col("a").alias("x"), F.coalesce("r", "a").alias("r"),
                 F.coalesce("rp", "b").alias("rp"), F.col("n_a").alias("n"), "o_rare", "o_common",
                 (F.col("rare") - F.col("o_rare")).alias("e_rare"), (F.col("common") - F.col("o_common")).alias("e_common")))
    g = settle(g)
    x = g.select("p", *[F.col(c).alias(f"{c}_x") for c in ("x", "r", "n", "o_rare", "o_common", "e_rare", "e_common")])
    y = g.filter("r != rp").select("p", *[F.col(c).alias(f"{c}_y") for c in ("x", "r", "rp", "n", "o_rare", "o_common",
                                                                             "e_rare", "e_common")])
    bound = sum((F.least(f"{c}_x", f"{c}_y") for c in ("o_rare", "o_common", "e_rare", "e_common")), F.lit(0))
    fits = ((F.col("r_x") != F.col("r_y"))
            # of two outsiders the pair comes once
            & ((F.col("r_x") == F.col("rp_y")) | (F.col("x_x") < F.col("x_y")))
            & _sizes_fit("n_x", "n_y")
            & ((100 + PERCENT) * bound >= PERCENT * (F.col("n_x") + F.col("n_y"))))
    rest = (y.join(x, (x["p"] == y["p"]) & fits)
            .groupBy(F.least("x_x", "x_y").alias("a"), F.greatest("x_x", "x_y").alias("b"))
            .agg(F.first(F.col("n_x") + F.col("n_y")).alias("n_sum")))
    o = F.col("o_rare") + F.col("o_common")
    second = overlaps(settle(rest), classes).filter(100 * o >= PERCENT * (F.col("n_sum") - o)).select("a", "b")
    return first.union(second)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest identifier that links reach, per row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = settle(document_sets(rows).select("doc_id", "n_shingles", "node"))
    roots = components(class_links(prefix_classes(rows)))
    first = sets.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    named = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    comp = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # only classes whose component has another first document, or copies, need an answer
    answer = (named.join(comp, "root").filter((F.col("copies") > 1) | ~F.col("component_id").eqNullSafe(F.col("least")))
              .select("node", "component_id"))
    return (sets.join(answer, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
