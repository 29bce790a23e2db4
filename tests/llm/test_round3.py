"""Hard negatives, licence scan and vector codes against brute force on small fixtures."""

import hashlib
import math
import re
import string

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationqc.llm import codes, licenses, negatives

#: Extra columns whose names clash with internal ones.
VEC = "vec_id long, embedding array<float>, label int, x int, part int, grp string, score double, rank int"
TEXTS = "doc_id long, text string, words int, hits string, places int, label string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, 2, "g", 0.5, 3) for i, v, lab in rows], VEC)


def floats(rng, n, dim, scale=1.0):
    return [[float(np.float32(v)) for v in row] for row in rng.standard_normal((n, dim)) * scale]


ODD = [(1000, None, 1), (1100, [1.0, None] + [0.0] * 6, 1), (1200, [float("nan")] + [0.0] * 7, 2), (1300, [float("inf")] * 8, 2),
       (1400, [1.0, 2.0], 3)]


# ---- hard negatives ---------------------------------------------------------------

def brute_negatives(rows):
    seen = {}
    for i, v, lab in rows:
        if i is not None and lab is not None and v is not None and len(v) == 8 and all(c is not None and math.isfinite(c) for c in v):
            seen[i] = (lab, [math.floor(256 * c) for c in v])
    out = []
    for a, (lab, x) in seen.items():
        if a % 100:
            continue
        score = {i: sum(p * q for p, q in zip(x, y)) for i, (_, y) in seen.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if seen[i][0] == lab][:5]:
            fit = [i for i in order if seen[i][0] != lab and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, r, n, score[p], score[n]) for r, n in enumerate(fit[:10], 1)]
    return sorted(out)


def mined(spark, rows):
    return sorted(tuple(r) for r in negatives.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect())


def test_negatives_brute_force_with_ties_hot_vector_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    hot = floats(rng, 1, 8)[0]
    rows = [(i, v, i % 3) for i, v in enumerate(floats(rng, 400, 8))]
    rows += [(i, hot, i % 4) for i in range(400, 620)]                       # a third of all rows: one vector, many ties
    rows += [(700, [0.0] * 8, 1), (800, [-v for v in hot], 0), (None, hot, 1), (900, hot, None)]
    rows += [rows[5], rows[100], rows[500]]                                  # repeated rows
    assert mined(spark, rows + ODD) == brute_negatives(rows)


def test_negatives_few_rows_and_empty(spark):
    assert mined(spark, []) == [] == mined(spark, ODD)
    rows = [(0, [1.0] * 8, 1), (1, [0.9] * 8, 1), (2, [0.5] * 8, 2)]
    assert mined(spark, rows) == brute_negatives(rows) != []
    assert mined(spark, rows[:1]) == []


def test_shared_list_walk_is_certified_and_ends_early(monkeypatch):
    monkeypatch.setattr(negatives, "STEP", 64)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((20, 16)) * 400
    x = np.floor(np.repeat(centre, 200, axis=0) + rng.standard_normal((4000, 16)) * 60).astype(np.int64)
    ids, labels = np.arange(4000), np.arange(4000) % 5
    at = np.arange(0, 4000, 100)
    c = negatives.directions(x[at].astype(float), 20)
    anchors = pd.DataFrame({"anchor_id": ids[at], "label": labels[at], "x": list(x[at]), "cluster": (x[at] @ c.T).argmax(1),
                            "lo": [[negatives.NONE + 1]] * 40, "hi": [[2 ** 62]] * 40, "floor": [[negatives.NONE]] * 40})
    got, work = negatives.walk(anchors, (ids, labels, x), c, 5, True)
    assert work < 0.5 * 40 * 4000                                            # most of each list is never scored
    for a in at:
        s = x @ x[a]
        want = sorted((-s[i], i) for i in ids if labels[i] == labels[a] and i != a)[:5]
        assert sorted(zip(-got[got.anchor_id == a].score, got[got.anchor_id == a].vec_id)) == want
    bound = negatives.shared_bounds(x.astype(float), np.linalg.norm(x, axis=1), c[0], 0.3)
    near = [a for a in at if negatives.angles(x[[a]].astype(float), np.linalg.norm(x[[a]], axis=1), c[0])[0] <= 0.3]
    assert near and all((x @ x[a] <= np.linalg.norm(x[a]) * bound + 1e-6).all() for a in near)


def test_negatives_in_many_parts_and_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PART", 10)
    monkeypatch.setattr(negatives, "GROUP", 3)
    monkeypatch.setattr(negatives, "ANCHORS_EACH", 4)
    rng = np.random.default_rng(6)
    rows = [(100 * i if i < 20 else 2000 + i, v, i % 2) for i, v in enumerate(floats(rng, 330, 8))]
    assert mined(spark, rows) == brute_negatives(rows)


# ---- vector codes -----------------------------------------------------------------

def brute_codes(rows, entries=256, rounds=4, parts=4):
    kept = [(i, lab, [math.floor(1024 * c) for c in v]) for i, v, lab in rows
            if v is not None and len(v) == 8 and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    x = np.array([v for *_, v in kept], np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)
    for _ in range(rounds):
        at, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[at[:, p] == e, p]
                if len(mine):
                    books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    at, d = nearest()
    sha = hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    error = d.sum(1)
    by = {}
    for (_, lab, _), e in zip(kept, error):
        by[lab] = by.get(lab, 0) + int(e)
    return sorted((str(i), "".join(f"{c:02x}" for c in a), int(e), by[lab], sha) for (i, lab, _), a, e in zip(kept, at, error))


def coded(spark, rows):
    return sorted((str(r[0]), *r[1:]) for r in codes.compress(vectors(spark, rows)).collect())


def test_codes_brute_force_with_odd_rows_and_hot_label(spark):
    rng = np.random.default_rng(8)
    rows = [(1000 - i, v, 1 if i % 3 else None) for i, v in enumerate(floats(rng, 700, 8))]
    rows += [(2000 + i, rows[7][1], 1) for i in range(300)] + [rows[3], (None, rows[9][1], 2)]
    assert coded(spark, rows + ODD) == brute_codes(rows)


def test_codes_few_rows_empty_and_uneven_length(spark):
    assert coded(spark, []) == [] == coded(spark, ODD[:4])
    rows = [(i, [float(i)] * 8, i % 2) for i in range(9)]
    assert coded(spark, rows) == brute_codes(rows)
    got = codes.compress(vectors(spark, [(i, [0.5 * i] * 6, 0) for i in range(5)])).collect()
    assert sorted(r.code for r in got) == ["%02x%02x%02x%02x" % (i, i, i, 0) for i in range(5)]


def test_bounds_prune_and_keep_exact_assignments():
    rng = np.random.default_rng(9)
    x = np.floor(rng.standard_normal((6000, 4)) * 300 + np.repeat(rng.standard_normal((60, 4)) * 2000, 100, axis=0)).astype(np.int64)
    rng.shuffle(x)
    history, groups = [x[:256].copy()], codes.entry_groups(x[:256])
    own, low, stamp = np.zeros(len(x), int), np.zeros((len(x), len(groups)), np.float32), np.zeros((len(x), len(groups)), int)
    works = []
    for _ in range(6):
        own, dist, low, stamp, work = codes.reassign(x, own, low, stamp, history, groups)
        full = ((x[:, None, :] - history[-1][None]) ** 2).sum(2)
        assert (own == full.argmin(1)).all() and (dist == full.min(1)).all()
        works.append(work)
        book = history[-1].copy()
        for e in range(256):
            if (own == e).any():
                book[e] = [int(s) // int((own == e).sum()) for s in x[own == e].sum(0)]
        history.append(book)
    assert works[-1] < 0.35 * works[0]
    # the norm of the summed moves is at most the sum of their norms, and less where entries turn
    net = codes.net_moves(history, groups)[0]
    steps = sum(np.array([np.sqrt(((b - a).astype(float) ** 2).sum(1))[g].max() for g in groups]) for a, b in zip(history, history[1:]))
    assert (net <= steps * (1 + 1e-6)).all() and (net < 0.999 * steps).any()


def test_squares_are_exact_for_large_numbers():
    x = np.array([[2 ** 25, -2 ** 25, 3]], np.int64)
    assert codes.squares(x, -x)[0, 0] == 4 * (2 ** 50 + 2 ** 50 + 9)


# ---- licences ---------------------------------------------------------------------

def brute_licenses(rows):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    texts = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower)) for _, t in rows]
    weights = {w: licenses.weight(len(rows), sum(w in ws for ws in texts)) for t in licenses.TEMPLATES for w in t.words}
    out = []
    for (i, _), ws in zip(rows, texts):
        found = []
        for t in licenses.TEMPLATES:
            for start in range(-len(t.words) + 1, len(ws)):
                same = [0 <= start + j < len(ws) and ws[start + j] == w for j, w in enumerate(t.words)]
                if sum(same) >= t.need and all(s or not m for s, m in zip(same, t.must)):
                    share = sum(weights[w] for w, s in zip(t.words, same) if s) / sum(weights[w] for w in t.words)
                    found.append((t.base, t.label, start, share))
        base = [f for f in found if f[0]]
        out.append((str(i), len(ws), len(base), min((f[2] for f in base), default=None), max((f[2] for f in base), default=None),
                    ",".join(sorted({f[1] for f in base})), ",".join(sorted({f[1] for f in found})),
                    round(max((f[3] for f in found), default=0.0), 4)))
    return sorted(out, key=str)


LICENSED = [
    (1, None), (2, ""), (3, " \t.,;"), (4, "Under the MIT License."), (5, "under the mit license under the MIT-license, under the mit lice"),
    (6, "apache license version 2 " * 300 + "CC BY-NC 4.0"), (7, "x" * 200_000 + " under the mit license"), (7, "x" * 200_000 + " under the mit license"),
    (None, "This work is licensed under the GNU General Public License, version 3."), (8, "this work is licensed by the GNU General Public License version 3"),
    (9, "gnu general public license version 3"), (10, "GNU general public licence version 3 work is licensed under the"),
    (11, "hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (12, "Redistribution and use in source and binary forms, with or without changes, are permitted provided that the following conditions are met:"),
    (13, "mit " * 5000), (14, "undér the mit license Ünder the mit license"), (15, "the the mit license under under the mit"),
    (16, "Released under the MIT license cc by nc"), (17, "licensed under cc by sa 4 0"), (18, "apache license version 2K version 2")]


def scanned(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "h", 2, "l") for i, t in rows], TEXTS)
    return sorted(((str(r[0]), *r[1:]) for r in licenses.scan(docs).collect()), key=str)


def test_licenses_brute_force(spark):
    got, want = scanned(spark, LICENSED), brute_licenses(LICENSED)
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert [r[-1] for r in got] == pytest.approx([r[-1] for r in want], abs=1e-9)
    assert {r[6] for r in got} >= {"", "mit", "gpl-3", "bsd", "apache-2,cc-by-nc"}
    assert scanned(spark, []) == []


def test_rare_positions_cannot_be_avoided():
    weights = {w: 1 + k for k, w in enumerate(sorted({w for t in licenses.TEMPLATES for w in t.words}))}
    for t in licenses.TEMPLATES:
        assert len(licenses.rare_positions(t, weights)) + t.need == len(t.words) + 1
    assert all(t.need == len(t.words) for t in licenses.BASE)
