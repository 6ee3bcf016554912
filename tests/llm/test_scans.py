"""Centroids, conversation tries and license scans on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import pytest
from conftest import prose
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from pixelproof.llm import centroids, licenses, numbering, tries
from pixelproof.llm.queries import REGISTRY

VECTORS = StructType(
    [StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))]
    + [StructField(n, StringType()) for n in ("id", "v", "cluster", "near")]
)
TURNS = StructType(
    [StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType())]
    + [StructField(n, StringType()) for n in ("c", "depth", "k1", "place")]
)


# ---- centroids -------------------------------------------------------------------
def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], VECTORS)


def expected_clusters(rows, width, factor, k, rounds, seed):
    kept = [
        (i, [math.floor(factor * x) for x in v]) for i, v in rows if v is not None and len(v) == width
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    sha = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centers = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else sha(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        centers = [[sum(x) // len(x) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centers)]
    final = [(i, *near(v)) for i, v in kept]
    sums = Counter()
    for _, d, n in final:
        sums[n] += d
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return Counter((i, n, d, sums[n], sum(sums.values()), name(centers[n])) for i, d, n in final)


ODD_VECTORS = [
    (1, [0.5, -0.5, 0.25]), (1, [0.5, -0.5, 0.25]), (2, [0.5, -0.5, 0.25]), (None, [3.0, 1.0, -7.3]), (3, None), (4, []), (5, [1.0, None, 2.0]),
    (6, [1.0, float("nan"), 2.0]), (7, [1.0, float("inf"), 2.0]), (8, [1.0, 2.0]), (9, [-0.001, -0.0, 0.001]), (10, [1e6, -1e6, 3e5]),
    *[(i, [math.sin(i), math.cos(3 * i), i / 50]) for i in range(11, 90)],
]


@pytest.mark.parametrize("k, rounds", [(1, 0), (4, 1), (7, 5), (200, 3)])
def test_clusters_against_brute_force(spark, k, rounds):
    how = {"width": 3, "factor": 256.0, "k": k, "rounds": rounds, "seed": "2"}
    found, centers = centroids.clustered(vectors(spark, ODD_VECTORS), "vec_id", "embedding", **how)
    rows = Counter(tuple(r[c] for c in ("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in found.collect())
    assert rows == expected_clusters(ODD_VECTORS, **how)
    assert len(centers) == min(k, sum(rows.values()))


def test_clusters_of_no_vectors(spark):
    found, centers = centroids.clustered(vectors(spark, []), "vec_id", "embedding", width=3, factor=1.0, k=4, rounds=2, seed="2")
    assert found.collect() == [] and centers == []


def test_vectors_that_do_not_fit_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        centroids.whole(vectors(spark, [(1, [1e300])]), "vec_id", "embedding", 1, 256.0).collect()
    with pytest.raises(Exception, match="(?i)overflow"):
        rows = vectors(spark, [(1, [1e15]), (2, [-1e15])])
        centroids.clustered(rows, "vec_id", "embedding", width=1, factor=256.0, k=1, rounds=0, seed="2")[0].collect()


def test_centroids_move_by_built_in_sums(spark):
    rows = centroids.whole(vectors(spark, ODD_VECTORS), "vec_id", "embedding", 3, 256.0)
    plan = rows.select(centroids.nearest("v", [(1, 2, 3), (4, 5, 6)]).alias("n"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "zip_with" in plan and "array_min" in plan


# ---- places in groups ----------------------------------------------------------------
def test_numbered_groups_larger_than_a_range(spark):
    rows = spark.createDataFrame([(i % 3 if i % 7 else None, (i * 37) % 101 if i % 5 else None, i) for i in range(600)], "g long, o long, i long")
    found = numbering.numbered(rows.repartition(9), ["g"], ["o", "i"], "place", "test").collect()
    expected = {}
    for g in (None, 0, 1, 2):
        own = sorted(((o is not None, o or 0, i) for g2, o, i in ((r["g"], r["o"], r["i"]) for r in rows.collect()) if g2 == g))
        expected |= {i: n for n, (_, _, i) in enumerate(own, 1)}
    assert {r["i"]: r["place"] for r in found} == expected


# ---- tries -----------------------------------------------------------------------------
def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], TURNS)


def expected_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, code, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    ends = {p: ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)) for p, m in nodes.items()}
    return Counter(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest())
        for p, m in nodes.items()
    )


def found_trie(df, **more):
    c = F.col("c")
    how = {"lender": c - c % 5, "borrowed": F.crc32(c.cast("string")) % 9, "most": 8} | more
    return Counter(tuple(r) for r in tries.trie(df, "conv_id", "turn", "role", "text", **how).collect())


ODD_TURNS = [
    (None, 1, "user", "nobody's"), (-7, 0, "user", "a"), (-5, 0, "user", "b"), (-5, None, "user", "first"), (-5, None, None, None),
    (3, 1, "user", "Ünï 😀"), (3, 1, "user", "Ünï 😀"), (3, 0, "", ""), (4, 0, None, ""), (5, 9, "bot", "x" * 100_000), (5, -1, "a:b", "c"), (6, 0, "a", "b:c"),
]
SHARED = [(c, t, "user" if t % 2 else "bot", f"t{t}" if t < 6 else f"t{t}-{c % 4}") for c in range(40) for t in range(3 + c % 20)]
DEEP = [(c, t, "u", str(t if t < 40 else t * (c % 3))) for c in (100, 101, 105, 110, 111, 117) for t in range(70 + c % 7)]


@pytest.mark.parametrize("rows, band", [(ODD_TURNS, 16), (SHARED + ODD_TURNS, 16), (SHARED[::2] + DEEP, 4), ([], 16)])
def test_trie_against_brute_force(spark, rows, band):
    assert found_trie(conversations(spark, rows), band=band) == expected_trie(rows)


def test_trie_with_many_ends(spark, monkeypatch):
    """Lists of ids longer than a piece are hashed in a stream; long conversations come in pieces."""
    monkeypatch.setattr(tries, "IDS", 7)
    rows = [(5 * c, 0, "user", "hi") for c in range(150)] + SHARED
    assert found_trie(conversations(spark, rows).repartition(5)) == expected_trie(rows)


# ---- licenses ----------------------------------------------------------------------------
def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


PATTERNS = [(n, r, re.compile(f"{r.pattern}(?: |$)")) for n, r in enumerate(licenses.rules())]


@cache
def expected_scan(text):
    """By trying every rule at every word, without any gate."""
    words = words_of(text)
    found = []
    for i in range(len(words)):
        window = " ".join(words[i : i + licenses.WIDTH])
        for n, r, pattern in PATTERNS:
            if m := pattern.match(window):
                found.append((i, i + len(m.group().split()), r.level, n, r.label))
    base = [f for f in found if f[2] == 0]
    rest = [f for f in found if f[2] > 0]
    kept = [
        x for x in rest if x[4] and not any(
            y[0] <= x[0] and y[1] >= x[1] and (y[2], y[0] - y[1], y[3]) < (x[2], x[0] - x[1], x[3]) for y in rest
        )
    ]
    starts = [f[0] for f in base]
    names = lambda fs: ",".join(sorted({f[4] for f in fs}))
    score = max([licenses.SURE[f[2]] for f in kept], default=0.0)
    return len(words), len(base), min(starts, default=None), max(starts, default=None), names(base), names(base + kept), score


TEXTS = [
    None, "", " \n", "plain words", "MIT License", "mit\tLICENSE-mit license", "Mit der Lizenz", "summit license", "mit licenses",
    "This work is licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-2.0-or-later", "License: MIT",
    "released under CC BY-NC-SA 4.0 or CC BY 4.0", "driver license and MIT license plate", "distributed by the terms of the BSD 3-Clause license",
    "the Unlicense", "https://opensource.org/licenses/MIT", "general public license " * 40, "Mİt license mıt license ＭＩＴ license",
    "mit license\u0000apache license", "GPLv3 AGPLv3 LGPL 2.1", "provided to you under the terms and conditions of the a mit license", "mit",
    " ".join(["licensed", "under", "the", "terms", "of", "the"] * 30) + " zlib license", "x" * 100_000 + " mit license " + "y " * 500,
]


def test_licenses_against_brute_force(spark, documents, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, TEXTS[9]), (90, prose(1, 300) + " isc license")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter(tuple(r) for r in REGISTRY["op13_licenses"](spark, str(tmp_path)).collect())
    assert found == Counter((i, *expected_scan(t)) for i, t in rows)


def test_spans_of_licenses(documents):
    rows = licenses.scanned(documents([(1, "A text, released under the MIT License. And more.")])).collect()
    assert [(x["start"], x["end"], x["label"]) for x in rows[0]["licenses"]] == [(2, 7, "mit")]
    assert [(x["start"], x["end"]) for x in rows[0]["base"]] == [(5, 7)] and rows[0]["lang"] == "en"


def test_rules_are_what_the_gates_expect():
    all_rules = licenses.rules()
    assert len(all_rules) > 500
    for r in all_rules:
        assert r.pattern.startswith(r.keyword) or r.keyword == licenses.GRANT_WORD
        assert r.needs in r.pattern and not set(r.needs + r.keyword) & set("()?|:")
        assert any(s in r.pattern.replace("(?:licensed|", "(?:") for s in licenses.STEMS)
        assert "*" not in r.pattern and "+" not in r.pattern and r.pattern.count(" ") < licenses.WIDTH


def test_license_scan_shuffles_nothing_and_runs_no_python(empty):
    scan = licenses.scanned(empty)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert scan.collect() == [] and "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
