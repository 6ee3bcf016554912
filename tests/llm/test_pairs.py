"""Joins, searches, passages and mixing against brute force on small tables."""

import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import prose
from pyspark.sql import functions as F

from pixelproof.llm import ann, blocks, graph, mixing, ngram_join, passages, topk
from pixelproof.llm import text
from pixelproof.llm.text import shingles
from pixelproof.llm.work import store


def united(pairs, nodes):
    """The smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def similar(x, y, percent=80):
    both = len(np.intersect1d(x, y))
    return len(x) and len(y) and 100 * both >= percent * (len(x) + len(y) - both)


def edited(text, places):
    words = text.split()
    for p in places:
        words[p % len(words)] = f"edit{p}"
    return " ".join(words)


# ---- components ------------------------------------------------------------------
@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = np.random.default_rng(3)
    pairs = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(200)],
        "random": [tuple(map(int, rng.integers(0, 120, 2))) for _ in range(70)] + [(7, 7), (None, 3)],
        "none": [],
    }[kind]
    found = graph.components(spark.createDataFrame(pairs, "a long, b long")).rows.collect()
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    expected = united(real, {n for pair in real for n in pair})
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)


# ---- n-gram join -----------------------------------------------------------------
def corpus():
    """Near copies of many kinds: chains of edits, copies, shared passages, texts at and just below the threshold."""
    rows = []
    for g in range(12):
        base = prose(100 + g, 60 + g * 9)
        rows += [edited(base, range(0, k * 11, 11)) for k in range(8)]
        rows += [base.upper(), base.replace(" ", "\t\n"), base]
    shared = prose(77, 120)
    rows += [f"{shared} {prose(300 + i, 40 + 7 * i)}" for i in range(25)]
    rows += [" ".join(prose(500, 200).split()[: 200 - i]) for i in range(60)]
    rows += ["", None, " \n ", "a b", "A  b", "one two three four five", "Ä b c d e", "ä b c d e"]
    return list(enumerate(rows))


def expected_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = list(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if similar(sets[a], sets[b])]
    return sets, united(pairs, ids)


@pytest.mark.parametrize("settings", [ngram_join.Settings(), ngram_join.Settings(cell=4, leaf=2, bitmap=64, sketch=16, hashes=1)])
def test_join_finds_every_link(documents, settings):
    """Whatever the size of cells, leaves, bitmaps and sketch: they cost time, not links."""
    rows = corpus()
    sets, expected = expected_groups(rows)
    found = ngram_join.joined(documents(rows), settings=settings).collect()
    assert {r["id"]: r["component"] for r in found} == expected
    assert {r["id"]: r["n"] for r in found} == {i: len(s) for i, s in sets.items()}


def test_tree_drops_no_similar_pair():
    rng = np.random.default_rng(4)
    for fan in (2, 8):
        for _ in range(20):
            pool = rng.integers(0, 1 << 62, 400).astype(np.uint64)
            sets = [np.unique(rng.choice(pool[:200], rng.integers(1, 90))) for _ in range(30)]
            sets += [np.append(s[1:], pool[300 + i]) for i, s in enumerate(sets[:20])]
            bits = np.vstack([ngram_join.bitmap_of(s, 128) for s in sets])
            i, j = ngram_join.Tree.over(bits, np.array([len(s) for s in sets]), fan).pairs(80)
            kept = set(zip(i.tolist(), j.tolist(), strict=True))
            alike = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if similar(sets[a], sets[b])}
            assert alike <= kept and len(kept) <= len(sets) * (len(sets) - 1) // 2


def cell_of(sets, least=64):
    """One cell, as the traversal gets it, of sets that are all groups of their own."""
    return pd.DataFrame({
        "token": 1, "lo": 0, "hi": 0, "part": 0, "id": range(len(sets)), "n": [len(x) for x in sets], "own": range(len(sets)),
        "bits": [ngram_join.bitmap_of(x, least).tobytes() for x in sets],
    })


def test_forest_drops_no_similar_pair_across_lengths():
    """Sets on both sides of a power of two, whose bitmaps have different lengths."""
    rng = np.random.default_rng(8)
    sets = []
    for n in (60, 64, 65, 120, 128, 130, 250, 257, 300):
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for cut in (0, n // 40, n // 10, n // 5, n // 2):
            sets += [base[cut:], np.unique(np.append(base, rng.integers(0, 1 << 62, cut).astype(np.uint64)))]
    for settings in (ngram_join.Settings(), ngram_join.Settings(leaf=2)):
        a, b = ngram_join.cell_pairs(cell_of(sets), settings)
        kept = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
        alike = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if similar(sets[i], sets[j])}
        assert len(kept) == len(a) and alike <= kept and len(alike) > 100


@pytest.mark.parametrize("n", [100, 1500, 2100, 10_000])
def test_forest_tells_unlike_sets_of_any_size_apart(n):
    rng = np.random.default_rng(n)
    shared = rng.integers(0, 1 << 62, 50).astype(np.uint64)  # a passage in all of them
    sets = [np.unique(np.append(shared, rng.integers(0, 1 << 62, n - 50 + i).astype(np.uint64))) for i in range(40)]
    a, _ = ngram_join.cell_pairs(cell_of(sets, 256), ngram_join.Settings())
    assert len(a) == 0


def test_unlike_sets_of_many_common_tokens_are_not_listed(spark, documents):
    """Texts of 190 common words and 40 of their own share two thirds of their shingles."""
    base = prose(9, 190)
    rows = [(i, f"{base} {' '.join(f'own{i}x{j}' for j in range(40))}") for i in range(30)]
    sets = [shingles(t) for _, t in rows]
    assert all(similar(x, y, 65) and not similar(x, y) for k, x in enumerate(sets) for y in sets[k + 1 :])
    settings, table = ngram_join.Settings(), documents(rows)
    nodes = table.select(F.col("doc_id").alias("id"), F.lit(len(sets[0])).alias("n"))
    rank = ngram_join.frequencies(table, "text", settings)
    signed = ngram_join.signatures(table, "doc_id", "text", nodes, rank, settings)
    groups = graph.components(spark.createDataFrame([], "a long, b long"))
    assert ngram_join.across(signed, groups, settings).count() < 40  # of 435


def test_join_by_the_longer_text_of_an_id(documents):
    long = prose(4, 200)
    found = ngram_join.joined(documents([(5, prose(3, 60)), (5, long), (6, edited(long, [100])), (7, prose(8, 60))])).collect()
    assert {(r["id"], r["component"]) for r in found} == {(5, 5), (6, 5), (7, 7)}


def test_join_of_awkward_tables(awkward, empty):
    found = ngram_join.joined(awkward).collect()
    assert len(found) == awkward.count()
    by = defaultdict(set)
    for r in found:
        by[r["id"]].add((r["n"], r["component"]))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[3] == {(0, 3)} and by[4] == {(1, 4)}
    assert {c for _, c in by[5] | by[6] | by[None]} == {5}  # equal sets, repeated rows, a null id
    assert ngram_join.joined(empty).count() == 0


# ---- passages --------------------------------------------------------------------
def test_passages_that_repeat(documents):
    a, b, c = prose(1, 70), prose(2, 55), prose(3, 49)
    rows = [
        (1, f"intro\n{a}\nend"), (2, f"{edited(a, [40])}\nother {prose(9, 60)}"), (3, f"{prose(10, 80)}\n{b}"), (4, b.upper()),
        (5, c), (6, c), (7, f"{prose(11, 60)}\n{prose(11, 60)}"), (8, f"{a} {prose(12, 200)}"), (9, None), (10, ""),
    ]
    docs = documents(rows)
    found = passages.repeats(docs)
    got = {(r["doc"], r["line"]): (r["first_doc"], r["first_line"], r["removed"]) for r in found.collect()}
    # short passages, lines of one document alone and parts of longer lines are not repeated paragraphs
    assert got == {(1, 1): (1, 1, False), (2, 0): (1, 1, True), (3, 1): (3, 1, False), (4, 0): (3, 1, True)}
    texts = dict(rows)
    for r in found.collect():
        assert texts[r["doc"]][r["start"] : r["stop"]] == texts[r["doc"]].split("\n")[r["line"]]
    cleaned = {r["doc_id"]: r["text"] for r in passages.without(docs, found).collect()}
    assert cleaned[4] == "" and cleaned[2] == f"other {prose(9, 60)}" and cleaned[1] == texts[1] and cleaned[9] is None


def test_passages_that_are_no_whole_line(documents):
    """Every word of a run of 50 or more that two documents share, by brute force, is in a span, and no other run is."""
    a, b = prose(1, 70), prose(2, 50)
    short = "\n".join(" ".join(a.split()[i : i + 9]) for i in range(0, 70, 9))
    rows = [
        (1, f"intro\n{a}\nend"), (2, f"{prose(20, 33)} {a} {prose(21, 200)}"), (3, f"{prose(22, 5)}\n{short}\n{prose(23, 9)}"),
        (4, f"{prose(24, 31)} {b}"), (5, f"{prose(25, 17)}\t{b.upper()}\n\n{prose(26, 8)}"), (6, prose(3, 49)), (7, prose(3, 49)),
        (8, None), (9, ""),
    ]
    docs = documents(rows)
    found = passages.spans(docs).collect()
    texts, words = dict(rows), {i: (t or "").lower().split() for i, t in rows}
    holders = defaultdict(set)
    for i, own in words.items():
        for k in range(len(own) - 49):
            holders[tuple(own[k : k + 50])].add(i)
    for i, own in words.items():
        covered = set()
        for r in found:
            if r["doc"] == i:
                before = len(texts[i][: r["start"]].split())
                covered |= set(range(before, before + len(texts[i][r["start"] : r["stop"]].split())))
                assert r["line"] == texts[i][: r["start"]].count("\n")
        runs = {j for k in range(len(own) - 49) if len(holders[tuple(own[k : k + 50])]) > 1 for j in range(k, k + 50)}
        assert covered == runs, i
    assert {(r["doc"], r["first_doc"]) for r in found if r["removed"]} == {(2, 1), (3, 1), (5, 4)}
    cleaned = {r["doc_id"]: r["text"] for r in passages.without(docs, passages.spans(docs)).collect()}
    assert cleaned[1] == texts[1] and cleaned[2] == f"{prose(20, 33)}  {prose(21, 200)}" and cleaned[8] is None
    assert cleaned[3] == f"{prose(22, 5)}\n{prose(23, 9)}"


def test_bands_reach_the_recall():
    settings = passages.Settings()
    bands, rows = passages.tuned(settings)
    assert bands * rows <= settings.hashes and 1 - (1 - 0.8**rows) ** bands >= settings.recall
    rng = np.random.default_rng(5)
    hits = 0
    for _ in range(300):
        pool = rng.integers(0, 1 << 62, 120).astype(np.uint64)
        x, y = np.sort(pool[:108]), np.sort(pool[12:])  # 96 of 120
        hits += bool(set(passages.bands_of(x, bands, rows).tolist()) & set(passages.bands_of(y, bands, rows).tolist()))
    assert hits >= 299


def test_passages_of_awkward_tables(awkward, empty):
    got = {(r["doc"], r["line"], r["removed"]) for r in passages.repeats(awkward).collect()}
    assert got == {(5, 0, False), (6, 0, True)}
    assert passages.repeats(empty).count() == 0


# ---- searches --------------------------------------------------------------------
@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(12, 24))
    rows = [(i, (middle[i % 12] + 0.4 * rng.normal(size=24)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(60)]  # one vector many times
    odd = [(3000, None), (3020, [float("nan")] * 24), (3040, [1.0, None] * 12), (3060, []), (3080, [0.0] * 24), (None, [1.0] * 24),
           (3100, [1.0, 2.0]), (3101, [2.0, 1.0]), (3120, [1e300] * 24)]
    return rows, odd


SCHEMA = "vec_id long, embedding array<double>"


def test_top_k_is_exact(spark, vectors):
    rows, odd = vectors
    odd = [r for r in odd if r[0] != 3120]  # whose scores do not fit 64 bits
    table = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    scaled = topk.scaled(table, "vec_id", "embedding", 64.0)
    settings = topk.Settings(k=7, query_block=16, candidate_block=100, steps=(5, 6))
    found = topk.top_k(scaled, scaled.where("id % 20 = 0"), settings).collect()
    ints = {i: np.floor(64 * np.array(v)) for i, v in rows} | {3080: np.zeros(24), 3100: np.array([64, 128.0]), 3101: np.array([128, 64.0])}
    expected = {}
    for q, x in ints.items():
        if q % 20 == 0:
            scores = sorted((-int(x @ y), i) for i, y in ints.items() if i != q and len(y) == len(x))[:7]
            expected |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(scores, 1)}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == expected


def test_bounds_of_large_numbers_are_exact(spark):
    rows = [(i, [float(2**27 - i), float(-(2**27) + 3 * i), 5.0]) for i in range(40)]
    table = spark.createDataFrame(rows, SCHEMA)
    scaled = topk.scaled(table, "vec_id", "embedding", 1.0)
    found = topk.top_k(scaled, scaled.where("id = 20"), topk.Settings(k=3, steps=(1, 1))).collect()
    q = [int(x) for x in rows[20][1]]
    scores = sorted((-sum(a * int(b) for a, b in zip(q, v, strict=True)), i) for i, v in rows if i != 20)[:3]
    assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [(i, -s) for s, i in scores]


def test_graph_search_reaches_the_recall(spark, vectors):
    rows, odd = vectors
    table = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    usable = blocks.usable(table, "vec_id", "embedding", zero=False)
    found = ann.searched(usable, usable.where("id % 20 = 0"), ann.Settings(shard=400)).collect()
    good = {i: np.array(v) for i, v in rows}
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    hits = total = 0
    for q, x in good.items():
        if q % 20:
            continue
        near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good.items() if i != q)[:10]
        assert len(got[q]) == 10 and got[q] == sorted(got[q]) and q not in [i for _, i in got[q]]
        assert all(s == pytest.approx(np.sqrt(((x - good[i]) ** 2).sum()), abs=1e-12) for s, i in got[q])
        hits, total = hits + len({i for _, i in near} & {i for _, i in got[q]}), total + 10
    assert hits >= 0.9 * total
    assert [i for _, i in got[2000]] == [0, *range(2001, 2010)]  # copies, ties to smaller ids
    assert got[3100] == [(pytest.approx(np.sqrt(2)), 3101)]
    assert not {3000, 3020, 3040, 3060, 3080} & set(got)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_broadcasts_no_copies_of_blocks(spark, vectors):
    scaled = topk.scaled(spark.createDataFrame(vectors[0], SCHEMA).repartition(5), "vec_id", "embedding", 64.0)
    found = topk.top_k(scaled, scaled.where("id % 20 = 0"), topk.Settings(query_block=16, candidate_block=100))
    assert "Broadcast" not in plan_of(found)


def test_graph_search_broadcasts_no_copies_of_queries(spark, vectors):
    usable = blocks.usable(spark.createDataFrame(vectors[0], SCHEMA).repartition(5), "vec_id", "embedding", zero=False)
    assert "Broadcast" not in plan_of(ann.searched(usable, usable.where("id % 20 = 0"), ann.Settings(shard=400)))


def test_copies_of_blocks_stay_few(spark):
    """The smaller side travels more often, and a group does not outgrow a task."""
    sizes = {"few": (3, 1 << 10), "many": (3000, 1 << 20)}
    q, c = (
        spark.range(n, numPartitions=1).selectExpr("1 AS dim", "cast('12345678' AS binary) AS ids", f"cast(repeat('x', {size}) AS binary) AS vectors")
        for n, size in sizes.values()
    )
    rows, columns = blocks.shape(q, c, 10)
    assert rows == 1 and columns >= max(blocks.CELLS, 3000 * (1 << 20) // blocks.CELL)
    assert blocks.shape(c, q, 10) == (columns, 1)
    assert blocks.shape(q.limit(0), q, 10) == (1, 3) and blocks.shape(q.limit(0), q.limit(0), 10) == (1, 1)


def test_vectors_are_stored_exactly_in_few_bytes():
    for size, vectors in (
        (1, [[-128, 127.0]]), (2, [[-129, 0.0], [1, 32767]]), (4, [[32768, 2.0**24]]), (4, [[0.5, 0.1 + np.float32(0)]]),
        (8, [[0.1, 1e300]]), (8, [[2.0**24 + 1, 0]]), (4, [[2.0**62, -(2.0**100)]]),
    ):
        kind = np.float32 if size == 4 else np.float64
        vectors = np.array(np.array(vectors, kind), np.float64)
        data = blocks.data(vectors)
        assert len(data) == size * vectors.size
        assert (blocks.matrix(data, vectors.shape[1], bytes(8 * len(vectors))) == vectors.T).all()


def test_searches_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    scaled = topk.scaled(none, "vec_id", "embedding", 64.0)
    assert topk.top_k(scaled, scaled).count() == 0
    usable = blocks.usable(none, "vec_id", "embedding")
    assert ann.searched(usable, usable).count() == 0


# ---- mixing ----------------------------------------------------------------------
def levels():
    lang = F.when(F.col("l") == "en", 3).otherwise(1)
    return [mixing.Level("l", F.col("lang"), lang), mixing.Level("s", F.col("source"), F.lit(1))]


def filled(budget, children):
    """Budgets of (weight, capacity) by handing out what is left until nothing changes."""
    got = [0.0] * len(children)
    open_ = list(range(len(children)))
    while open_ and budget > 1e-9:
        share = budget / sum(children[i][0] for i in open_)
        full = [i for i in open_ if children[i][0] * share >= children[i][1]]
        if not full:
            for i in open_:
                got[i] = children[i][0] * share
            break
        for i in full:
            got[i] = children[i][1]
            budget -= children[i][1]
        open_ = [i for i in open_ if i not in full]
    return got


def test_shortages_go_to_siblings_first(documents):
    rng = np.random.default_rng(8)
    rows = []
    for (lang, source), n in {("en", "a"): 300, ("en", "b"): 20, ("en", "c"): 90, ("de", "a"): 50, ("de", "d"): 10}.items():
        for _ in range(n):
            rows.append((len(rows), prose(len(rows), int(rng.integers(1, 40))), lang, source))
    settings = mixing.Settings(budget=0.8, max_epochs=2)
    out = mixing.mixed(documents(rows), levels(), settings=settings).collect()
    tokens = {i: len(t.split()) for i, t, *_ in rows}
    have = defaultdict(int)
    for i, _, lang, source in rows:
        have[lang, source] += tokens[i]
    langs = {"en": 3, "de": 1}
    caps = {x: 2 * sum(v for (y, _), v in have.items() if y == x) for x in langs}
    total = 0.8 * sum(have.values())
    budgets = {}
    for lang, b in zip(langs, filled(total, [(w, caps[x]) for x, w in langs.items()]), strict=True):
        own = [k for k in have if k[0] == lang]
        budgets |= dict(zip(own, filled(b, [(1, 2 * have[k]) for k in own]), strict=True))
    took = defaultdict(int)
    for r in out:
        assert 1 <= r["copies"] <= 2 and r["n_tokens"] == tokens[r["doc_id"]]
        took[r["lang"], r["source"]] += r["copies"] * r["n_tokens"]
    for leaf, b in budgets.items():
        assert b - 40 <= took[leaf] <= b + 1e-6  # a prefix stops before the text that does not fit


def test_mixing_awkward_tables(awkward, empty, documents):
    out = mixing.mixed(awkward, levels()).collect()
    assert {r["s"] for r in out} <= {"s1", "?"}
    assert len([r for r in out if r["doc_id"] == 5]) in (0, 2)  # repeated rows stand together
    assert mixing.mixed(empty, levels()).count() == 0
    assert mixing.mixed(documents([(1, ""), (2, None)]), levels()).count() == 0


def test_top_k_of_large_components(spark):
    """Nothing is left out: sums beyond doubles, and beyond where partial sums fit 64 bits, against whole numbers."""
    rows = [(0, [5e6, 1.0]), (20, [5e6, 1.0]), (1, [9e6, 1.0]), (2, [9e6, 1.0]), (3, [-3e7, 0.5]), (5, [0.25, 0.0]), (40, [2.0**24 + 1, 3.0])]
    whole = {i: [int(x * 64 // 1) for x in v] for i, v in rows}
    scaled = topk.scaled(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 64.0)
    found = {tuple(r) for r in topk.top_k(scaled, scaled.where("id % 20 = 0")).select("query_id", "rank", "vec_id", "score").collect()}
    want = set()
    for q in (0, 20, 40):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)}
    assert found == want
    near = topk.scaled(spark.createDataFrame([(0, [2.0**31, 2.0**30]), (1, [2.0**31, 2.0**30 - 1]), (2, [-(2.0**31), 1.0]), (3, [1.0, 2.0])], SCHEMA), "vec_id", "embedding", 1.0)
    got = {r["vec_id"]: r["score"] for r in topk.top_k(near, near.where("id = 0")).collect()}
    assert got == {1: 2**62 + 2**30 * (2**30 - 1), 2: -(2**62) + 2**30, 3: 2**31 + 2**31}


def test_top_k_score_beyond_64_bits_is_an_error(spark):
    scaled = topk.scaled(spark.createDataFrame([(0, [1e10, 1.0]), (1, [1e10, 1.0])], SCHEMA), "vec_id", "embedding", 1.0)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(scaled, scaled.where("id = 0")).collect()
    with pytest.raises(Exception, match="not finite"):
        topk.scaled(spark.createDataFrame([(0, [1e308])], SCHEMA), "vec_id", "embedding", 64.0).collect()


def test_passages_keep_no_signatures_on_disk(documents):
    folder = Path(store(documents([]), "beside").path.removeprefix("file:")).parent
    before = set(folder.iterdir())
    base = prose(6, 120)
    found = passages.spans(documents([(1, base), (2, f"{base} {prose(7, 20)}"), (3, prose(8, 70))])).collect()
    assert {r["doc"] for r in found} == {1, 2}
    kept = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert "passage-groups" in kept and not kept & {"passages", "passage-nodes", "run-pieces", "run-wanted"}


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(text, "CHUNK", 64)
    monkeypatch.setattr(text, "_POWERS", text.powers(65))
    long = "ab c\t" * 40 + "x" * 300 + "\né AB " + prose(1, 200)
    names, begins = text.word_hashes(long)
    words, raw = text.shingle_words(long), long.encode().lower()
    seen = {}
    assert all(raw[at : at + len(w)] == w and seen.setdefault(w, n) == n for w, n, at in zip(words, names, begins, strict=True))
    assert len(set(seen.values())) == len(seen) and seen[b"ab"] == text.word_hashes("Ab")[0][0]


def test_join_counts_tokens_where_it_names_sets(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "frequencies", None)  # no pass over the texts of its own
    found = ngram_join.joined(documents([(1, prose(1)), (2, edited(prose(1), [3])), (3, prose(2))]).repartition(3)).collect()
    assert {(r["id"], r["component"]) for r in found} == {(1, 1), (2, 1), (3, 3)}


def test_stored_tables_leave_no_shuffles(spark, documents):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    table = documents([(i, prose(i)) for i in range(50)]).repartition(3, "doc_id")
    store(table, "shuffles-first")
    before = files.getAllFiles().size()
    for _ in range(3):
        store(table, "shuffles")
    assert files.getAllFiles().size() <= before


def test_runs_by_brute_force_and_in_blocks(spark, documents):
    """Runs of texts with edits and repetitions; windows in a row that one piece stands for are one row."""
    base = [f"{w}{i}" for i, w in enumerate(prose(5, 400).split())]
    rows, big = [], 1 << 60
    for i in range(6):
        words = base[i * 20 : 300 + i * 15]
        words = [f"own{i}" if (k * 7 + i * 13) % 83 == 0 else w for k, w in enumerate(words)]
        words += ["la", "lu"] * (30 + i) + [f"end{i}"]
        rows.append((big + i, "\n".join(" ".join(words[k : k + 40]) for k in range(0, len(words), 40))))
    rows.append((big + 9, rows[0][1]))
    folder = Path(store(documents([]), "beside").path.removeprefix("file:")).parent
    before = set(folder.iterdir())
    found = {(r["doc"], r["start"], r["stop"], r["first_doc"], r["first_line"], r["removed"]) for r in passages.spans(documents(rows)).collect()}
    first, holders, expected, n = {}, defaultdict(set), set(), 0
    for d, t in rows:
        words = t.split()
        for p in range(len(words) - 49):
            first.setdefault(tuple(words[p : p + 50]), (d, p))
            holders[tuple(words[p : p + 50])].add(d)
    for d, t in rows:
        words = t.split()
        starts = [m.start() for m in re.finditer(r"\S+", t)]
        runs, last = [], None
        for p in range(len(words) - 49):
            w = tuple(words[p : p + 50])
            if len(holders[w]) > 1:
                n += 1
                name = (first[w][0], p - first[w][1])
                if last != (name, p - 1):
                    runs.append([p, p])
                runs[-1][1], last = p, (name, p)
        for a, b in runs:
            one, at = first[tuple(words[a : a + 50])]
            expected.add((d, starts[a], starts[b + 49] + len(words[b + 49]), one, at // 40, (d, a) != (one, at)))
    assert found == expected
    made = {p.name.rsplit("-", 1)[0]: p for p in set(folder.iterdir()) - before}
    assert spark.read.parquet(str(made["run-blocks"])).count() < n / 4


def test_passages_look_at_words_once(documents, monkeypatch):
    """Paragraphs and the pieces of runs come from one pass, and each shuffle of tokens is cut to those met before."""
    made, among = [], []
    own, meeting = passages.store, ngram_join.meeting
    monkeypatch.setattr(passages, "store", lambda table, purpose: made.append(purpose) or own(table, purpose))
    monkeypatch.setattr(ngram_join, "meeting", lambda *args: among.append(len(args) == 4) or meeting(*args))
    base = prose(6, 120)
    found = passages.spans(documents([(1, base), (2, f"{base} {prose(7, 20)}"), (3, prose(8, 70))]))
    assert {r["doc"] for r in found.collect()} == {1, 2}
    assert "run-wanted" in made and "run-pieces" not in made and among == [True, True]


def test_signatures_made_together_are_those_of_each_set():
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 46, 300, 700, 46)]
    sets.append(np.sort(np.concatenate([sets[1], sets[1][:9]])))  # tokens may repeat
    settings = passages.Settings()
    n, bands, bits = passages.signed(np.concatenate(sets), np.array(list(map(len, sets))), settings)
    assert n.tolist() == [1, 46, 300, 700, 46, 46]
    for row, tokens in enumerate(map(np.unique, sets)):
        assert bands[row].tolist() == passages.bands_of(tokens, *passages.tuned(settings)).tolist()
        assert bits[row] == ngram_join.bitmap_of(tokens, passages.BITMAP).tobytes()


def test_documents_of_many_batches_stay_whole_and_runs_within_lines_are_known():
    docs = [1] * 5 + [2] * 7 + [3] + [4] * 2 + [5] * 6
    for size in (1, 2, 3, 5, 21):
        table = pa.table({"doc": docs, "x": range(len(docs))})
        cut = list(passages.whole_documents(iter(table.to_batches(max_chunksize=size))))
        assert [x for b in cut for x in b["x"].to_pylist()] == list(range(len(docs)))
        assert all(a["doc"][-1] != b["doc"][0] for a, b in zip(cut, cut[1:], strict=False))
    rng = np.random.default_rng(2)

    def some(n):
        start = rng.integers(0, 60, n)
        return [rng.integers(0, 4, n) - (1 << 62), rng.integers(0, 2, n).astype(bool), start, start + rng.integers(1, 30, n)]

    runs, lines = some(300), some(40)
    rows = [list(zip(*x, strict=True)) for x in (runs, lines)]
    expected = [any(r[:2] == x[:2] and x[2] <= r[2] and r[3] <= x[3] for x in rows[1]) for r in rows[0]]
    assert passages.within(runs, lines).tolist() == expected and not passages.within(runs, some(0)).any()
