"""Spelling variants, nearest neighbours and the conversation trie against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import burst, queries, routing, spelling

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# ---- spelling -------------------------------------------------------------------------------------------


def brute_words(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_groups(words):
    near = collections.defaultdict(set)
    deleted = collections.defaultdict(set)
    for w in words:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            deleted[key].add(w)
    for group in deleted.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda b: (-words[b], b), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]])
    return out


def spelled(df):
    rows = [(r["word"], (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_spelling_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, MIDDLE, "documents").collect()]
    want = brute_groups(brute_words(rows))
    assert spelled(queries.op11_spelling_variants(spark, MIDDLE)) == want and len(want) > 1000
    assert sum(v[0] is not None for v in want.values()) > 50


def test_spelling_edges(spark):
    rows = [
        (1, "Étudiant étudiant ÉTUDIANT " + "letters " * 300 + "lettters " * 20 + "letterss letterss lettterss lettterss"),
        (2, None),
        (3, ""),
        (4, "short words do not count, 1234567 __ !!"),
        (5, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaab aaaaaab baaaaaa baaaaaa"),
        (5, "aaaaaaa aaaaaaa"),
        (None, "nobody's nameless nameless"),
        (7, "abcdefg abcdefg " * 5000 + "x" * 3000 + " " + "x" * 3000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("word", "n", "run", "key", "root")})
    want = brute_groups(brute_words(rows))
    assert spelled(spelling.group_spellings(docs)) == want
    assert spelling.group_spellings(docs.limit(0)).count() == 0


def test_spelling_random_words(spark):
    """Few letters, so that chunks are shared by very many words; chains of forms; counts that tie."""
    rng = random.Random(3)
    words = {}
    for _ in range(1500):
        w = "".join(rng.choice("ab") for _ in range(rng.randrange(7, 12)))
        words[w] = rng.choice([2, 2, 3, 20, 20, 30, 200, 300, 2000])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got, want = spelled(spelling.group_words(frame)), brute_groups(words)
    assert got == want and any(v[1] != v[0] for v in want.values() if v[0])
    pairs = [(r["a"], r["b"]) for r in spelling.near_pairs(frame).collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs}) == sum(v[3] for v in want.values()) // 2


# ---- nearest neighbours ---------------------------------------------------------------------------------


def brute_nearest(rows, asked, k=20):
    """Scores by id of each query, best row of an id."""
    x = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in sorted({i for i in ids.tolist() if asked(i)}):
        scores = np.max([(x * x[j]).sum(axis=1) for j in np.flatnonzero(ids == q)], axis=0)
        best = {}
        for i, s in zip(ids.tolist(), scores.tolist(), strict=True):
            if i != q:
                best[i] = max(s, best.get(i, -np.inf))
        out[q] = sorted(((s, -i) for i, s in best.items()), reverse=True)[:k]
    return out


def check_search(found, want, k=20, least=0.9):
    got = collections.defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q, best in want.items():
        rows = got[q]
        assert [r for r, _, _ in rows] == list(range(1, len(best) + 1))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1])) and len({i for _, i, _ in rows}) == len(rows)
        truth = {-i: s for s, i in best}
        hits += len(truth.keys() & {i for _, i, _ in rows})
        total += len(truth)
        assert all(abs(truth[i] - s) < 1e-9 for _, i, s in rows if i in truth)
    assert set(got) <= set(want)
    assert hits >= least * total
    return hits / max(1, total)


def test_nearest_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in queries.table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    want = brute_nearest(rows, lambda i: i % 20 == 0)
    check_search(queries.op12_nearest_neighbours(spark, "/root/testdata/sf0.1"), want)


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, 16))
    return centres[rng.integers(0, 40, n)] + 0.35 * rng.normal(size=(n, 16))


def test_nearest_in_two_levels(spark):
    """Many parts, parts that are cut again, and blocks smaller than a part."""
    x = clustered(6000)
    frame = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = routing.stage(routing.usable(frame), "ann-test")
    networks, sample = routing.learn(rows, 32, 8)
    assert 1300 <= len(sample) <= 1500
    assert len(networks) > 1
    leaves = routing.index(rows, networks).groupBy("part", "sub").count().count()
    assert leaves > 16
    routed = routing.route(rows.filter("vec_id % 20 = 0").withColumn("bound", F.lit(0.0)), networks).count()
    assert routed < 0.8 * 300 * leaves  # queries do not look everywhere
    want = brute_nearest(list(enumerate(x)), lambda i: i % 20 == 0)
    check_search(routing.nearest(frame, "vec_id % 20 = 0", wished=32, parts=8, rows_side=100, queries_side=50), want)


def test_nearest_beyond_the_sample(spark, monkeypatch):
    """A sample that is a small part of the rows: bounds prune, and nothing that was found is lost."""
    monkeypatch.setattr(routing, "SAMPLE", 500)
    x = clustered(6000, 5)
    frame = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = brute_nearest(list(enumerate(x)), lambda i: i % 20 == 0)
    check_search(routing.nearest(frame, "vec_id % 20 = 0", wished=400, parts=8), want)


def test_nearest_edges(spark):
    x = clustered(300, 2)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # equal vectors: ties to smaller ids
    rows += [(20, rows[21][1]), (5, rows[5][1]), (5, rows[6][1])]  # repeated ids
    out = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [float("inf"), *[1.0] * 15]), (2080, [None, *[1.0] * 15]), (2100, [1.0]), (2120, []), (None, rows[0][1])]
    frame = spark.createDataFrame(rows + out, "vec_id long, embedding array<double>").withColumns({c: F.lit("?") for c in ("v", "part", "sub", "query_id", "q", "d")})
    got = routing.nearest(frame, "vec_id % 20 = 0")
    check_search(got, brute_nearest(rows, lambda i: i % 20 == 0))
    assert routing.nearest(frame.limit(0), "vec_id % 20 = 0").count() == 0
    assert routing.nearest(frame.filter("vec_id = 40"), "vec_id % 20 = 0").count() == 0
    assert {f.name: f.dataType.typeName() for f in got.schema} == {f.name: f.dataType.typeName() for f in routing.nearest(frame.limit(0), "true").schema}


def test_parts_are_balanced():
    x = clustered(2000, 3)
    edges = routing.nearest_in(x, 8)
    part = routing.balanced_parts(x, edges, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.max() <= -(-2000 * 21 // 160) and sizes.min() > 0
    cut = (part[:, None] != part[edges]).mean()
    rng = np.random.default_rng(0)
    assert cut < 0.5 * (rng.permutation(part)[:, None] != part[edges]).mean()


# ---- conversation trie ----------------------------------------------------------------------------------


def brute_trie(convs):
    """convs: {conv_id: [(role, text), ...]}"""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in children[node])
    out = []
    for node, ids in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        up = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), up, len(ids), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_rebuilt(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def nodes(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", [SMALL, MIDDLE])
def test_trie_whole_table(spark, sf):
    rows = [tuple(r) for r in queries.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = brute_trie(brute_rebuilt(rows))
    assert nodes(queries.op13_conversation_trie(spark, sf)) == want and len(want) > 40


def test_trie_bursts(spark):
    """Containers burst in several rounds, along long shared histories, with ends on the way and copies."""
    rng = random.Random(4)
    common = [("user", f"common {k}") for k in range(30)]
    convs = {}
    for c in range(400):
        turns = list(common[: rng.choice([0, 5, 30])]) + [(rng.choice("ua"), rng.choice(["x", "yy", "", "\U0001f600z"])) for _ in range(rng.randrange(8))]
        convs[c] = turns
    for c in range(400, 700):
        convs[c] = convs[17]
    convs[9999] = [("u", f"turn {k}") for k in range(3000)]
    rows = [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    own = burst.sequences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    empty = [(c,) for c, turns in convs.items() if not turns]
    own = own.unionByName(spark.createDataFrame(empty, "conv_id long").withColumn("cells", F.unhex(F.lit(""))))
    want = brute_trie(convs)
    for container in (1, 8, 60, 100_000):
        assert nodes(burst.prefix_trie(own, container)) == want


def test_trie_edges(spark):
    rows = [
        (100, None, "user", "null turn first"), (100, 3, "user", "b"), (100, 3, "user", "a"), (100, 3, "assistant", "z"), (100, 1, None, None), (100, 1, None, None),
        (101, 0, "user", "only"), (102, 0, "user", "x"), (102, 1, "user", "y"), (7, 0, "user", "no base"), (8, 0, "", ""), (None, 0, "user", "nobody"), (None, 1, "user", "nobody"),
        *[(150, k, "user", "long " * (k % 50)) for k in range(400)], *[(c, k, "user", "same") for c in range(200, 260) for k in range(7)],
        (5000, 0, "user", "w" * 100_000), (5000, 0, "user", "w" * 100_000),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("?") for c in ("head", "cells", "n", "path", "depth", "conv")})
    assert nodes(burst.conversation_trie(frame)) == brute_trie(brute_rebuilt(rows))
    assert burst.conversation_trie(frame.limit(0)).count() == 0
