"""Top products, the prefix trie and periodic runs against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from coppice.llm import centroids, convolution, kdtree, periodic, trie
from coppice.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, label int, _row string, score int, rank int, _shard int"


def products(vectors, k=20):
    """Every query row's best rows, with missing components as zeros and 64-bit limits."""
    least, most = -(1 << 63), (1 << 63) - 1
    codes = []
    for vec_id, vector in vectors:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            codes.append((vec_id, [min(max(math.floor(64 * x), least), most) for x in vector]))
    out = Counter()
    for i, (query_id, query) in enumerate(codes):
        if query_id is None or query_id % 20:
            continue
        found = []
        for j, (vec_id, code) in enumerate(codes):
            score = min(max(sum(a * b for a, b in zip(query, code, strict=False)), least), most)
            found += [(-score, vec_id is None, vec_id or 0, vec_id)] if i != j else []
        for rank, (score, _, _, vec_id) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out[query_id, rank, vec_id, -score] += 1
    return out


@pytest.mark.parametrize(("shard_rows", "leaf_rows"), [(kdtree.SHARD_ROWS, kdtree.LEAF_ROWS), (40, 4)])
def test_top_products_equal_brute_force(spark, shard_rows, leaf_rows):
    """Ties, repeated rows and ids, nulls, infinities, other lengths, sums beyond 2^53; many shards."""
    rng = random.Random(9)
    rows = [(i, [rng.choice([-2.0, -0.5, 0.0, 0.3, 1.0]) for _ in range(6)]) for i in range(400)]
    rows += [(None, [1.0] * 6), (None, [1.0] * 6), (20, rows[3][1]), (40, rows[40][1]), (40, rows[40][1])]
    rows += [(500, None), (520, [1.0, None]), (540, [math.nan]), (560, [math.inf, 1.0]), (580, [])]
    rows += [(600, [2.0, 1.0]), (620, [1.0] * 9), (640, [1e300, -1e300, 3e15]), (641, [1e17, 2.0])]
    rows += [(660, [1e16 + 2, 1.0, 1.0]), (-20, [0.0] * 6)]
    df = spark.createDataFrame([(*r, 0, "mine", 1, 2, 3) for r in rows], VECTORS)
    got = kdtree.highest_products(df, F.col("vec_id") % 20 == 0, 20, 64, shard_rows, leaf_rows)
    assert Counter(tuple(r) for r in got.collect()) == products(rows)
    assert got.schema["rank"].dataType.simpleString() == "int"
    assert kdtree.highest_products(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_tree_boxes_are_tight_and_searches_skip_nodes():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (20, 4))
    points = centres[rng.integers(0, 20, 3000)] + rng.integers(-4, 5, (3000, 4))
    part = {
        "rows": np.arange(3000), "ids": np.arange(3000), "nameless": np.zeros(3000, bool), "points": points
    }
    arrays = kdtree.build(part, 16)
    for (start, stop), low, high in zip(arrays["spans"], arrays["low"], arrays["high"], strict=True):
        assert (arrays["points"][start:stop].min(axis=0) == low).all()
        assert (arrays["points"][start:stop].max(axis=0) == high).all()
    tree, seen = kdtree.Tree(arrays), []
    tree.child = type("Seen", (list,), {"__getitem__": lambda s, i: seen.append(i) or list.__getitem__(s, i)})(tree.child)
    (_, best), = tree.nearest({"rows": np.array([-1]), "points": centres[:1]}, [None], 20)
    exact = sorted(((-int(points[i] @ centres[0]), i) for i in range(3000)))[:20]
    assert best == [(-s, i) for s, i in exact]
    assert len(seen) < 0.3 * len(arrays["child"])


def trie_of(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    sequences = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        sequences[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[sequences[c][:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        repeated = (len(m) - 1) * len(k[-1][1].encode().split()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += repeated
            leaves[k[:d]] += children[k] == 0
    return Counter(
        (
            m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
            hashlib.sha256(",".join(str(c) for c in m if len(sequences[c]) == len(k)).encode()).hexdigest(),
        )
        for k, m in members.items()
    )


@pytest.mark.parametrize("limit", [3, 4096])
def test_trie_equals_brute_force(spark, limit, monkeypatch):
    """Shared openings, long and copied conversations, nulls, clashing names; many small components."""
    monkeypatch.setattr(trie, "PIECE", 7)
    rng = random.Random(2)
    rows = []
    for c in range(120):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9, 60 if c % 9 == 0 else 4])):
            if c != 20:
                rows.append((c, turn or None, rng.choice(["a", "b", None]), rng.choice(["x y", "x", None])))
    rows += [(c, turn, "a", f"same {turn}") for c in range(200, 240) for turn in range(30)]
    rows += [(None, 0, "a", "lost"), (60, 1, "a", "w " * 3000)]
    schema = "conv_id long, turn long, role string, text string, node int, words string, _part string"
    df = spark.createDataFrame([(*r, 1, "mine", "p") for r in rows], schema).repartition(5)
    assert Counter(tuple(r) for r in trie.prefix_trie(df, limit).collect()) == trie_of(rows)


def test_trie_of_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    got = Counter(tuple(r) for r in QUERIES["op12_prefix_trie"](spark, sf_dir).collect())
    assert got == trie_of([tuple(r) for r in rows])


def test_trie_of_repeated_turns_and_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(5, 1, "a", "x"), (5, 1, "a", "x"), (5, 1, "a", "x"), (5, 1, "a", "x"), (5, 1, "a", "x")]
    df = spark.createDataFrame(rows, schema)
    assert Counter(tuple(r) for r in trie.prefix_trie(df).collect()) == trie_of(rows)
    assert trie.prefix_trie(df.limit(0)).count() == 0


def test_centroid_sums_of_paths_stars_and_random_trees():
    rng = random.Random(4)
    shapes = [
        [0, *range(299)], [0] * 300, [0, *[rng.randrange(i) for i in range(1, 300)]], [0],
        [0, *[max(0, i - rng.choice([1, 1, 2, 9])) for i in range(1, 300)]],
    ]
    for parent in shapes:
        values = [[rng.randrange(9), rng.randrange(9)] for _ in parent]
        sums = [list(v) for v in values]
        for node in range(len(parent) - 1, 0, -1):
            sums[parent[node]] = [a + b for a, b in zip(sums[parent[node]], sums[node], strict=True)]
        assert centroids.subtree_sums(parent, values) == sums


def runs_of(words):
    n, out = len(words), []
    codes = np.unique(words, return_inverse=True)[1] if n else np.empty(0, int)
    for q in range(1, n // 3 + 1):
        equal = np.concatenate(([0], codes[:-q] == codes[q:], [0])).astype(int)
        for a, b in zip(*(np.flatnonzero(np.diff(equal) == s) for s in (1, -1)), strict=True):
            stretch, length = codes[a : b + q], int(b - a + q)
            if length >= max(24, 3 * q) and not any(
                (stretch[:-p] == stretch[p:]).all() for p in range(1, q)
            ):
                out.append((int(a), length, q))
    return sorted(out)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def digests_of(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (
        doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def test_runs_of_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect())
    assert got == Counter(digests_of(*d) for d in docs)
    assert sum(n for (_, found, *_), n in got.items() if found) > len(docs) / 20


def test_runs_of_odd_rows(spark):
    """Nested and overlapping runs, one word over and over, nulls, empty texts, repeated rows."""
    rng = random.Random(6)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a b " * 20), (None, None), (4, "word " * 1000)]
    rows += [(5, ("a b a b a b a b c " * 9)), (6, "x y z " * 9 + "y z " * 14), (6, "x y z " * 9 + "y z " * 14)]
    for i in range(40):
        words = [rng.choice("abcdefgh"[: rng.randrange(1, 9)]) for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(3)):
            p, at = rng.randrange(1, 40), rng.randrange(len(words) + 1)
            words[at:at] = (rng.choices("abcdefgh", k=p) * 7)[: rng.randrange(3 * p, 7 * p + 1)]
        rows.append((100 + i, " ".join(words)))
    schema = "doc_id long, text string, runs int, collapsed string, start long, n_runs string"
    df = spark.createDataFrame([(*r, 1, "mine", 2, "x") for r in rows], schema)
    found = periodic.digested(periodic.period_runs(periodic.with_planted_repeats(df)))
    assert Counter(tuple(r) for r in found.collect()) == Counter(digests_of(*r) for r in rows)
    assert periodic.period_runs(df.limit(0)).count() == 0


def test_convolution_finds_every_recurrence():
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 3, 600)
    starts = np.arange(0, 560, 8)
    ends = np.where(starts < 300, 300, 600)
    for length, least, most in ((1, 1, 3), (4, 1, 9), (8, 5, 30)):
        at = starts[starts + length <= ends]
        which, distance = convolution.recurrences(codes, at, ends[: len(at)], length, least, most)
        slow = [
            (i, d)
            for i, s in enumerate(at)
            for d in range(least, most + 1)
            if s + d + length <= ends[i] and (codes[s : s + length] == codes[s + d : s + d + length]).all()
        ]
        assert list(zip(which.tolist(), distance.tolist(), strict=True)) == slow
