"""Ranked search, the prefix trie and vector search against brute force, with nulls, empty and long texts, ties, repeats, clashing columns and empty tables."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from issuetrail.llm import prefix_trie, ranked_search, vector_search

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

# Ranked search ------------------------------------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked_plainly(docs, items, k=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, every = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 75 + 25 * sum(c.values()) * n // every
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, 2**63 - 1 if doc_id is None else doc_id))
        found += [(item_id, rank, None if d == 2**63 - 1 else d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def ranked(spark, docs, items, **more):
    rows = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, block int, term string")
    asked = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, shard int, weight string")
    return sorted((tuple(r) for r in ranked_search.ranked(rows, asked, **more).collect()), key=repr)


def some_documents(seed, n):
    pick = random.Random(seed)
    vocabulary = ["the", "The", "of", "Éa", "éa", "naïve", "x1", "1", "漢字", "\U0001f600", "a-b", "e'f"] + [f"w{i}" for i in range(60)]
    docs = [(i, pick.choice([" ", "\n", ", "]).join(pick.choices(vocabulary, k=pick.randint(1, 60)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " \t.-"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (3, "w1 w1 w4"), (5, docs[5][1]), (n + 3, " ".join(["w7 w8"] * 30_000))]
    # many equal texts: their ties reach past the last rank
    return docs + [(1000 - i, "W9, w10 w9") for i in range(50)]


def test_ranking_is_that_of_brute_force(spark):
    docs = some_documents(1, 120)
    items = [(1, "w9 w10"), (2, "the The of W1 w1 w1"), (3, None), (4, "..."), (5, "nowhere"), (5, "w3 éa 漢字 Éa"), (None, "w7"), (7, "w9 " * 500)]
    expected = ranked_plainly(docs, items)
    assert ranked(spark, docs, items) == expected
    assert ranked(spark, docs, items, block_terms=3, block_items=2, tile_terms=2, tile_documents=7, shard_terms=20_000) == expected


def test_terms_in_all_documents_give_no_rank(spark):
    docs = [(i, "a b") for i in range(3)]
    assert ranked(spark, docs, [(1, "a")]) == ranked_plainly(docs, [(1, "a")])


def test_empty_tables_rank_nothing(spark):
    assert ranked(spark, [], [(1, "a")]) == [] == ranked(spark, [(1, "a")], [])
    assert ranked(spark, [(1, None)], [(1, "a")]) == []


def test_tiles_stay_exact_past_the_bound_of_doubles():
    weights = np.array([2**40, 2**32, 3, 5])
    block = ranked_search._Block(np.array([0, 0, 1, 1]), ["a", "b", "b", "c"], weights, 20, 2048)
    assert len(block.tiles) == 3 and [tile.dtype.kind for _, tile in block.tiles] == ["i", "f", "f"] or len(block.tiles) > 1
    found = block.scores(np.array([75, 90]), ["a b", "c b zz"], [np.array([9, 1], "<i4").tobytes(), np.array([2, 3, 1], "<i4").tobytes()])
    impact = lambda tf, m: 10**9 * tf // (1000 * tf + 12 * m)
    assert found.tolist() == [[2**40 * impact(9, 75) + 2**32 * impact(1, 75), 2**32 * impact(3, 90)], [3 * impact(1, 75), 3 * impact(3, 90) + 5 * impact(2, 90)]]


# Prefix trie --------------------------------------------------------------------------------------------


def trie_plainly(rows):
    own = {}
    # equal turn numbers are told apart by a hash
    key = lambda r: hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    for conv_id, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, key(r))):
        own.setdefault(conv_id, []).append((role or "", text or ""))
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
        for d in range(len(rebuilt) + 1):
            members.setdefault(tuple(rebuilt[:d]), []).append(c)
        ends.setdefault(tuple(rebuilt), []).append(c)
    children = Counter(path[:-1] for path in members if path)
    saved, leaves = Counter(), Counter()
    for path, found in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(found) - 1) * len(path[-1][1]) if path else 0
            leaves[path[:d]] += not children[path]
    digest = lambda path: hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
    parent = lambda path: min(members[path[:-1]]) if path else None
    nodes = [(min(found), len(path), parent(path), len(found), children[path], leaves[path], saved[path], digest(path)) for path, found in members.items()]
    return sorted(nodes, key=repr)


def trie(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 1, b"x", 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, chain binary, n_convs int")
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(frame, **more).collect()), key=repr)


def conversations(seed):
    pick = random.Random(seed)
    roles, texts = ["user", "assistant", "", None], ["", "a", "ab", None, "é\U0001f600"]
    rows = []
    for c in [0, 1, 2, 3, 4, 7, 99, 100, 101, 205, 206, 207, 208, 300, -7, -100, -250, 10**15 + 1]:
        rows += [(c, t, pick.choice(roles), pick.choice(texts)) for t in range(pick.randint(1, 9))]
    # one far longer than the others, a copy of it, and many copies of a short one
    long = [(t, "user" if t % 2 else "assistant", f"t{t % 5}") for t in range(150)]
    rows += [(c, *turn) for c in (400, 500, 601) for turn in long]
    rows += [(c, t, "user", "same") for c in range(700, 790) for t in range(3)]
    # null and equal turn numbers, a repeated row, rows without a conversation
    return rows + [(800, None, "user", "z"), (800, 1, "b", "2"), (800, 1, "a", "1"), (800, 1, "a", "1"), (None, 0, "user", "lost"), (None, None, None, None)]


@pytest.mark.parametrize("band", [1, 40, 64])
def test_trie_is_that_of_brute_force(spark, band):
    rows = conversations(5)
    if band == 1:
        rows = [r for r in rows if (r[1] or 0) < 12]
    assert trie(spark, rows, band=band) == trie_plainly(rows)


def test_turnless_conversations_are_at_the_root(spark):
    # 205 has no base and too few turns of its own
    turnless = next(c for c in range(201, 300) if prefix_trie.kept_turns(c) >= 2)
    rows = [(turnless, 0, "user", "a"), (turnless, 1, "user", "b")]
    assert trie(spark, rows) == trie_plainly(rows) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_an_empty_table_has_no_trie(spark):
    assert trie(spark, []) == [] == trie(spark, [(None, 0, "user", "a")])


def test_peeling_in_parts_merges(spark, monkeypatch):
    rows = conversations(6)
    whole = prefix_trie._peeled
    monkeypatch.setattr(prefix_trie, "_peeled", lambda *a: whole(*a, chars=100))
    assert trie(spark, rows) == trie_plainly(rows)


# Vector search ------------------------------------------------------------------------------------------


def searched_plainly(rows, k=5):
    whole = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((n, i, [math.floor(256 * x) for x in v]))
    found = []
    for n, i, v in whole:
        if i is None or i % 50:
            continue
        scored = []
        for m, j, w in whole:
            if m != n and len(w) == len(v):
                score = min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63)), 2**63 - 1)
                scored.append((-score, 2**63 - 1 if j is None else j))
        found += [(i, rank, None if j == 2**63 - 1 else j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def searched(spark, rows, kind="float", **more):
    frame = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], f"vec_id long, embedding array<{kind}>, row int, shelf string, r double")
    return sorted((tuple(r) for r in vector_search.top_k(frame, **more).collect()), key=repr)


def vectors(seed, n, dim=8):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, dim))
    found = centres[pick.integers(0, 6, n)] + pick.normal(size=(n, dim)) * 0.1
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(found)]


def test_vector_search_is_that_of_brute_force(spark):
    rows = vectors(1, 700)
    copied = rows[3][1]
    rows += [(1000 + i, copied) for i in range(220)] + [(50, rows[9][1]), (50, rows[9][1]), (None, rows[0][1]), (100, rows[1][1])]
    rows += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (2200, []), (2250, []), (2300, [1.0, 2.0]), (2301, [3.0, -1.5])]
    expected = searched_plainly(rows)
    assert searched(spark, rows) == expected
    assert searched(spark, rows, pivots=3, sample=10, shelf_numbers=200, ring=16) == expected


def test_large_components_are_exact(spark):
    pick = random.Random(3)
    rows = [(i * 10, [pick.uniform(-1, 1) * 10.0 ** pick.randint(0, 9) for _ in range(5)]) for i in range(40)]
    rows += [(4000, [1e200, 0.0, 0.0, 0.0, 1.0]), (4001, [1e200, 1.0, 0.0, 0.0, 1.0]), (4002, [-1e300, 1.0, 0.0, 0.0, 1.0])]
    assert searched(spark, rows, "double") == searched_plainly(rows)


def test_few_vectors(spark):
    assert searched(spark, []) == [] == searched(spark, [(0, [1.0])])
    assert searched(spark, [(0, [1.0]), (7, [-1.0])]) == [(0, 1, 7, -65536)]


def test_rings_that_cannot_reach_are_passed_over():
    """The bound is never below a true product, and far rings are below the k-th score."""
    pick = np.random.default_rng(0)
    numbers = np.floor(256 * np.concatenate([pick.normal(size=(40, 4)) * 0.05 + c for c in ([3, 0, 0, 0], [0, 3, 0, 0], [0, 0, -3, 0])]))
    pivot = numbers[:1]
    order = np.argsort(vector_search.distances(numbers, pivot)[:, 0])
    numbers = numbers[order]
    r = vector_search.distances(numbers, pivot)[:, 0]
    rows = {"row": range(120), "vec_id": range(120), "dim": 4, "key": r, "norm": np.sqrt((numbers**2).sum(1)), "v": [vector_search._packed(x) for x in numbers]}
    shelf = vector_search._Shelf(vector_search.pd.DataFrame(rows), 5, 10)
    bound = shelf.bounds(np.asarray(rows["norm"]), r)
    products = vector_search.products(numbers, numbers)
    assert (np.repeat(bound, 10, axis=1) >= products).all()
    kth = np.sort(products[:40], axis=1)[:, -6]
    assert (bound[:40, 8:] < kth[:, None]).mean() > 0.9
