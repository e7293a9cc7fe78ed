"""The operators against brute force, exact round trips or held-out accuracy, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from issuetrail.llm import chat_format, components, decontamination, fingerprints, language_model, line_dedup, mixing, near_dedup, personal_data, toxicity, url_filter

DOCS = "doc_id long, text string, source string, n_chars long, word string, hash string, size int"
WORDS = ["the", "of", "and", "river", "stone", "market", "engine", "cloud", "paper", "silver", "garden", "winter"]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n))


def documents(spark, texts):
    """Ids 0, 1, ...; columns that clash with names used inside."""
    rows = [(i, t, f"s{i % 3}", None if t is None else len(t), "w", "h", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd(spark):
    """Nulls, empty and blank texts, a very long one, equal rows, and an id with two texts."""
    texts = [prose(1, 60), None, "", "  \n\t ", prose(2, 20_000), "one", prose(1, 60), "Éa ß \U0001f600 b\nc"]
    some = documents(spark, texts)
    more = spark.createDataFrame([(0, texts[0], "s0", 1, "w", "h", 1), (3, "other text here", None, 1, "w", "h", 1), (None, "no id at all", "s1", 1, None, None, None), (None, None, None, None, None, None, None)], DOCS)
    return some.union(more)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# Fingerprints -------------------------------------------------------------------------------------------


def weighted_votes(text):
    """128 bits, each pair of words voting with its length."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
    pairs = [" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))] if words else []
    signed = lambda term, seed: xxhash.xxh64_intdigest(term, seed=seed)
    total, found = sum(map(len, pairs)), ""
    for second in (False, True):
        bits = [0] * 64
        for term in pairs:
            value = signed(term, 42)
            # the second word hashes an integer 1 with the first as its seed
            value = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed=value) if second else value
            for bit in range(64):
                bits[bit] += (value >> bit & 1) * len(term)
        found += f"{sum(1 << bit for bit in range(64) if 2 * bits[bit] > total):016x}"
    return found


def cosine(a, b):
    return max(0.0, math.cos(math.pi * (int(a, 16) ^ int(b, 16)).bit_count() / 128))


def test_edits_and_equal_texts(spark):
    found = fingerprints.fingerprint_edits(odd(spark)).collect()
    texts = {}
    for r in odd(spark).collect():
        key = -(2**63) if r["doc_id"] is None else r["doc_id"]
        texts.setdefault(key, []).append(r["text"] or "")
    longest = {k: max(v, key=len) for k, v in texts.items()}
    order = sorted(texts, reverse=True)
    assert len(found) == odd(spark).count()
    expected = []
    for key, of_id in texts.items():
        after = longest[order[(order.index(key) + 1) % len(order)]]
        for text in of_id:
            half = len(text) // 2
            changed = text[: len(text) - half] + after[:half]
            own, other = weighted_votes(text), weighted_votes(changed)
            near = round(cosine(own, other), 9), round(cosine(own, weighted_votes(after)), 9)
            expected.append((None if key == -(2**63) else key, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other, *near))
    rows = [(*r[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[0]["fingerprint"] == by_id[6]["fingerprint"] != by_id[4]["fingerprint"]
    assert by_id[1]["fingerprint"] == "0" * 32
    assert fingerprints.fingerprint_edits(empty(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_near_pairs_finds_all(spark, radius):
    pick = random.Random(5)
    base = [pick.getrandbits(128) for _ in range(40)]
    values = set(base)
    for b in base:
        for flips in range(1, 6):
            v = b
            for bit in pick.sample(range(128), flips):
                v ^= 1 << bit
            values.add(v)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(v & (2**64 - 1)), signed(v >> 64)) for v in values]
    found = fingerprints.near_pairs(spark.createDataFrame(rows, "w0 long, w1 long"), ["w0", "w1"], radius).collect()
    ordered = sorted(values)
    expected = sum((a ^ b).bit_count() <= radius for i, a in enumerate(ordered) for b in ordered[:i])
    assert len(found) == expected == len({tuple(sorted([(r["a_w0"], r["a_w1"]), (r["b_w0"], r["b_w1"])])) for r in found})


# Near-dedup ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("radius", [0, 2, 3, 5])
def test_sliced_links_are_all_links(radius):
    pick = np.random.default_rng(radius)
    base = pick.integers(0, 2**63, 12).astype(np.uint64)
    prints = np.repeat(base, 17) ^ (np.uint64(1) << pick.integers(0, 64, 204).astype(np.uint64)) ^ (np.uint64(1) << pick.integers(0, 64, 204).astype(np.uint64))
    block = np.sort(pick.integers(0, 3, 204))
    ends = np.append(np.flatnonzero(np.diff(block)), 203)
    left = ends[np.searchsorted(ends, np.arange(204))] - np.arange(204)
    found = {(int(a), int(b)) for x, y in near_dedup.sliced_links(prints, left, radius) for a, b in zip(x, y, strict=True)}
    assert found == {(i, j) for i in range(204) for j in range(i + 1, 204) if block[i] == block[j] and int(prints[i] ^ prints[j]).bit_count() <= radius}


@pytest.mark.parametrize("block_rows", [2048, 8])
def test_groups_are_those_of_brute_force(spark, block_rows):
    """With small blocks, buckets are split down to the last bits."""
    pick = random.Random(9)
    values = [pick.getrandbits(64) for _ in range(30)]
    for v in list(values[:6]):
        for _ in range(40):
            v ^= 1 << pick.randrange(64)
            values.append(v)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    edges = near_dedup.print_links(spark.createDataFrame([(v, i) for i, v in enumerate(values)], "print long, node long"), 3, block_rows)
    found = {r["u"]: r["v"] for r in components.components(edges).collect()}
    root = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if ((a ^ values[j]) & (2**64 - 1)).bit_count() <= 3:
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    assert [found.get(i, i) for i in range(len(values))] == root


def test_one_document_of_each_group_stays(spark):
    frame = odd(spark)
    kept = near_dedup.deduplicate(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"], r["text"]) for r in rows if r["doc_id"] in (0, 6)), key=str) == [(False, 0, prose(1, 60))]
    groups = near_dedup.near_groups(frame).collect()
    assert {r["component_id"] for r in groups if r["doc_id"] in (0, 6)} == {0}
    # null, empty and blank texts have the same fingerprint
    assert {r["component_id"] for r in groups if r["doc_id"] in (1, 2)} == {1}
    assert len(rows) == len({r["component_id"] if r["component_id"] is not None else r["print"] for r in groups})
    assert near_dedup.deduplicate(empty(spark)).count() == 0 and near_dedup.near_groups(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(50)] + [(7, 7), (60, 61), (61, 60)]
    found = {r["u"]: r["v"] for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 51)}, 61: 60}


# Line dedup ---------------------------------------------------------------------------------------------


def test_repeated_runs_go(spark):
    shared = "\n".join(prose(100 + i, 20) for i in range(3))
    texts = [f"{prose(1, 9)}\n{shared}\n{prose(2, 9)}", f"{prose(3, 9)}\n{shared}", f"{prose(4, 9)}\n{shared.splitlines()[0]}\n{prose(5, 9)}", None, "", shared, "a\nb", "a\nb"]
    frame = documents(spark, texts)
    result = line_dedup.remove_repeated(frame)
    assert result.columns == [*frame.columns, "removed_lines"]
    found = {r["doc_id"]: r for r in result.collect()}
    assert found[0]["text"] == texts[0] and found[2]["text"] == texts[2] and found[3]["text"] is None and found[4]["text"] == ""
    assert found[1]["text"] == prose(3, 9) and found[1]["n_chars"] == len(prose(3, 9)) and found[1]["removed_lines"] == 3
    assert found[5]["text"] == "" and found[7]["text"] == "a\nb"
    assert line_dedup.remove_repeated(odd(spark)).count() == odd(spark).count()
    assert line_dedup.remove_repeated(empty(spark)).count() == 0


def test_runs_of_short_lines_go_whole(spark):
    """20 lines of 17 characters, which no pair of 40 is in, among long ones too; a short run stays."""
    verse = "\n".join(f"line {i:02d} of verse" for i in range(20))
    mixed = f"{prose(1, 9)}\n{prose(2, 9)}\na\nb\nc\n{prose(3, 9)}\n{prose(4, 9)}"
    texts = [f"{prose(5, 9)}\n{verse}", f"{prose(6, 9)}\n{verse}\n{prose(7, 9)}", mixed, f"{prose(8, 9)}\n{mixed}", "x\ny\nz", "w\nx\ny\nz"]
    found = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated(documents(spark, texts)).collect()}
    assert found[0] == texts[0] and found[1] == f"{prose(6, 9)}\n{prose(7, 9)}"
    assert found[2] == mixed and found[3] == prose(8, 9) and found[4] == "x\ny\nz" and found[5] == "w\nx\ny\nz"


def without_repeated_runs(texts):
    """Every run of lines against all before it."""
    seen, cleaned = set(), []
    for text in texts:
        lines, gone = text.split("\n"), set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                run = "\n".join(lines[i : j + 1])
                if len(run) >= (40 if j > i else 200):
                    gone |= set(range(i, j + 1)) if run in seen else set()
                    seen.add(run)
        cleaned.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return cleaned


@pytest.mark.parametrize("divisor", [1, 2, 5, 1000])
def test_what_goes_does_not_depend_on_the_chunks(spark, divisor):
    pick = random.Random(divisor)
    lines = ["", "a", "bb"] + [prose(i, 1) for i in range(6)] + [prose(i, 4) for i in range(6)] + [prose(7, 60), prose(8, 80)]
    shared = [[pick.choice(lines) for _ in range(n)] for n in (2, 3, 5, 9, 30)]
    texts = []
    for _ in range(60):
        parts = [pick.choice(shared) if pick.random() < 0.4 else pick.choices(lines, k=pick.randint(1, 4)) for _ in range(pick.randint(1, 4))]
        texts.append("\n".join(x for part in parts for x in part))
    found = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated(documents(spark, texts), divisor=divisor).collect()}
    assert [found[i] for i in range(len(texts))] == without_repeated_runs(texts)


def test_runs_that_were_not_repeated_together_stay(spark):
    """Short pairs that overlap, each from another text, make a run that stands nowhere else; a long line goes alone, a shorter one doesn't."""
    a, b, c, d = "first line here", "second line", "third line", "fourth line"
    texts = [f"{a}\n{b}", f"{b}\n{c}", f"{c}\n{d}", "\n".join([prose(1, 9), a, b, c, d, prose(2, 9)])]
    long, short = "x" * 400, "y" * 150
    texts += [f"{prose(i, 9)}\n{long}\n{short}{i}" for i in range(3)] + [f"{prose(10 + i, 9)}\n{short}\n{prose(20 + i, 9)}" for i in range(2)]
    found = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated(documents(spark, texts)).collect()}
    assert [found[i] for i in range(5)] == texts[:5] and [found[i] for i in (7, 8)] == texts[7:]
    assert found[5] == texts[5].replace(f"{long}\n", "") and found[6] == texts[6].replace(f"{long}\n", "")


def test_runs_that_share_a_hash_are_told_apart(spark, monkeypatch):
    """With a hash that knows widths only for the first seed, all is done again with another."""
    whole = line_dedup.profile
    blind = F.udf(lambda hashes: b"\0" * len(hashes), "binary")
    monkeypatch.setattr(line_dedup, "profile", lambda rows, seed: whole(rows, seed) if seed else whole(rows, seed).withColumn("hashes", blind("hashes")))
    texts = [f"{prose(1, 9)}\n{prose(2, 9)}", f"{prose(1, 9)[::-1]}\n{prose(2, 9)[::-1]}", f"{prose(1, 9)}\n{prose(2, 9)}"]
    found = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated(documents(spark, texts)).collect()}
    assert [found[i] for i in range(3)] == [texts[0], texts[1], ""]


# Mixing -------------------------------------------------------------------------------------------------


def test_mixture_has_the_target_shares(spark):
    rows = [(i, "x", "a" if i % 10 else ("b" if i % 20 else None), 1, "w", "h", 1) for i in range(6000)]
    frame = spark.createDataFrame(rows, DOCS)
    mixed = mixing.replicate(frame, {"b": 0.5})
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["b"] / 6000 - 0.5) < 0.04 and abs(sum(counts.values()) / 6000 - 1) < 0.06
    again = mixing.replicate(frame, {"b": 0.5}).collect()
    assert again == mixed.collect() == mixing.replicate(frame, {"b": 0.5}, most_sent=0).collect()
    assert mixing.replicate(odd(spark), {"s0": 0.9}).columns == [*DOCS.replace(" long", "").replace(" string", "").replace(" int", "").split(", "), "copy"]
    assert mixing.replicate(empty(spark), {"s0": 0.9}).count() == 0


@pytest.mark.parametrize("rate", [0.1, 1.0, 7.5, 300.0])
def test_steps_are_the_poisson_distribution(spark, rate):
    steps = spark.range(1).select(mixing.poisson_steps(F.lit(rate)).alias("s")).first()["s"]
    pmf = np.diff(np.array([0.0, *steps]))
    assert abs(pmf.sum() - 1) < 1e-9 and abs((pmf * np.arange(len(pmf))).sum() - rate) < 1e-6 * rate


def test_rare_sources_are_drawn_in_parts(spark):
    """One row at a rate of 700 and one at 2,100."""
    rows = [(i, "x", "src0" if i == 7 else "src1" if i == 8 else "other", 1, "w", "h", 1) for i in range(7000)]
    frame = spark.createDataFrame(rows, DOCS)
    counts = {r["source"]: r["count"] for r in mixing.replicate(frame, {"src0": 0.1, "src1": 0.3}).groupBy("source").count().collect()}
    assert abs(counts["src0"] - 700) < 5 * 700**0.5 and abs(counts["src1"] - 2100) < 5 * 2100**0.5
    assert {r["source"]: r["count"] for r in mixing.replicate(frame, {"src0": 0.1, "src1": 0.3}, most_sent=0).groupBy("source").count().collect()} == counts


# Decontamination ----------------------------------------------------------------------------------------


def edited(text, edits, seed):
    pick = random.Random(seed)
    chars = list(text)
    for _ in range(edits):
        at = pick.randrange(len(chars))
        chars[at : at + 1] = pick.choice([[], ["z"], [chars[at], "y"]])
    return "".join(chars)


def test_passages_with_edits_are_found(spark):
    items = [prose(1000 + i, 30) for i in range(20)]
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "tiny"), (0, items[0])], "item_id long, text string")
    texts = [f"{prose(i, 50)} {edited(items[i % 20], int(0.05 * len(items[i % 20])) if i % 2 else 0, i).upper()} {prose(i + 500, 50)}" for i in range(200)]
    clean = [prose(5000 + i, 150) for i in range(100)] + [items[0][: len(items[0]) // 2], None, "", prose(7, 20_000)]
    frame = documents(spark, texts + clean)
    found = {r["doc_id"]: r["benchmark_items"] for r in decontamination.contaminated(frame, benchmark).collect()}
    assert sum(i % 20 in found[i] for i in range(200)) >= 198
    assert all(not found[i] for i in range(200, len(texts) + len(clean)))
    kept = decontamination.decontaminate(frame, benchmark)
    assert kept.columns == frame.columns and kept.count() >= len(clean)
    assert decontamination.contaminated(odd(spark), benchmark.limit(0)).where(F.size("benchmark_items") > 0).count() == 0
    split = decontamination.contaminated(frame, benchmark, block_chars=700).select("doc_id", "benchmark_items")
    assert {r["doc_id"]: r["benchmark_items"] for r in split.collect()} == found


@pytest.mark.parametrize("size", [1000, 3000, 10_000])
def test_long_items_with_edits_are_found(size):
    """Edits at a twentieth of the bytes, at random places, in prose that begins within another text."""
    items, texts, n = [], [], 24_000 // size if size > 1000 else 24
    for i in range(n):
        item = prose(size + i, size // 5)[:size]
        items.append((i, item))
        pick = random.Random(i)
        changed = list(item)
        for k in pick.sample(range(size), int(0.05 * size)):
            changed[k] = pick.choice(["", "#", changed[k] + "~"])
        texts.append(f"{prose(i + 5000, 30)} {''.join(changed)} {prose(i + 6000, 30)}")
    met = decontamination.Block(items, 0.05, 0.99).met_by([*texts, *(prose(i + 7000, size // 5) for i in range(2))])
    assert sum(i in met[i] for i in range(n)) >= n - (n == 24)
    assert not any(met[n:])


@pytest.mark.parametrize("size, share", [(32, 0.05), (40, 0.05), (47, 0.05), (63, 0.05), (100, 0.05), (300, 0.05), (40, 0.2)])
def test_every_item_keeps_a_seed(size, share):
    """Substitutions at the worst places: evenly spaced."""
    pick = random.Random(size)
    item = "".join(pick.choice("abcdefghijklmnop") for _ in range(size))
    edits = int(share * size)
    edited = list(item)
    for k in range(1, edits + 1):
        edited[k * (size - edits) // (edits + 1) + k - 1] = "#"
    length = decontamination.seed_size([size], share)
    codes = [set(decontamination.seeds(decontamination.folded(t), length).tolist()) for t in (item, "".join(edited))]
    assert codes[0] & codes[1]
    assert decontamination.holds(item.encode(), "".join(edited).encode(), edits)


def test_short_items_with_edits_are_found(spark):
    pick = random.Random(4)
    items = ["".join(pick.choice("abcdefghijklmnop ") for _ in range(47)) for _ in range(30)]
    texts = [f"{prose(i, 30)} {t[:15]}#{t[16:31]}#{t[32:]} {prose(i + 50, 30)}" for i, t in enumerate(items)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontamination.contaminated(documents(spark, texts), benchmark).collect()
    assert sum(r["doc_id"] in r["benchmark_items"] for r in found) >= 29


@pytest.mark.parametrize("size", [20, 28])
def test_one_edit_in_a_short_item_is_found(spark, size):
    pick = random.Random(size)
    items = ["".join(pick.choice("abcdefghijklmnop ") for _ in range(size)) for _ in range(60)]
    cuts = [pick.randrange(1, size - 1) for _ in items]
    texts = [f"{prose(i, 30)} {t[:at]}{['#', '', t[at] + '#'][i % 3]}{t[at + 1 :]} {prose(i + 90, 30)}" for i, (t, at) in enumerate(zip(items, cuts, strict=True))]
    # half of the items have no id
    benchmark = spark.createDataFrame([(i if i % 2 else None, t) for i, t in enumerate(items)], "item_id long, text string")
    frame = documents(spark, [*texts, prose(900, 40)])
    found = {r["doc_id"]: r["benchmark_items"] for r in decontamination.contaminated(frame, benchmark).collect()}
    assert sum((i if i % 2 else None) in found[i] for i in range(60)) >= 58 and not found[60]
    split = decontamination.contaminated(frame, benchmark, block_chars=20 * size).collect()
    assert {r["doc_id"]: set(r["benchmark_items"]) for r in split} == {i: set(ids) for i, ids in found.items()}


@pytest.mark.parametrize("seed", range(20))
def test_holds_is_the_edit_distance_to_a_substring(seed):
    pick = random.Random(seed)
    item = "".join(pick.choice("abc") for _ in range(12))
    region = "".join(pick.choice("abc") for _ in range(30))
    row = [0] * 31
    for i, a in enumerate(item, 1):
        row, before = [i], row
        for j, b in enumerate(region, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    for edits in range(6):
        assert decontamination.holds(item.encode(), region.encode(), edits) == (min(row) <= edits)


# Toxicity -----------------------------------------------------------------------------------------------


def test_held_out_toxic_texts_are_told_apart(spark):
    bad = ["vilewort", "grubface", "muckhead"]
    rows, marks = [], []
    for i in range(400):
        text = prose(i, 40 + i % 50)
        if i % 5 == 0:
            text = f"{text[:50]} {bad[i % 3].upper() if i % 2 else bad[i % 3] + 'ly'}! {text[50:]}"
        rows.append(text)
        marks.append((i, 1, int(i % 5 == 0)))
    frame = documents(spark, rows)
    labels = spark.createDataFrame([*marks, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame.where(~toxicity.held_out()), labels)
    scored = {r["doc_id"]: r for r in toxicity.score(frame, model).collect()}
    assert np.mean([(scored[i]["toxicity"] >= 0.7) == (i % 5 == 0) for i in range(400)]) >= 0.98
    start, end = scored[5]["toxic_spans"][0]
    assert rows[5][start:end].lower().startswith("muckhead")
    assert toxicity.score(odd(spark), model).count() == odd(spark).count()
    assert toxicity.reject_toxic(frame, labels).columns == frame.columns
    untold = toxicity.fit(empty(spark), labels)
    assert {r["toxicity"] for r in toxicity.score(odd(spark), untold).collect()} == {0.0}


def test_marginals_are_those_of_all_paths():
    pick = np.random.default_rng(3)
    emission, moves = pick.normal(0, 2, 9), np.array([[1.0, 0.4], [0.7, 2.5]])
    begins = np.array([True, False, False, False, False, True, False, False, False])
    total, sums = 0.0, np.zeros(9)
    for path in range(512):
        y = [path >> i & 1 for i in range(9)]
        weight = 1.0
        for t in range(9):
            weight *= np.exp(emission[t] * y[t]) * (np.exp(0.3 * y[t]) if begins[t] else moves[y[t - 1], y[t]])
        total += weight
        sums += weight * np.array(y)
    p, _, _ = toxicity.forward_backward(emission, begins, moves, 0.3)
    assert np.allclose(p, sums / total)


# Language model -----------------------------------------------------------------------------------------


def test_probabilities_of_a_context_sum_to_one():
    texts = [prose(i, 30) for i in range(20)]
    grams, _ = language_model.events(texts)
    levels = []
    for k in range(language_model.ORDER + 1):
        levels.append(np.unique(grams & ((1 << 9 * (k + 1)) - 1), return_counts=True))
    trie = language_model.Trie(levels)
    contexts = [int(grams[7]) >> 9, int(grams[100]) >> 9, 5 << 9 * 4 | int(grams[50]) >> 9 & (1 << 36) - 1, 0, 300]
    for context in contexts:
        scores = trie.score(np.array([context << 9 | s for s in range(257)]))
        assert abs((10**scores).sum() - 1) < 1e-9


@pytest.mark.parametrize("most_grams", [20, 2_000_000])
def test_scores_are_those_of_the_whole_trie(spark, most_grams):
    """However few n-grams are sent to the tasks."""
    texts = [prose(i, 30 + i) for i in range(12)] + ["Zebra quartz \x01\x02", "", "the ", "\u00e9\u00e9"]
    frame = documents(spark, [*texts, texts[3]])
    held = {1, 5, 12, 15}
    grams, _ = language_model.events([t for i, t in enumerate([*texts, texts[3]]) if i not in held])
    trie = language_model.Trie([np.unique(grams & ((1 << 9 * (k + 1)) - 1), return_counts=True) for k in range(language_model.ORDER + 1)])
    found = {r["doc_id"]: r["score"] for r in language_model.score(frame, ~F.col("doc_id").isin(*held), most_grams=most_grams).collect()}
    for i, text in enumerate([*texts, texts[3]]):
        assert abs(found[i] - trie.score(language_model.events([text])[0]).sum()) < 1e-6


def test_base_is_exact_and_all_rows_stay(spark):
    frame = odd(spark)
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) != 5
    found = language_model.score(frame, learn).collect()
    assert len(found) == frame.count()
    rows = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").replace("É", "É").translate(str.maketrans("ABC", "abc")))) for r in frame.collect()]
    counts = {}
    for doc_id, words in rows:
        if doc_id != 5:
            for w in [*words, "\n"]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    expected = sorted((len(w) + 1, sum(counts.get(x, 0) > 0 for x in [*w, "\n"]), round(sum(np.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in [*w, "\n"]), 6)) for _, w in rows)
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found) == expected
    assert {r["train_tokens"] for r in found} == {n} and all(r["score"] < 0 for r in found)
    assert language_model.score(empty(spark), learn).count() == 0
    untaught = language_model.score(documents(spark, ["abc"]), F.lit(False)).first()
    assert untaught["train_tokens"] == 0 and abs(untaught["score"] + 4 * np.log10(257)) < 1e-9


# PII, URLs, chat ----------------------------------------------------------------------------------------


def spans_plainly(text):
    """The contract's expressions as they are written."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(kind, start, end) for start, kind, end in sorted(found)]


def test_base_spans_are_those_of_the_expressions(spark):
    pick = random.Random(9)
    parts = ["1.2.3.4", "@", "x.org", ".", "4111 1111 1111 1111", "+1 (743) 555-3824", "+4111111111111111", "a-b", "256", " ", "\n", "é", "%", "-", "0", "10.20.30.40.50", "a@b.c"]
    texts = ["1.2.3.4@x.org", "4111111111111111@x.org", "4111.1.1.1@x.org 4111 1111 1111 1111", "+14111111111111111"]
    texts += ["".join(pick.choices(parts, k=pick.randint(1, 12))) for _ in range(400)]
    names = personal_data.KINDS
    expected = {i: ",".join(f"{names[k]}:{s}:{e}" for k, s, e in spans_plainly(t)) for i, t in enumerate(texts)}
    found = personal_data.find(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["base_sha256"] for r in found} == {i: hashlib.sha256(x.encode()).hexdigest() for i, x in expected.items()}
    # what the method finds comes besides, in the same order
    for r in found:
        spans = [x for x in r["spans"].split(",") if x]
        assert len(spans) - r["n_found"] == len([x for x in expected[r["doc_id"]].split(",") if x])
        assert r["n_found"] or r["spans"] == expected[r["doc_id"]]


def test_base_spans_and_patterns(spark):
    base = personal_data.base_spans("x a.b@c.de_f@g.hi 1.2.3.4 256.1.1.1, 4111 1111 1111 1111, +1 (234) 555-0000")
    assert [k for _, _, k in base] == [0, 0, 1, 2, 3]
    texts = [f"{prose(i, 4)} reach me: user{i}@mail.example.org bye {prose(i, 3)}" for i in range(12)]
    texts += ["please reach me: someone9-at-mail bye now", "reach me: user77(at)x bye", None, "", "1" * 50_000, "+1" * 20_000]
    found = {r["doc_id"]: r for r in personal_data.find(documents(spark, texts)).collect()}
    assert all(found[i]["n_email"] == 1 and found[i]["spans"].startswith("email:") for i in range(12))
    assert found[14]["spans"] == "" and found[14]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert personal_data.find(odd(spark)).count() == odd(spark).count() and personal_data.find(empty(spark)).count() == 0


def test_each_kind_is_found_beside_its_seeds(spark):
    """Seeds with spaces inside and without digits; one more of each kind that the base expressions refuse."""
    seeds = {
        "email": [f"{a}@{b}.org" for a in ("anna", "bert", "carl", "dora") for b in ("mail", "post", "home")],
        "ip": [f"10.20.{i}.7" for i in range(100, 112)],
        "card": [n for i in range(1000, 1200) if personal_data._luhn((n := f"4111 1111 1111 {i}").replace(" ", ""))][:12],
        "phone": [f"+1743555{i}" for i in range(3000, 3012)],
    }
    new = {"email": "emil@m\u00fcller.org", "ip": "10.20.300.7", "card": "4111 1111 1111 1112", "phone": "+17435559999 00000"}
    texts = [f"stone write {k}-to {v} thanks" for k, vs in seeds.items() for v in vs]
    texts += [f"stone write {k}-to {v} thanks" for k, v in new.items()]
    texts += [f"call office +1 (743) 555-{i} today" for i in range(3000, 3004)]
    found = {r["doc_id"]: r for r in personal_data.find(documents(spark, texts)).collect()}
    for i, (kind, value) in enumerate(new.items(), 48):
        start = texts[i].index(value)
        assert found[i]["n_found"] == 1 and found[i]["spans"] == f"{kind}:{start}:{start + len(value.split(' 00000')[0])}", kind
    assert all(found[i]["n_found"] == 0 for i in range(48))
    assert {kind for *_, kind in personal_data.candidates(texts[-1], personal_data.base_spans(texts[-1]))} == {3}


def test_rounds_find_unseen_instances(spark):
    rows = [("p1", f"seed{i}", 2) for i in range(20)] + [("p1", "new", None), ("p2", "new", None), ("p2", "rare", None), ("p3", "alone", None)]
    good = personal_data.good_patterns(spark.createDataFrame(rows, "pattern string, instance string, kind int")).collect()
    assert [(r["pattern"], r["kind"]) for r in good] == [("p1", 2)] and good[0]["score"] > 0.95


def test_rules_filter_and_list(spark):
    urls = ["http://A.Example.com/en/x?y", "https://www.example.com/en/1", "ftp://b.net/es/", "http://example.com", None, "nothing", "http://x.org/listed.html#a", "http://www.X.org/listed/", "a://b://c/d", "http://x.org/other"]
    pages = spark.createDataFrame([(i, u, "w") for i, u in enumerate(urls)], "page_id long, url string, word string")
    listed = spark.createDataFrame([("x.org/listed",), (None,), ("",), ("x.org/listed",)], "key string")
    found = {r["page_id"]: r for r in url_filter.judge(pages, listed, url_filter.RULES).collect()}
    assert [found[i]["rule"] for i in range(4)] == ["example.com/en/", "www.example.com/en/", "net/es/", None]
    assert [found[i]["verdict"] for i in range(10)] == ["block", "allow", "block", "allow", "allow", "allow", "block", "block", "allow", "allow"]
    assert (found[4]["host"], found[5]["path"], found[8]["host"], found[8]["path"]) == ("", "", "b:", "//c/d")
    assert all(found[i]["maybe_listed"] for i in (6, 7))
    many = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    passed = url_filter.maybe_listed(many, url_filter.bloom_blocks(many.where("key like '%1'"), 256), 256)
    assert passed.where("key like '%1' and not maybe").count() == 0 and passed.where("key not like '%1' and maybe").count() < 300


def test_url_filter_sizes_and_paths(spark):
    keys = spark.range(40_000).select(F.concat(F.lit("site.org/"), F.col("id")).alias("key"), (F.col("id") % 4 == 0).alias("listed"))
    for share in (0.1, 0.01, 0.001):
        blocks = url_filter.blocks_for(10_000, share)
        passed = url_filter.maybe_listed(keys, url_filter.bloom_blocks(keys.where("listed"), blocks), blocks)
        assert passed.where("listed and not maybe").count() == 0
        assert passed.where("not listed and maybe").count() <= 30_000 * share
    assert url_filter.blocks_for(0, 0.01) == 1 and url_filter.blocks_for(2_000_000, 0.01) > 15 * url_filter.blocks_for(100_000, 0.01)
    # a third of the pages without a host, a third with one listed URL
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "http://www.bad.org/x/").otherwise(F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".org/p"), F.col("id"))).alias("url"),
        F.lit(1).alias("key"),
        F.lit(2).alias("block"),
    )
    listed = spark.createDataFrame([("bad.org/x",), ("h2.org/p2",), ("",), (None,), ("bad.org/x",)], "key string")
    sent = url_filter.judge(pages, listed, url_filter.RULES)
    met = url_filter.judge(pages, listed, url_filter.RULES, most_blocks=0)
    plans = [frame._jdf.queryExecution().optimizedPlan().toString() for frame in (sent, met)]
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]
    found = sorted(sent.collect())
    assert found == sorted(met.collect()) and len(found) == 3000
    assert [r["page_id"] for r in found if r["listed"]] == [i for i in range(3000) if i % 3 == 1 or i == 2]
    assert all(r["verdict"] == "allow" and not r["maybe_listed"] for r in found if r["page_id"] % 3 == 0)
    nothing = url_filter.judge(pages, listed.limit(0), url_filter.RULES)
    assert nothing.count() == 3000 and nothing.where("listed or maybe_listed").count() == 0
    assert url_filter.judge(pages.limit(0), listed, url_filter.RULES).count() == 0


def test_chat_round_trip(spark):
    said = ["\\### Assistant: </turn> ok", "\\", "</turn", "####", "a\n### User: b</turn>", "", None, "é\U0001f600\\\\"]
    rows = [(c, i, role, text, "x") for c, roles in enumerate([["user", "assistant"] * 4, ["assistant", "weird: ### role", "User", "=x", "system", "tool", None, "user"]]) for i, (role, text) in enumerate(zip(roles, said, strict=True))]
    rows += [(2, None, "user", "b", "x"), (2, None, "user", "a", "x"), (None, 0, "user", "q", "x"), (3, 0, "user", "same", "x"), (3, 0, "user", "same", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, texts string")
    found = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(frame)).collect()}
    for c in (0, 1):
        turns = [(r or "", t or "") for k, _, r, t, _ in rows if k == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert found[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert found[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and found[c]["loss_chars"] == len(loss)
    assert found[0]["valid"] and not found[1]["valid"] and not found[3]["valid"] and found[3]["n_turns"] == 2 and found[None]["n_turns"] == 1
    assert chat_format.read_back(chat_format.format_turns(frame.limit(0))).count() == 0


def test_toxicity_learns_from_texts_of_any_length(spark):
    rows = [{"chars": n} for n in (30, 500, 80, 40, 21)]
    assert [r["chars"] for r in toxicity._fitting(rows, 160)] == [30, 80, 40]
    # every toxic text is long, and stands in the table more than once
    texts = [(i, prose(i, 4000) + " vilest slurword " + prose(i + 500, 40)) if i % 2 else (i, prose(i, 30)) for i in range(80)]
    frame = spark.createDataFrame([row for row in texts for _ in range(2)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    assert min(len(t) for i, t in texts if i % 2) > 20_000
    model = toxicity.fit(frame, labels)
    scored = {r["doc_id"]: r["toxicity"] for r in toxicity.score(frame, model).collect()}
    assert all((scored[i] >= 0.7) == bool(i % 2) for i in range(80))
    # no toxic text has room: the rate of labels
    short = toxicity.fit(frame, labels, sample_chars=20_000)
    assert {r["toxicity"] for r in toxicity.score(frame, short).collect()} == {0.5}
