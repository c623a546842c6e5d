"""Operators that compare rows, against brute force."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from ledgerloom.llm import decontamination, interpolation, mixing, oracles, simhash, substrings, topk
from ledgerloom.llm.components import components

R = random.Random(11)
VOCABULARY = ["".join(R.choice("abcdefghij") for _ in range(R.randint(2, 6))) for _ in range(3000)]


def prose(n, seed):
    r = random.Random(seed)
    return [r.choice(VOCABULARY) for _ in range(n)]


def roots(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize(
    "pairs",
    [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(9, 3), (3, 9), (4, 5), (5, 9)]],
)
def test_components(spark, pairs):
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    want = roots(70, pairs)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in found.collect()} == {
        x: want[x] for x in touched if want[x] != x
    }


# SimHash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    own = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(prints, ids):
    pairs = [
        (i, j) for i, j in itertools.combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3
    ]
    root = roots(len(prints), pairs)
    least = defaultdict(list)
    for i, r in enumerate(root):
        if ids[i] is not None:
            least[r].append(ids[i])
    return [min(least[r], default=None) for r in root]


def test_simhash_equals_brute_force(documents, odd_texts, sample):
    near = prose(300, 1)
    copies = [" ".join(near[:i] + ["changed"] + near[i + 1 :]) for i in range(0, 300, 10)]
    texts = [*odd_texts, *copies, *copies[:5], *(r["text"] for r in sample.collect())]
    prints = [plain_fingerprint(t) for t in texts]
    want = plain_components(prints, range(len(texts)))
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(documents(texts)).collect()}
    assert [rows[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [rows[i]["component_id"] for i in range(len(texts))] == want


@pytest.mark.parametrize("bits, blocks", [(0, 1), (1, 2), (3, 4), (3, 6), (7, 9)])
def test_close_fingerprints_share_a_mask(bits, blocks):
    r = random.Random(bits)
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), bits):
            y ^= 1 << b
        assert any(x & m % 2**64 == y & m % 2**64 for m in simhash.masks(bits, blocks))


def test_links_lose_no_pair(spark):
    r = random.Random(8)
    seeds = [r.getrandbits(64) for _ in range(20)]
    prints = {s ^ sum(1 << b for b in set(r.choices(range(64), k=r.randint(0, 3)))) for s in seeds for _ in range(20)}
    signed = sorted(p - 2**64 if p >> 63 else p for p in prints)
    want = {(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) % 2**64).bit_count() <= 3}
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    assert {tuple(r) for r in found.collect()} == want and found.count() == len(want)


def test_one_of_each_group_stays(odd, documents):
    texts = ["b c d e f", None, "", "b c d e f", "q r s t", "q r s t"]
    df = documents(texts, [5, 4, 3, 2, None, 7])
    out = simhash.one_of_each(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [2, 3, 7]
    twice = df.union(df)
    assert sorted(r["doc_id"] for r in simhash.one_of_each(twice).collect()) == [2, 3, 7]
    assert simhash.one_of_each(odd).columns == odd.columns


# Substrings


def test_compact_windows_equal_all_of_brute_force():
    r = random.Random(2)
    for _ in range(300):
        n, least = r.randint(0, 40), r.randint(1, 12)
        values = [r.randint(1, r.choice([5, 1000])) for _ in range(n)]
        want = set()
        for c in range(n):
            low = c
            while low and values[low - 1] > values[c]:
                low -= 1
            high = c
            while high + 1 < n and values[high + 1] >= values[c]:
                high += 1
            if high - low + 1 >= least:
                want.add((c, low, high))
        got = substrings.compact_windows(np.array(values, np.uint64), least)
        assert set(zip(*(x.tolist() for x in got))) == want


def covered(rows, doc, low, high):
    return any(r["doc_id"] == doc and r["start_word"] <= low and r["end_word"] >= high for r in rows)


def test_passages_are_found_and_clean_texts_left(documents, odd_texts):
    shared, other = prose(60, 100), prose(52, 101)
    near = shared[:30] + ["zzz"] + shared[31:]
    inserted = other[:20] + ["yyy"] + other[20:]
    whole = prose(55, 102)
    texts = []
    for i in range(40):
        own = prose(120, i)
        body = {0: shared, 1: shared, 2: near, 3: other, 4: other, 5: inserted, 6: shared[:49], 7: shared}.get(i, [])
        texts.append(" ".join(own[:50] + body + own[50:]))
    texts += [" ".join(whole), " ".join(whole).upper(), " ".join(whole), *odd_texts]
    rows = substrings.repeated_passages(documents(texts)).collect()
    for i in (0, 1, 7):
        assert covered(rows, i, 50, 110), i
    for i in (3, 4):
        assert covered(rows, i, 50, 102), i
    assert covered(rows, 2, 50, 80) and covered(rows, 2, 81, 110)
    assert covered(rows, 5, 50, 70)
    for i in (40, 41, 42):
        assert covered(rows, i, 0, 55), i
    odd_repeats = {i for i, t in enumerate(texts) if t is not None and texts.count(t) > 1 and len(t.split()) >= 50}
    assert {r["doc_id"] for r in rows} == {0, 1, 2, 7, 3, 4, 5, 40, 41, 42} | odd_repeats
    ids = {r["doc_id"]: r["class_id"] for r in rows}
    assert ids[0] == ids[1] == ids[2] == ids[7] == 0 and ids[3] == ids[4] == ids[5] == 3 and ids[42] == 40


def test_passages_on_one_shingle_with_many_contexts(documents):
    """Pairs of texts that share a passage, all passages around one same line."""
    line = prose(9, 500)
    texts = []
    for i in range(30):
        passage = prose(30, 600 + i) + line + prose(30, 700 + i)
        for side in (0, 1):
            own = prose(80, 1000 + 2 * i + side)
            texts.append(" ".join(own[:40] + passage + own[40:]))
    rows = substrings.repeated_passages(documents(texts)).collect()
    assert all(covered(rows, i, 40, 109) for i in range(60))
    assert {r["doc_id"]: r["class_id"] for r in rows} == {i: i - i % 2 for i in range(60)}


def test_no_repeated_passage_of_the_sample_is_lost(sample):
    """Every run of 50 words that two different documents share lies in a row of either."""
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in sample.collect()}
    seen = defaultdict(set)
    for doc, words in texts.items():
        for i in range(len(words) - 49):
            seen[b" ".join(words[i : i + 50])].add((doc, i))
    spans = defaultdict(list)
    for r in substrings.repeated_passages(sample).collect():
        spans[r["doc_id"]].append((r["start_word"], r["end_word"]))
    n = 0
    for places in seen.values():
        if len({doc for doc, _ in places}) > 1:
            for doc, i in places:
                n += 1
                assert any(low <= i and i + 50 <= high for low, high in spans[doc]), (doc, i)
    assert n > 100
    shared = {doc for places in seen.values() if len({d for d, _ in places}) > 1 for doc, _ in places}
    assert len(set(spans) - shared) <= 0.05 * len(texts)  # near copies have no run that long


def test_pieces_bound_the_texts_read_together():
    sizes = [3, 4, 3, 1, 30, 0, 2, 9, 1]
    batch = pd.DataFrame({"doc": range(9), "size": sizes})
    cut = [p["doc"].tolist() for p in substrings.pieces(batch, 10)]
    assert cut == [[0, 1, 2], [3], [4], [5, 6], [7, 8]]
    assert not list(substrings.pieces(batch.iloc[:0], 10))


def test_windows_without_room_leave_a_batch_only_as_firsts():
    """Half of the windows of one key extend to one side of the shingle, half to the other."""
    n = 400
    doc, left = np.arange(n), np.arange(n) % 2
    windows = {
        "key": np.ones(n, np.uint64), "doc": doc, "size": 1000 + doc, "c": np.full(n, 60),
        "l": 60 - 50 * left, "r": 60 + 50 * (1 - left), "before": np.full(n, 7), "after": np.full(n, -1),
    }
    rows = substrings._packs(windows, 50, 1, True)
    left_over = substrings._unpacked(rows["packs"][rows["kind"] == 0].tolist(), substrings.WINDOW)
    links = substrings._unpacked(rows["packs"][rows["kind"] == 1].tolist(), substrings.LINK)
    assert len(left_over["key"]) == 2
    assert set(links["b"].tolist()) | set(left_over["doc"].tolist()) == set(range(n))


# Decontamination


def test_benchmark_passages_are_found(spark, documents, odd_texts):
    items = [prose(n, 40 + n) for n in (5, 9, 12, 14, 30, 59)]
    bench = [(i, " ".join(w)) for i, w in enumerate(items)] + [(6, None), (7, ""), (0, " ".join(items[0])), (None, " ".join(prose(20, 77)))]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    texts, want = [], []
    for i, words in enumerate(items):
        own = prose(100, 900 + i)
        texts.append(" ".join(own[:40] + [w.title() + "," for w in words] + own[40:]))
        want.append(i)
        if len(words) >= 14:
            changed = list(words)
            changed[6] = "zz"
            if len(words) >= 30:
                changed[20] = "zz"
            texts.append(" ".join(own[:10] + changed + own[10:]))
            want.append(i)
    n = len(texts)
    texts += [" ".join(prose(300, 2000 + i)) for i in range(20)] + odd_texts
    rows = {r["doc_id"]: r for r in decontamination.decontaminate(documents(texts), benchmark).collect()}
    for i in range(n):
        assert rows[i]["contaminated"] == 1 and str(want[i]) in {x.split(":")[0] for x in rows[i]["items"].split(",")}, i
    assert not any(rows[i]["contaminated"] for i in range(n, len(texts)))
    assert rows[0]["items"] == "0:40:45"


def test_overlaps_equal_brute_force_on_the_sample(spark, sample):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [decontamination.word_hashes(r["text"]).tolist() for r in benchmark.collect()]
    runs = {tuple(w[i : i + 12]) for w in items for i in range(len(w) - 11)}
    rows = {r["doc_id"]: r["contaminated"] for r in decontamination.decontaminate(sample, benchmark).collect()}
    n = 0
    for r in sample.collect():
        w = decontamination.word_hashes(r["text"]).tolist()
        exact = any(tuple(w[i : i + 12]) in runs for i in range(len(w) - 11))
        n += exact
        assert rows[r["doc_id"]] >= exact
    assert n and sum(rows.values()) <= n + 3


def test_overlaps_equal_brute_force_of_the_rule():
    """A part of 12 words, 0.8 of them equal, is found however unequal the words beside it are."""
    r = np.random.default_rng(5)
    blocks = [1] * 12 + ([0] * 3 + [1] * 7) * 3
    cases = [np.array(blocks, bool), *(r.random(int(r.integers(8, 90))) > r.uniform(0.1, 0.4) for _ in range(400))]
    for same in cases:
        item = np.arange(len(same)).astype(np.uint64)
        doc = np.where(same, item, item + np.uint64(1000))
        score = np.concatenate([[0], np.cumsum(np.where(same, 1, -4))])
        for at in np.flatnonzero(same)[::5].tolist():
            lengths = [
                e - s
                for s in range(min(len(same), at + decontamination.SPAN))
                for e in range(max(at + 1, s + min(12, len(same))), len(same) + 1)
                if same[s] and same[e - 1] and score[e] >= score[s]
            ]
            got = decontamination.overlap(doc, item, 0, at)
            assert (got is not None) == bool(lengths)
            if got is not None:
                assert score[got[1]] >= score[got[0]] and got[1] - got[0] in lengths
            part = decontamination.longest_part(same, at, min(12, len(same)))
            assert (part[1] - part[0] if part else None) == max(lengths, default=None)


@pytest.mark.parametrize("size", range(12, 21))
def test_masks_hit_every_placement_of_replaced_words(size):
    places = [
        {start + i for i in mask} for mask in decontamination.MASKS for start in range(size - max(mask))
    ]
    for replaced in itertools.combinations(range(size), size // 5):
        assert any(p.isdisjoint(replaced) for p in places), replaced


def test_an_overfull_bit_map_changes_nothing(spark, documents):
    words = prose(30, 1)
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    df = documents([" ".join(prose(30, 5) + words), " ".join(prose(60, 6))])
    few = decontamination.find_overlaps(df, benchmark, bloom_bits=4)
    assert few.collect() == decontamination.find_overlaps(df, benchmark).collect() != []


# Mixing, language model, search


def connection(sf):
    c = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        c.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return c


def test_mixing_budgets(documents):
    r = random.Random(4)
    sizes = {"a": 900, "b": 40, "c": 300, "d": 5, None: 200}
    texts = [(" ".join(prose(r.randint(1, 30), i)), s) for i, s in enumerate(sizes) for _ in range(sizes[s] // 15 + 1)]
    df = documents(texts)
    rows = mixing.mix(df).collect()
    by = defaultdict(list)
    source = {i: s for i, (_, s) in enumerate(texts)}
    for row in rows:
        assert row["size"] == len(texts[row["doc_id"]][0].split()) and row["taken"] <= 3 * row["size"]
        by[source[row["doc_id"]]].append(row)
    total = sum(r["size"] for r in rows)
    caps = {s: 3 * sum(r["size"] for r in by[s]) for s in by}
    weight = dict(zip(["a", "b", "c", "d", None], (5, 2, 1, 5, 2)))
    capped = set()
    while True:  # the contract's own wording: give out, cap, share the excess again
        rest = total - sum(caps[s] for s in capped)
        share = {s: rest * weight[s] / sum(w for t, w in weight.items() if t not in capped) for s in by if s not in capped}
        over = {s for s in share if share[s] > caps[s]}
        if not over:
            break
        capped |= over
    for s, own in by.items():
        want = caps[s] if s in capped else share[s]
        assert math.isclose(own[0]["target"], want, rel_tol=1e-12)
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - want) < 1
    assert sorted(rows) == sorted(mixing.mix(df.repartition(5)).collect())


def test_heavier_documents_come_first(spark, documents):
    texts = [("word " * 20 if i % 2 else "12345 " * 20, "s") for i in range(400)] + [("x " * 9000, "t")]
    rows = [r for r in mixing.mix(documents(texts)).collect() if r["doc_id"] < 400]
    extra = lambda odd: sum(r["taken"] for r in rows if r["doc_id"] % 2 == odd)
    full = 3 * sum(r["size"] for r in rows)
    if sum(r["taken"] for r in rows) < full:
        assert extra(1) > extra(0)


def test_mixing_odd_rows(odd, none, spark):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(none).count() == 0
    out = mixing.mixed_rows(odd).select("row.*", "mix.taken")
    assert sum(r["taken"] for r in out.collect()) == sum(r["taken"] for r in rows)
    assert out.columns == [*odd.columns, "taken"]


@pytest.mark.parametrize("chunk_bytes", [16 << 20, 20_000])
def test_language_model_equals_counts_in_a_dictionary(monkeypatch, documents, odd_texts, sample, chunk_bytes):
    learned = []
    monkeypatch.setattr(
        interpolation, "mixture", lambda cells, v, f=interpolation.mixture: learned.append(f(cells, v)) or learned[-1]
    )
    texts = odd_texts + [r["text"] for r in sample.collect()]
    rows = interpolation.score_texts(documents(texts), chunk_bytes=chunk_bytes).collect()
    weights = learned[0]
    assert np.allclose(weights.sum(1), 1) and (weights[:, 2] > 0).all()
    one, two, n = Counter(), Counter(), 0
    split = [[*(t or "").encode().lower().split(), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    for words, out in zip(split, held):
        if not out:
            one.update(words)
            two.update(zip([None, *words], words))
            n += len(words)
    v = len(one)
    assert len(rows) == len(texts)
    for r in rows:
        words = split[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(words), n)
        assert r["n_known"] == sum(one[w] > 0 for w in words)
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        score = 0.0
        for before, w in zip([None, *words], words):
            l2, l1, l0 = weights[one[before].bit_length() if one[before] else 0]
            score += math.log10(l2 * two[before, w] / max(1, one[before]) + l1 * one[w] / n + l0 / (v + 1))
        assert math.isclose(r["score"], score, rel_tol=1e-9)
    outside = [r for r in rows if r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] for r in outside) > sum(r["base_score"] for r in outside)


def test_language_model_without_training_texts(documents, none, odd):
    assert interpolation.score_texts(none).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = interpolation.score_texts(documents(["a b"], [held])).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"]) == (0, 0, 3) and row["score"] == 0
    out = interpolation.score_texts(odd)
    assert sorted(map(str, (r[0] for r in out.collect()))) == sorted(str(r["doc_id"]) for r in odd.collect())


def plain_top_k(rows, k=20):
    """rows: (id, vector or None)."""
    own = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, q) in enumerate(own):
        if i is not None and i % 20 == 0:
            scores = [
                (-sum(x * y for x, y in zip(q, p)), j is None, j or 0, j) for b, (j, p) in enumerate(own) if a != b
            ]
            out += [(i, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_rows, block_rows", [(8192, 2048), (64, 7)])
def test_top_k_equals_brute_force(spark, shard_rows, block_rows):
    r = random.Random(6)
    rows = [(i, [r.choice([-1.5, -0.2, 0.0, 0.3, 2.0]) for _ in range(6)]) for i in range(900)]  # many ties
    rows += [(20, [0.1] * 6), (20, [0.1] * 6), (None, [9.0] * 6), (None, [9.0] * 6)]
    rows += [(40, None), (60, [1.0, None]), (80, [float("nan")] * 6), (100, [float("inf")] * 6), (120, []), (140, [5.0])]
    df = spark.createDataFrame([(*x, "y") for x in rows], "vec_id long, embedding array<double>, score string")
    found = topk.top_k(df, shard_rows=shard_rows, block_rows=block_rows).collect()
    assert sorted((tuple(x) for x in found), key=str) == plain_top_k(rows)


def test_top_k_large_components_few_rows_and_none(spark):
    rows = [(0, [3e11, -7e11]), (1, [1e3, 1e3]), (2, [5e2, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((tuple(x) for x in topk.top_k(df).collect()), key=str) == plain_top_k(rows)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
def test_registered_query_equals_its_sql(spark, name):
    from ledgerloom.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    ours = queries()[name](spark, sf)
    theirs = connection(sf).execute(oracles.oracle_sql()[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    assert sorted(map(tuple, ours.select(*columns).collect())) == sorted(theirs.fetchall())


@pytest.mark.parametrize(
    "operator",
    [
        simhash.near_duplicates,
        lambda df: decontamination.decontaminate(df, df.selectExpr("doc_id as item_id", "text")),
        mixing.mix,
    ],
    ids=["simhash", "decontamination", "mixing"],
)
def test_odd_rows_keep_a_row_each(odd, none, operator):
    out = operator(odd)
    assert sorted(map(str, (r[0] for r in out.collect()))) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert operator(none).count() == 0


def test_substrings_of_odd_rows(odd, none):
    rows = substrings.repeated_passages(odd).collect()
    assert all(r["end_word"] - r["start_word"] >= 50 for r in rows)
    assert substrings.repeated_passages(none).count() == 0


def test_first_texts_hide_no_passage_of_lines(documents):
    """Pairs of texts share three lines; all shorter texts have only two of them."""
    texts = []
    for t in range(16):
        one, two, three = (prose(20, 8000 + 50 * t + i) for i in range(3))
        for i in range(2):
            own = prose(300, 8010 + 50 * t + i)
            texts.append(" ".join(own[:150] + one + two + three + own[150:]))
        for i in range(10):
            own = prose(160, 8020 + 50 * t + i)
            texts.append(" ".join(own[:80] + (one + two if i % 2 else two + three) + own[80:]))
    rows = substrings.repeated_passages(documents(texts)).collect()
    pairs = [i for i in range(len(texts)) if i % 12 < 2]
    assert [i for i in pairs if not covered(rows, i, 150, 210)] == []
    assert {r["doc_id"] for r in rows} == set(pairs)


@pytest.mark.parametrize(
    "size, edits",
    [(90, {45: 6}), (80, {40: 5}), (90, {44: 0, 48: 0}), (200, {100: 16}), (200, {5: 16}), (240, {50: 8, 190: 8})],
)
def test_passages_survive_edits_within_the_similarity(size, edits):
    """A text and a copy with words inserted at some places, or a word replaced (0)."""
    line = [w.encode() for w in prose(size, 8300)]
    copy = []
    for i, word in enumerate(line):
        n = edits.get(i)
        copy += [word] if n is None else [b"zz%d" % i] if n == 0 else [b"yy%d" % x for x in range(i, i + n)] + [word]
    shingles = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (line, copy)]
    assert len(shingles[0] & shingles[1]) >= 0.8 * len(shingles[0] | shingles[1])
    first, second = ([w.encode() for w in prose(60, 8301 + i)] for i in range(2))
    a, b = first + line + first, second + copy + second
    place = next((60 + i, 60 + j) for i in range(size) for j in range(size) if line[i : i + 5] == copy[j : j + 5])
    spans, failed = substrings.verify(substrings.Words(a), b, {place}, 50)[:2]
    assert spans == [(60, 60 + size, 60, 60 + len(copy))] and not failed


def clustered(n, width, centres, seed):
    r = np.random.default_rng(seed)
    middles = r.normal(0, 1, (centres, width)) * r.uniform(0.5, 3, (centres, 1))
    return np.floor(64 * (middles[r.integers(0, centres, n)] + r.normal(0, 0.05, (n, width))))


def test_the_tree_branches_and_most_of_it_is_never_scored():
    points = clustered(8192, 16, 40, 1)
    queries = points[::37]
    ids = np.arange(len(points))
    search = topk.Search(points, ids, ids, 20)
    assert sum(c is not None for c in search.tree.children) > 60  # inner nodes are kept
    q, p, s = search.best(queries, ids[::37], np.full(len(queries), -np.inf))
    scores = queries @ points.T
    scores[np.arange(len(queries)), ids[::37]] = -np.inf
    for i in range(len(queries)):
        order = np.lexsort((ids, -scores[i]))[:20]
        assert p[q == i].tolist() == order.tolist() and s[q == i].tolist() == scores[i][order].tolist()
    assert search.computed < search.full / 4


def test_a_known_score_prunes_more():
    points = clustered(4096, 8, 30, 2)
    ids = np.arange(len(points))
    queries, rows = points[:50], ids[:50]
    plain, known = topk.Search(points, ids, ids, 5), topk.Search(points, ids, ids, 5)
    q, _, s = plain.best(queries, rows, np.full(50, -np.inf))
    floors = np.array([s[q == i].min() for i in range(50)])
    again = known.best(queries, rows, floors)
    assert [x.tolist() for x in again] == [x.tolist() for x in plain.best(queries, rows, np.full(50, -np.inf))]
    assert known.computed < plain.computed


def test_many_pairs_and_long_texts_are_verified_fast():
    """A text of 20,000 words and a copy with words replaced, from sparsely to densely."""
    import time

    rng = random.Random(17)
    own = [b"w%d" % rng.randrange(50_000) for _ in range(20_000)]
    for share, covered in ((0.01, 1.0), (0.02, 0.95), (0.04, 0.5), (0.1, 0.0)):
        copy = [b"x%d" % rng.randrange(10**6) if rng.random() < share else w for w in own]
        places = {(i, i) for i in range(0, 19_990, 150) if own[i : i + 5] == copy[i : i + 5]}
        start = time.perf_counter()
        spans, _ = substrings.verify(substrings.Words(own), copy, places, 50)
        assert time.perf_counter() - start < 1
        inside = np.zeros(len(own), bool)
        for low, high, *_ in spans:
            inside[low:high] = True
        assert inside.mean() >= covered


@pytest.mark.parametrize("seed", range(4))
def test_passages_have_the_similarity_and_none_better_is_left_out(seed):
    """Against all ends of runs around a place, by sets: the passage is the best of those within
    the limit."""
    rng = random.Random(seed)
    few = seed % 2  # words that repeat much, or hardly
    own = [b"w%d" % rng.randrange(25 if few else 4000) for _ in range(260)]
    copy = []
    for w in own:
        kind = rng.random()
        copy += [] if kind < 0.01 else [w, b"y%d" % rng.randrange(99)] if kind < 0.02 else [b"z"] if kind < 0.03 else [w]
    pair = substrings.Pair(substrings.Words(own), substrings.Words(copy))
    for ac in range(0, 255, 12):
        for bc in [j for j in range(len(copy) - 4) if copy[j : j + 5] == own[ac : ac + 5]][:3]:
            got = pair.passage(ac, bc, 50)
            never = type("All", (substrings.Pair,), {"hopeless": lambda *_: False})(substrings.Words(own), substrings.Words(copy))
            after, before = never.ends(ac, bc, 1, (ac, bc)), never.ends(ac, bc, -1, (ac, bc))
            best = None
            for i, j, *low in before.tolist():
                for k, m, *high in after.tolist():
                    score = low[0] + high[0] - low[2] - high[2]
                    if min(k - i, m - j) >= 50 and pair.similarity(i, k, j, m) >= 0.8 and (best is None or score > best):
                        best = score
            if best is None:
                assert got is None
                continue
            i, k, j, m = got
            scores = {
                (x[0], y[0]): x[2] + y[2] - x[4] - y[4] for x in before.tolist() for y in after.tolist()
            }
            assert scores[i, k] == best and pair.similarity(i, k, j, m) >= 0.8


def test_many_tiny_texts_are_several_chunks(spark):
    """50,000 empty rows and a few others: by bytes alone they would be one chunk."""
    df = spark.range(50_000).selectExpr("id as doc_id", "case when id < 50 then 'a b c' end as text")
    out = interpolation.score_texts(df)
    assert out.count() == 50_000
    # Every held-out and training chunk is a group: ten thousand rows or less in each.
    plan = out._jdf.queryExecution().toString()
    assert "pmod(xxhash64(id" in plan and ", 6)" in plan
    few = df.where("doc_id < 2000")
    assert sorted(map(tuple, interpolation.score_texts(few, chunk_rows=100).collect()), key=repr) == sorted(
        map(tuple, interpolation.score_texts(few).collect()), key=repr
    )


def test_places_that_no_passage_can_hold_are_not_searched(monkeypatch):
    """Two texts share 60 lines of 9 words, each between 30 words of their own, which one repeats."""
    filler = [w.encode() for w in prose(30, 9000)]
    lines = [[w.encode() for w in prose(9, 9100 + i)] for i in range(60)]
    a = [w for line in lines for w in filler + line]
    b = [w for i, line in enumerate(lines) for w in [x.encode() for x in prose(30, 9200 + i)] + line]
    places = {(39 * i + 30 + j, 39 * i + 30 + j) for i in range(60) for j in range(5)}
    searched, search = [], substrings.Pair.passage
    monkeypatch.setattr(substrings.Pair, "passage", lambda *x: searched.append(x) or search(*x))
    spans, failed = substrings.verify(substrings.Words(a), b, places, 50)
    assert not spans and set(failed) == places and not searched


@pytest.mark.parametrize("seed", range(6))
def test_places_left_unsearched_are_in_no_passage(seed):
    """Texts of lines, whole and edited: each place of a shared shingle is searched all the same."""
    rng = random.Random(seed)
    lines = [[b"w%d" % rng.randrange(12 if seed % 3 == 0 else 900) for _ in range(18)] for _ in range(9)]
    a, b = ([w for _ in range(9) for w in rng.choice(lines)] for _ in range(2))
    b = a[30:150] + b if seed % 2 else b
    b = [b"z" if rng.random() < 0.02 else w for w in b]
    pair = substrings.Pair(substrings.Words(a), substrings.Words(b))
    at = [(i, j) for i in range(len(a) - 4) for j in range(len(b) - 4) if a[i : i + 5] == b[j : j + 5]]
    possible = pair.possible(*np.array(at, np.int64).reshape(-1, 2).T, 50)
    found = np.array([pair.passage(i, j, 50) is not None for i, j in at], bool)
    assert not (found & ~possible).any()


def test_places_of_a_pair_are_packed_once():
    rng = np.random.default_rng(3)
    rows = {n: rng.integers(0, 4, 300) for n in substrings.LINK}
    rows["a"][:100] = -(2**62)
    packed = [substrings._by_pair({n: x[part::2] for n, x in rows.items()}) for part in (0, 1)]
    got = set()
    pairs = {(a, b) for p in packed for a, b in zip(p["a"], p["b"])}
    for a, b in pairs:
        own = substrings._places([x for p in packed for x in p.loc[(p["a"] == a) & (p["b"] == b), "places"]])
        columns = list(map(tuple, own.T.tolist()))
        assert columns == sorted(set(columns))
        got |= {(a, b, ac, bc, *reach) for bc, ac, *reach in columns}
    assert got == set(zip(*(rows[n].tolist() for n in substrings.LINK)))


def test_windows_meet_again_by_equal_words_alone():
    """A place's keys of a step stand for the words around it, wherever the text lies in a piece; the
    words that a partner shares have none."""
    line = [w.encode() for w in prose(60, 9500)]
    texts = [[b"x%d_%d" % (i, j) for j in range(20 + 7 * i)] + line + [b"y%d" % i] * 9 for i in range(4)]
    own = [substrings.Words(t) for t in texts]
    again = substrings.Again(50, 16, 6)
    for i, j in ((0, 1), (2, 3)):
        at = np.array([[50 + 7 * j], [50 + 7 * i], [45], [34], [45], [34]])
        again.add(i, j, own[i], own[j], at, np.ones(1, bool))
    keys = {(kind, doc): set() for kind in (0, 1) for doc in range(4)}
    for kind, windows in again.taken():
        for key, doc, c in zip(windows["key"].tolist(), windows["doc"].tolist(), windows["c"].tolist()):
            assert c == 50 + 7 * doc
            keys[kind, doc].add(key)
    assert keys[0, 0] == keys[0, 1] == keys[0, 2] == keys[0, 3] and len(keys[0, 0]) == 2
    # Of the first text's keys, those that begin 18, 24 and 30 words before lie within the line; the
    # second of these lies within the run of words that the partners share.
    assert len(keys[1, 0]) == 7 and len(keys[1, 0] & keys[1, 2]) == 3
    assert len(keys[1, 1]) == 6 and len(keys[1, 0] & keys[1, 1]) == 2
    assert keys[1, 1] & keys[1, 3] == keys[1, 0] & keys[1, 1]
    assert again.held == 0 and not list(again.taken())


def test_texts_that_share_too_few_shingles_are_told_without_a_pair(monkeypatch):
    """Sharing 36 distinct shingles is too few for a passage of 46, sharing 46 is not."""
    line = [w.encode() for w in prose(50, 9700)]
    fillers = [[b"f%d_%d" % (i, j) for j in range(60)] for i in range(3)]
    a = substrings.Words(fillers[0] + line)
    made, pair = [], substrings.Pair
    monkeypatch.setattr(substrings, "Pair", lambda *x: made.append(x) or pair(*x))
    for n, passages in ((40, 0), (50, 1)):
        copy = fillers[1] + line[:n] + fillers[2]
        spans, failed = substrings.verify(a, copy, {(60, 60), (70, 70)}, 50)
        assert len(spans) == len(made) == passages and len(failed) == 2 * (not passages)
