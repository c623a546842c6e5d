from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerloom.llm import shingle_join
from ledgerloom.llm.shingle_join import part_enum, shingle_set, similar_documents

SPACE = "\t\n\x0b\x0c\r "


def plain_set(text, width=5):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        lowered = lowered.replace(c, " ")
    w = [x for x in lowered.split(" ") if x]
    if not w:
        return frozenset()
    return frozenset(" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def plain_rows(rows, width=5, percent=80):
    """(id, size, smallest id reachable) by comparing all pairs."""
    sets = [plain_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(
        ((doc, len(s), least.get(top(i), doc)) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def found(df, **kw):
    return sorted(map(tuple, similar_documents(df, **kw).collect()), key=repr)


def edited(rng, text, share):
    w = text.split()
    for _ in range(int(len(w) * share)):
        kind, at = rng.randrange(3), rng.randrange(len(w))
        if kind == 0:
            w[at] = f"e{rng.randrange(10**6)}"
        elif kind == 1:
            w.insert(at, f"i{rng.randrange(10**6)}")
        elif len(w) > 1:
            del w[at]
    return " ".join(w)


def corpus(seed, lines=0):
    """Texts of 1 to 400 words with edited copies right around the limit, and shared lines."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for size in (1, 2, 4, 5, 6, 8, 12, 20, 30, 33, 40, 60, 100, 180, 400):
        for _ in range(4):
            base = " ".join(word() for _ in range(size))
            texts += [base, base.upper(), base + " tail"]
            texts += [edited(rng, base, share) for share in (0.01, 0.02, 0.025, 0.03, 0.05, 0.1)]
    shared = [" ".join(word() for _ in range(30)) for _ in range(6)]
    for _ in range(lines):
        own = " ".join(word() for _ in range(rng.randrange(5, 60)))
        texts.append(" ".join([*rng.sample(shared, rng.randrange(1, 6)), own]))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_sets_are_those_of_the_contract():
    for text in (None, "", " \t", "a", "A a", "a b c d", "a b c d e", "a b c d e f", "x " * 50, "a\x1cb\x85c d e f g"):
        assert len(shingle_set(text)) == len(plain_set(text)), text
    assert set(shingle_set("A b C d e f")) == set(shingle_set("a B\tc D\ne  F "))
    assert not set(shingle_set("a b c d")) & set(shingle_set("a b c d e"))


def test_every_similar_pair_shares_as_many_signatures_as_each_set_says():
    """The promise of part_enum, by random pairs at the very limit of the similarity."""
    rng = np.random.default_rng(3)
    for size in (*range(1, 70), 100, 127, 128, 129, 250, 511, 900, 3000):
        for _ in range(4):
            union = rng.integers(0, 2**63, size + 1 + size // 4, dtype=np.uint64)
            a = np.unique(union[:size])
            limit = len(a) // 4
            gone = rng.integers(0, limit + 1)
            added = max(0, (len(a) - gone) * 5 // 4 - len(a)) if gone else limit
            b = np.unique(np.concatenate([a[gone:], union[size : size + added]]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            sigs, who, need = part_enum([a, b])
            common = len(np.intersect1d(sigs[who == 0], sigs[who == 1]))
            assert (need >= 1).all() and common >= need.max(), (size, gone, added, need)


@pytest.mark.parametrize("seed,lines", [(1, 0), (2, 60)])
def test_components_equal_all_pairs(spark, documents, seed, lines):
    rows = corpus(seed, lines)
    df = documents([t for _, t in rows], [i for i, _ in rows]).repartition(6)
    assert found(df) == plain_rows(rows)


@pytest.mark.parametrize("hot, sieves, crowd", [(1, 0, 1), (2, 1, 2), (64, 5, 4)])
def test_signatures_of_many_sets_lose_no_link(documents, monkeypatch, hot, sieves, crowd):
    """Chunks that hold back most of their rows, more and fewer rounds of leaving nodes out, and nodes
    that nearly all meet by their differences."""
    rows = corpus(5, 150)
    rng = random.Random(8)
    base = " ".join(f"b{rng.randrange(500)}" for _ in range(120))
    rows += [(10_000 + i, edited(rng, base, 0.02)) for i in range(40)]
    monkeypatch.setattr(shingle_join, "HOT", hot)
    monkeypatch.setattr(shingle_join, "SIEVES", sieves)
    monkeypatch.setattr(shingle_join, "CROWD", crowd)
    rows += [(20_000 + i, edited(rng, base, 0.05)) for i in range(60)]
    rows += [(30_000 + i, " ".join(base.split()[: 90 + i] + ["tail"] * i)) for i in range(30)]
    df = documents([t for _, t in rows], [i for i, _ in rows]).repartition(5)
    assert found(df) == plain_rows(rows)


def test_threshold_and_width_are_parameters(spark, documents):
    rows = corpus(9)[:250]
    df = documents([t for _, t in rows], [i for i, _ in rows])
    assert found(df, width=3, percent=60) == plain_rows(rows, 3, 60)


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    clash = odd.select("*", *(F.lit(1).alias(c) for c in ["node", "least", "data", "key", "n", "a", "b", "comp"] if c not in odd.columns))
    assert found(clash) == plain_rows(rows)
    assert similar_documents(none).count() == 0
    far = [(2**62 + 1, "p q r s t u"), (2**62 + 3, "p q r s t u"), (None, "p q r s t u")]
    df = spark.createDataFrame(far, "doc_id long, text string")
    assert {r["component_id"] for r in similar_documents(df).collect()} == {2**62 + 1}
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, None), (3, ""), (7, "q"), (7, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == sorted(
        [(None, 2, None), (None, 2, None), (None, 0, None), (3, 0, 3), (3, 0, 3), (7, 1, 7), (7, 1, 7)], key=repr
    )


def test_a_third_of_all_rows_in_one_group_and_a_long_text(spark):
    rng = random.Random(4)
    base = " ".join(f"v{rng.randrange(900)}" for _ in range(150))
    rows = [(i, base) for i in range(600)]
    rows += [(1000 + i, edited(rng, base, 0.01)) for i in range(300)]
    long = " ".join(f"l{rng.randrange(10**5)}" for _ in range(60_000))
    rows += [(5000, long), (5001, edited(rng, long, 0.01)), (5002, edited(rng, long, 0.2))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(df).collect()}
    assert all(got[i] == 0 for i, _ in rows[:600])
    assert (got[5000], got[5001], got[5002]) == (5000, 5000, 5002)
    sample = [rows[0], *rows[600:]]
    assert {i: c for i, _, c in plain_rows(sample[:-3])}.items() <= got.items()


def compared(monkeypatch, df):
    """The components, and how many pairs of texts were compared for them."""
    counts = []
    verified = shingle_join._verified

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(shingle_join, "_verified", counted)
    return found(df), sum(counts)


def test_far_copies_of_one_text_are_not_compared_with_each_other(documents, monkeypatch):
    """Copies that meet in crowds are compared with few others each, and no link is lost."""
    monkeypatch.setattr(shingle_join, "CROWD", 1)
    rng = random.Random(21)
    base = [f"h{i}" for i in range(150)]

    def copy(words):
        own = list(base)
        for at in rng.sample(range(150), words):
            own[at] = f"r{rng.randrange(10**9)}"
        return " ".join(own)

    texts = [copy(1) for _ in range(40)] + [copy(rng.randrange(4, 13)) for _ in range(160)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got, pairs = compared(monkeypatch, documents(texts).repartition(4))
    assert got == plain_rows(rows)
    assert pairs < 8 * len(texts)


def test_each_signature_of_a_set_leaves_its_chunk_once(documents, monkeypatch):
    """A text that stands first of many with a signature is no likelier to be taken for their hub."""
    monkeypatch.setattr(shingle_join, "HOT", 3)
    base = " ".join(f"m{i}" for i in range(60))
    texts = [f"{base} end{i}" for i in range(30)]
    data = [(i, zstandard.compress(t.encode())) for i, t in enumerate(texts)]
    nodes = documents([]).sparkSession.createDataFrame(data, "node long, data binary").repartition(3)
    rows = [tuple(r) for r in shingle_join._members(nodes, 5, 80)[0].select("sig", "node").collect()]
    assert len(rows) == len(set(rows)) and {n for _, n in rows} == set(range(30))
