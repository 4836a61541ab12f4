"""The filter audit, SimHash and whitening operators against brute force, on messy and on crowded tables."""

import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import xxhash

from urbanframe.llm import filter_audit, simhash, whitening

WORDS = "river stone cloud lamp green tower window bread silver quiet morning paper garden".split()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    long = " ".join(f"{rng.choice(WORDS)}{rng.randint(0, 400)}" for _ in range(120))
    varied = " ".join(f"w{k}" for k in range(150))
    rows = [(1, long, "en"), (2, long, "de"), (3, None, None), (4, "", "en"), (5, " \t\n\x0b\x0c\r", ""), (6, "ONE", "en"), (7, "costs $ 5", "de"), (8, varied, "en")]
    rows += [(9, varied.upper(), "en"), (9, varied.upper(), "en"), (None, varied, "en"), (None, varied, "xx"), (10, "é" * 50 + "ABCDE", "de"), (11, varied + " #", None)]
    rows += [(12, "x y z", "en"), (13, " ".join(f"{rng.choice(WORDS)}{k % 40000}" for k in range(60_000)), "en"), (14, long.replace("1", "2", 1), "en")]
    return rows + [(100 + k, varied if k % 2 else long, "en") for k in range(60)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, x, "p", 0, "f") for d, t, x in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, part string, fails int, fp string").repartition(5)


def _failures(texts):
    blank = " \t\n\x0b\x0c\r"
    for d, t, lang in texts:
        t = t or ""
        words = "".join(" " if c in blank else c for c in t).split(" ")
        words = [w for w in words if w]
        capitals = sum("A" <= c <= "Z" for c in t)
        copy = d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in texts)
        bits = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * capitals > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": copy}
        yield d, lang or "", {f for f, v in bits.items() if v}


def test_audit_against_documents_one_by_one(spark, docs, texts):
    marks = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (6, 0, None), (8, 1, 1), (9, 1, 0), (9, 1, 0), (None, 1, 1), (107, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    good, toxic = {d for d, q, _ in marks if q == 1 and d}, {d for d, _, t in marks if t == 1 and d}
    expected, found = {}, list(_failures(texts))
    for part in {p for _, p, _ in found}:
        rows = [(d, f) for d, p, f in found if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, own in enumerate(order, 1):
                gone = [(d, f) for d, f in left if own in f]
                left = [(d, f) for d, f in left if own not in f]
                shapley[own] += len(gone)
                fails = [f for _, f in rows if own in f]
                expected[part, "".join(order), step] = [len(left), len(gone), len(fails) - len(gone), sum(f == {own} for f in fails), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in expected.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    got = filter_audit.audit(docs, labels).collect()
    assert len(got) == len(expected) == 600 * len({p for _, p, _ in found})
    for r in got:
        assert [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] == expected[r.part, r.filter_order, r.step], r
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert {r.good_lost + r.toxic_lost for r in filter_audit.audit(docs, labels.limit(0)).collect()} == {0}


def test_audit_of_many_parts(spark):
    """More parts than a task counts at a time."""
    rows = [(k, "same text", f"l{k % 700}") for k in range(2100)]
    got = filter_audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1), spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int"))
    first = {r.part: r for r in got.filter("filter_order = 'EABCD' AND step = 1").collect()}
    assert len(first) == 700 and sum(r.removed for r in first.values()) == 2099 and first["l0"].removed == 2 and first["l3"].good_lost == 1


def _print(text):
    blank = " \t\n\x0b\x0c\r"
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in blank else c for c in text or "")
    words = [w for w in text.split(" ") if w]
    runs = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _least(prints, bits):
    """Distinct fingerprints to the smallest number of their component, by all pairs."""
    x = np.array(sorted(prints), np.uint64)
    root = np.arange(len(x))
    while True:
        low = np.array([root[np.bitwise_count(x ^ p) <= bits].min() for p in x])
        if (low == root).all():
            return dict(zip(x.tolist(), root.tolist(), strict=True))
        root = low


def test_simhash_against_all_pairs(docs, texts):
    prints = {d: _print(t) for d, t, _ in texts if d != 13 and d is not None}
    got = simhash.simhash_components(docs).collect()
    assert len(got) == len(texts)
    values = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert all(values[d] == p for d, p in prints.items()) and all(len(r.fingerprint) == 16 for r in got)
    root = _least({int(r.fingerprint, 16) for r in got}, 4)
    ids = {}
    for r in got:
        if r.doc_id is not None:
            k = root[int(r.fingerprint, 16)]
            ids[k] = min(ids.get(k, r.doc_id), r.doc_id)
    assert all(r.component_id == ids[root[int(r.fingerprint, 16)]] for r in got)
    assert values[3] == values[4] == values[5] == 0 and {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}
    assert simhash.simhash_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("bits", "most"), [(4, 1 << 14), (4, 20), (0, 5), (7, 30)])
def test_links_of_crowded_fingerprints(spark, bits, most):
    """Chains, clusters around one fingerprint and lone fingerprints; with small parts every shard has overlapping parts."""
    rng = random.Random(bits)
    flip = lambda p, n: p ^ sum(1 << b for b in rng.sample(range(64), n))
    prints = {rng.getrandbits(64) for _ in range(800)} | {0, 2**64 - 1}
    for centre in rng.sample(sorted(prints), 5):
        prints |= {flip(centre, rng.randint(0, bits + 2)) for _ in range(150)}
        chain = centre
        for _ in range(60):
            chain = flip(chain, max(1, bits))
            prints.add(chain)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    links = simhash.near_prints(spark.createDataFrame(signed, "fp long").repartition(3), bits, most).collect()
    expected, root = _least(prints, bits), {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        a, b = a % 2**64, b % 2**64
        assert (a ^ b).bit_count() <= bits
        root[max(top(a), top(b))] = min(top(a), top(b))
    groups = {}
    for p, k in expected.items():
        groups.setdefault(k, set()).add(top(p))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def _whitened(rows, k):
    x = {i: np.floor(256 * np.array(v, float)) for i, v in rows}
    distinct = np.unique(np.array(list(x.values())), axis=0)
    values, axes = np.linalg.eigh(np.cov(distinct.T, bias=True).reshape(distinct.shape[1], -1))
    values, axes = values[::-1], axes[:, ::-1]
    n, sums = len(distinct), [int(s) for s in distinct.sum(0)]
    return {
        (i, c + 1): (n, sum((n * int(a) - s) ** 2 for a, s in zip(v, sums, strict=True)), float((v - distinct.mean(0)) @ axes[:, c] / math.sqrt(values[c])), values[c] / values.sum())
        for i, v in x.items()
        for c in range(min(k, len(values)))
    }


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(6, 6))
    rows = [(k, [float(np.float32(v)) for v in rng.normal(size=6) @ mix + 3]) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]
    odd = [(-1, None), (-2, []), (-3, [1.0] * 5 + [None]), (-4, [1.0] * 5 + [float("nan")]), (-5, [float("inf")] + [1.0] * 5), (-6, [1.0, 2.0]), (-7, [float("-inf")] * 6)]
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows + odd], "vec_id long, embedding array<float>, n int, whitened string").repartition(7)
    got, expected = whitening.whiten(df).collect(), _whitened(rows, 4)
    assert len(got) == len(expected) == 4 * len(rows)
    sign = {c: math.copysign(1, next(r.whitened for r in got if r.component == c and r.vec_id == 3) * expected[3, c][2]) for c in range(1, 5)}
    for r in got:
        n, deviation, whitened, explained = expected[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.whitened * sign[r.component] - whitened) < 1e-9
        assert abs(r.explained / explained - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening_of_few_and_large_vectors(spark):
    names = "vec_id string, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], names)).count() == 0
    assert whitening.whiten(spark.createDataFrame([("a", None)], names)).count() == 0
    one = whitening.whiten(spark.createDataFrame([("a", [1.0, 2.0]), (None, [1.0, 2.0])], names)).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(i, c, 1, 0, None, 0.0, None) for i in ("a", None) for c in (1, 2)}
    line = whitening.whiten(spark.createDataFrame([(str(k), [float(k), 2.0 * k, 5.0]) for k in range(9)], names)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line) and all(r.identity_error < 1e-12 for r in line)
    far = whitening.whiten(spark.createDataFrame([("a", [1e14, 0.0]), ("b", [-1e14, 1.0]), ("c", [0.0, 0.5])], names)).collect()
    assert {r.deviation for r in far if r.vec_id != "c"} == {None} and {r.deviation for r in far if r.vec_id == "c"} == {(3 * 128 - 384) ** 2}


def test_merging_is_that_of_all_rows():
    rng = np.random.default_rng(1)
    x = rng.integers(-(10**6), 10**6, (500, 5))
    parts = [whitening.summary(p) for p in np.split(x, [1, 2, 90, 300])]
    total = whitening.NOTHING
    for p in parts:
        total = total.merged(p)
    whole = whitening.summary(x)
    assert total.n == 500 and total.sums == whole.sums == x.sum(0).tolist()
    assert np.allclose(total.scatter, whole.scatter, rtol=1e-12) and np.allclose(total.mean, whole.mean, rtol=1e-12)
    assert whitening.summary(np.full((3, 1), 2**62)).sums == [3 * 2**62]
