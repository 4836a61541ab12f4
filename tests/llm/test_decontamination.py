"""Leaks against Smith-Waterman on all pairs of documents and items."""

import random

import pytest

from urbanframe.llm import decontamination

ITEMS = [30, 12, 6, 5, 3, 2, 1]


def _smith_waterman(a, b):
    above, best = [0] * (len(b) + 1), 0
    for word in a:
        here = [0]
        for j, other in enumerate(b, 1):
            here.append(max(0, above[j - 1] + (2 if word == other else -1), above[j] - 1, here[-1] - 1))
        above, best = here, max(best, *here)
    return best


def _changed(words, at):
    return [f"new{k}" if k in at else w for k, w in enumerate(words)]


def _tables(share):
    """Items of several lengths; one edited passage of the first stands in so large a share of the documents."""
    rng = random.Random(5)
    items = [[f"i{k}w{j}" if j % 4 else f"c{j}" for j in range(n)] for k, n in enumerate(ITEMS)]
    rows = [[rng.choice(["c0", "c4", "c8", "x", "y", "z", *items[1]]) for _ in range(rng.randint(0, 60))] for _ in range(100)]
    popular = _changed(items[0], {3, 8, 12, 17, 22, 27})
    for k in range(int(share * 100)):
        rows[k] = rows[k] + popular + ["tail"]
    for k, item in enumerate(items):
        rows.append([w for v in item for w in (v, "added")])
        rows.append([w for j, v in enumerate(item) for w in ([v, "added"] if j % 2 else [v])])
        rows.append(_changed(item, {1}))
        rows.append(["x"] * 5 + item[: -(-len(item) * 2 // 3)] + ["y"])
        rows.append([w for w in item if rng.random() < 0.8] * 3)
        rows.append(_changed(item, {j for j in range(len(item)) if rng.random() < 0.15 * (k % 2 + 1)}))
    return items, rows


@pytest.mark.parametrize("share", [0.01, 0.3])
@pytest.mark.parametrize("threshold", [0.6, 0.45, 0.9])
def test_finds_all_that_alignment_of_all_pairs_finds(spark, share, threshold):
    items, rows = _tables(share)
    expected = {}
    for d, words in enumerate(rows):
        for i, item in enumerate(items):
            score = _smith_waterman(item, words) / (2 * len(item))
            if score >= threshold - 1e-9:
                expected[d, i] = round(score, 9)
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(rows)], "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = decontamination.find_leaks(docs, tests, threshold).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in found} == expected
    for r in found:
        part = rows[r.doc_id][r.start_word : r.end_word]
        assert round(_smith_waterman(items[r.item_id], part) / (2 * len(items[r.item_id])), 9) == round(r.score, 9)
    kept = decontamination.without_leaks(docs, tests, threshold)
    assert {r.doc_id for r in kept.collect()} == set(range(len(rows))) - {d for d, _ in expected}
