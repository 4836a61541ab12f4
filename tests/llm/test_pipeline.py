"""Every stage and run() against plain Python over a small table with copies, leaks, nulls, ties and repeated rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from urbanframe.llm import language_id, sentencepiece_codec
from urbanframe.llm.decontamination import words_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_place string, row long, c0 int, __hash string"
WORDS = {
    "en": "the house of rising sun and that other thing was there with many people who often went out into green fields near water".split(),
    "de": "der und das nicht ein Haus mit dem Garten wo viele Leute oft hinaus auf grüne Felder am Wasser gingen weil schön war".split(),
}
ITEMS = ["what is the capital city of the old northern kingdom by the sea", "", None, "zz"]


def _rows():
    rng = random.Random(9)
    text = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    rows = [(k, text("en" if k % 2 else "de", rng.randint(5, 80)), "en" if k % 2 else "de") for k in range(60)]
    base = text("en", 70).split()
    for k in range(100, 112):  # near copies: from one to some changed words
        own = list(base)
        for _ in range(k % 5):
            own[rng.randrange(70)] = rng.choice(WORDS["de"])
        rows.append((k, " ".join(own), "en"))
    rows += [(5, " ".join(base) + " more words", "en"), (5, text("de", 40), "de"), (5, text("de", 40), "de"), (None, " ".join(base), "en"), (None, text("en", 30), None)]
    rows += [(200, rows[3][1], "en"), (201, rows[3][1].replace(" ", "  \n"), "en"), (202, rows[3][1], "en"), (202, rows[3][1], "en")]
    edited = ITEMS[0].replace("capital", "main").replace("old", "very old")
    rows += [(300, f"{text('en', 9)} {ITEMS[0].upper()} {text('en', 4)}", "en"), (301, f"{text('en', 9)} {edited}", "en"), (302, "the capital city by the sea", "en"), (303, f"{text('en', 6)} zz", "en")]
    rows += [(400, None, None), (401, "", "en"), (402, "12 34 !!", None), (403, " \t\n", None), (404, " ".join(rng.choice(WORDS["en"]) for _ in range(6000)), "en")]
    return rows


def _language(rows, model):
    out = []
    for row in rows:
        (lang,), (score,) = model.predict([row[1]])
        if lang != "und" and score >= corpus_pipeline.LEAST_SCORE:
            out.append((*row[:2], lang, *row[3:]))
    return out


def _best(rows, key):
    """One row of each group: the least by key, then any."""
    return min(rows, key=key)


def _exact(rows):
    groups = {}
    for row in rows:
        groups.setdefault("".join(c for c in row[1] or "" if c not in " \t\n\r\x0b\x0c"), []).append(row)
    return [_best(g, lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]


def _near(rows):
    sets = []
    for row in rows:
        w = (row[1] or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and label[i] != label[j] and 100 * len(x & y) >= 80 * len(x | y):
                old, new = label[i], label[j]
                label = [new if v == old else v for v in label]
    groups = {}
    for row, v in zip(rows, label, strict=True):
        groups.setdefault(v, []).append(row)
    return [_best(g, lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def _score(item, text):
    above, best = np.zeros(len(text) + 1, int), 0
    for word in item:
        here = [0]
        for j, other in enumerate(text, 1):
            here.append(max(0, above[j - 1] + (2 if word == other else -1), above[j] - 1, here[-1] - 1))
        above, best = here, max(best, *here)
    return best


def _clean(rows):
    items = [w for w in map(words_of, ITEMS) if w]
    return [r for r in rows if all(_score(i, words_of(r[1])) < 0.6 * 2 * len(i) for i in items)]


def _shown(row):
    return tuple(row)[:5]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(d, t, lang, f"s{k % 3}", len(t or ""), "x", 7, None, "h") for k, (d, t, lang) in enumerate(_rows())]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_every_stage_and_run(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.learn(docs)
    plain = [lambda r: _language(r, model), _exact, _near, _clean]
    for (name, stage), whole in zip(corpus_pipeline.STAGES, plain, strict=False):
        # each stage by itself on all rows, and on what the one before kept
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns, name
        for r in (kept := got.collect()):
            assert (r.text_place, r.row, r.c0, r["__hash"]) == ("x", 7, None, "h")
        assert Counter(r.text for r in kept) == Counter(r[1] for r in whole(rows)), name
        assert Counter(r.doc_id for r in kept) == Counter(r[0] for r in whole(rows)), name
    for step in plain:
        rows = step(rows)
    library = sentencepiece_codec._library(open(sentencepiece_codec.default_model(), "rb").read())
    expected = Counter((r[0], r[2], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True, True) for r in rows for ids in [library.encode(r[1])])
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.lang, r.n_tokens, r.ids_crc32, r.round_trip, r.parity) for r in got) == expected


@pytest.mark.parametrize("stage", [corpus_pipeline.exact, corpus_pipeline.near])
def test_rows_have_one_fate_in_whatever_splits_they_are_read(spark, tables, stage):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.unionByName(docs.filter("doc_id < 3")).unionByName(docs.filter("doc_id = 202"))
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
    out = stage(spark, docs, folder)
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "16")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = out.collect()
    finally:
        for name in ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(name)
    expected = (_exact if stage is corpus_pipeline.exact else _near)(rows + [r for r in rows if r[0] in (0, 1, 2, 202)])
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in expected)


def test_stages_on_no_rows(spark, tables):
    folder, _ = tables
    none = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id = -1")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
    assert corpus_pipeline.tokens(spark, docs, SF).filter("NOT parity OR NOT round_trip").count() == 0
