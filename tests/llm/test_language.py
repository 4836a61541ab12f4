"""The language kernel against its formula on sets, and what it learns."""

import random

import numpy as np
import pytest

from urbanframe.llm import language_id
from urbanframe.llm.common import table


def _sets(text, max_n):
    folded = "".join(c if c.isalpha() else "\0" for c in text.lower())
    return [{folded[i : i + n] for i in range(len(folded) - n + 1)} for n in range(1, max_n + 1)]


def _kernel(a, b, max_n):
    pairs = zip(_sets(a, max_n), _sets(b, max_n), strict=True)
    return sum(len(x & y) / max(1, len(x) * len(y)) ** 0.5 for x, y in pairs) / max_n


@pytest.mark.parametrize("most_flags", [0, language_id.MOST_FLAGS])
def test_features_are_the_kernel(monkeypatch, most_flags):
    monkeypatch.setattr(language_id, "MOST_FLAGS", most_flags)
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßñéçабвгдежзийклмнопрстуфхцчшщъыьэюяαβγδεζηθικλμνξοπρστυφχψω日本語中文字漢" + "".join(map(chr, range(0xAC00, 0xAC40)))
    train = [("".join(rng.choice(letters + "  .,1") for _ in range(rng.randint(1, 60))) + "a", rng.choice("xyz")) for _ in range(40)]
    model = language_id.fit(train, landmarks=5)
    chosen = [t for lang in model.langs for t in [a for a, b in train if b == lang][:5]]
    texts = [t for t, _ in train] + ["", "a", "ŁÓDŹ ŁÓDŹ", "12 34", "ııİ", "\U00020000\U00020001 x"]
    want = np.array([[_kernel(t, c, language_id.MAX_N) for c in chosen] for t in texts])
    assert np.allclose(model.features(texts), want, atol=1e-5)


def test_two_languages_of_one_large_script():
    rng = random.Random(5)
    signs = [chr(0x4E00 + k) for k in range(900)]
    common, first, second = signs[:600], signs[600:750], signs[750:]
    text = lambda own: "".join(rng.choice(own if rng.random() < 0.25 else common) for _ in range(60))
    rows = [(text(own), lang) for _ in range(150) for own, lang in ((first, "one"), (second, "two"))]
    model = language_id.fit(rows[:200])
    langs, _ = model.predict([t for t, _ in rows[200:]])
    assert sum(a == b for a, (_, b) in zip(langs, rows[200:], strict=True)) >= 97


def test_no_language_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_TRAIN", 100)
    rows = [(k, f"text number {k % 90} in words", f"l{k % 90}") for k in range(900)]
    sample = language_id.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert {lang for _, lang in sample} == {f"l{k}" for k in range(90)} and len(sample) == 90


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    found = language_id.identify(docs, language_id.learn(docs)).withColumn("held", language_id.held_out()).filter("held AND lang IS NOT NULL AND lang_pred <> 'und'")
    rows = found.select("lang", "lang_pred").collect()
    assert len(rows) > 1000 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.99


def test_odd_labels_dont_fill_the_driver(spark, monkeypatch):
    """With more labels than are learned the most frequent ones are, whatever odd ones some rows have; long texts aren't learned from."""
    monkeypatch.setattr(language_id, "MAX_LANGS", 3)
    monkeypatch.setattr(language_id, "LONGEST", 500)
    rows = [(k, "the house of the rising sun" if k % 2 else "der Garten und das Haus", "en" if k % 2 else "de") for k in range(400)]
    rows += [(1000 + k, f"odd label number {k}", f"x{k}") for k in range(300)] + [(2000 + k, "lo " * 1000, "long") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_id.labelled_sample(docs, "doc_id", "text", "lang")
    assert {lang for _, lang in sample} == {"en", "de"} and max(len(t) for t, _ in sample) <= 500
    assert language_id.learn(docs).langs == ("de", "en")
