from pathlib import Path

import numpy as np
import pyarrow as pa

from urbanframe.llm import token_store

DATA = Path(token_store.default_tokenizer()).read_text()


def _both(texts, end=b""):
    streams = []
    for by_word in (True, False):
        ids, stops = token_store.WordEncoder(DATA, by_word).encode(pa.array(texts, pa.string()), end)
        streams.append([x.tolist() for x in np.split(ids, stops)[: len(texts)]])
    return streams


def test_decomposed_capitals_have_the_ids_of_the_whole_text():
    words, whole = _both([f"Ta{c}a and {c} ONE" for c in ("H̱", "T̈", "J̌", "W̊", "Y̊", "Ậ", "É")])
    assert words == whole


def test_blanks_nulls_and_special_tokens():
    texts = [None, "", " ", "\t\n", " a  b ", "x\x0by\x0cz\r", "One, two. THREE", "<|endoftext|> A <|B|>", "1.5e3 don't ñandú 日本語 a\u00a0b", "Wörter WÖRTER wörter.,", "I\u0307stanbul İx ẞ ſ K", "Éa$$$ Ñ.*** a,%%% b'' c's d-e f(g) h]^_`{~} ȺĲŒ ǅ ß ŉ ǰ", "x<|end y<z> \"q\" #1 a1! ÀÉ!!"]
    words, whole = _both(texts, np.array([1], "<u4").tobytes())
    assert words == whole and all(w[-1] == 1 for w in words)
    assert _both([]) == [[], []]


def test_chunks_depend_on_their_own_stream():
    rng = np.random.default_rng(3)
    streams = [rng.integers(0, 50_000, n).astype("<u4") for n in (0, 1, 5, 7, 8, 200, 9000, 0, 40_000)]
    streams.append(np.zeros(10_000, "<u4"))
    stops = np.cumsum([len(x) for x in streams])
    together = token_store.cuts(np.concatenate(streams), stops)
    for x, stop, ends in zip(streams, stops, together, strict=True):
        alone = token_store.cuts(x, np.array([len(x)]))[0]
        assert [e - (stop - len(x)) for e in ends] == alone and (alone[-1] == len(x) if len(x) else not alone)
        assert all(0 < b - a <= token_store.MOST for a, b in zip([0, *alone], alone, strict=False))
