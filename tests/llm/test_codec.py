"""The SentencePiece codec without the tokenizers library's pipeline around its model."""

from types import SimpleNamespace

import numpy as np

from urbanframe.llm import sentencepiece_codec as SC


def test_segments_go_to_the_model_itself_and_have_the_library_s_ids(monkeypatch):
    monkeypatch.setattr(SC, "REMEMBERED", 5)
    with open(SC.default_model(), "rb") as f:
        data = f.read()
    codec, library = SC.Codec(data, 1), SC._library(data)
    codec.segments = SimpleNamespace(model=codec.segments.model)
    texts = ["", " ", "  two  blanks ", "a▁b ▁▁c", "tab\tand\nlines", "naïve Straße 東京 🙂🙂", "x" * 500, "<unk> <s> </s> <0x41>", "é ​﻿", "the same the same THE same"]
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == library.encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(["the other words"])] == library.encode(["the other words"])
