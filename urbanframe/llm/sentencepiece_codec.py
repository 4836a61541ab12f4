"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here; its normaliser, the metaspace marker, the scores (unigram) or merges (BPE) and byte
fallback are rebuilt as a tokenizer of the tokenizers library. Batches are encoded and decoded again, and
every text's ids can be compared with those of the sentencepiece library.

A piece holds the marker only at its start, which is checked when the tokenizer is built, so a text's ids are those of its
segments (a run of markers and what follows) in a row. Segments repeat far more often than texts, so each worker encodes
a segment once and remembers a bounded number of them; that changes the time only.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.llm.common import table

MARK = "▁"
#: Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Segments that a worker remembers, in each of two generations, and the texts that it holds at once.
REMEMBERED, TEXTS = 150_000, 250
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protobuf message: numbers, and bytes for the others."""
    at, end = 0, len(data)

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = number()
        field, wire = tag >> 3, tag & 7
        if wire == 0:
            yield field, number()
            continue
        length = {1: 8, 5: 4}.get(wire) or number()
        yield field, data[at : at + length]
        at += length


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@dataclass(frozen=True)
class PieceModel:
    pieces: tuple[tuple[str, float, int], ...]  # piece, score, kind
    kind: int
    charsmap: bytes
    add_prefix: bool
    squeeze: bool
    unknown: int

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        pieces: list[tuple[str, float, int]] = []
        trainer: dict[int, int | bytes] = {}
        rules: dict[int, int | bytes] = {}
        for field, value in _fields(data):
            if field == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        return cls(tuple(pieces), trainer.get(3, UNIGRAM), bytes(rules.get(2, b"")), bool(rules.get(3, 1)), bool(rules.get(4, 1)), unknown)


class Codec:
    """Encodes and decodes lists of texts; built from the bytes of a model file."""

    def __init__(self, data: bytes, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        from tokenizers import Regex, Tokenizer, models, normalizers

        self.model = m = PieceModel.parse(data)
        ids = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        bytes_too = any(k == BYTE for _, _, k in m.pieces)
        if m.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in m.pieces], m.unknown, bytes_too)
        elif m.kind == BPE:
            core = models.BPE(ids, self._merges(ids), unk_token=m.pieces[m.unknown][0], fuse_unk=True, byte_fallback=bytes_too)
        else:
            raise ValueError(f"models of kind {m.kind} aren't supported")
        steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
        if m.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        self.plain = not steps
        self.normalizer = normalizers.Sequence(steps)
        self.segments = Tokenizer(core)  # of text that is already normal and marked
        self.surface = [bytes([int(p[3:-1], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, _, k in m.pieces]
        self.whole_texts = any(MARK in p.lstrip(MARK) for p, _, k in m.pieces if k in (NORMAL, USER_DEFINED))
        # two generations: what was used since the last full one stays
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merges(self, ids: dict[str, int]) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, the best score first."""
        usable = {p for p, _, k in self.model.pieces if k in (NORMAL, USER_DEFINED)}
        found = []
        for piece in usable:
            cuts = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in usable and piece[i:] in usable]
            score = self.model.pieces[ids[piece]][1]
            found += [(-score, ids[a], ids[b], (a, b)) for a, b in cuts]
        return [pair for *_, pair in sorted(found)]

    def _split(self, text: str) -> list[str]:
        if not self.plain:
            text = self.normalizer.normalize_str(text)
        if not text:
            return []
        marked = (MARK if self.model.add_prefix else "") + text.replace(" ", MARK)
        return [marked] if self.whole_texts else SEGMENT.findall(marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self._split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, new = self.known, []
        for segment in set().union(*parts).difference(known):
            if (ids := self.older.get(segment)) is None:
                new.append(segment)
            else:
                known[segment] = ids
        # nothing stands before or after the model, so it is asked itself: that spares offsets, masks and words of short segments
        tokens = self.segments.model.tokenize
        for segment in new:
            known[segment] = packed([t.id for t in tokens(segment)])
        return [b"".join(map(known.__getitem__, p)) for p in parts]

    def normal(self, text: str) -> str:
        """What decoding gives back: the normalised text, in which a marker is a space."""
        return (text if self.plain else self.normalizer.normalize_str(text)).replace(MARK, " ")

    def decode(self, encoded: list[bytes]) -> list[str]:
        """The texts of ids: their surfaces in a row, byte pieces joined to characters, without the space put before."""
        out = []
        for ids in encoded:
            text = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
            out.append(text[1:] if self.model.add_prefix and text.startswith(" ") else text)
        return out


@lru_cache(2)
def codec(data: bytes, threads: int) -> Codec:
    return Codec(data, threads)


@lru_cache(2)
def _library(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def _run(sent, threads: int, verify: bool, text_at: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                b = whole.slice(at, TEXTS)
                texts = [t or "" for t in b.column(text_at).to_pylist()]
                own = codec(data, threads)
                encoded = own.encode(texts)
                decoded = own.decode(encoded)
                same = [d == own.normal(t) for d, t in zip(decoded, texts, strict=True)]
                agreed: list[bool | None] = [None] * len(texts)
                if verify:
                    agreed = [packed(x) == e for x, e in zip(_library(data).encode(texts, num_threads=threads), encoded, strict=True)]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(e) // 4 for e in encoded])]).astype(np.int32))
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(encoded), "<i4")))
                crc = pa.array([zlib.crc32(e) for e in encoded], pa.int64())
                yield pa.RecordBatch.from_arrays([*b.columns, ids, crc, pa.array(decoded), pa.array(same), pa.array(agreed, pa.bool_())], names)

    return run


ADDED = "ids array<int>, ids_crc32 long, decoded string, round_trip boolean, parity boolean"


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text", threads: int = 2, verify: bool = True) -> DataFrame:
    """Adds ids, ids_crc32, decoded, round_trip and parity to every row.

    ids are those of the whole text without special ids; null counts as empty, and an empty text has no ids. ids_crc32 is
    the CRC of the ids as little-endian unsigned 32-bit integers. round_trip tells whether decoding gave back the
    normalised text, parity whether the sentencepiece library gives the same ids (null without verify). Rows, repeated
    ones too, and other columns pass through; columns with the added names are replaced. The model file is read by the
    driver and sent to the workers; its size is that of a vocabulary.
    """
    with open(model_path, "rb") as f:
        data = f.read()
    added = [x.split()[0] for x in ADDED.split(", ")]
    rest = [c for c in docs.columns if c not in added]
    rows = docs.select(*rest)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    sent = docs.sparkSession.sparkContext.broadcast(data)
    return rows.mapInArrow(_run(sent, threads, verify, rest.index(text_col), [*rest, *added]), f"{fields}, {ADDED}")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), default_model())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32", "round_trip", "parity")
