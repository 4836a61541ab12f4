"""Token ids in a content-addressed store.

A rolling hash over the ids cuts each document's stream into chunks, so equal stretches of ids give equal chunks wherever
they stand. The store is a folder with Parquet tables: ``stored/table=chunks`` has every different chunk once (its key is
the SHA-256 of its ids; the ids are little-endian unsigned 32-bit integers, compressed byte by byte); ``recipes`` has each
document's chunk hashes, the number of its ids and the root of a Merkle tree over the hashes, in ascending order of the ids
of the documents. Reading checks every chunk against its hash and every recipe against its root.

A digest of a document needs no chunk to move: each chunk is checked and summed up where it is stored, and checksums of
chunks are combined in the order of the recipe. ``read_documents`` brings back the ids themselves.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.llm.common import new_path, prefix_sums, remove_path, slices, table, written
from urbanframe.llm.substring_dedup import rolling

#: A chunk ends where the hash of the last SPAN ids has no bits of CUT; it has LEAST to MOST ids, the last one maybe fewer.
SPAN, CUT, LEAST, MOST = 8, 0x1FF, 128, 4096
END_ID = 1
#: Words that a worker remembers with their ids, in each of two generations.
REMEMBERED = 150_000
#: Texts that a worker encodes at a time.
TEXTS = 250
#: Small Latin letters, all in composed form, and those that become one of them.
SMALL = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower())
LATIN = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1 and c.lower() in SMALL)
#: ASCII marks that can't be part of a contraction or a special token.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<|>")
#: Byte-level models spell bytes that don't print by letters from 256 on, in order.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
#: Folders of a store: chunks and recipes as they were encoded, by table, and the recipes in order.
STORED, CHUNKS, UNSORTED, RECIPES = "stored", "chunks", "unsorted", "recipes"
FIELDS = ["key", "doc_id", "num", "n_tokens", "root", "hashes", "data"]
#: Reversed polynomial of CRC-32, a fixed value.
POLYNOMIAL = 0xEDB88320
#: A document has fewer than 2 to this power bytes of ids.
LENGTH_BITS = 44


class WordEncoder:
    """Encodes texts with a tokenizer of the tokenizers library.

    With ``by_word`` the tokenizer must lower-case texts, drop ASCII blanks, never look across them, and end a run of
    letters at a mark. Then a text's ids are those of its words in a row, and a word that was met before is
    looked up. A new word of lower-case Latin letters goes to the tokenizer's model at once, as the steps before it would
    leave it alone but for the spelling of its bytes. Otherwise whole texts are encoded.
    """

    def __init__(self, data: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_str(data), by_word
        self.model = self.tokenizer.model
        # two generations: what was used since the last full one stays
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _looked_up(self, words: list[str], letters: list[bool]) -> list[bytes]:
        """The ids of different words. The model gets new ones of small Latin letters at once, the tokenizer all others."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {"": b""}, self.known
        known, older, ascii_, other, rest = self.known, self.older, [], [], []
        out = [*map(known.get, words)]
        for k in [k for k, x in enumerate(out) if x is None]:
            word = words[k]
            if word in older:
                known[word] = older[word]
            else:
                (rest if not letters[k] else ascii_ if word.isascii() else other).append(word)
        spelt = " ".join(other).encode().decode("latin-1").translate(BYTE_LETTERS | {32: 32}).split(" ") if other else []
        ids, stops, tokenize = [], [0], self.model.tokenize
        for word in chain(ascii_, spelt):
            ids += [t.id for t in tokenize(word)]
            stops.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        known.update(zip(ascii_ + other, [raw[a:b] for a, b in pairwise(stops)], strict=True))
        known.update(zip(rest, self._encoded(rest), strict=True))
        return [known[w] if x is None else x for w, x in zip(words, out, strict=True)]

    def encode(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column of texts in a row, each text's followed by end, and the ends of the texts in them."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.by_word:
            ids = [x + end for x in self._encoded(texts.to_pylist())]
            return np.frombuffer(b"".join(ids), "<u4"), np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
        split = pc.ascii_split_whitespace(pc.if_else(_keeps_case(texts), texts, pc.ascii_lower(texts)))
        coded, ends = split.flatten().dictionary_encode(), split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]
        words = coded.dictionary
        # letters, and the marks after them, are looked up on their own
        parted = pc.match_substring_regex(words, f"^[{LATIN}]+[{re.escape(MARKS)}]*$")
        stems, marks = pc.if_else(parted, pc.utf8_lower(pc.utf8_rtrim(words, MARKS)), words), pc.if_else(parted, pc.utf8_ltrim(words, LATIN), "")
        parts = pa.concat_arrays([stems, marks]).dictionary_encode()
        known = self._looked_up(*(x.to_numpy(zero_copy_only=False).tolist() for x in (parts.dictionary, pc.match_substring_regex(parts.dictionary, f"^[{SMALL}]+$"))))
        pool, lengths = np.frombuffer(b"".join([*known, end]), "<u4"), np.fromiter(map(len, [*known, end]), np.int64, len(known) + 1) // 4
        two = parts.indices.to_numpy().reshape(2, len(words)).T
        pool, upto = _runs(pool, lengths, np.append(two.ravel(), len(known)))  # the end is a word of its own, the last
        lengths = np.diff(np.append(upto[1:-1:2], upto[-1]), prepend=0)
        ids, upto = _runs(pool, lengths, np.insert(coded.indices.to_numpy(), ends, len(words)))
        return ids, upto[ends + np.arange(len(ends))]


def _runs(pool: np.ndarray, lengths: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a pool, which are of the given lengths, by their numbers, and where each run ends."""
    own = lengths[number]
    upto = np.cumsum(own)
    first = (np.cumsum(lengths) - lengths)[number] - upto + own
    return pool[np.repeat(first, own) + np.arange(upto[-1] if len(upto) else 0)], upto


def _keeps_case(texts: pa.Array) -> pa.Array:
    """Which texts the tokenizer must get as they are; in the others A-Z can be made small before.

    They may have special tokens, or marks (U+0300 to U+036F) that a letter may be composed with: the tokenizer composes
    letters before it makes them small, and some have a composed form for the small letter only.
    """
    return pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[\u0300-\u036f]"))


@lru_cache(2)
def encoder(data: str, by_word: bool) -> WordEncoder:
    return WordEncoder(data, by_word)


def cuts(ids: np.ndarray, stops: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each stream of ids; they depend on the ids around them, not on their place.

    Streams stand in a row in ids, and stops are their ends.
    """
    h = rolling(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(0xD6E8FEB86659FD93), SPAN)
    h = (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
    marks = np.flatnonzero((h & np.uint64(CUT)) == 0) + SPAN
    starts = np.concatenate([np.zeros(1, np.int64), stops[:-1]])
    stream = np.searchsorted(stops, marks, "left")
    good = marks - SPAN >= starts[stream]  # the ids that were hashed are of one stream
    marks, bounds = marks[good].tolist(), np.searchsorted(stream[good], np.arange(len(stops) + 1)).tolist()
    out = []
    for k, (at, stop) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
        ends: list[int] = []
        for mark in (*marks[bounds[k] : bounds[k + 1]], stop):
            while mark - at > MOST:
                at += MOST
                ends.append(at)
            if mark - at >= LEAST or mark == stop and mark > at:
                ends.append(mark)
                at = mark
        out.append(ends)
    return out


def merkle_root(hashes: list[bytes]) -> bytes:
    """SHA-256 tree over leaves and nodes of different marks; an odd last node goes up as it is."""
    level = [hashlib.sha256(b"\x00" + h).digest() for h in hashes] or [hashlib.sha256(b"\x00").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\x01" + b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def packed(part: bytes, zip_: zstandard.ZstdCompressor) -> bytes:
    """Little-endian 32-bit ids, their first bytes together, then their second ones and so on, compressed."""
    return zip_.compress(np.frombuffer(part, np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(data: bytes, unzip: zstandard.ZstdDecompressor) -> bytes:
    return np.frombuffer(unzip.decompress(data), np.uint8).reshape(4, -1).T.tobytes()


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo that of CRC-32, bits reversed."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = b >> 1 ^ POLYNOMIAL if b & 1 else b >> 1
        bit >>= 1
    return out


@lru_cache(1)
def _shifts() -> np.ndarray:
    """For each k, each of the four bytes of a checksum and each value of it: that times x to the power 8 * 2 ** k."""
    out, square = np.zeros((LENGTH_BITS, 4, 256), np.uint32), 1 << 23
    for k in range(LENGTH_BITS):
        for byte in range(4):
            for bit in range(8):
                out[k, byte, 1 << bit : 2 << bit] = out[k, byte, : 1 << bit] ^ np.uint32(_times(square, 1 << 8 * byte + bit))
        square = _times(square, square)
    return out


def joined_crcs(crcs: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of strings of bytes that are made of pieces, from the pieces' own and their sizes; ends number the pieces.

    A piece counts as its own checksum times x to the power of all bits after it.
    """
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])
    number = np.diff(ends, prepend=0)
    after = np.repeat(upto[ends], number) - upto[1:]
    out = crcs.astype(np.uint32)
    for k, table_ in enumerate(_shifts()):
        at = np.flatnonzero(after >> k & 1)
        if len(at):
            x = out[at]
            out[at] = table_[0][x & 255] ^ table_[1][x >> 8 & 255] ^ table_[2][x >> 16 & 255] ^ table_[3][x >> 24]
    sums = np.concatenate([np.zeros(1, np.uint32), np.bitwise_xor.accumulate(out)])
    return sums[ends] ^ sums[ends - number]


def _chunked(sent, by_word: bool, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_, seen = zstandard.ZstdCompressor(level=3), set()
        tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        for b in slices(batches, TEXTS):
            if len(seen) > REMEMBERED:
                seen.clear()
            roots, hashes, new, data = [], [], [], []
            ids, stops = encoder(sent.value, by_word).encode(b.column(1), tail)
            raw, begin = ids.astype("<u4").tobytes(), 0
            for ends in cuts(ids, stops):
                own = []
                for end in ends:
                    part = raw[4 * begin : 4 * end]
                    own.append(h := hashlib.sha256(part).digest())
                    if h not in seen:  # sent once by each task, as far as it remembers
                        seen.add(h)
                        new.append(h)
                        data.append(packed(part, zip_))
                    begin = end
                roots.append(merkle_root(own))
                hashes.append(own)
            n, binary = b.num_rows, pa.binary()
            keys = [x.to_bytes(8, "big") for x in b.column(2).to_pylist()]
            columns = [pa.array(keys, binary), b.column(0), b.column(2), pa.array(np.diff(stops, prepend=0), pa.int64()), pa.array(roots, binary), pa.array(hashes, pa.list_(binary)), pa.nulls(n, binary)]
            yield pa.RecordBatch.from_arrays(columns, FIELDS)
            yield pa.RecordBatch.from_arrays([pa.array(new, binary), *(pa.nulls(len(new), c.type) for c in columns[1:-1]), pa.array(data, binary)], FIELDS)

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID, by_word: bool = False) -> str:
    """Writes the ids of docs (doc_id, text) to a store in path, which must be new, and returns path.

    tokenizer is a JSON file of the tokenizers library; no special ids are added but end_id after each document. Null and
    empty texts have no other id; with end_id None they have an empty recipe. Repeated rows and rows with the same doc_id
    are documents of their own, in an order of their own; a null doc_id comes first. Other columns are left out.
    """
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("num"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"key binary, doc_id {kind}, num long, n_tokens long, root binary, hashes array<binary>, data binary"
    # one exchange for chunks, which meet by their hashes, and recipes, whose keys are their own
    once = rows.mapInArrow(_chunked(sent, by_word, end_id), schema).groupBy("key").agg(*(F.first(c).alias(c) for c in FIELDS[1:]))
    which = F.when(F.col("data").isNull(), UNSORTED).otherwise(CHUNKS).alias("table")
    once.select("*", which).write.option("compression", "none").partitionBy("table").parquet(f"{path}/{STORED}")
    recipes = docs.sparkSession.read.schema(f"{schema}, table string").parquet(f"{path}/{STORED}").filter(F.col("table") == UNSORTED).select(FIELDS[1:-1])
    recipes.repartitionByRange("doc_id", "num").sortWithinPartitions("doc_id", "num").write.option("compression", "none").parquet(f"{path}/{RECIPES}")
    remove_path(docs.sparkSession, f"{path}/{STORED}/table={UNSORTED}")
    return path


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(hash, data) of a store's chunks."""
    stored = spark.read.schema("key binary, data binary, table string").parquet(f"{path}/{STORED}").filter(F.col("table") == CHUNKS)
    return stored.select(F.col("key").alias("hash"), "data")


def _values(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unzip = zstandard.ZstdDecompressor()
    for b in slices(batches, 5000):
        data = [unpacked(x, unzip) for x in _values(b.column("data"))]
        for h, x in zip(_values(b.column("hash")), data, strict=True):
            if hashlib.sha256(x).digest() != h:
                raise ValueError(f"chunk {h.hex()} doesn't match its hash")
        yield pa.RecordBatch.from_arrays([b.column("hash"), pa.array([zlib.crc32(x) for x in data], pa.int64()), pa.array([len(x) // 4 for x in data], pa.int64())], ["hash", "crc", "n"])


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(1)
        parts, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
        hashes, at = _values(parts.field("hash")), 0
        for root, end in zip(_values(b.column(0)), ends.tolist(), strict=True):
            if merkle_root(hashes[at:end]) != root:
                raise ValueError(f"the recipe of root {root.hex()} can't be rebuilt")
            at = end
        if parts.field("crc").null_count:
            raise ValueError("a chunk of a recipe isn't in the store")
        counts = parts.field("n").to_numpy().astype(np.int64)
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])[ends]
        crcs = joined_crcs(parts.field("crc").to_numpy(), 4 * counts, ends)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(upto, prepend=0)), pa.array(crcs.astype(np.int64))], ["root", "n_read", "ids_crc32"])


def _parts(recipes: DataFrame, chunks: DataFrame, columns: list[str]) -> DataFrame:
    """The different roots with the parts of their recipes in order; a recipe that many documents have is read once."""
    one = recipes.groupBy("root").agg(F.first("hashes").alias("hashes"))
    parts = one.select("root", F.posexplode_outer("hashes").alias("at", "hash")).join(chunks, "hash", "left")
    each = F.sort_array(F.collect_list(F.when(F.col("hash").isNotNull(), F.struct("at", "hash", *columns))))
    return parts.groupBy("root").agg(each.alias("parts"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a store, from its files; damage is an error."""
    recipes = spark.read.parquet(f"{path}/{RECIPES}")
    chunks = written(_chunks(spark, path).mapInArrow(_summed, "hash binary, crc long, n long"), "chunk-sums")
    roots = written(_parts(recipes, chunks, ["crc", "n"]).mapInArrow(_combined, "root binary, n_read long, ids_crc32 long"), "recipe-sums")
    docs = recipes.select("doc_id", "num", "root", "n_tokens").join(roots, "root")
    docs = docs.withColumn("n_tokens", F.when(F.col("n_tokens") == F.col("n_read"), F.col("n_read")).otherwise(F.raise_error(F.lit("a recipe's number of ids is wrong")).cast("long")))
    return prefix_sums(docs.select("doc_id", "num", "n_tokens", "ids_crc32"), ["doc_id", "num"], {"start": F.col("n_tokens")}, "starts").select("doc_id", "start", "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every document of a store, rebuilt from its chunks."""

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            ids = []
            for root, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = [unpacked(p["data"], unzip) for p in parts]
                if merkle_root([hashlib.sha256(x).digest() for x in data]) != root:
                    raise ValueError(f"the recipe of root {root.hex()} can't be rebuilt")
                ids.append(np.frombuffer(b"".join(data), "<i4"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["root", "ids"])

    recipes, chunks = spark.read.parquet(f"{path}/{RECIPES}"), _chunks(spark, path)
    roots = _parts(recipes, chunks, ["data"]).mapInArrow(rebuilt, "root binary, ids array<int>")
    return recipes.select("doc_id", "root").join(roots, "root").select("doc_id", "ids")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = write_store(docs, new_path(spark, "token-store"), default_tokenizer(), END_ID, by_word=True)
    return read_digests(spark, path)
