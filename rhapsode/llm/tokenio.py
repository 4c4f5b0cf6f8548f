"""Operator 4: token ids in binary shards, with a minimal perfect hash index for keyed access.

A shard holds the ids of consecutive documents back to back (raw little-endian uint16, or uint32 for large
vocabularies), the document keys in order, and an index: level by level, the keys that no other key hits claim a bit
of the level's bit array; the rank of a key's bit is its slot. Each of the n slots stores a 32-bit fingerprint of
its key and the place of its document, so that a lookup reads a few bits, one fingerprint and one offset, and a key
that is not there is refused with a chance of 1 - 2^-32.

Shards are written by executors through pyarrow's file systems (local or shared folders, HDFS, object stores)
under names that no other attempt uses; the manifest, a table, names the files that count.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, new_path, small_batches

MAGIC = b"RHTOK1\0\0"
END_ID = 2
#: Documents that are encoded and written at a time; ids that are read at a time; words whose ids are remembered, twice.
BATCH, BLOCK, WORDS = 64, 1 << 20, 100_000
SHARD_BYTES = 64 << 20


# ---- encoding

#: Texts of these characters have no composition or context to mind: lower-cased, they fall into the pieces of PIECES.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"
_OTHER = re.compile(f"[^A-Z{_LETTERS}\u00c0-\u00d6\u00d8-\u00de0-9 \\t\\n\\r\\x0b\\x0c.,;:!?()\\-\"/@+=_%$#&*]|\u0130")
_PIECES = re.compile(f"[{_LETTERS}]+|[0-9]|[.,;:!?()\\-\"/@+=_%$#&*]+")


#: Byte-level vocabularies name bytes that aren't printable in Latin-1 by the characters from 256 on, in turn.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}


def pieces(text: str) -> list[str]:
    """Parts of a text whose ids, in turn, are the ids of the text: pieces of its plain words, and other words as they are."""
    if not _OTHER.search(text):
        return _PIECES.findall(text.lower())
    out = []
    for w in text.encode().split():
        w = w.decode()
        if _OTHER.search(w):
            out.append(w)
        else:
            out += _PIECES.findall(w.lower())
    return out


#: What a tokenizer must do to a text before its model for pieces() to be its parts: fixed values, as tokenizers files have them.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def fits_pieces(path: str) -> bool:
    """Whether the tokenizers file lower-cases and cuts texts so that the ids of a text are those of its pieces() in turn."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normalizer, cutter = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    return normalizer.get("normalizers") == _NORMALIZER and cutter.get("pretokenizers") == [_SPLIT, _BYTES] and spec["model"].get("dropout") is None


class _Ids(dict):
    """Ids of pieces as bytes: of those met before, from here or the memory before this one; of others, from the tokenizer's model."""

    def __init__(self, tok, older: _Ids | None = None):
        super().__init__()
        self.tok, self.tokenize, self.older = tok, tok.model.tokenize, {} if older is None else dict(older)

    def __missing__(self, w: str) -> bytes:
        ids = self.older.get(w)
        if ids is None:
            if _OTHER.search(w):
                new = self.tok.encode(w, add_special_tokens=False).ids
            else:  # a pre-token already: only its bytes have to be named as the vocabulary names them
                new = [t.id for t in self.tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_NAMES))]
            ids = array("I", new).tobytes()
        self[w] = ids
        return ids


class WordEncoder:
    """ids of whole texts by a tokenizers file, with a bounded memory of words.

    by_words: the ids of a text are those of its pieces() in turn, which holds where fits_pieces(). Pieces that occur again are not encoded
    again; new ones go to the tokenizer's model directly. Else the texts are encoded as they are.
    """

    def __init__(self, path: str, by_words: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tok, self.by_words = Tokenizer.from_file(path), by_words
        self.seen = _Ids(self.tok)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_words:
            return [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        if len(self.seen) > WORDS:
            self.seen = _Ids(self.tok, self.seen)
        return [np.frombuffer(b"".join(map(self.seen.__getitem__, pieces(t))), dtype=np.uint32) for t in texts]

    @classmethod
    def shared(cls, path: str, by_words: bool) -> WordEncoder:
        """One encoder for all tasks of a worker process."""
        import tokenizers

        held = tokenizers.__dict__.setdefault("_rhapsode_encoders", {})
        if (path, by_words) not in held:
            held.clear()
            held[path, by_words] = cls(path, by_words)
        return held[path, by_words]


# ---- minimal perfect hash

def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixer (the finisher of SplitMix64) of keys already hashed to 64 bits."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_keys(keys: list) -> np.ndarray:
    """64-bit hashes of keys, as text; None is a key of its own."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest("\0none" if k is None else str(k), 1) for k in keys], dtype=np.uint64)


class PerfectHash:
    """A minimal perfect hash function over distinct 64-bit keys: n keys have the slots 0 to n - 1."""

    GAMMA, WORST = 2, 48

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.sizes = [len(x) * 64 for x in levels]
        counts = [np.bitwise_count(x).astype(np.int64) for x in levels]
        every = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if levels else np.zeros(1, dtype=np.int64)
        self.ranks, at = [], 0
        for x in levels:
            self.ranks.append(every[at : at + len(x)])
            at += len(x)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys):
            if len(levels) == cls.WORST:
                raise ValueError("keys repeat")
            words = max(1, -(-len(keys) * cls.GAMMA // 64))
            at = mix(keys, len(levels)) % np.uint64(words * 64)
            alone = np.bincount(at.astype(np.int64), minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[at.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for one that is surely absent; other absent keys get any slot."""
        out, left = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = mix(keys[left], level) % np.uint64(self.sizes[level])
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[left[hit]] = self.ranks[level][word[hit]] + below
            left = left[~hit]
        return out


# ---- shards

def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard; memory holds the keys and places of its documents, never its ids."""

    def __init__(self, path: str, wide: bool):
        self.fs, self.path = _fs(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.dtype = self.fs.open_output_stream(self.path), np.dtype("<u4" if wide else "<u2")
        self.out.write(MAGIC)
        self.keys, self.ends, self.at = [], [], 0

    def add(self, keys: list, ids: list[np.ndarray]) -> None:
        self.out.write(np.concatenate(ids).astype(self.dtype).tobytes())
        for k, x in zip(keys, ids, strict=True):
            self.at += len(x)
            self.keys.append(k)
            self.ends.append(self.at)

    def close(self) -> dict:
        ends = np.array(self.ends, dtype="<u8")
        starts = np.concatenate([np.zeros(1, dtype="<u8"), ends])[:-1]
        hashes = hash_keys(self.keys)
        distinct, first = np.unique(hashes, return_index=True)  # of rows that repeat, the first is the one found by key
        mph = PerfectHash.build(distinct)
        slot = mph.slots(distinct)
        prints, places = np.zeros(len(distinct), dtype="<u4"), np.zeros(len(distinct), dtype="<u8")
        prints[slot], places[slot] = (mix(distinct, 99) >> np.uint64(32)).astype("<u4"), first.astype("<u8")
        head = {"ids": self.at, "docs": len(self.keys), "bytes": self.dtype.itemsize, "slots": len(distinct), "levels": [len(x) for x in mph.levels], "keys": 0}
        keys = json.dumps(self.keys).encode()
        head["keys"] = len(keys)
        for part in (starts, *mph.levels, prints, places):
            self.out.write(np.ascontiguousarray(part).tobytes())
        self.out.write(keys)
        tail = json.dumps(head).encode()
        self.out.write(tail + struct.pack("<Q", len(tail)) + MAGIC)
        self.out.close()
        return head


class ShardReader:
    """Reads a shard: documents in order, or by key in constant time. The ids are read in blocks, never all at once."""

    def __init__(self, path: str):
        self.fs, self.path = _fs(path)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        foot = self._at(size - 16, 16)
        if foot[8:] != MAGIC:
            raise ValueError(f"{path} isn't a whole shard")
        n = struct.unpack("<Q", foot[:8])[0]
        h = self.head = json.loads(self._at(size - 16 - n, n))
        self.dtype, at = np.dtype(f"<u{h['bytes']}"), len(MAGIC) + h["ids"] * h["bytes"]

        def part(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(self._at(at, count * int(dtype[-1])), dtype=dtype)
            at += count * int(dtype[-1])
            return out

        self.starts = part("<u8", h["docs"])
        self.mph = PerfectHash([part("<u8", k) for k in h["levels"]])
        self.prints, self.places = part("<u4", h["slots"]), part("<u8", h["slots"])
        self.keys = json.loads(self._at(at, h["keys"])) if h["keys"] else []
        self.ends = np.append(self.starts[1:], np.uint64(h["ids"]))

    def _at(self, offset: int, n: int) -> bytes:
        return self.file.read_at(n, offset)

    def find(self, keys: list) -> np.ndarray:
        """The place of each key's (first) document in the shard, -1 where there is none."""
        h = hash_keys(keys)
        slot = self.mph.slots(h)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == (mix(h[ok], 99) >> np.uint64(32)).astype("<u4")
        out = np.full(len(keys), -1, dtype=np.int64)
        out[ok] = self.places[slot[ok]].astype(np.int64)
        return out

    def ids(self, place: int) -> np.ndarray:
        a, b = int(self.starts[place]), int(self.ends[place])
        return np.frombuffer(self._at(len(MAGIC) + a * self.dtype.itemsize, (b - a) * self.dtype.itemsize), dtype=self.dtype)

    def get(self, key) -> np.ndarray | None:
        place = int(self.find([key])[0])
        return None if place < 0 else self.ids(place)

    def scan(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of all documents, many small ones with one read."""
        i, n = 0, len(self.starts)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + np.uint64(BLOCK), side="right")))
            a, w = int(self.starts[i]), self.dtype.itemsize
            block = np.frombuffer(self._at(len(MAGIC) + a * w, (int(self.ends[j - 1]) - a) * w), dtype=self.dtype)
            for k in range(i, j):
                yield k, block[int(self.starts[k]) - a : int(self.ends[k]) - a]
            i = j


# ---- tables

def _uri(spark: SparkSession, path: str) -> str:
    """A path with the scheme that Spark would use for it, as pyarrow reads it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return f"file://{full[5:]}" if full.startswith("file:/") and not full.startswith("file:///") else full


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, path: str | None = None, shards: int | None = None) -> DataFrame:
    """Encodes docs into shards in ascending id order (nulls first); the manifest: (shard, path, docs, ids, first, last).

    Null texts are empty: their documents hold the end id alone. Rows that repeat are all written, in the order of their text
    hashes, and the first is the one found by key. An empty table writes no shard. Extra columns play no part. A document must
    fit in memory; a shard need not. The manifest is a table in the shared work folder. Any tokenizers file will do; words are
    remembered where the file's rules allow it (fits_pieces).
    """
    spark, by_words = docs.sparkSession, fits_pieces(tokenizer)
    folder = _uri(spark, path or new_path(spark, "tokens"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    if shards is None:
        size = docs.select(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    rows = rows.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, out, end = WordEncoder.shared(tokenizer, by_words), None, np.array([end_id], dtype=np.uint32)
        shard, name = TaskContext.get().partitionId(), ""
        for b in batches:
            for i in range(0, b.num_rows, BATCH):
                part = b.slice(i, BATCH)
                ids = [np.concatenate([x, end]) for x in encode(part.column(1).to_pylist())]
                if out is None:
                    name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.tok"
                    out = ShardWriter(name, encode.tok.get_vocab_size() > 1 << 16)
                out.add(part.column(0).to_pylist(), ids)
        if out is not None:
            head = out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [name], "docs": [head["docs"]], "ids": [head["ids"]], "first": [str(out.keys[0])], "last": [str(out.keys[-1])]})

    with small_batches(spark):
        return materialize(rows.mapInArrow(write, "shard int, path string, docs long, ids long, first string, last string"), "manifest")


def read_tokens(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files; start counts the ids of all documents before it.

    id_type: of the ids that were written, a whole number or a string. Each document is found through its shard's index; of rows that repeat, the second and later ones by their place.
    """
    from pyspark.sql import Window

    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("path", before.alias("base"))  # a row for each shard
    n = max(1, min(manifest.count(), 100_000))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, base in zip(f["path"], f["base"], strict=True):
                r = ShardReader(path)
                found = r.find(r.keys)
                again = np.array([r.keys[k] == r.keys[j] for j, k in enumerate(found)], dtype=bool)
                if not again.all():
                    raise ValueError(f"{path}: a key isn't found through the index")
                rows = []
                for k, ids in r.scan():
                    at = int(found[k]) if found[k] == k else k
                    rows.append((r.keys[k], int(base) + int(r.starts[at]), len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                for i in range(0, len(rows), 50_000):
                    yield pd.DataFrame(rows[i : i + 50_000], columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": object if id_type == "string" else "Int64"})

    return files.repartition(n).mapInPandas(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
