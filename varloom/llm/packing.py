"""Packing by power-of-two decomposition.

Every document's ids are cut into pieces whose lengths are powers of two: as many of the
longest as fit, then one for each set bit of the rest, longest first. Each piece is a
sequence of its own length bucket, so nothing is padded and no sequence crosses documents.
Batches are then drawn from one bucket at a time.

No shuffle: pieces are made where a document is read and numbered by task and row.

Nulls: a null text is empty and gives the end id alone; a null ``doc_id`` stays null.
Repeated rows each give their own pieces. Empty tables give no rows. Other columns are
dropped, so their names cannot clash.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import Words, slices, text_bytes, words

LONGEST = 4096
CACHE = 400_000


class Encoder:
    """Ids of texts, equal to those of the vocabulary file on the whole texts.

    The file lower-cases, splits at white space and parts letters from other signs before
    anything else, so each such stretch is encoded once and kept under its 64-bit hash: texts
    repeat them far more often than not. Plain texts (ASCII and Latin letters, without
    apostrophes, special ids or rare white space) are cut that way; any other text goes through
    the file as it is. The store is emptied at ``CACHE`` stretches.
    """

    LETTER, SIGN = 1, 2

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.kind = np.full(256, self.SIGN, np.uint8)
        self.kind[[10, 32]] = 0
        self.kind[97:123] = self.kind[128:] = self.LETTER
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)  # ids that close a stretch of letters
        for t, i in self.tok.get_vocab().items():
            self.ends[i] = t.endswith("</w>")
        self.odd = np.zeros(256, bool)
        self.odd[:32] = self.odd[127] = self.odd[0xC2] = self.odd[0xC4:] = True
        self.odd[10], self.odd[ord("'")] = False, True
        self.clear()

    def clear(self) -> None:
        self.probe = np.zeros(1 << 20, np.int32)  # by the first 20 bits: where the key may be
        self.keys, self.at, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def not_plain(self, col: pa.Array) -> list[int]:
        """Texts with anything but ``\\n``, printable ASCII without apostrophes and ``<|``, and the letters À to ÿ (two bytes, the first 0xC3)."""
        data, off = text_bytes(col)
        bad = self.odd[data]
        bad[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)) | (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        return np.unique(np.searchsorted(off, np.flatnonzero(bad), "right") - 1).tolist()

    def __call__(self, col: pa.Array) -> list[np.ndarray]:
        texts = [t or "" for t in col.to_pylist()]
        odd = self.not_plain(col)
        rest = dict(zip(odd, self.tok.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False)))
        w = words(pa.array([t.lower() if i not in rest else "" for i, t in enumerate(texts)], pa.large_string()), self.kind, False)
        if len(self.keys) > CACHE:
            self.clear()
        found = self.find(w.hash)
        if len(new := np.flatnonzero(found < 0)):
            self.learn(w, new[np.unique(w.hash[new], return_index=True)[1]])
            found = self.find(w.hash)
        size = self.size[found]
        done = np.append(0, np.cumsum(size))
        ids = self.pool[np.repeat(self.at[found] - done[:-1], size) + np.arange(done[-1])]
        cut = done[w.doc]
        return [np.asarray(rest[i].ids, np.uint32) if i in rest else ids[cut[i]:cut[i + 1]] for i in range(len(texts))]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(hashes), -1)
        k = self.probe[hashes >> np.uint64(44)].astype(np.int64)
        at = np.flatnonzero(self.keys[k] != hashes)
        if len(at):
            other = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
            k[at] = np.where(self.keys[other] == hashes[at], other, -1)
        return k

    def learn(self, w: Words, new: np.ndarray) -> None:
        data = w.data.tobytes()
        part = [data[a:b].decode() for a, b in zip(w.start[new].tolist(), w.end[new].tolist())]
        letters = self.kind[w.data[w.start[new]]] == self.LETTER
        signs = [self.tok.encode(part[i], add_special_tokens=False).ids for i in np.flatnonzero(~letters)]
        ids = [np.asarray(x, np.uint32) for x in signs]
        size = [len(x) for x in ids]
        of = new[~letters]
        if letters.any():  # one call for all; a closing id ends each
            got = np.asarray(self.tok.encode(" ".join(part[i] for i in np.flatnonzero(letters)), add_special_tokens=False).ids, np.uint32)
            ids.append(got)
            size += np.diff(np.flatnonzero(self.ends[got]) + 1, prepend=0).tolist()
            of = np.append(of, new[letters])
        size = np.asarray(size, np.int64)
        at = len(self.pool) + np.cumsum(size) - size
        keys = np.append(self.keys, w.hash[of])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.size = keys[order], np.append(self.at, at)[order], np.append(self.size, size)[order]
        self.pool = np.concatenate([self.pool, *ids])
        self.probe[self.keys >> np.uint64(44)] = np.arange(len(self.keys))


def pieces_of(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    out = [(s, longest) for s in range(0, n - longest + 1, longest)]
    at, size = len(out) * longest, longest // 2
    while size:
        if (n - at) >= size:
            out.append((at, size))
            at += size
        size //= 2
    return out


def pack(docs: DataFrame, tokenizer: str, longest: int = LONGEST, end_id: int = 2, ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit; null unless ``ids``),
    ids_crc32, doc_tokens, sequence_id, offset and bucket (the sequence's length).

    ``tokenizer`` is a path that every executor has; ``longest`` must be a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    tail = end_id.to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tokenizer)
        for whole in batches:
            for b in slices(whole, "text", 2 << 20):
                rows: list[tuple] = []
                for doc, of in zip(b.column("doc_id").to_pylist(), enc(b.column("text"))):
                    got = of.astype("<u4").tobytes() + tail
                    n = len(got) // 4
                    for s, k in pieces_of(n, longest):
                        p = got[4 * s:4 * (s + k)]
                        rows.append((doc, s, k, p if ids else None, zlib.crc32(p), n))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = d.mapInArrow(run, "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint")
    return out.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint"), "bucket": F.col("length")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The pieces by sequence length, one folder a bucket; batches read one folder."""
    pieces.write.partitionBy("bucket").mode("errorifexists").parquet(path)
