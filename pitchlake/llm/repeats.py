"""Removal of repeated byte strings: blockwise suffix buckets over a difference cover.

A byte goes if a ``LENGTH``-byte string that covers it starts anywhere else,
in the same or another document.  Finding them takes the prefixes of length
``LENGTH`` of all suffixes, bucket by bucket, as in blockwise suffix-array
construction; a difference cover keeps most suffixes out of the buckets.

1. Documents are packed into chunks of about ``CHUNK`` bytes (one row each),
   written once to the shared folder.
2. Cover sample: the positions p of a document with ``p mod PERIOD`` in
   ``COVER``, about 6 % of all.  Any two positions i, j have a shift d <
   PERIOD with i + d and j + d both in the sample.  So if the strings of LENGTH
   bytes at i and j are equal, the sample strings of ``SAMPLE`` = LENGTH -
   PERIOD + 1 bytes at i + d and j + d are equal too.  The sample is ranked:
   the rank that matters is whether a sample string occurs again.
3. A suffix enters the buckets only if a sample position less than PERIOD
   after it has a repeated rank; all other suffixes are unique at LENGTH.  The
   chunks are written again with the runs of these suffixes.
4. The remaining suffixes are dealt to buckets by the leading bits of a 64-bit
   fingerprint of their first LENGTH bytes, ``BLOCKS`` blocks of buckets one
   after the other.  A task sorts one bucket at a time; equal neighbours are
   repeats.
5. Every chunk gets one bit per suffix back, and cuts its documents.

Bounds: a task holds one chunk (some arrays of 8 bytes per byte of text) or
one bucket of about ``BUCKET`` bytes.  A chunk sends each distinct fingerprint
once, so a string that a third of all documents share costs one entry per
chunk.  Buckets, not keys, are the unit of the shuffle, and their number
follows the input.  Only fingerprints and bits are shuffled per suffix.

Two different strings are taken for equal with a chance of 2^-64 per pair of
candidate suffixes (about 0.1 % for one such error in 200 million candidates).

Edge cases: null and empty texts have no bytes.  Texts shorter than LENGTH
keep all.  Repeated rows are copies of each other.  A null doc_id is passed
through.  An empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import discard, release, staged
from pitchlake.llm.shingles import mix, powers

LENGTH = 400
PERIOD = 273
#: A perfect difference set modulo 273 (every residue but 0 is a difference once).
COVER = (1, 2, 4, 8, 16, 32, 64, 91, 117, 128, 137, 182, 195, 205, 234, 239, 256)
SAMPLE = LENGTH - PERIOD + 1
CHUNK = 1 << 20
BUCKET = 32 << 20
BLOCKS = 3

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept per worker for chunks of the usual size."""
    if n > len(_POWERS.get("up", ())):
        up, down = powers(n, _BASE), powers(n, _UNBASE)
        if n > 2 * CHUNK:
            return up, down
        _POWERS.update(up=up, down=down)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Chunk:
    """The documents of one row, as bytes with the places where documents end."""

    def __init__(self, data: bytes, ends):
        self.data = np.frombuffer(data, np.uint8)
        self.ends = np.asarray(ends, np.int64)
        self.starts = np.append(0, self.ends[:-1])
        self._sums: np.ndarray | None = None

    def left(self) -> np.ndarray:
        """Bytes from each position to the end of its document."""
        return np.repeat(self.ends, self.ends - self.starts) - np.arange(len(self.data))

    def fingerprints(self, at: np.ndarray, length: int) -> np.ndarray:
        """64-bit fingerprints of the strings of ``length`` bytes at some positions."""
        up, down = _powers(len(self.data))
        if self._sums is None:
            self._sums = np.append(np.uint64(0), np.cumsum(_BYTE[self.data] * up, dtype=np.uint64))
        return mix((self._sums[at + length] - self._sums[at]) * down[at])

    def sample(self) -> np.ndarray:
        place = np.arange(len(self.data)) - np.repeat(self.starts, self.ends - self.starts)
        return np.flatnonzero(_IN_COVER[place % PERIOD] & (self.left() >= SAMPLE))

    def suffixes(self, repeated: np.ndarray) -> np.ndarray:
        """Positions of suffixes of LENGTH bytes or more with a repeated sample string near their start."""
        step = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(step, np.maximum(repeated - (PERIOD - 1), 0), 1)
        np.add.at(step, repeated + 1, -1)
        return np.flatnonzero((np.cumsum(step[:-1]) > 0) & (self.left() >= LENGTH))

    def cut(self, repeats: np.ndarray) -> np.ndarray:
        """True for the bytes that stay, given the positions of repeated strings."""
        step = np.zeros(len(self.data) + 1, np.int32)
        step[repeats] += 1
        step[repeats + LENGTH] -= 1                 # positions are distinct, so no index repeats
        return np.cumsum(step[:-1]) == 0


_CHUNK, _CHUNK_NAMES = "chunk long, doc_ids array<long>, ends array<long>, data binary", ["chunk", "doc_ids", "ends", "data"]


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """chunk, doc_ids, ends, data (compressed) of all documents."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, n, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        squeeze = zstandard.ZstdCompressor(level=1)

        def row() -> pd.DataFrame:
            ends = np.cumsum([len(t) for t in texts]).tolist()
            return pd.DataFrame({"chunk": [(task << 32) + n], "doc_ids": [list(ids)], "ends": [ends],
                                 "data": [squeeze.compress(b"".join(texts))]})

        for pdf in batches:
            for i, t in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
                b = (t or "").encode("utf-8", "surrogatepass")
                if texts and size + len(b) > chunk_bytes:
                    yield row()
                    n, ids, texts, size = n + 1, [], [], 0
                ids.append(None if i is pd.NA else int(i))
                texts.append(b)
                size += len(b)
        if texts:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(pack, _CHUNK)


def _open(batch: pa.RecordBatch) -> Iterator[tuple[dict, Chunk]]:
    """The rows of a batch, one at a time: small columns, and the text."""
    expand = zstandard.ZstdDecompressor()
    small = [c for c in batch.schema.names if c != "data"]
    data = batch.column("data")
    for i in range(batch.num_rows):
        row = {c: batch.column(c)[i].as_py() for c in small}
        yield row, Chunk(expand.decompress(data[i].as_buffer()) if row["ends"] and row["ends"][-1] else b"", row["ends"])


def _deal(chunk: int, values: np.ndarray, bits: int, low: int = 0, high: int | None = None) -> pa.RecordBatch:
    """One row per bucket in [low, high): its distinct fingerprints, and which of them the chunk has twice."""
    distinct, counts = np.unique(values, return_counts=True)
    bucket = distinct >> np.uint64(64 - bits)
    first = np.searchsorted(bucket, np.arange(low, (1 << bits if high is None else high) + 1, dtype=np.uint64))
    rows = [(low + k, distinct[a:b].tobytes(), np.packbits(counts[a:b] > 1).tobytes())
            for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)) if b > a]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()),
         pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], _DEALT_NAMES)


_DEALT, _DEALT_NAMES = "bucket int, chunk long, prints binary, twice binary", ["bucket", "chunk", "prints", "twice"]
_ANSWER = "bucket int, chunk long, n int, bits binary"


def sort_bucket(table: pa.Table) -> pa.Table:
    """Per chunk one bit for each of its fingerprints in the bucket: does it occur again?"""
    prints = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("prints")]
    n = [len(x) for x in prints]
    values = np.concatenate(prints)
    again = np.concatenate([np.unpackbits(np.frombuffer(t.as_buffer(), np.uint8), count=k)
                            for t, k in zip(table.column("twice"), n, strict=True)]).astype(bool)
    order = np.argsort(values, kind="stable")
    values = values[order]
    equal = values[1:] == values[:-1]
    again[order[1:]] |= equal
    again[order[:-1]] |= equal
    bits = [np.packbits(x).tobytes() for x in np.split(again, np.cumsum(n)[:-1])]
    return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"),
                     "n": pa.array(n, pa.int32()), "bits": pa.array(bits, pa.binary())})


def _sorted(dealt: DataFrame, label: str) -> DataFrame:
    return staged(dealt.groupBy("bucket").applyInArrow(sort_bucket, _ANSWER), label)


def _repeated(values: np.ndarray, answers: list[dict]) -> np.ndarray:
    """For each value, whether the buckets found it to be repeated."""
    distinct, inverse = np.unique(values, return_inverse=True)
    bits = [np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["n"]) for a in sorted(answers, key=lambda a: a["bucket"])]
    flags = np.concatenate([*bits, np.zeros(0, np.uint8)]).astype(bool)
    if len(flags) != len(distinct):
        raise ValueError(f"chunk has {len(distinct)} fingerprints, its buckets answered {len(flags)}")
    return flags[inverse]


def _answered(table: DataFrame, answers: DataFrame) -> DataFrame:
    """The chunks with the answers of their buckets (a bit per fingerprint)."""
    per_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias("answers"))
    return table.join(per_chunk, "chunk", "left").withColumn(
        "answers", F.coalesce("answers", F.array().cast("array<struct<bucket:int,n:int,bits:binary>>")))


def _bits(n: float) -> int:
    """Bucket bits for n fingerprints: buckets of about BUCKET bytes, four at least."""
    return max(2, math.ceil(math.log2(max(1.0, 8 * n / BUCKET))))


def _runs(positions: np.ndarray) -> bytes:
    """Sorted positions as runs (begin, length)."""
    first = np.flatnonzero(np.diff(positions, prepend=-2) != 1)
    length = np.diff(np.append(first, len(positions)))
    return np.stack([positions[first], length], axis=1).astype("<i8").tobytes()


def _positions(runs: bytes) -> np.ndarray:
    begin, length = np.frombuffer(runs, "<i8").reshape(-1, 2).T
    return np.repeat(begin - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256 of every row of ``docs``.

    ``spans`` lists the removed runs as byte offsets begin, end, begin, end, ...
    """
    spark = docs.sparkSession
    packed = staged(chunks(docs, chunk_bytes), "repeats-chunks")
    n_bytes = packed.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    sample_bits = _bits(n_bytes * len(COVER) / PERIOD)

    def deal_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, chunk in _open(batch):
                yield _deal(row["chunk"], chunk.fingerprints(chunk.sample(), SAMPLE), sample_bits)

    ranks = _sorted(packed.mapInArrow(deal_sample, _DEALT), "repeats-sample")
    release(spark)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for row, chunk in _open(batch):
                at = chunk.sample()
                runs.append(_runs(chunk.suffixes(at[_repeated(chunk.fingerprints(at, SAMPLE), row["answers"])])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _CHUNK_NAMES], pa.array(runs, pa.binary())],
                                             [*_CHUNK_NAMES, "suffixes"])

    table = staged(_answered(packed, ranks).mapInArrow(choose, _CHUNK + ", suffixes binary"), "repeats-suffixes")
    discard(packed)
    release(spark)

    # as if a third of all suffixes were candidates; a larger share makes larger buckets
    bits = max(_bits(n_bytes / 3), math.ceil(math.log2(BLOCKS)))
    edges = [round((1 << bits) * k / BLOCKS) for k in range(BLOCKS + 1)]
    found = None
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        def deal_block(batches: Iterator[pa.RecordBatch], low: int = low, high: int = high) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, chunk in _open(batch):
                    prints = chunk.fingerprints(_positions(row["suffixes"]), LENGTH)
                    bucket = prints >> np.uint64(64 - bits)
                    yield _deal(row["chunk"], prints[(bucket >= low) & (bucket < high)], bits, low, high)

        block = _sorted(table.mapInArrow(deal_block, _DEALT), "repeats-block")
        found = block if found is None else found.unionAll(block)
        release(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, chunk in _open(batch):
                at = _positions(row["suffixes"])
                stays = chunk.cut(at[_repeated(chunk.fingerprints(at, LENGTH), row["answers"])])
                out = []
                for doc_id, a, b in zip(row["doc_ids"], chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
                    keep = stays[a:b]
                    turns = np.flatnonzero(np.diff(np.concatenate([[1], keep, [1]]).astype(np.int8)))
                    kept = chunk.data[a:b][keep].tobytes()
                    out.append((doc_id, b - a, b - a - len(kept), len(turns) // 2, turns.tolist(), hashlib.sha256(kept).hexdigest()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    return _answered(table, found).mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept_sha256 string")
