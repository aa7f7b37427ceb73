"""Operator 9: packing token sequences by bounded-space online best-fit.

Documents become pieces of at most `size` ids. Pieces are dealt by a hash and come in order of that
hash. Packing is online but for a look-ahead: LOOKAHEAD pieces at a time are put the longest first (lookahead=1 puts each as it comes). Each goes into the open bin that it fills best, found in a bitset whose bit f says that an
open bin has f free places. At most `open_bins` bins are open: when another is needed, the fullest
one closes. Each task packs its own bins, so a task holds open_bins numbers and no more.

Defined results: a null text is the empty text, whose one piece is the closing id; null doc_ids,
ties and repeated rows are packed like any others; further columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import map_slices, spread, table

SEQUENCE, OPEN_BINS, LOOKAHEAD, END_ID = 2048, 1024, 2048, 0
BYTE_BPE, BYTE_RANKS, SPECIAL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "<|endoftext|>"


@lru_cache(maxsize=1)
def _encoders() -> tuple:
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    slow.no_truncation()
    slow.no_padding()
    with open(public_tokenizers.path(BYTE_RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), slow


def encode(text: str) -> np.ndarray:
    """Ids as the tokenizers library gives them. The same vocabulary as ranks is several times faster; texts that hold the special token's string, or a character that the two libraries may class differently, take the slower way."""
    fast, slow = _encoders()
    if SPECIAL in text or not (text.isascii() or max(text) < "Ͱ"):
        return np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return np.array(fast.encode_ordinary(text), dtype=np.uint32)


def pieces(docs: DataFrame, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32 (and ids). Documents of more than size ids are cut so that only the first piece may be shorter."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, ids_out = [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
            start, end = 0, (len(ids) - 1) % size + 1
            for piece in range(-(-len(ids) // size)):
                part = ids[start:end]
                rows.append((doc_id, piece, start, end - start, zlib.crc32(part.tobytes())))
                if with_ids:
                    ids_out.append(part.astype(np.int32))
                start, end = end, end + size
        cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            cols, names = [*cols, pa.array(ids_out, pa.list_(pa.int32()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    return map_slices(docs.select("doc_id", "text"), "text", run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids, most_bytes=4 << 20)


class BestFit:
    """Bounded-space online best-fit. put() gives a piece's bin (numbered as opened) and its place there."""

    def __init__(self, size: int = SEQUENCE, open_bins: int = OPEN_BINS):
        self.size, self.most, self.free, self.bins, self.open, self.next = size, open_bins, 0, [[] for _ in range(size + 1)], 0, 0

    def _take(self, free: int) -> int:
        bins = self.bins[free]
        number = bins.pop()
        if not bins:
            self.free ^= 1 << free
        self.open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            number, free = self.next, self.size
            self.next += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.size - free


def pack(cut: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, lookahead: int = LOOKAHEAD) -> DataFrame:
    """cut (with a column length) plus sequence_id and offset. Adaptive execution decides how many tasks pack; a sequence lies within one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, first = BestFit(size, open_bins), TaskContext.get().partitionId() << 40

        def placed(part: pa.Table) -> Iterator[pa.RecordBatch]:
            lengths = part.column("length").to_numpy()
            put: list = [None] * len(lengths)
            for i in np.argsort(-lengths, kind="stable").tolist():
                put[i] = fit.put(int(lengths[i]))
            cols = [pa.array([first + n for n, _ in put], pa.int64()), pa.array([o for _, o in put], pa.int64())]
            yield from pa.table([*part.columns, *cols], names=[*part.schema.names, "sequence_id", "offset"]).combine_chunks().to_batches()

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:  # a look-ahead reaches over the borders of batches, so their size changes nothing
            held.append(batch)
            rows += batch.num_rows
            if rows >= lookahead:
                whole = pa.Table.from_batches(held)
                while rows >= lookahead:
                    yield from placed(whole.slice(0, lookahead))
                    whole, rows = whole.slice(lookahead), rows - lookahead
                held = whole.to_batches()
        if rows:
            yield from placed(pa.Table.from_batches(held))

    cut = cut.drop("sequence_id", "offset")
    key = [F.xxhash64("doc_id", "piece"), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    schema = ", ".join(f"`{n}` {t}" for n, t in [*cut.dtypes, ("sequence_id", "long"), ("offset", "long")])
    salt = F.monotonically_increasing_id()  # repeated rows, and those without doc_id, are dealt out like others
    return cut.repartition("doc_id", "piece", salt).sortWithinPartitions(*key).mapInArrow(run, schema)


def op9_bounded_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))))
