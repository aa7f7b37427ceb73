"""Operator 5: document fingerprints by a randomised edit embedding.

A text is walked by a random walk that all texts share: at each step the character under the pointer is
put out, and a random bit of (step, character) says whether the pointer moves on. After an edit the walks of two texts
soon fall into step again, so edit distance becomes Hamming distance. BITS places of the walk are sampled: each bit
of a fingerprint is a random bit of the character at its place. The places depend on the walk's length only, and so
that two lengths mostly share them (the last record of a random sequence up to that length). Unlike characters agree in
half of the bits, so likeness is the share of equal bits, stretched from 0.5..1 to 0..1.

near_duplicates() samples bands of bits, joins on them, and verifies by likeness of whole fingerprints. A band has some bits more than it takes to number the
fingerprints, so that unlike ones seldom share it, and there are as many bands as find a pair of likeness LIKE with a chance of RECALL, more like ones with a higher one.

For the query documents are dealt by ranges of doc_id, so that a document and the next one meet in a task; of each range only
the first document is sent twice.

Defined results: class_id is the least doc_id of the class; rows without doc_id are in none (null), rows that share a doc_id are one document with several texts. A null text is the empty text, whose fingerprint is all zeros. Documents with equal doc_id
follow each other by text (null first); null doc_ids come after all others. Each row of the input gives a row.
A single document is its own next. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import cut, map_slices, meeting_rows, spread, stored_bytes, table, tile_pairs, tiles
from larkspur.llm.components import components

BITS, SEED = 512, 20240229
#: A task gets a range of doc_id and holds POOL_CHARS characters at a time.
QUANTILES, TASK_BYTES, POOL_CHARS, BLOCK = 1024, 64 << 20, 12_000_000, 512
#: Stands behind each text while it is walked: a code point that no text has. The pointer stays on it.
STOP = "\ud800"
LIKE, RECALL, TILE = 0.8, 0.96, 4096
#: A band has EXTRA_BITS + BITS_EACH * log2(fingerprints) bits. Unlike texts agree in 0.535 of the bits, so with 1.11 (1 / log2(1 / 0.535)) chance meetings grow as the fingerprints do.
EXTRA_BITS, BITS_EACH = 6, 1.11


@lru_cache(maxsize=1)
def records() -> np.ndarray:
    """For each bit the places (from 1) at which a random sequence has a new record, up to 2**40."""
    rng = np.random.default_rng(SEED)
    at, out = np.ones(BITS), [np.ones(BITS)]
    while at.min() < 2**40:
        at = np.minimum(np.floor(at / rng.random(BITS)) + 1, 2**42)
        out.append(at)
    return np.array(out).T.astype(np.int64)


@lru_cache(maxsize=4096)
def sampled_places(steps: int) -> np.ndarray:
    """The steps (from 0) that are sampled of a walk of so many steps."""
    r = records()
    return r[np.arange(BITS), (r <= steps).sum(axis=1) - 1] - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def embed(texts: list[str]) -> np.ndarray:
    """Fingerprints as rows of BITS / 8 bytes. All texts walk at once; those that have ended are left behind."""
    n = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((len(texts), BITS // 8), dtype=np.uint8)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    if not len(order):
        return out
    flat = np.frombuffer("".join(texts[i] + STOP for i in order).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    number = np.zeros(int(flat.max()) + 1, dtype=np.int32)
    number[flat] = 1
    letters = np.flatnonzero(number).astype(np.uint32)
    number[letters] = np.arange(len(letters), dtype=np.int32)
    flat = number[flat]
    size = n[order] + 1
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    where, steps = first.copy(), 2 * n[order]
    places = np.array([sampled_places(int(s)) for s in steps])
    event_step = places.ravel()
    event_block = event_step // BLOCK
    by_block = np.argsort(event_block.astype(np.uint16) if steps[0] < 65536 * BLOCK else event_block, kind="stable")
    block_ends = np.cumsum(np.bincount(event_block, minlength=int(steps[0]) // BLOCK + 1))
    letter_hash, seen = _mix(letters + np.uint32(SEED)), np.zeros(len(order) * BITS, dtype=np.int32)
    done = 0
    for begin in range(0, int(steps[0]), BLOCK):
        active = int(np.searchsorted(-steps, -begin, side="left"))  # texts with steps > begin come first
        length = min(BLOCK, int(steps[0]) - begin)
        with np.errstate(over="ignore"):
            step_hash = _mix(np.arange(begin, begin + length, dtype=np.uint32) * np.uint32(0x9E3779B1) + np.uint32(1))
            moves = (_mix(step_hash[:, None] ^ letter_hash) & np.uint32(1)).astype(np.int64)
        moves[:, letters == ord(STOP)] = 0
        path, at = np.empty((length, active), dtype=np.int64), where[:active]
        for k in range(length):
            path[k] = at
            at = at + moves[k].take(flat.take(at))
        where[:active] = at
        upto = int(block_ends[begin // BLOCK])
        e = by_block[done:upto]
        seen[e] = flat[path[event_step[e] - begin, e // BITS]]
        done = upto
    seen = seen.reshape(-1, BITS)
    with np.errstate(over="ignore"):
        bits = _mix(letter_hash[seen] ^ _mix(np.arange(BITS, dtype=np.uint32) + np.uint32(77))) & np.uint32(1)
    out[order] = np.packbits(bits.astype(bool), axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1, of rows of fingerprints."""
    differ = np.bitwise_count(a ^ b).sum(axis=-1)
    return np.maximum(0.0, 1.0 - 2.0 * differ / BITS)


def edited(text: str, after: str) -> str:
    """The last third (rounded down) replaced by as many characters of the next document, or all it has."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def tasks_for(docs: DataFrame) -> int:
    """As many tasks as the session shuffles to, or more if each would get over TASK_BYTES of the input as stored."""
    stored = stored_bytes(docs)
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return usual if stored is None else max(usual, -(-stored // TASK_BYTES))


def in_ranges(docs: DataFrame, ranges: int, classes: DataFrame | None = None) -> DataFrame:
    """docs(doc_id, text) dealt by (range, guest); rows of classes(doc_id, class_id) go to the ranges of their doc_ids, with `told` set: ranges of descending doc_id; each range's first rows are also guests of the range before, the first range's of the last.

    Up to QUANTILES bounds are quantiles; beyond that each part between two bounds is split evenly. Of the ranges only (number, first doc_id) is gathered, in one task, and broadcast."""
    parts = max(1, min(ranges, QUANTILES))
    shares = [(i + 1) / parts for i in range(parts - 1)]
    summary = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), *([F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(10 * QUANTILES)).alias("b")] if shares else [])).first()
    low, high = (summary["low"] or 0), (summary["high"] or 0)
    bounds = sorted(set((summary["b"] or []) if shares else []) - {low})
    each = -(-ranges // (len(bounds) + 1))
    edges = F.array(*(F.lit(x).cast("long") for x in [high + 1, *reversed(bounds), low]))
    part = (F.lit(len(bounds)) - F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in bounds)), lambda x: F.col("doc_id") >= x))) if bounds else F.lit(0)
    upper, lower = F.get(edges, F.col("_p")), F.get(edges, F.col("_p") + 1)
    inside = F.floor((upper - 1 - F.col("doc_id")).cast("double") * each / F.greatest((upper - lower).cast("double"), F.lit(1.0)))
    docs = docs.withColumn("class_id", F.lit(None).cast("long")).withColumn("told", F.lit(False))
    if classes is not None:
        docs = docs.unionByName(classes.select("doc_id", F.lit(None).cast("string").alias("text"), "class_id", F.lit(True).alias("told")))
    rows = docs.withColumn("_p", part).withColumn("range", F.when(F.col("doc_id").isNull(), (len(bounds) + 1) * each).otherwise(F.col("_p") * each + F.greatest(F.least(inside, F.lit(each - 1)), F.lit(0))).cast("long")).drop("_p")
    firsts = rows.where("not told").groupBy("range").agg(F.max("doc_id").alias("_first"))
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(F.col("range").alias("_own"), "_first", F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(whole)).alias("_to"))
    led = rows.join(F.broadcast(firsts), (F.col("range") == F.col("_own")) & F.col("doc_id").eqNullSafe(F.col("_first")) & ~F.col("told"), "left")
    both = F.array(F.struct(F.col("range"), F.lit(False).alias("guest")), F.struct(F.col("_to").alias("range"), F.lit(True).alias("guest")))
    return led.withColumn("_at", F.explode(F.when(F.col("_own").isNotNull(), both).otherwise(F.slice(both, 1, 1)))).select("doc_id", "text", "_at.range", "_at.guest", "class_id", "told")


def with_next(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and class_id (from classes, one row a doc_id) of each row of docs(doc_id, text)."""
    n = tasks_for(docs)
    rows = in_ranges(docs, n, classes)

    def made(ids: list, texts: list[str], class_of: dict) -> pa.RecordBatch:
        """Of all texts but the last, which is only a next one."""
        after = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        prints = embed([*texts, *after])
        a, b, c = prints[: len(ids)], prints[len(texts) :], prints[1 : len(texts)]
        hexes = lambda p: pa.array([x.tobytes().hex() for x in p], pa.string())
        cols = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in after], pa.string()), hexes(a), hexes(b), pa.array(likeness(a, b)), pa.array(likeness(a, c)), pa.array([class_of.get(i) for i in ids], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        chars, place = 0, None
        class_of: dict = {}
        for batch in batches:
            for doc_id, text, at, guest, class_id, told in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "guest", "class_id", "told")), strict=True):
                text = text or ""
                if at != place:
                    if ids:
                        raise ValueError("a range has no guest")
                    place, class_of = at, {}
                if told:  # before the range's texts
                    class_of[doc_id] = class_id
                    continue
                if guest:
                    if ids:  # the first guest is the next of the range's last row
                        yield made(ids, [*texts, text], class_of)
                        ids, texts, chars = [], [], 0
                    continue
                if chars >= POOL_CHARS:
                    yield made(ids, [*texts, text], class_of)
                    ids, texts, chars = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                chars += len(text)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"]
    order = ["range", F.col("told").desc(), "guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    dealt = rows.repartitionById(n, F.col("range").cast("int")).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, class_id long")


def forest(prints: np.ndarray, nodes: np.ndarray, like: float) -> list[tuple[int, int]]:
    """Links of a spanning forest of all pairs of prints that are at least so like."""
    left, out = np.arange(len(prints)), []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = likeness(prints[left], prints[at]) >= like
            if near.any():
                found, left = left[near], left[~near]
                todo += found.tolist()
                out += [(int(nodes[at]), int(x)) for x in nodes[found]]
    return out


def bands_for(prints: int, like: float = LIKE, recall: float = RECALL) -> tuple[int, int]:
    """(bands, bits of each) for so many fingerprints."""
    bits, differ = math.ceil(EXTRA_BITS + BITS_EACH * math.log2(max(prints, 2))), math.floor((1 - like) / 2 * BITS)
    chance = math.prod((BITS - differ - i) / (BITS - i) for i in range(bits))  # that a band holds none of the bits that differ
    return math.ceil(math.log(1 - recall) / math.log1p(-chance)), bits


def near_duplicates(docs: DataFrame, like: float = LIKE, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """(doc_id, class_id) of each doc_id of docs(doc_id, text): class_id is the least doc_id linked by fingerprints that are `like` each other and share a band. Equal fingerprints are one node."""

    def prints_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = embed([t or "" for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.tobytes() for x in found], pa.binary())], names=["doc_id", "print"])

    rows = cut(map_slices(docs.select("doc_id", "text").where("doc_id is not null"), "text", prints_of, "doc_id long, print binary"))
    nodes = cut(rows.groupBy("print").agg(F.min("doc_id").alias("node")))
    bands, band_bits = bands_for(nodes.count(), like, recall)
    rng = np.random.default_rng(SEED + 1)
    picks = [np.sort(rng.choice(BITS, band_bits, replace=False)) for _ in range(bands)]

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = np.int64(1) << np.arange(band_bits, dtype=np.int64)
        for batch in batches:
            bits = np.unpackbits(np.frombuffer(b"".join(batch.column("print").to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8), axis=1)
            for b, pick in enumerate(picks):
                keys = (np.int64(b) << np.int64(band_bits)) | (bits[:, pick] @ powers)
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("node")], names=["k", "node"])

    met = cut(meeting_rows(nodes.mapInArrow(keys_of, "k long, node long")))
    sizes = met.groupBy("k").agg(F.count("*").alias("n"))
    dealt = tiles(met.join(sizes, "k"), "node", tile).join(nodes, "node").select("k", "i", "j", "node", "print")

    def of(held: pa.Table) -> list[tuple[int, int]]:
        prints = np.frombuffer(b"".join(held.column("print").to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8)
        return forest(prints, held.column("node").to_numpy(), like)

    shared = rows.groupBy("doc_id").agg(F.min("print").alias("x"), F.max("print").alias("y")).where("x <> y").select("doc_id")
    by_id = rows.join(shared, "doc_id").join(nodes, "print").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    placed = nodes.join(components(tile_pairs(dealt, ["node"], of).unionByName(by_id)), "node", "left").select("print", F.coalesce("root", "node").alias("class_id"))
    return rows.join(cut(placed), "print").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def op5_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_next(docs, cut(near_duplicates(spread(docs))))
