"""Operator 6: SimHash near-duplicates by pigeonhole blocks.

A fingerprint's 64 bits are split into BLOCKS blocks. Two fingerprints that differ in at most
DISTANCE bits differ in at most as many blocks, so they agree on BLOCKS - DISTANCE others: every choice of
that many blocks is a key, and close pairs meet under one key at least. Equal fingerprints are one node.
Under a key the Hamming distances of all pairs are checked, but only a spanning forest of the links is
passed on. Keys with more than TILE nodes are dealt out as pairs of tiles, to as many tasks as they need.

Defined results: a null text is the empty text; texts without words have fingerprint zero and are linked
like any others. Rows that share a doc_id (repeated rows) count as one document with their several
fingerprints. Rows without doc_id take no part in components: their component_id is null. Further columns are
not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import cut, map_slices, spread, table, tile_pairs, tiles
from larkspur.llm.components import components

WORDS, SEED, DISTANCE, BLOCKS, TILE = 3, 42, 3, 6, 4096


def simhash(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text as an unsigned number."""
    parts = text.encode().lower().split()  # both of ASCII only
    if not parts:
        return 0
    joined, ends = b" ".join(parts), np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[i:j], seed) for i, j in zip(starts, ends[words - 1 :])] or [digest(joined, seed)]  # noqa: B905
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """The long columns `keys` (doc_id if none is named) and fp, the 64 bits as a signed number, of each row."""
    keys = keys or ("doc_id",)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([simhash(t or "") for t in batch.column("text").to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(found.view(np.int64))], names=[*keys, "fp"])

    return map_slices(docs.select(*keys, "text"), "text", run, ", ".join(f"{k} long" for k in keys) + ", fp long")


def block_keys(fp: str, distance: int = DISTANCE, blocks: int = BLOCKS) -> F.Column:
    """All keys of a fingerprint: each numbers a choice of blocks and holds a hash of their bits."""
    bounds = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(x, y)) for x, y in zip(bounds, bounds[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = [F.xxhash64(F.lit(k), F.col(fp).bitwiseAND(F.lit(signed(sum(masks[i] for i in chosen))).cast("long"))) for k, chosen in enumerate(combinations(range(blocks), blocks - distance))]
    return F.array(*keys)


def forest(fps: np.ndarray, nodes: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links of a spanning forest of all links within a set of different fingerprints."""
    left, out = np.arange(len(fps)), []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= distance
            found = left[near]
            if len(found):
                left = left[~near]
                todo += found.tolist()
                out += [(int(nodes[at]), int(n)) for n in nodes[found]]
    return out


def links(nodes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect what is connected by Hamming distance. nodes(node, fp): each fp once."""
    rows = nodes.select("node", "fp", F.explode(block_keys("fp", distance, blocks)).alias("k"))
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"), F.min(F.struct("fp", "node")).alias("x"), F.max(F.struct("fp", "node")).alias("y")).where("n > 1")
    sizes = cut(sizes)
    pairs = sizes.where(f"n = 2 and bit_count(x.fp ^ y.fp) <= {distance}").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    big = rows.join(sizes.where("n > 2").select("k", "n"), "k")
    big = tiles(big, "fp", tile).select("k", "i", "j", "fp", "node")

    def of(held: pa.Table) -> list[tuple[int, int]]:
        return forest(held.column("fp").to_numpy().view(np.uint64), held.column("node").to_numpy(), distance)

    more = tile_pairs(big, ["fp"], of)
    return pairs.unionByName(more)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs."""
    rows = cut(fingerprints(docs))
    nodes = cut(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    shared = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("p"), F.max("fp").alias("q")).where("p <> q").select("doc_id")
    by_id = rows.join(shared, "doc_id").join(nodes, "fp").select("node", F.col("doc_id").alias("other"))  # a doc_id with several texts joins them
    found = links(nodes).unionByName(by_id.select(F.col("node").alias("a"), F.col("other").alias("b")))
    roots = components(found)
    placed = cut(nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id")))
    return rows.join(placed, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def repeats(docs: DataFrame) -> DataFrame:
    """(_row) of the rows of numbered docs(_row, doc_id, text) that are not the first of their group: each row is a document by itself, and comes by its doc_id (null last), then by its number."""
    rows = cut(fingerprints(docs, "_row", "doc_id"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    nodes = cut(rows.groupBy("fp").agg(F.min("_row").alias("node"), F.min(first).alias("first")))
    roots = cut(nodes.join(components(links(nodes.select("node", "fp"))), "node", "left").select("fp", "first", F.coalesce("root", "node").alias("root")))
    firsts = cut(roots.groupBy("root").agg(F.min("first").alias("of")))
    kept = cut(roots.join(firsts, "root").select("fp", F.col("of._row").alias("stays")))
    return rows.join(kept, "fp").where(F.col("_row") != F.col("stays")).select("_row")


def op6_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
