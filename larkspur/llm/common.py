"""What the operators of this subpackage share: table reads, checkpoints, Arrow row maps."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Sizes from here on are Spark's way to say that it knows none.
UNKNOWN_BYTES = 1 << 60


def stored_bytes(df: DataFrame) -> int | None:
    """The size of what df reads, as stored, if Spark knows it."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return None if n >= UNKNOWN_BYTES else n


#: Inputs under this size are dealt to all cores: they often lie in one row group, which is one task however many cores there are.
SMALL_BYTES = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """df, dealt anew if it is small; larger inputs are read as they lie."""
    stored = stored_bytes(df)
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if stored is not None and stored < SMALL_BYTES else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in tests (where it is unset) a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='larkspur-shared-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(at)
    return at


_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


@contextmanager
def held_scratch(spark: SparkSession) -> Iterator[None]:
    """What cut() writes inside is removed at the end: for work whose result is written before it."""
    made: list[str] = []
    token = _HELD.set(made)
    try:
        yield
    finally:
        _HELD.reset(token)
        for at in made:
            remove(spark, at)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: df is written as Parquet to the shared folder and read from there. What is written is removed at the end of held_scratch(), else when the driver's process ends."""
    return _cut(df, _HELD.get())


def _cut(df: DataFrame, made: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/larkspur-{uuid.uuid4().hex}"
    if made is None:
        atexit.register(remove, spark, at)
    else:
        made.append(at)
    with shuffles_freed(spark):
        df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def cut_alone(spark: SparkSession, work: Callable[[], DataFrame]) -> DataFrame:
    """cut() of what work() gives; all that work() itself cuts is removed then."""
    made = _HELD.get()
    with held_scratch(spark):
        return _cut(work(), made)


#: Whether Spark removes the shuffle files of an execution when it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Executions planned inside leave no shuffle files behind, which else stay until the driver collects garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def remove(spark: SparkSession, at: str) -> None:
    """Delete a folder of the shared one, if the session still runs."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended
        return


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices whose column holds about most_bytes, one row at least, so that what is made of a slice stays bounded."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and held + n > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(n)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def map_slices(df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, most_bytes: int = 8 << 20) -> DataFrame:
    """mapInArrow over slices of bounded size; fn may return None for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, most_bytes):
            out = fn(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def tiles(rows: DataFrame, by: str, tile: int) -> DataFrame:
    """rows(k, n, ...), n the number of rows of k, dealt out: each row gets its tile t and (i, j), pairs of tiles of k of about `tile` rows each, so that any two rows of k meet under some (k, i, j)."""
    count = F.ceil(F.col("n") / tile).cast("int")
    rows = rows.withColumns({"t": F.pmod(F.xxhash64(by, F.lit(7)), count).cast("int"), "_o": F.explode(F.sequence(F.lit(0), count - 1))})
    return rows.withColumns({"i": F.least("t", "_o"), "j": F.greatest("t", "_o")}).drop("_o", "n")


def meeting_rows(rows: DataFrame) -> DataFrame:
    """rows(k, node) whose k another row has too; equal rows count once. One shuffle; one row is held beside a batch, however many have a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marked = None, False
        out = lambda k, node: pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(node, pa.int64())], names=["k", "node"])
        for batch in batches:
            k, node = (batch.column(n).to_numpy() for n in ("k", "node"))
            if held is not None:
                k, node = np.concatenate(([held[0]], k)), np.concatenate(([held[1]], node))
            new = np.ones(len(k), dtype=bool)
            new[1:] = (k[1:] != k[:-1]) | (node[1:] != node[:-1])
            k, node = k[new], node[new]
            same, keep = k[1:] == k[:-1], np.zeros(len(k), dtype=bool)
            keep[0] = marked and held is not None
            keep[1:] |= same
            keep[:-1] |= same
            held, marked = (k[-1], node[-1]), bool(keep[-1])
            if keep[:-1].any():
                yield out(k[:-1][keep[:-1]], node[:-1][keep[:-1]])
        if marked:
            yield out([held[0]], [held[1]])

    return rows.select("k", "node").repartition("k").sortWithinPartitions("k", "node").mapInArrow(run, "k long, node long")


def tile_pairs(rows: DataFrame, order: list[str], links: Callable[[pa.Table], list[tuple[int, int]]], tasks: int | None = None, together: int = 1) -> DataFrame:
    """(a, b) of all links(rows of a (k, i, j)). One (k, i, j) is held at a time, or those that follow each other until they have so many rows together. With so many tasks, small ones are not merged."""
    keys = ["k", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def emit() -> Iterator[pa.RecordBatch]:
            if held and (found := links(pa.Table.from_batches(held))):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

        for batch in batches:
            k, i, j = (batch.column(n).to_numpy() for n in keys)
            new = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for x, y in zip([0, *new.tolist()], [*new.tolist(), len(k)], strict=True):
                if x == y:
                    continue
                if (at := (k[x], i[x], j[x])) != last:
                    if sum(b.num_rows for b in held) >= together:
                        yield from emit()
                        held = []
                    last = at
                held.append(batch.slice(x, y - x))
        yield from emit()

    return rows.repartition(*([tasks] if tasks else []), *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, "a long, b long")
