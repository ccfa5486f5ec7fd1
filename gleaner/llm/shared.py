"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

WORD = np.zeros(256, dtype=bool)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    WORD[_c] = True
WORD[128:] = True

PRIME = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 20
BATCH_BYTES = 8 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only on a single machine (tests), where none is named.

    A cluster without such a folder is an error: its executors don't share a machine's own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    held = context.getCheckpointDir()
    if folder:
        if not held:
            context.setCheckpointDir(folder)
        return folder
    if not held:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        held = context.getCheckpointDir()
    return held


def cut(df: DataFrame) -> DataFrame:
    """Runs the plan once and cuts its lineage through reliable storage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back (column pruning stays possible)."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_of(text: str) -> int:
    """Bytes of a size setting such as 4m, 64kb or 1048576; plain numbers are bytes."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", text.lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit[:1] if unit != "b" else ""]


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` for long texts: a batch is held several times over, on both sides of the pipe.

    Plans read this setting of the session when they run, so it stays for later queries of
    the session as well; it changes no result.  A lower limit that the session has stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = size_of(spark.conf.get(name))
    if held <= 0 or held > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def fresh(df: DataFrame, name: str) -> str:
    """A name like this one that no column of ``df`` has, in whatever case."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name = f"_{name}"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over an array of uint64."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((PRIME * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _inverse(p: int) -> int:
    return pow(p, -1, 1 << 64)


def text_chunks(column: pa.Array, lower: bool = True, limit: int = CHUNK_BYTES):
    """Cuts a string column into runs of rows of about ``limit`` bytes.

    Yields (first row, bytes as uint8, row offsets).  A row is never cut: a very
    long text makes a chunk of its own.  Null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if not len(column):
        return
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    start = 0
    while start < len(column):  # only one run of rows is held in another form at a time
        end = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(column))
        part = column.slice(start, end - start)
        if part.null_count:
            part = part.fill_null("")
        if lower:
            part = pc.utf8_lower(part)
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        raw = part.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        yield start, data[offsets[0] : offsets[-1]], offsets - offsets[0]
        start = end


class Words:
    """Words of a chunk: ``hash`` and ``row`` of each, byte spans, and ``first[row] : first[row + 1]``."""

    __slots__ = ("hash", "row", "start", "end", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        """A word is a longest run of ASCII letters or digits and bytes above 127, within one row."""
        n = len(data)
        word = WORD[data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inner = offsets[1:-1]
        inner = inner[inner < n]
        begins[inner] = word[inner]
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        last = inner[inner > 0] - 1
        ends[last] = word[last]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        with np.errstate(over="ignore"):
            power = np.full(n + 1, PRIME, dtype=np.uint64)
            power[0] = 1
            np.cumprod(power, out=power)
            back = np.full(n + 1, _inverse(PRIME), dtype=np.uint64)
            back[0] = 1
            np.cumprod(back, out=back)
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
            value = (total[self.end] - total[self.start]) * back[self.start]
            self.hash = mix(value + (self.end - self.start).astype(np.uint64))
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
