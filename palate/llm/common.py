"""Shared plumbing: tables, Arrow text buffers as byte arrays, word hashes, written intermediates, span digests."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from palate.session import scratch_path

# Bytes of text that one numpy pass holds at a time; its temporaries are about 60 times as large.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts lineage, keeps column pruning, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Up to this many rows of a few numbers may be broadcast.
BROADCAST_ROWS = 1_000_000


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, a narrow table cheap to count, broadcast if it has `limit` rows at most; otherwise joins shuffle."""
    return F.broadcast(df) if df.count() <= limit else df


def worker_model(key, make):
    """What `make` gives, kept by the Python worker for its later tasks, one model at a time."""
    kept = sys.modules.setdefault("_palate_worker", types.ModuleType("_palate_worker")).__dict__
    if kept.get("key") != key:
        release_model()
        kept["model"], kept["key"] = make(), key
    return kept["model"]


def release_model() -> None:
    """Let go of the model that tasks of an earlier operator left in this Python worker."""
    kept = sys.modules.setdefault("_palate_worker", types.ModuleType("_palate_worker")).__dict__
    if kept.pop("key", None) is not None:
        del kept["model"]
        gc.collect()


# Rows of an Arrow batch between Spark and Python; the default of 10,000 whole texts is more than a task should hold.
BATCH_ROWS = 1_000


def map_batches(rows: DataFrame, work, schema) -> DataFrame:
    """mapInArrow over batches of BATCH_ROWS rows at most (a setting of the session)."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return rows.mapInArrow(work, schema)


def fields_and(fields: list[StructField], ddl: str) -> StructType:
    """A schema of given fields, whatever their names, and those of a DDL string."""
    return StructType([*fields, *DataType.fromDDL(ddl).fields])


def kept_and(docs: DataFrame, columns: list[str], ddl: str) -> tuple[list[StructField], StructType]:
    """The fields of kept columns and the schema of those and a DDL string's; a column named like one of these gives way."""
    made = DataType.fromDDL(ddl).fields
    taken = {f.name.lower() for f in made}
    kept = [docs.schema[c] for c in columns if c.lower() not in taken]
    return kept, StructType([*kept, *made])


def kept_beside(docs: DataFrame, kept: list[StructField], value: Column) -> DataFrame:
    """Kept columns under names of their own, which mapInArrow needs to differ, and the column to work on, last."""
    return docs.select(*[docs[f"`{f.name}`"].alias(f"kept_{i}") for i, f in enumerate(kept)], value.alias("value"))


def has_map(kind: DataType) -> bool:
    return "map<" in kind.simpleString()


def row_hash(docs: DataFrame) -> Column:
    """A 64-bit hash of whole rows: which cells are null counts, maps go in as JSON."""
    fields = sorted(docs.schema.fields, key=lambda f: f.name)
    cells = [F.to_json(F.struct(docs[f"`{f.name}`"])) if has_map(f.dataType) else docs[f"`{f.name}`"] for f in fields]
    return F.xxhash64(*cells, *[docs[f"`{f.name}`"].isNull() for f in fields])


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column and the row offsets into them (rows + 1); null counts as empty."""
    kind = np.int64 if str(column.type).startswith("large") else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def text_slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of whole rows of about `limit` bytes."""
    raw, bounds = text_buffers(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, last, raw[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def byte_table(pattern_bytes: set[int]) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[sorted(pattern_bytes)] = True
    return marks


# A-Z to a-z; UTF-8 bytes of other letters stay
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# ASCII letters and digits, and every byte of a character beyond ASCII
ALNUM = byte_table({*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)})
# everything but space and \t \n \v \f \r
VISIBLE = byte_table(set(range(256)) - {32, 9, 10, 11, 12, 13})


def word_bounds(raw: np.ndarray, bounds: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of marked bytes inside one row) and, per row, the index of its first word."""
    flag = marks[raw]
    edges = bounds[:-1][bounds[:-1] < len(raw)]
    start = flag.copy()
    start[1:] &= ~flag[:-1]
    start[edges] |= flag[edges]
    end = flag.copy()
    end[:-1] &= ~flag[1:]
    inner = edges[edges > 0] - 1
    end[inner] |= flag[inner]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mix(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    places = np.arange(lengths.sum()) - np.repeat(firsts, lengths)
    powers = np.ones(int(lengths.max()), np.uint64)
    powers[1:] = BASE
    powers = np.multiply.accumulate(powers)
    terms = BYTE_CODES[raw[places + np.repeat(starts, lengths)]] * powers[places]
    return mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))


def joined_spans(spans: Column) -> Column:
    """'kind:start:end' of an array of structs, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
