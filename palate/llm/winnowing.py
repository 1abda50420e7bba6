"""Document fingerprints by winnowing: rolling hashes of all runs of characters, of every window the rightmost smallest."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField

from palate.llm.common import BASE, fields_and, map_batches, mix, release_model, text_slices

# Texts that share a run of GRAM + WINDOW - 1 characters share a fingerprint; shorter runs than GRAM never match.
GRAM, WINDOW = 8, 16
# A place that holds no run; real hashes are smaller.
NOTHING = np.uint64(2 ** 64 - 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2 ** 64))
# Rows that one task of the ordered pass holds, on average, and cells of the order per task.
TASK_ROWS, CELLS = 20_000, 4


def code_points(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, the byte at which each begins (and the end), and the rows' offsets into them."""
    leads = np.flatnonzero((raw & 0xC0) != 0x80)
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return codes, np.append(leads, len(raw)), np.searchsorted(leads, bounds)


def winnow(codes: np.ndarray, bounds: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and positions of the rows' fingerprints, and the rows' offsets into them.

    The hash of a run comes from a running sum: the next run's loses the leaving character and gains the entering one.
    Of every `window` runs in a row the smallest hash is kept, the rightmost of equal ones. A text of fewer than `gram`
    characters is one run, fewer than `window` runs are one window, an empty text has no fingerprint.
    """
    sizes = np.diff(bounds)
    lengths = np.minimum(sizes, gram)
    runs = np.where(sizes > 0, sizes - lengths + 1, 0)
    slots = np.where(runs > 0, np.maximum(runs, window), 0)
    firsts = np.concatenate([[0], np.cumsum(slots)])
    if not firsts[-1]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(sizes) + 1, np.int64)
    powers = np.full((2, len(codes) + 1), 1, np.uint64)
    powers[0, 1:], powers[1, 1:] = BASE, INVERSE
    powers = np.multiply.accumulate(powers, axis=1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[1, :-1])])
    inside = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    begin, length = np.repeat(bounds[:-1], runs) + inside, np.repeat(lengths, runs)
    hashes = mix((sums[begin + length] - sums[begin]) * powers[0, begin + length - 1])
    values = np.full(firsts[-1], NOTHING)
    values[np.repeat(firsts[:-1], runs) + inside] = np.minimum(hashes, NOTHING - np.uint64(1))
    best, places, width = values, np.arange(len(values)), 1
    while width < window:
        ahead = min(width, window - width)
        right = best[ahead:] <= best[:-ahead]
        places = np.where(right, places[ahead:], places[:-ahead])
        best = np.minimum(best[ahead:], best[:-ahead])
        width += ahead
    windows = slots - window + 1
    windows[slots == 0] = 0
    starts = np.repeat(firsts[:-1], windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    chosen = places[starts]
    chosen = chosen[np.diff(chosen, prepend=-1) != 0]
    cuts = np.searchsorted(chosen, firsts)
    return values[chosen], chosen - np.repeat(firsts[:-1], np.diff(cuts)), cuts


def likeness(first: np.ndarray, second: np.ndarray) -> float:
    """Shared among all distinct hashes of two fingerprints; two empty texts are alike."""
    first, second = np.unique(first), np.unique(second)
    if not len(first) and not len(second):
        return 1.0
    both = np.sort(np.concatenate([first, second]))
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def printed(hashes: np.ndarray, positions: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Per row its 'hash:position' pairs, comma-joined: 16 and 8 hexadecimal digits."""
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    line = np.empty((len(hashes), 26), np.uint8)
    line[:, 16], line[:, 25] = ord(":"), ord(",")
    for place in range(16):
        line[:, place] = digits[(hashes >> np.uint64(60 - 4 * place)) & np.uint64(15)]
    for place in range(8):
        line[:, 17 + place] = digits[(positions >> (28 - 4 * place)) & 15]
    kept = np.ones(line.shape, bool)
    filled = np.diff(cuts) > 0
    kept[cuts[1:][filled] - 1, 25] = False
    offsets = 26 * cuts - np.concatenate([[0], np.cumsum(filled)])
    return pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(line[kept])])


def fingerprint_documents(docs: DataFrame, keep: list[str], text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """`keep` as one struct `row`, with n_chars, hashes array<long> and positions array<int> of every whole text's fingerprint.

    Hashes are 64 bits wide, as signed numbers; positions are those of a run's first code point, ascending. Null and
    empty texts have empty arrays, repeated rows all appear, an empty table gives no rows; column names cannot clash.
    A very long text takes memory in proportion to its own length.
    """
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].alias("_text"))
    schema = fields_and([rows.schema["row"]], "n_chars long, hashes array<long>, positions array<int>")

    def run(batches):
        release_model()
        for batch in batches:
            kept = batch.column(0)
            for first, last, raw, bounds in text_slices(batch.column(1)):
                codes, _, starts = code_points(raw, bounds)
                hashes, positions, cuts = winnow(codes, starts, gram, window)
                offsets = pa.array(cuts, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [kept.slice(first, last - first), pa.array(np.diff(starts), pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                     pa.ListArray.from_arrays(offsets, pa.array(positions, pa.int32()))],
                    names=["row", "n_chars", "hashes", "positions"])

    return map_batches(rows, run, schema)


def sortable(key) -> tuple:
    return (key is not None, key)


def order_cells(rows: DataFrame, cells: int) -> tuple[list, list, dict]:
    """The order (_key, _hash) cut into cells: their smallest and largest members, and the cell that each largest one also follows.

    Spark's range partitioner deals keys and hashes out; what comes to the driver is two members per cell.
    """
    ranged = rows.select("_key", "_hash").repartitionByRange(cells, F.col("_key").asc_nulls_first(), "_hash")
    member = F.struct("_key", "_hash")
    ends = ranged.withColumn("_part", F.spark_partition_id()).groupBy("_part").agg(F.min(member).alias("a"), F.max(member).alias("z")).collect()
    ends = sorted(((*sortable(r["a"][0]), r["a"][1]), (*sortable(r["z"][0]), r["z"][1])) for r in ends)
    lows, highs = [a for a, _ in ends], [z for _, z in ends]
    # downwards, a cell's largest member comes after the smallest of the next higher cell; the largest of all after the last
    follows = {high: (number + 1) % len(highs) for number, high in enumerate(highs)}
    return lows, highs, follows


def fingerprint_sequence(
    docs: DataFrame, key: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW,
) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness, with the next document in view.

    Documents follow each other by descending key (null last; rows of one key by descending digest of the text), the first
    after the last. The edited text has the last half of its code points replaced by as many of the next document's
    first ones, or by all. Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint ('hash:position' in
    hexadecimal, comma-joined), near_edited and near_next (likeness to the edited text's and the next document's).

    The order is cut into cells (see `order_cells`); texts travel once, to their cell, where a sorted pass meets each with
    the one after it; a cell's largest member also goes to the cell that ends before it. Null texts count as empty,
    equal rows (key and text) share one place in the order and one result that appears for each of them, an empty
    table gives no rows, other columns are ignored, keys are integers, strings or dates. A very long text takes
    memory in proportion to its own length.
    """
    rows = docs.select(docs[key].alias("_key"), F.coalesce(docs[text], F.lit("")).alias("_text")).withColumn("_hash", F.md5("_text"))
    own = rows.schema["_key"]
    schema = fields_and([StructField("_key", own.dataType)], (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"))
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // TASK_ROWS)
    lows, _, follows = order_cells(rows, CELLS * tasks)
    if not lows:
        return spark.createDataFrame([], schema).withColumnRenamed("_key", key)

    def place(batches):
        release_model()
        for batch in batches:
            members = [(*sortable(k), h) for k, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            copies: dict = {}
            for number, member in enumerate(members):
                copies.setdefault(member, []).append(number)
            takes, cells, counts = [], [], []
            for member, numbers in copies.items():
                takes.append(numbers[0])
                cells.append(bisect.bisect_right(lows, member) - 1)
                counts.append(len(numbers))
                if member in follows:  # count 0: only seen as the next one
                    takes.append(numbers[0])
                    cells.append(follows[member])
                    counts.append(0)
            taken = batch.take(pa.array(takes, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cells, pa.int32()), pa.array(counts, pa.int64())], names=["_key", "_text", "_hash", "_cell", "_copies"])

    placed = map_batches(rows, place, fields_and([own, *rows.schema.fields[1:]], "_cell int, _copies long"))
    ordered = placed.repartition(tasks, "_cell").sortWithinPartitions(
        "_cell", F.col("_copies") == 0, F.col("_key").desc_nulls_last(), F.desc("_hash"))
    kind = to_arrow_type(own.dataType)

    def walk(batches):
        release_model()
        names = schema.names
        for held, following in neighbours(batches):
            for first, last, *_ in text_slices(held.column(1)):
                part = held.slice(first, last - first)
                nexts = following.slice(first, last - first)
                columns = compared(part.column(1), nexts, gram, window)
                copies = part.column(4).to_numpy()
                counted = np.flatnonzero(copies > 0)
                out = pa.RecordBatch.from_arrays([part.column(0).cast(kind), *columns], names=names)
                if (copies == 1).all():
                    yield out
                    continue
                yield out.take(pa.array(counted))
                for number in counted[copies[counted] > 1]:
                    left = int(copies[number]) - 1
                    while left:
                        size = min(left, 256)
                        yield out.take(pa.array(np.full(size, number)))
                        left -= size

    return map_batches(ordered, walk, schema).withColumnRenamed("_key", key)


def neighbours(batches) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(distinct rows, the text after each) of sorted batches. A cell's last row is only seen as the next one."""
    carried = None

    def merged(table: pa.RecordBatch, final: bool):
        cells, counts = table.column(3).to_numpy(), table.column(4).to_numpy()
        hashes, keys = table.column(2).to_pylist(), table.column(0).to_pylist()
        apart = [True] + [
            cells[i] != cells[i - 1] or (counts[i] > 0) != (counts[i - 1] > 0) or hashes[i] != hashes[i - 1] or keys[i] != keys[i - 1]
            for i in range(1, len(cells))]
        firsts = np.flatnonzero(apart)
        kept = table.take(pa.array(firsts))
        return kept.set_column(4, "_copies", pa.array(np.add.reduceat(counts, firsts), pa.int64()))

    for batch in batches:
        if not batch.num_rows:
            continue
        if carried is not None:
            batch = pa.concat_batches([carried, batch])
        batch = merged(batch, False)
        size = batch.num_rows - 1
        if size:
            held = batch.slice(0, size)
            # rows that end a cell have count 0 and are dropped, so what follows them does not matter
            yield held, batch.column(1).slice(1, size)
        carried = batch.slice(size, 1)


def compared(texts: pa.Array, nexts: pa.Array, gram: int, window: int) -> list[pa.Array]:
    """n_chars, edited digest, both fingerprints and both likenesses of texts and those that follow them."""
    sides = []
    for column in (texts, nexts):
        _, _, raw, bounds = next(text_slices(column, 1 << 62))
        sides.append((raw, *code_points(raw, bounds)))
    (raw, codes, leads, starts), (next_raw, next_codes, next_leads, next_starts) = sides
    sizes = np.diff(starts)
    pieces, digests, edited_sizes = [], [], []
    for row, size in enumerate(sizes):
        begin, cut = starts[row], starts[row + 1] - size // 2
        after = next_starts[row]
        end = min(after + size // 2, next_starts[row + 1])
        pieces += [codes[begin:cut], next_codes[after:end]]
        edited_sizes.append(cut - begin + end - after)
        digest = hashlib.sha256(raw[leads[begin]:leads[cut]])
        digest.update(next_raw[next_leads[after]:next_leads[end]])
        digests.append(digest.hexdigest())
    edited = winnow(np.concatenate(pieces), np.concatenate([[0], np.cumsum(edited_sizes)]), gram, window)
    mine, later = winnow(codes, starts, gram, window), winnow(next_codes, next_starts, gram, window)

    def near(one, other):
        return pa.array([likeness(one[0][a:b], other[0][c:d]) for a, b, c, d in zip(one[2], one[2][1:], other[2], other[2][1:])], pa.float64())

    return [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), printed(*mine), printed(*edited), near(mine, edited), near(mine, later)]
