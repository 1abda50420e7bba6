"""Benchmark decontamination: latent semantic search for benchmark passages, then subsequence and answer checks."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from palate.llm.common import ALNUM, fields_and, map_batches, release_model, text_slices, word_bounds, word_hashes, written

# Documents are summed up in blocks of STEP words; LONG and SHORT passages are compared with runs of so many words.
STEP, LONG, SHORT = 8, 32, 16
# Items of more words than this are verified in parts of this many, half overlapping.
UNIT = 64
RANK, OVERSAMPLE, POWERS = 320, 16, 1
# Passages that one pass over the documents searches for; more take further passes. Passages share few words, so their
# spectrum is flat: the rank must be near their number, or single words would pass for whole passages.
BLOCK = 400
# A candidate's cosine; shares of a unit's words in common order that decide alone, or together with the answer.
COSINE, SURE, POSSIBLE, ANSWER = 0.45, 0.8, 0.6, 0.6
# Words whose document frequencies travel to the tasks (16 bytes each); rarer ones share the bound of those left out.
TABLE = 1 << 18


@dataclass
class Units:
    """What is verified: word hashes of each unit and of its answer, and the item it belongs to."""
    items: list
    words: list[np.ndarray]
    answers: list[np.ndarray]


def hashes_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.lower().encode("utf-8"), np.uint8)
    starts, ends, _ = word_bounds(raw, np.array([0, len(raw)]), ALNUM)
    return word_hashes(raw, starts, ends)


def units_of(rows: list[tuple], answers: bool) -> Units:
    """Units of (item, text[, answer]) rows. Without an answer column the last sentence of two words or more answers."""
    out = Units([], [], [])
    for row in rows:
        words = hashes_of(row[1] or "")
        if not len(words):
            continue
        if answers and row[2]:
            answer = hashes_of(row[2])
        else:
            sentences = [h for h in map(hashes_of, re.split(r"[.!?\n]+", row[1])) if len(h) > 1]
            answer = sentences[-1] if sentences else words[-5:]
        last = max(1, -(-(len(words) - UNIT) // (UNIT // 2)) + 1)
        for part in range(last):
            begin = min(part * UNIT // 2, max(0, len(words) - UNIT))
            out.items.append(row[0])
            out.words.append(words[begin:begin + UNIT])
            out.answers.append(answer)
    return out


def passages_of(units: Units) -> Iterator[tuple[int, np.ndarray]]:
    """(unit, word hashes) of the passages that are searched for."""
    for number, words in enumerate(units.words):
        if len(words) <= LONG:
            yield number, words
            continue
        for begin in sorted({*range(0, len(words) - LONG, LONG // 2), len(words) - LONG}):
            yield number, words[begin:begin + LONG]


class Lookup:
    """Places of hashes in a sorted table, len(table) for others: a directory by the top bits, then a step or few."""

    def __init__(self, table: np.ndarray):
        self.table = np.append(table, np.uint64(2 ** 64 - 1))
        self.shift = np.uint64(64 - min(20, max(1, len(table).bit_length() + 1)))
        cells = np.arange((1 << (64 - int(self.shift))) + 1)
        self.begin = np.searchsorted(table >> self.shift, cells).astype(np.int32)
        self.most = int(np.diff(self.begin).max(initial=0))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        cells = (hashes >> self.shift).astype(np.int64)
        place, end = self.begin[cells], self.begin[cells + 1]
        out = np.full(len(hashes), len(self.table) - 1, np.int32)
        open_ = np.flatnonzero(place < end)
        for _ in range(self.most):
            at = place[open_]
            met = self.table[at] == hashes[open_]
            out[open_[met]] = at[met]
            place[open_] += 1
            open_ = open_[~met & (place[open_] < end[open_])]
        return out


@dataclass
class Frequencies:
    """In how many documents the corpus' more frequent words occur; every other word occurs in `least` at most."""
    words: np.ndarray  # sorted hashes
    counts: np.ndarray
    least: int
    total: int
    counted: DataFrame | None = None  # the whole table (word, n) in the shared folder

    def __post_init__(self):
        self.known = np.append(np.log((self.total + 1) / (self.counts + 1)) + 1e-3, np.log((self.total + 1) / (self.least + 1)) + 1e-3)

    def idf(self, hashes: np.ndarray) -> np.ndarray:
        """Weights of words, whichever block or document they stand in; beyond the table the bound, so never too much."""
        return self.known[Lookup(self.words)(hashes)]

    def exact(self, spark, hashes: np.ndarray) -> np.ndarray:
        """Weights of a block's vocabulary by their own counts, however rare they are in the corpus."""
        own = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "word long")
        met = {r["word"]: r["n"] for r in self.counted.join(F.broadcast(own), "word").collect()}  # a block's words at most
        counts = np.array([met.get(int(h), 0) for h in hashes.view(np.int64)])
        return np.log((self.total + 1) / (counts + 1)) + 1e-3


def document_frequencies(docs: DataFrame, limit: int = TABLE) -> Frequencies:
    """Every word of all documents (column _text) is counted; the table holds at most `limit` of them, the most frequent."""
    def count(batches):
        release_model()
        held, size = [], 0

        def merged():
            words, places = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            counts = np.bincount(places, np.concatenate([n for _, n in held])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])

        for batch in batches:
            for _, _, raw, bounds in text_slices(batch.column(0)):
                starts, ends, firsts = word_bounds(raw, bounds, ALNUM)
                words, places = np.unique(word_hashes(raw, starts, ends), return_inverse=True)
                rows = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
                pairs = np.unique(rows * len(words) + places)
                if not len(words):
                    continue
                held.append((words, np.bincount(pairs % len(words), minlength=len(words))))
                size += len(words)
                if size > 1 << 21:
                    yield merged()
                    held, size = [], 0
        if held:
            yield merged()

    total = docs.count()
    counted = written(map_batches(docs.select("_text"), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "frequencies")
    least, kept = 0, 0
    # distinct counts: at most the square root of twice the distinct (document, word) pairs
    for row in sorted(counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["n"]):
        kept += row["words"]
        if kept > limit:
            least = row["n"]
            break
    table = counted.where(F.col("n") > least).toPandas()  # `limit` rows of two numbers at most
    words = table["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return Frequencies(words[order], table["n"].to_numpy(np.int64)[order], least, total, counted)


def summed(rows: DataFrame, work, shape: tuple[int, int]) -> np.ndarray:
    """The sum over tasks of the matrix that `work` makes of a task's (terms, weights) rows; matrices travel in bands."""
    bands = 16

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            for terms, weights in zip(batch["terms"], batch["weights"]):
                work(total, np.asarray(terms), np.asarray(weights))
        cuts = np.linspace(0, shape[0], bands + 1).astype(int)
        yield pd.DataFrame({"band": range(bands), "part": [total[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]})

    def add(parts):
        total = np.sum([np.frombuffer(p) for p in parts["part"]], axis=0)
        return pd.DataFrame({"band": parts["band"].iloc[:1], "part": [np.asarray(total).tobytes()]})

    made = rows.mapInPandas(run, "band int, part binary").groupBy("band").applyInPandas(add, "band int, part binary").collect()
    return np.frombuffer(b"".join(bytes(r["part"]) for r in sorted(made, key=lambda r: r["band"]))).reshape(shape)


def randomised_svd(rows: DataFrame, width: int, rank: int, seed: int = 3) -> np.ndarray:
    """The leading right singular vectors (width x rank) of the sparse matrix whose rows are (terms, weights).

    A Gaussian range finder with power iterations: every product with the matrix is one pass over `rows`, tasks send
    sums of fixed shape, only matrices of width x (rank + OVERSAMPLE) are factored on the driver.
    """
    context = rows.sparkSession.sparkContext
    columns = min(rank + OVERSAMPLE, width)
    basis = np.random.default_rng(seed).standard_normal((width, columns))
    for _ in range(1 + POWERS):
        shared = context.broadcast(basis)

        def forth_and_back(total, terms, weights):
            total[terms] += np.outer(weights, weights @ shared.value[terms])

        basis, _ = np.linalg.qr(summed(rows, forth_and_back, (width, columns)))
    shared = context.broadcast(basis)

    def gram(total, terms, weights):
        row = weights @ shared.value[terms]
        total += np.outer(row, row)

    _, vectors = np.linalg.eigh(summed(rows, gram, (basis.shape[1], basis.shape[1])))
    return basis @ vectors[:, ::-1][:, :rank]


def common_length(unit: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, one machine-word operation per region word of the unit (bit-parallel)."""
    places: dict[int, int] = {}
    for place, word in enumerate(unit.tolist()):
        places[word] = places.get(word, 0) | 1 << place
    full = (1 << len(unit)) - 1
    row = full
    for word in region.tolist():
        match = places.get(word)
        if match:
            met = row & match
            row = ((row + met) | (row - met)) & full
    return len(unit) - row.bit_count()


class Index:
    """Everything a task needs to search documents for one block of passages."""

    def __init__(self, vocabulary: np.ndarray, weights: np.ndarray, frequencies: Frequencies, axes: np.ndarray, sides: list, floor: float, units: Units):
        size, words = len(vocabulary), np.union1d(vocabulary, frequencies.words)
        terms = np.minimum(np.searchsorted(vocabulary, words), size - 1)
        known = vocabulary[terms] == words
        self.lookup, self.size = Lookup(words), size
        # per word of the table, and last for any other one: its term (`size`: not in the vocabulary) and squared weight
        self.terms = np.append(np.where(known, terms, size), size).astype(np.int32)
        self.squares = np.append(np.where(known, weights[terms], frequencies.idf(words)), frequencies.known[-1]) ** 2
        self.latent = (weights[:, None] * axes).astype(np.float32)  # idf-weighted latent vector of each term
        self.sides = sides  # words in a run, passages as unit-free search rows, their units
        self.floor, self.units = floor, units
        self.unit_terms = [np.searchsorted(vocabulary, words) for words in units.words]

    def hits(self, raw: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, float, float, bool, int, int]]:
        """(row, unit, cosine, share in order, answer found, first word, last word + 1) of verified candidates."""
        starts, ends, firsts = word_bounds(raw, bounds, ALNUM)
        words = word_hashes(raw, starts, ends)
        places = self.lookup(words)
        terms, weight = self.terms[places], self.squares[places]
        counts = np.diff(firsts)
        steps = -(-counts // STEP)
        offsets = np.concatenate([[0], np.cumsum(steps)])
        owner = np.repeat(np.arange(len(counts)), steps)
        # the first word of every step: a row's steps follow each other
        begins = firsts[owner] + (np.arange(offsets[-1]) - offsets[owner]) * STEP
        known = terms < self.size
        if not known.any():
            return
        total = np.add.reduceat(weight, begins)
        mass = np.add.reduceat(np.where(known, weight, 0), begins)

        def over(values, run):
            # sums over `run` steps of one row; runs at a row's end are shorter
            out = values.copy()
            for ahead in range(1, run):
                out[:-ahead] += values[ahead:] * (owner[ahead:] == owner[:-ahead])
            return out

        # most runs have too little weight in known words for any cosine: only the others are projected
        runs, needed = [], np.zeros(offsets[-1] + LONG, bool)
        for width, search, numbers in self.sides:
            norms = over(total, width // STEP)
            hopeful = np.flatnonzero(over(mass, width // STEP) >= self.floor * norms)
            runs.append((width, search, numbers, hopeful, np.sqrt(norms)))
            for ahead in range(width // STEP):
                needed[hopeful + ahead] = True
        needed = np.flatnonzero(needed[:offsets[-1]])
        if not len(needed):
            return
        slots = np.full(offsets[-1] + LONG, -1)
        slots[needed] = np.arange(len(needed))
        sums = self.projected(terms, begins[needed], np.append(begins, len(words))[needed + 1])
        owner = np.concatenate([owner, np.full(LONG, -1)])
        candidates: dict[tuple[int, int], list] = {}
        for width, search, numbers, hopeful, lengths in runs:
            for begin in range(0, len(hopeful), 2048):
                part = hopeful[begin:begin + 2048]
                vectors = sums[slots[part]]
                for ahead in range(1, width // STEP):
                    vectors += sums[np.where(owner[part + ahead] == owner[part], slots[part + ahead], -1)]
                # no cosine is larger than what the projection keeps of the run's length
                likely = np.einsum("ij,ij->i", vectors, vectors) >= self.floor * lengths[part] ** 2
                part, vectors = part[likely], vectors[likely]
                cosines = (vectors @ search.T) / lengths[part][:, None]
                for at, passage in zip(*np.nonzero(cosines >= COSINE)):
                    place = int(part[at])
                    candidates.setdefault((int(owner[place]), int(numbers[passage])), []).append(
                        (-float(cosines[at, passage]), (place - int(offsets[owner[place]])) * STEP, width))
        present = np.zeros(self.size + 1, bool)
        for (row, unit), found in sorted(candidates.items()):
            own, answer, own_terms = self.units.words[unit], self.units.answers[unit], self.unit_terms[unit]
            best = None
            for cosine, begin, width in sorted(found):
                first = int(firsts[row]) + max(0, begin - len(own))
                last = min(int(firsts[row + 1]), int(firsts[row]) + begin + width + len(own))
                near = terms[first:last]
                # words of the unit that stand near the place at all: no common subsequence is longer
                present[near] = True
                most = int(present[own_terms].sum()) / len(own)
                present[near] = False
                if most < POSSIBLE or best is not None and most <= best[3]:
                    continue
                region = words[first:last]
                share = common_length(own, region) / len(own)
                if best is not None and share <= best[3]:
                    continue
                answered = share >= POSSIBLE and common_length(answer, region) >= ANSWER * len(answer)
                best = (row, unit, -cosine, share, answered, first - int(firsts[row]), last - int(firsts[row]))
                if share >= SURE:
                    break
            if best is not None and (best[3] >= SURE or best[3] >= POSSIBLE and best[4]):
                yield best

    def projected(self, terms: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums of the latent vectors of steps of words; the last row stays zero."""
        sums = np.zeros((len(begins) + 1, self.latent.shape[1]), np.float32)
        places = begins[:, None] + np.arange(STEP)
        inside = np.where(places < ends[:, None], terms[np.minimum(places, len(terms) - 1)], self.size)
        inside.sort(axis=1)  # words outside the vocabulary go last
        for column in inside.T:
            rows = np.flatnonzero(column < self.size)
            sums[rows] += self.latent[column[rows]]
        return sums


def build_index(docs: DataFrame, units: Units, passages: list[tuple[int, np.ndarray]], frequencies: Frequencies) -> Index:
    """TF-IDF of the passages with document frequencies of the whole corpus, their SVD, and the search rows."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([words for _, words in passages]))
    idf = frequencies.exact(spark, vocabulary)
    terms = [np.unique(np.searchsorted(vocabulary, words), return_counts=True) for _, words in passages]
    data = [([int(t) for t in t_], [float(w) for w in c * idf[t_]]) for t_, c in terms]
    rows = spark.createDataFrame(data, "terms array<int>, weights array<double>").repartition(max(1, len(data) // 128))
    axes = randomised_svd(rows, len(vocabulary), min(RANK, len(passages), len(vocabulary)))
    latent = idf[:, None] * axes
    vectors = np.stack([c @ latent[t_] for t_, c in terms])
    whole = np.sqrt(np.array([((c * idf[t_]) ** 2).sum() for t_, c in terms]))
    kept = np.einsum("ij,ij->i", vectors, vectors)
    # cosine with a run's latent vector, the part outside the space counted in both lengths, scaled so that the passage
    # itself has 1
    search = (vectors * (whole / np.maximum(kept, 1e-12))[:, None]).astype(np.float32)
    lengths = np.array([len(words) for _, words in passages])
    owners = np.array([unit for unit, _ in passages])
    short = lengths <= (LONG + SHORT) // 2 - 2
    sides = [(w, search[m], owners[m]) for w, m in ((SHORT, short), (LONG, ~short)) if m.any()]
    # no run with a smaller share of known weight reaches COSINE with any passage
    floor = COSINE ** 2 * float((kept / whole ** 2).min())
    return Index(vocabulary, idf, frequencies, axes, sides, floor, units)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", answer: str | None = None,
) -> DataFrame:
    """(key, item, cosine, share, answered, first_word, last_word): benchmark items that documents hold.

    Passages of the items are searched by cosine in a latent space of TF-IDF, all words of a run weighed by their document
    frequency in the corpus, those of the block's vocabulary or not; a candidate is a leak if SURE of its unit's
    words occur in order near the place, or POSSIBLE of them together with the answer. One row per
    document row and item, of its best unit. Every run of words of every whole text is compared with every passage; the
    benchmark travels in blocks of about BLOCK passages (an item is never cut), one pass over the documents each, whose
    leaks are written before the next. Null and empty texts hold nothing, null or wordless items are never found,
    repeated rows and copies all appear, an empty table or benchmark gives no rows; other columns are ignored, whatever
    their names. A very long text is searched in one piece, with memory in proportion to its own length.
    """
    columns = [benchmark[item], benchmark[item_text], *([benchmark[answer]] if answer else [])]
    rows = docs.select(docs[key].alias("key"), F.lower(F.coalesce(docs[text], F.lit(""))).alias("_text"))
    schema = fields_and(
        [StructField("key", docs.schema[key].dataType), StructField("item", benchmark.schema[item].dataType)],
        "cosine double, share double, answered boolean, first_word long, last_word long")
    frequencies, out = None, docs.sparkSession.createDataFrame([], schema)
    held, block = [], 0

    def flush():
        nonlocal out, frequencies, held
        units = units_of(held, answer is not None)
        passages = list(passages_of(units))
        held = []
        if not passages:
            return
        frequencies = document_frequencies(rows) if frequencies is None else frequencies
        out = out.union(search(rows, build_index(rows, units, passages, frequencies), schema))

    for row in benchmark.select(*columns).toLocalIterator():  # the driver holds one block at a time
        held.append(tuple(row))
        block += max(1, len((row[1] or "").split()) // (LONG // 2))
        if block >= BLOCK:
            flush()
            block = 0
    flush()
    return out.withColumnsRenamed({"key": key, "item": item})


def search(rows: DataFrame, index: Index, schema: StructType) -> DataFrame:
    """The index's leaks in all rows, written. It travels as bytes that hold its classes, so workers need no copy of them."""
    shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))
    kind = to_arrow_type(schema["item"].dataType)

    def run(batches):
        release_model()
        index = pickle.loads(shared.value)
        for batch in batches:
            keys, found = batch.column(0), []
            for first, _, raw, bounds in text_slices(batch.column(1)):
                best: dict = {}
                for row, unit, *rest in index.hits(raw, bounds):
                    own = (first + row, index.units.items[unit])
                    if own not in best or (rest[1], rest[0]) > (best[own][1], best[own][0]):
                        best[own] = rest
                found += [(*own, *rest) for own, rest in best.items()]
            places, items, *rest = zip(*found) if found else [()] * 7
            types = [pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(places, pa.int64())), pa.array(items, kind), *(pa.array(list(v), t) for v, t in zip(rest, types))]
                if found else [keys[:0], pa.array([], kind), *(pa.array([], t) for t in types)],
                names=["key", "item", "cosine", "share", "answered", "first_word", "last_word"])

    leaks = written(map_batches(rows, run, schema), "leaks")
    shared.destroy()
    return leaks
