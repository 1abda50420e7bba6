"""Language identification by cross-parsing: suffix automata of labelled text, fewest normalised phrases win."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from palate.llm.common import kept_and, kept_beside, map_batches, text_slices, worker_model

# Bounds of the training sample: this many documents of a language on average, the letters at the start of each, and
# bytes of normalised text per language.
TRAIN_DOCS = 160
TRAIN_CHARS = 1_000
TRAIN_BYTES = 48_000
# Texts are parsed in pieces of this many bytes, all pieces of a batch side by side.
PIECE = 512
UNDECIDED = "und"
# A text of at least FOREIGN_BYTES of letters that costs more bits a byte than this is in none of the learnt languages.
FOREIGN_BITS, FOREIGN_BYTES = 6.0, 100


def letters(text: Column) -> Column:
    """Lower-case runs of letters, one space between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def held_out(key: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> dict[str, bytes]:
    """Per label at most TRAIN_BYTES of normalised text, from documents that are not held out and have a label.

    Documents are taken by a hash of their id, about TRAIN_DOCS a label; their shares follow from counts over all
    rows, so the sample has the same size for any input. What reaches the driver is bounded by these parameters.
    """
    usable = docs.where(F.col(label).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    counts = {row[label]: row["count"] for row in usable.groupBy(label).count().collect()}  # one row per language
    if not counts:
        return {}
    steps = 1 << 30
    quota = F.lit(0)
    for name, count in sorted(counts.items()):
        quota = F.when(F.col(label) == name, F.lit(math.ceil(steps * min(1.0, TRAIN_DOCS / count)))).otherwise(quota)
    sample = (
        usable.where(F.pmod(F.xxhash64(F.col(key)), F.lit(steps)) < quota)
        .select(F.col(label).alias("label"), F.xxhash64(F.col(key)).alias("place"),
                F.substring(letters(F.substring(F.col(text), 1, 4 * TRAIN_CHARS)), 1, TRAIN_CHARS).alias("body"))
        .distinct()
    )
    texts: dict[str, list] = {}
    for row in sample.collect():
        texts.setdefault(row["label"], []).append((row["place"], row["body"]))
    out = {}
    for name, found in sorted(texts.items()):
        bodies = dict.fromkeys(body for _, body in sorted(found) if body)  # copies of a text count once
        joined = " ".join(bodies).encode("utf-8")[:TRAIN_BYTES]
        if joined:
            out[name] = joined
    return out


def suffix_automaton(data: bytes) -> tuple[list[dict[int, int]], list[int]]:
    """Transitions of every state (state 0 is the root) and suffix links of the automaton of all substrings."""
    moves, links, lengths = [{}], [-1], [0]
    last = 0
    for symbol in data:
        current = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        state = last
        while state != -1 and symbol not in moves[state]:
            moves[state][symbol] = current
            state = links[state]
        if state != -1:
            target = moves[state][symbol]
            if lengths[state] + 1 == lengths[target]:
                links[current] = target
            else:
                clone = len(moves)
                moves.append(dict(moves[target]))
                lengths.append(lengths[state] + 1)
                links.append(links[target])
                while state != -1 and moves[state].get(symbol) == target:
                    moves[state][symbol] = clone
                    state = links[state]
                links[target] = links[current] = clone
        last = current
    return moves, links


class Parser:
    """Cross-parsing of many texts side by side against the automaton of one language's text.

    A phrase is the longest match at its place: it grows while the automaton has a transition; where it has none, a
    phrase starts anew at this symbol, and a symbol that the text lacks is a phrase of its own. `step` holds the next state for (state, symbol class), negative where a new
    phrase starts, states multiplied by the number of classes; class 0 is any symbol the text lacks.
    """

    def __init__(self, data: bytes):
        moves, _ = suffix_automaton(data)
        symbols = sorted(set(data))
        self.classes = np.zeros(256, np.uint8)
        self.classes[symbols] = np.arange(1, len(symbols) + 1)
        self.log_length = math.log2(len(data) + 1)
        width, outside = len(symbols) + 1, len(moves)
        # where a phrase ends: the state of the next symbol alone, or, if the text lacks it, the state outside
        restart = np.full(width, outside, np.int32)
        for symbol, state in moves[0].items():
            restart[self.classes[symbol]] = state
        table = np.tile(-restart * width, (len(moves) + 1, 1)).astype(np.int32)
        for state, row in enumerate(moves):
            for symbol, target in row.items():
                table[state, self.classes[symbol]] = target * width
        self.step, self.outside = table.ravel(), outside * width

    def phrases(self, columns: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each piece: `columns[j, :active[j]]` are the j-th bytes of the pieces still that long."""
        counts = np.zeros(columns.shape[1], np.int32)
        states = np.full(columns.shape[1], self.outside, np.int32)
        for place, size in enumerate(active):
            reached = self.step[states[:size] + self.classes[columns[place, :size]]]
            counts[:size] += reached < 0
            np.absolute(reached, out=states[:size])
        return counts


def pieces_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes cut into pieces of PIECE, longest first and transposed; how many are still active at each place; their rows."""
    sizes = np.diff(bounds)
    per_row = -(-sizes // PIECE)
    rows = np.repeat(np.arange(len(sizes)), per_row)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = bounds[rows] + nth * PIECE
    lengths = np.minimum(PIECE, bounds[rows + 1] - starts)
    order = np.argsort(-lengths, kind="stable")
    rows, starts, lengths = rows[order], starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    padded = np.concatenate([raw, np.zeros(PIECE, np.uint8)])
    columns = np.empty((longest, len(rows)), np.uint8)
    for place in range(longest):
        columns[place] = padded[np.minimum(starts + place, len(padded) - 1)]
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    return columns, active, rows


def worker_parsers(texts: dict[str, bytes]) -> list[tuple[str, Parser]]:
    key = ("parsers", hashlib.sha256(repr(sorted(texts.items())).encode()).hexdigest())
    return worker_model(key, lambda: [(name, Parser(data)) for name, data in sorted(texts.items())])


def cross_entropies(raw: np.ndarray, bounds: np.ndarray, parsers: list[tuple[str, Parser]]) -> np.ndarray:
    """Per row and language: phrases * log2(training length) / bytes, the cross-parsing estimate in bits a byte."""
    columns, active, rows = pieces_of(raw, bounds)
    sizes = np.maximum(np.diff(bounds), 1)
    out = np.empty((len(sizes), len(parsers)))
    for place, (_, parser) in enumerate(parsers):
        phrases = np.bincount(rows, parser.phrases(columns, active), minlength=len(sizes))
        out[:, place] = phrases * parser.log_length / sizes
    return out


def predict_languages(docs: DataFrame, texts: dict[str, bytes], columns: list[str], text: str = "text") -> DataFrame:
    """`columns` of every row plus lang_pred, score (0 to 1: margin over the runner-up), bits (the winner's estimate) and
    foreign (whether no learnt language fits).

    Only the text decides. Whole texts are parsed; PIECE bytes at a time start a phrase of their own, the same for every
    language. Null texts and texts without a letter, or nothing to learn from, give 'und' with score 0 and bits null; ties
    go to the first language by name. Repeated rows stay, an empty table gives no rows, other columns are ignored,
    a kept column named like a result gives way to it.
    """
    kept, schema = kept_and(docs, columns, "lang_pred string, score double, bits double, foreign boolean")

    def run(batches):
        parsers = worker_parsers(texts)
        for batch in batches:
            names, scores, bits, foreign = [], [], [], []
            for _, _, raw, bounds in text_slices(batch.column(len(kept))):
                found = np.diff(bounds) > 0
                if not parsers or not found.any():
                    names += [UNDECIDED] * len(found)
                    scores += [0.0] * len(found)
                    bits += [None] * len(found)
                    foreign += [False] * len(found)
                    continue
                values = cross_entropies(raw, bounds, parsers)
                best = values.argmin(axis=1)
                ranked = np.sort(values, axis=1)
                second = ranked[:, 1] if values.shape[1] > 1 else np.full(len(found), np.inf)
                margin = np.clip(1 - ranked[:, 0] / np.maximum(second, 1e-12), 0, 1)
                names += [parsers[b][0] if f else UNDECIDED for b, f in zip(best, found)]
                scores += np.where(found, margin, 0.0).tolist()
                bits += [v if f else None for v, f in zip(ranked[:, 0].tolist(), found)]
                foreign += (found & (ranked[:, 0] > FOREIGN_BITS) & (np.diff(bounds) >= FOREIGN_BYTES)).tolist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(bits, pa.float64()), pa.array(foreign, pa.bool_())],
                names=[f.name for f in kept] + ["lang_pred", "score", "bits", "foreign"])

    return map_batches(kept_beside(docs, kept, letters(docs[text])), run, schema)
