"""License scan: ordered signature rules behind a keyword prefilter, overlaps settled by priority and containment."""

from __future__ import annotations

import re
import re._parser as regex_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from palate.llm.common import ALNUM, LOWER, kept_and, kept_beside, map_batches, text_slices, word_bounds, worker_model
from palate.llm.license_rules import all_rules

# Base phrases of consecutive words and their labels (fixed values).
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
BASE_CONFIDENCE = 0.6
CONFIDENCE = {4: 1.0, 3: 0.95, 2: 0.8, 1: 0.5}
GAP = r"[\s*#/;-]+"


def spaced(pattern: str) -> str:
    """The pattern with every space outside brackets matching any run of white space and comment marks."""
    return re.sub(r"(\[[^\]]*\]|\\.)| ", lambda m: m[1] or f"(?:{GAP})", pattern)


def mandatory(pattern: str) -> list[str]:
    """Strings that every match of the pattern holds as they are."""
    runs = [""]

    def read(items):
        for name, value in items:
            name = str(name)
            if name == "LITERAL":
                runs[-1] += chr(value)
            elif name == "SUBPATTERN":
                read(value[3])
            elif name != "AT":
                runs.append("")
                if name.endswith("_REPEAT") and value[0]:
                    read(value[2])
                    runs.append("")

    read(regex_parser.parse(pattern))
    return [run for run in runs if run]


def filter_word(keyword: str, pattern: str) -> str:
    """What a text must hold for the (spaced) pattern to match: the longest word of the keyword that every match holds, or
    else the longest string that every match holds. A space can match any white space and comment marks, so none is in it."""
    held = mandatory(pattern)
    words = [word for word in keyword.split() if any(word in run for run in held)]
    return max(words or held, key=len)


def compiled_rules() -> list[tuple[str, int, bytes, re.Pattern]]:
    return worker_model("license_rules", lambda: [
        (label, priority, filter_word(keyword, spaced(pattern)).encode(), re.compile(spaced(pattern).encode()))
        for label, priority, keyword, pattern in all_rules()])


def phrase_patterns() -> list[tuple[str, bytes, re.Pattern]]:
    inner, word = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    return [(label, words[0].encode(), re.compile(
        rb"(?<!" + word + rb")" + inner.join(w.encode() for w in words) + rb"(?!" + word + rb")")) for words, label in PHRASES]


def detections(low: bytes) -> list[tuple[int, int, str, int]]:
    """(start byte, end byte, label, priority) that remain after suppression, by start.

    A detection goes if it lies within another of higher priority, or of equal priority and greater length, or equal in
    both but of an earlier rule or place. Detections that overlap without containment all stay.
    """
    present: dict[bytes, bool] = {}
    found = []
    for order, (label, priority, keyword, pattern) in enumerate(compiled_rules()):
        if keyword not in present:
            present[keyword] = keyword in low
        if present[keyword]:
            found += [(-priority, m.start() - m.end(), m.start(), order, m.end(), label) for m in pattern.finditer(low)]
    found.sort()
    places = {start: i + 1 for i, start in enumerate(sorted({f[2] for f in found}))}
    reach = [0] * (len(places) + 1)  # Fenwick tree: greatest end of a kept detection that starts at or before a place
    kept = []
    for priority, _, start, _, end, label in found:
        place, furthest = places[start], 0
        while place:
            furthest = max(furthest, reach[place])
            place &= place - 1
        if furthest >= end:
            continue
        kept.append((start, end, label, -priority))
        place = places[start]
        while place <= len(places):
            reach[place] = max(reach[place], end)
            place += place & -place
    return sorted(kept)


def scan_licenses(docs: DataFrame, columns: list[str], text: str = "text", spans: bool = False) -> DataFrame:
    """`columns` of every row plus what its whole text says about licences.

    n_words; n_base, first_word, last_word and base_labels of the base phrases (word numbers from 0); labels of both the
    base phrases and the rules; score, the confidence of the surest detection (0: none); with `spans` also the kept
    detections as 'label:start:end' in bytes of the text. Labels are distinct, sorted and comma-joined. Null and
    empty texts have no words and no labels; repeated rows stay; an empty table gives no rows. A kept column
    named like a result gives way to it. A very long text is scanned as a whole.
    """
    kept, schema = kept_and(docs, columns, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
                            + (", detections string" if spans else ""))

    def run(batches):
        phrases = phrase_patterns()
        keywords = sorted({keyword for _, _, keyword, _ in compiled_rules()})
        for batch in batches:
            rows = []
            for first, last, raw, bounds in text_slices(batch.column(len(kept))):
                raw = LOWER[raw]
                starts, _, firsts = word_bounds(raw, bounds, ALNUM)
                whole = raw.tobytes()
                for row in range(last - first):
                    low = whole[bounds[row]:bounds[row + 1]]
                    words, labels = [], set()
                    for label, keyword, pattern in phrases:
                        if keyword in low and (hits := [m.start() for m in pattern.finditer(low)]):
                            labels.add(label)
                            words += np.searchsorted(starts[firsts[row]:firsts[row + 1]] - bounds[row], hits).tolist()
                    surest = BASE_CONFIDENCE if labels else 0.0
                    base = ",".join(sorted(labels))
                    extra = detections(low) if any(k in low for k in keywords) else []
                    for _, _, label, priority in extra:
                        labels.add(label)
                        surest = max(surest, CONFIDENCE[priority])
                    rows.append((int(firsts[row + 1] - firsts[row]), len(words), min(words, default=None), max(words, default=None),
                                 base, ",".join(sorted(labels)), surest, ",".join(f"{n}:{a}:{b}" for a, b, n, _ in extra)))
            made = list(zip(*rows)) if rows else [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"][:8 if spans else 7]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), *(pa.array(list(v), t) for v, t, _ in zip(made, types, names))],
                names=[f.name for f in kept] + names)

    return map_batches(kept_beside(docs, kept, docs[text]), run, schema)
