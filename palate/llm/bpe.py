"""Byte-level BPE over public rank files: a rank queue on hierarchical bitmaps, exact to the greedy merge order."""

from __future__ import annotations

import base64
import hashlib
import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from palate.llm.common import kept_and, kept_beside, map_batches, worker_model

# The pre-token pattern of the byte-level rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same for texts of ASCII and Latin letters only, where plain character ranges say it all and match faster.
BEYOND_LATIN = r"[^\t-\r -~ªµºÀ-ÖØ-öø-ɏ]"
LATIN_PATTERN = (
    r" ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]++|'(?:[stmd]|re|ve|ll)| ?[0-9]++| ?[^\sA-Za-z0-9ªµºÀ-ÖØ-öø-ɏ]++|\s+(?!\S)|\s+")
# Pre-tokens up to this many bytes are remembered per Python worker, CACHE_ENTRIES at most at a time.
CACHE_BYTES = 32
CACHE_ENTRIES = 800_000


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file's content: one 'base64 rank' line per token."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int], width: int = 256) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank merges first, of equal ranks the leftmost.

    Parts are a linked list over byte places. Pairs wait in one bucket per merge rank, which holds their left
    places (one number, or a heap of them). A two-level bitmap of the non-empty buckets, `width` bits to a word,
    gives the next rank by find-first-set. An entry whose pair has changed since is stale and skipped, so
    nothing is ever searched for; near-linear in the length, pre-tokens of any length may come.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    size = len(piece)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    pair = [-1] * size  # rank of the pair that starts here; -1: no such pair, or no part starts here
    top, words, buckets = 0, {}, {}
    fresh = [(place, get(piece[place:place + 2])) for place in range(size - 1)]
    while True:
        for place, rank in fresh:
            if rank is None:
                pair[place] = -1
                continue
            pair[place] = rank
            bucket = buckets.get(rank)
            if bucket is None:
                buckets[rank] = place
                word = rank // width
                bit = 1 << rank % width
                if word in words:
                    words[word] |= bit
                else:
                    words[word] = bit
                    top |= 1 << word
            elif type(bucket) is int:
                buckets[rank] = [bucket, place] if bucket < place else [place, bucket]
            else:
                heappush(bucket, place)
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            low = bits & -bits
            rank = word * width + low.bit_length() - 1
            bucket = buckets[rank]
            if type(bucket) is int:
                place = bucket
                del buckets[rank]
                bits ^= low
                if bits:
                    words[word] = bits
                else:
                    del words[word]
                    top ^= 1 << word
            else:
                place = heappop(bucket)
                if len(bucket) == 1:
                    buckets[rank] = bucket[0]
            if pair[place] == rank:
                break
        else:
            break
        gone = after[place]
        end = after[gone]
        after[place] = end
        pair[gone] = -1
        fresh = [(place, None)]
        if end < size:
            before[end] = place
            fresh = [(place, get(piece[place:after[end]]))]
        left = before[place]
        if left >= 0:
            fresh.append((left, get(piece[left:end])))
    ids, place = [], 0
    while place < size:
        ids.append(ranks[piece[place:after[place]]])
        place = after[place]
    return ids


class Encoder(dict):
    """Pre-token -> its ids as decimal text; short pre-tokens are remembered."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks = parse_ranks(content)
        token_of = {rank: token for token, rank in self.ranks.items()}
        tokens = [token_of.get(rank, b"") for rank in range(max(token_of, default=-1) + 1)]
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.width = max(64, int(len(self.ranks) ** 0.5) + 1)
        self.find = regex.compile(pattern).findall
        self.beyond_latin = re.compile(BEYOND_LATIN).search if pattern == PATTERN else None
        self.find_latin = re.compile(LATIN_PATTERN).findall

    def __missing__(self, piece: str) -> str:
        data = piece.encode("utf-8")
        ids = " ".join(map(str, merge_bytes(data, self.ranks, self.width)))
        if len(data) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids

    def pieces(self, text: str) -> list[str]:
        """Ids of each pre-token, in decimal, joined by single spaces."""
        latin = self.beyond_latin is not None and self.beyond_latin(text) is None
        return [self[piece] for piece in (self.find_latin if latin else self.find)(text)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from all tokens laid end to end."""
        sizes = self.sizes[ids]
        shift = self.starts[ids] - (np.cumsum(sizes) - sizes)
        return self.flat[np.arange(sizes.sum()) + np.repeat(shift, sizes)].tobytes()


def worker_encoder(content: bytes, pattern: str) -> Encoder:
    return worker_model(("bpe", hashlib.sha256(content).hexdigest(), pattern), lambda: Encoder(content, pattern))


def shared_ranks(spark: SparkSession, path: str):
    """The rank file (about a MB, as large as the vocabulary) sent to every executor; only the driver opens the path."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_documents(
    docs: DataFrame, path: str, pattern: str, columns: list[str], text: str = "text", digests: bool = False,
) -> DataFrame:
    """`columns` of every row plus n_tokens and either ids (array<int>) and round_trip (whether they decode to the text's
    bytes) or, with `digests`, ids_sha256 and decoded_sha256.

    `path` is a rank file, `pattern` splits text into pre-tokens, each of which is
    encoded on its own without special tokens; decoded_sha256 is of the bytes decoded from the ids.
    Null texts count as empty (no ids), repeated rows stay, an empty table gives no rows. A kept column named like a result
    gives way to it. A very long text is encoded as a whole.
    """
    ranks = shared_ranks(docs.sparkSession, path)
    types = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "n_tokens long, ids array<int>, round_trip boolean"
    kept, schema = kept_and(docs, columns, types)

    def run(batches):
        encoder = worker_encoder(ranks.value, pattern)
        for batch in batches:
            arrays = [batch.column(i) for i in range(len(kept))]
            counts, first, second = [], [], []
            for value in batch.column(len(kept)):
                text = value.as_py() or ""
                decimal = " ".join(encoder.pieces(text))
                ids = np.fromstring(decimal, np.int32, sep=" ") if decimal else np.zeros(0, np.int32)
                counts.append(len(ids))
                if digests:
                    first.append(hashlib.sha256(decimal.encode()).hexdigest())
                    second.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                else:
                    first.append(ids)
                    second.append(encoder.decode(ids) == text.encode())
            made = [pa.array(counts, pa.int64())]
            if digests:
                made += [pa.array(first, pa.string()), pa.array(second, pa.string())]
            else:
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *first])))
                made += [ids, pa.array(second, pa.bool_())]
            names = [f.name for f in kept] + ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "round_trip"])]
            yield pa.RecordBatch.from_arrays([*arrays, *made], names=names)

    return map_batches(kept_beside(docs, kept, docs[text]), run, schema)


def decode_documents(encoded: DataFrame, path: str, columns: list[str], ids: str = "ids") -> DataFrame:
    """`columns` of every row plus the text its ids decode to; bytes that are no UTF-8 become U+FFFD, null ids ''."""
    ranks = shared_ranks(encoded.sparkSession, path)
    kept, schema = kept_and(encoded, columns, "decoded string")

    def run(batches):
        encoder = worker_encoder(ranks.value, PATTERN)
        for batch in batches:
            texts = [encoder.decode(np.array(value.as_py() or [], np.int64)).decode("utf-8", "replace") for value in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(texts, pa.string())], names=[f.name for f in kept] + ["decoded"])

    return map_batches(kept_beside(encoded, kept, encoded[ids]), run, schema)
