"""Best-fit-decreasing packing of tokenised documents into sequences.

Documents are tokenised in place and cut into pieces. Best fit decreasing asks only for
the lengths, of which there are at most ``capacity``: how many pieces have each length is
all that is gathered, and a segment tree over the remaining capacities finds the tightest
open sequence for each run of equal lengths. The resulting placements, a few thousand
rows at any size of the input, then say for the n-th piece of a length where it goes.
This is the packing that the documents one by one would get.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
#: The vocabulary's added token: only the reference encoder knows it.
ADDED = "<|endoftext|>"
#: Tokens that a Python worker hands back at once, about.
OUT_TOKENS = 1 << 20
#: Offsets (one row for each length in each split) are broadcast up to this count.
BROADCAST_OFFSETS = 1 << 20
#: Outside of these characters the encoders could follow different Unicode tables; such
#: texts take the reference encoder.
_PLAIN = regex.compile("[\t\n\r -~¡-ɏ]*")


@lru_cache(maxsize=4)
def _fast(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@lru_cache(maxsize=4)
def _reference(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))


def encode(text: str | None, vocabulary: str = VOCABULARY) -> list[int]:
    """Token ids of a whole text, as the vocabulary's JSON tokenizer gives them."""
    text = text or ""
    if ADDED not in text and _PLAIN.fullmatch(text):
        return _fast(vocabulary).encode_ordinary(text)
    return _reference(vocabulary).encode(text, add_special_tokens=False).ids


def _tokenised(capacity: int, end_id: int, vocabulary: str):
    columns = ["id", "piece", "start", "length", "ids", "task", "nth"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        met: dict[int, int] = defaultdict(int)
        rows, held = [], 0
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                ids = np.array([*encode(text, vocabulary), end_id], "<u4")
                start, piece = 0, 0
                while start < len(ids):
                    length = (len(ids) - start - 1) % capacity + 1
                    rows.append((doc, piece, start, length, ids[start:start + length].tobytes(), task,
                                 met[length]))
                    met[length] += 1
                    start, piece = start + length, piece + 1
                held += len(ids)
                if held > OUT_TOKENS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        yield pd.DataFrame(rows, columns=columns)
    return cut


class _Tightest:
    """Segment tree over remaining capacities: which have an open sequence."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = [False] * (2 * self.leaves)

    def set(self, remaining: int, filled: bool) -> None:
        node = remaining + self.leaves
        self.filled[node] = filled
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] or self.filled[2 * node + 1]

    def at_least(self, need: int) -> int | None:
        """The smallest filled capacity of at least ``need``: up from its leaf, then down."""
        node = need + self.leaves
        if self.filled[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first, sequence, each, offset) of best fit decreasing.

    The pieces of a length, in any order, from number ``first`` on go ``each`` at a time
    into consecutive sequences from ``sequence`` on, starting at ``offset``. Runs of
    sequences with equal room are kept together: a piece goes to the tightest sequence,
    and the next one of its length to the same, as long as it fits.
    """
    tree, room = _Tightest(capacity), defaultdict(list)
    placed, opened = [], 0

    def give(remaining: int, first: int, many: int) -> None:
        if many and remaining:
            room[remaining].append((first, many))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            remaining = tree.at_least(length)
            if remaining is None:
                remaining, first = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            else:
                first, many = room[remaining].pop()
                if not room[remaining]:
                    tree.set(remaining, False)
            each = remaining // length
            n = min(left, many * each)
            placed.append((length, done, first, each, capacity - remaining))
            full, rest = divmod(n, each)
            give(remaining - each * length, first, full)
            if rest:
                give(remaining - rest * length, first + full, 1)
            used = full + bool(rest)
            give(remaining, first + used, many - used)
            done, left = done + n, left - n
    return placed


def _places(placements: list[tuple[int, int, int, int, int]]):
    at = sorted(placements)
    length, first, sequence, each, offset = (np.array([p[i] for p in at], np.int64) for i in range(5))
    keys = (length << 48) | first

    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        n, number = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
        k = np.searchsorted(keys, (n << 48) | number, side="right") - 1
        since = number - first[k]
        return pd.DataFrame({"sequence_id": sequence[k] + since // each[k],
                             "offset": offset[k] + since % each[k] * n})
    return F.pandas_udf(place, "sequence_id long, offset long")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (little-endian 32-bit), sequence_id, offset.

    A document is its tokens and ``end_id``. Only documents longer than ``capacity`` are
    cut, into pieces of that length behind a first one that may be shorter. Null and empty
    texts are one piece of the end id alone. Every repeated row is packed, with its id
    repeated; null ids stay null. Other columns of ``df`` are not read. An empty table
    gives an empty result. Very long texts are tokenised whole.
    """
    # ids as strings: pandas would turn longs with nulls into floats
    docs = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    pieces = written(docs.mapInPandas(
        _tokenised(capacity, end_id, vocabulary),
        "id string, piece int, start long, length long, ids binary, task int, nth long"), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
                      .select(F.col("length").alias("o_length"), F.col("task").alias("o_task"), "n", "before"),
                      "piece-offsets")
    # a row for each length: at most ``capacity`` of them
    lengths = {r["o_length"]: r["n"] for r in offsets.groupBy("o_length").agg(F.sum("n").alias("n")).collect()}
    side = offsets.drop("n")
    if offsets.count() <= BROADCAST_OFFSETS:
        side = F.broadcast(side)
    place = _places(best_fit(lengths, capacity))
    return (pieces.join(side, (F.col("length") == F.col("o_length")) & (F.col("task") == F.col("o_task")))
            .withColumn("at", place("length", F.col("before") + F.col("nth")))
            .select(F.col("id").cast("long").alias(id_col), "piece", "start", "length", "ids", "at.sequence_id", "at.offset"))
