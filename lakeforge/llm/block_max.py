"""Ranked lexical search by Block-Max MaxScore over sharded, compressed posting lists.

An index is built in two steps: documents become rows of term numbers and frequencies,
and these are dealt by a hash into shards of bounded size. A shard holds for each term a
list of blocks of 128 postings, compressed, with the frequencies and lengths that no other
posting of the block (or list) beats, from which the highest score is known exactly for
any corpus statistics. A query walks a shard's documents in windows. Lists whose bounds
together can't lift a document over the tenth best so far are non-essential: they never
bring a candidate, and the maxima of their blocks reject candidates before anything is
decompressed. Every shard gives back its ten best, and these are merged.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Documents of a shard, about; postings of a block; documents that a query looks at together.
SHARD_DOCS = 16_384
BLOCK = 128
WINDOW = 2048
#: Items that are searched for together.
ITEMS = 2048

#: What separates terms becomes a blank, A-Z become lower-case, all else stays.
_TERMS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and all non-ASCII characters; only A-Z are lower-cased."""
    return (text or b"").translate(_TERMS).split()


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Score of a term of weight one in documents of ``n`` terms, ``tf`` of them this one."""
    tf, n = tf.astype(np.int64), n.astype(np.int64)
    if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63:
        m = np.array([25 + 75 * int(v) * n_docs // n_terms for v in n], np.int64)
    else:
        m = 25 + 75 * n * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _skyline(tf: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Postings that no other one beats in both frequency and shortness."""
    order = np.lexsort((n, -tf))
    tf, n = tf[order], n[order]
    best = np.r_[True, n[1:] < np.minimum.accumulate(n)[:-1]]
    return tf[best], n[best]


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.astype(np.int32).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.int32)


def _forward(numbers: dict[bytes, int]):
    """Documents as their length and the frequencies of numbered terms; without terms, no row."""
    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.keys()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keep, n, term, tf = [], [], [], []
                for i, text in enumerate(batch["text"]):
                    words = terms(text.as_py())
                    if words:
                        counts = Counter(words)
                        found = known & counts.keys()
                        keep.append(i)
                        n.append(len(words))
                        term.append([numbers[t] for t in found])
                        tf.append([counts[t] for t in found])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch["doc_id"].take(pa.array(keep, pa.int64())), "n": pa.array(n, pa.int64()),
                    "terms": pa.array(term, pa.list_(pa.int32())), "tfs": pa.array(tf, pa.list_(pa.int32()))})
    return forward


def _shard(group: pa.Table) -> pa.Table:
    """The index rows of a shard: its documents (term null), and each term's blocks.

    Postings name a document by its place in the order of ids, so equal scores go by id.
    """
    group = group.sort_by([("doc_id", "ascending"), ("row", "ascending")])  # nulls last
    n = group["n"].to_numpy()
    term, tf = (c.combine_chunks().flatten().to_numpy() for c in (group["terms"], group["tfs"]))
    doc = np.repeat(np.arange(len(n)), group["terms"].combine_chunks().value_lengths().to_numpy())
    order = np.lexsort((doc, term))
    term, tf, doc = term[order], tf[order], doc[order]
    cuts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.empty(0, int)
    out = {"term": [None], "df": [len(n)], "last": [[]], "high_tf": [[]], "high_n": [_packed(n.astype(np.int32))],
           "high_at": [[]], "docs": [[]], "tfs": [[]],
           "doc_ids": [group["doc_id"].to_pylist()]}
    for a, b in zip(cuts, np.r_[cuts[1:], len(term)], strict=False):
        starts = range(a, b, BLOCK)
        sky = [_skyline(tf[s:min(s + BLOCK, b)], n[doc[s:min(s + BLOCK, b)]]) for s in starts]
        out["term"].append(int(term[a]))
        out["df"].append(int(b - a))
        out["last"].append([int(doc[min(s + BLOCK, b) - 1]) for s in starts])
        out["high_tf"].append([int(v) for s in sky for v in s[0]])
        out["high_n"].append(_packed(np.concatenate([s[1] for s in sky])))
        out["high_at"].append(np.cumsum([0] + [len(s[0]) for s in sky])[:-1].tolist())
        out["docs"].append([_packed(np.diff(doc[s:min(s + BLOCK, b)], prepend=0)) for s in starts])
        out["tfs"].append([_packed(tf[s:min(s + BLOCK, b)]) for s in starts])
        out["doc_ids"].append(None)
    table = pa.table({k: pa.array(v, _INDEX.field(k).type) for k, v in out.items()})
    return table.append_column("shard", pa.repeat(group["shard"][0], len(table))).select(_INDEX.names)


_INDEX = pa.schema([
    ("shard", pa.int32()), ("term", pa.int32()), ("df", pa.int64()), ("last", pa.list_(pa.int32())),
    ("high_tf", pa.list_(pa.int32())), ("high_n", pa.binary()), ("high_at", pa.list_(pa.int32())),
    ("docs", pa.list_(pa.binary())), ("tfs", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64()))])
_INDEX_SQL = ("shard int, term int, df long, last array<int>, high_tf array<int>, high_n binary, high_at array<int>, "
              "docs array<binary>, tfs array<binary>, doc_ids array<long>")


class _List:
    """A term's posting list in a shard: bounds of its blocks, which open on demand."""

    def __init__(self, row: dict, n: np.ndarray, w: int, stats: tuple[int, int]):
        self.docs, self.tfs, self.n, self.w, self.stats = row["docs"], row["tfs"], n, w, stats
        self.last = np.array(row["last"], np.int64)
        score = w * impact(np.array(row["high_tf"], np.int64), _unpacked(row["high_n"]), *stats)
        self.high = np.maximum.reduceat(score, row["high_at"])
        self.bound = int(self.high.max())
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.open:
            doc, tf = np.cumsum(_unpacked(self.docs[i])), _unpacked(self.tfs[i])
            self.open[i] = doc, self.w * impact(tf, self.n[doc], *self.stats)
        return self.open[i]

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``lo`` to before ``hi``, and their scores."""
        first = int(np.searchsorted(self.last, lo))
        stop = min(len(self.last), int(np.searchsorted(self.last, hi - 1)) + 1)
        if first >= stop:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        doc, score = (np.concatenate(x) for x in zip(*[self.block(i) for i in range(first, stop)], strict=True))
        inside = slice(*np.searchsorted(doc, [lo, hi]))
        return doc[inside], score[inside]

    def maxima(self, docs: np.ndarray) -> np.ndarray:
        """What this list may add to each document, from the maxima of its blocks."""
        at = np.searchsorted(self.last, docs)
        return np.where(at < len(self.last), self.high[np.minimum(at, len(self.last) - 1)], 0)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """What it adds; opens only blocks that may hold one of ``docs`` (ascending)."""
        out = np.zeros(len(docs), np.int64)
        at = np.searchsorted(self.last, docs)
        for i in np.unique(at[at < len(self.last)]):
            mine = np.flatnonzero(at == i)
            doc, score = self.block(int(i))
            place = np.minimum(np.searchsorted(doc, docs[mine]), len(doc) - 1)
            out[mine] = np.where(doc[place] == docs[mine], score[place], 0)
        return out


def top(lists: list[tuple[_List, int]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents of a shard, best first, for lists and how often the query has each.

    Documents are met in ascending order, so one that equals the k-th best doesn't enter.
    """
    lists = sorted(((p, q) for p, q in lists if p.bound > 0), key=lambda x: x[0].bound * x[1])
    below = np.cumsum([0] + [p.bound * q for p, q in lists])
    best_doc, best, floor = np.empty(0, np.int64), np.empty(0, np.int64), 0
    for lo in range(0, n_docs, WINDOW):
        split = int(np.searchsorted(below[1:], floor, "right"))  # lists before it can't do it alone
        if split == len(lists):
            break
        total = np.zeros(WINDOW, np.int64)
        for p, q in lists[split:]:
            doc, score = p.between(lo, lo + WINDOW)
            total[doc - lo] += q * score
        docs = np.flatnonzero(total)
        score, docs = total[docs], docs + lo
        for i in range(split - 1, -1, -1):
            p, q = lists[i]
            stay = score + below[i + 1] > floor
            docs, score = docs[stay], score[stay]
            stay = score + q * p.maxima(docs) + below[i] > floor
            docs, score = docs[stay], score[stay]
            score = score + q * p.scores(docs)
        best_doc, best = np.concatenate([best_doc, docs]), np.concatenate([best, score])
        order = np.lexsort((best_doc, -best))[:k]
        order = order[best[order] > 0]
        best_doc, best = best_doc[order], best[order]
        floor = int(best[-1]) if len(best) == k else 0
    return best_doc, best


def _searched(items: list[tuple[int, dict[int, int]]], weights: dict[int, int], stats: tuple[int, int], k: int):
    """The k best documents of a shard for every item."""
    def search(index: pa.Table) -> pa.Table:
        rows = index.to_pylist()
        head = next(r for r in rows if r["term"] is None)
        n, ids = _unpacked(head["high_n"]).astype(np.int64), head["doc_ids"]
        lists = {r["term"]: _List(r, n, weights[r["term"]], stats) for r in rows if r["term"] in weights}
        found = []
        for item, wanted in items:
            docs, scores = top([(lists[t], q) for t, q in wanted.items() if t in lists], len(n), k)
            found += [(item, ids[d], int(s)) for d, s in zip(docs, scores, strict=True)]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({"item": pa.array(columns[0], pa.int32()), "doc_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.int64())})
    return search


def build_index(docs: DataFrame, numbers: dict[bytes, int], id_col: str = "doc_id",
                text_col: str = "text") -> tuple[DataFrame, tuple[int, int], dict[int, int]]:
    """The shards' posting lists of the numbered terms, (documents, terms with repeats), and
    in how many documents each numbered term is. Lengths and counts cover all documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text"))
    forward = written(rows.mapInArrow(_forward(numbers), "doc_id long, n long, terms array<int>, tfs array<int>")
                      .withColumn("row", F.monotonically_increasing_id()), "forward-index")
    count, length = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # at most one row for each term of a block of items
    held = dict(forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())
    holding = forward.where(F.size("terms") > 0)
    shards = max(1, -(-count // SHARD_DOCS))
    index = (holding.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
             .groupBy("shard").applyInArrow(_shard, _INDEX_SQL))
    return written(index, "posting-lists"), (count, length), held


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """The k documents with the highest scores above 0 for each item: item_id, rank (from 1),
    doc_id, score; equal scores by ascending doc_id, null ids last.

    Terms are maximal runs of ASCII letters and digits and of all other characters beyond
    ASCII, A-Z lower-cased, of whole texts; null and empty texts have none and count
    nowhere. A repeated document is ranked as often as it is there. Of rows that repeat an
    item_id (null is an id here) the smallest text asks. Items that meet no document, and
    empty tables, give no rows. Other columns are not read, whatever their names.

    Items are searched in blocks of about ITEMS over all documents, each block with an index of
    its own terms, so what is sent to the tasks is bounded by the block's texts.
    """
    spark = docs.sparkSession
    shape = "item_id long, rank int, doc_id long, score long"
    asked = items.groupBy(F.col(item_col).cast("long").alias("item_id")).agg(F.min(query_col).alias("text"))
    asked = written(asked, "items")
    blocks = -(-asked.count() // ITEMS)
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = mine.select("item_id", F.col("text").cast("binary")).collect()
        part = _search_block(docs, [(r[0], Counter(terms(r[1]))) for r in rows], k, id_col, text_col)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], shape) if found is None else found


def _search_block(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int, id_col: str,
                  text_col: str) -> DataFrame | None:
    numbers = {t: i for i, t in enumerate(sorted({t for _, wanted in items for t in wanted}))}
    index, stats, held = build_index(docs, numbers, id_col, text_col)
    if not stats[0] or not held:
        return None
    weights = {t: weight(n, stats[0]) for t, n in held.items()}
    wanted = [(i, {numbers[t]: q for t, q in terms_.items()}) for i, (_, terms_) in enumerate(items)]
    best = index.groupBy("shard").applyInArrow(_searched(wanted, weights, stats, k),
                                               "item int, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    names = docs.sparkSession.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "i int, item_id long")
    return (best.withColumn("rank", rank).where(F.col("rank") <= k)
            .join(F.broadcast(names), F.col("item") == F.col("i"))
            .select("item_id", "rank", "doc_id", "score"))
