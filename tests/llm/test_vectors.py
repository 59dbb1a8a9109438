"""Product quantisation, Shallot search and Block-Max MaxScore against brute force, and on hard inputs."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeforge.llm import block_max, product_quantisation, shallot

VECTORS = "vec_id long, embedding array<double>, label int, node long, w long, part int, n_links string"
DOCS = "doc_id long, text string, n string, terms string, row string, shard string, score string"


def _brute_links(rows, least=0.93):
    """rows: (id, vector, label); n_links and component by comparing all pairs."""
    fine = [v is not None and label is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)
            and any(v) for _, v, label in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            other = rows[j]
            if fine[i] and fine[j] and label == other[2] and len(v) == len(other[1]):
                a, b = np.array(v, float), np.array(other[1], float)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least_id = {}
    for i, (vid, _, _) in enumerate(rows):
        if vid is not None:
            least_id[find(i)] = min(vid, least_id.get(find(i), vid))
    return Counter((vid, links[i], c := least_id.get(find(i)), vid == c) for i, (vid, _, _) in enumerate(rows))


def _found(df):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def test_vector_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(product_quantisation, "LIST_ROWS", 8)
    monkeypatch.setattr(product_quantisation, "BLOCK_ROWS", 64)
    monkeypatch.setattr(product_quantisation, "BLOCK_QUERIES", 128)
    r = np.random.default_rng(5)
    rows = [(i, v.tolist(), int(i % 3 > 1)) for i, v in enumerate(r.normal(size=(300, 16)))]
    rows += [(1000 + i, (np.array(rows[0][1]) + r.normal(size=16) * 0.28).tolist(), 0) for i in range(150)]
    rows += [(2000 + i, (np.array(rows[i][1]) * 3 + r.normal(size=16) * 0.7).tolist(), rows[i][2]) for i in range(100)]
    rows += [(3000 + i, rows[1][1], rows[1][2]) for i in range(90)]
    random.Random(1).shuffle(rows)
    want = _brute_links(rows)
    assert len({c for _, n, c, _ in want if n}) > 20
    df = spark.createDataFrame([(*x, 0, 0, 0, "") for x in rows], VECTORS)
    assert _found(product_quantisation.near_duplicates(df)) == want


def test_hard_vectors(spark):
    a, b = [1.0, 0.0, 2.0], [1.0, 0.0, 2.01]
    rows = [(1, a, 0), (1, a, 0), (2, b, 0), (3, a, 1), (4, a, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0),
            (8, [1.0, None, 2.0], 0), (9, [1.0, float("nan"), 2.0], 0), (10, [1.0, 0.0], 0), (11, [2.0, -0.0], 0),
            (None, b, 1), (None, [5.0, 5.0, 5.0], 1), (12, [1e300, 0.0, 2e300], 0)]
    df = spark.createDataFrame([(*x, 0, 0, 0, "") for x in rows], VECTORS)
    want = Counter({(1, 3, 1, True): 2, (2, 3, 1, False): 1, (3, 1, 3, True): 1, (4, 0, 4, True): 1, (5, 0, 5, True): 1,
                    (6, 0, 6, True): 1, (7, 0, 7, True): 1, (8, 0, 8, True): 1, (9, 0, 9, True): 1,
                    (10, 1, 10, True): 1, (11, 1, 10, False): 1, (None, 1, 3, False): 1, (None, 0, None, True): 1,
                    (12, 3, 1, False): 1})
    assert _found(product_quantisation.near_duplicates(df)) == want
    assert product_quantisation.near_duplicates(df.limit(0)).count() == 0
    alone = product_quantisation.near_duplicates(df.where("vec_id = 7"))
    assert _found(alone) == Counter({(7, 0, 7, True): 1})


def test_probes_are_sufficient():
    """Of two vectors within reach in different lists, one at least asks the other's."""
    r = np.random.default_rng(2)
    x = product_quantisation._unit(r.normal(size=(4000, 12)))
    y = product_quantisation._unit(x + r.normal(size=x.shape) * 0.09)
    near = (x * y).sum(1) >= 0.93
    quantiser = product_quantisation.Quantiser.learn(x, 64)
    reach = math.sqrt(2 - 2 * 0.93)
    (hx, ax), (hy, ay) = quantiser.probes(x, reach), quantiser.probes(y, reach)
    apart = near & (hx != hy)
    i = np.flatnonzero(apart)
    assert len(i) > 500 and (ax[i, hy[i]] | ay[i, hx[i]]).all()
    assert ax.sum(1).mean() < 32
    codes, error = quantiser.encode(y, hy)
    for j in i[:200]:
        found = quantiser.lookup(x[j:j + 1], int(hy[j]), codes[j:j + 1])[0, 0]
        assert found <= np.linalg.norm(x[j] - y[j]) + error[j] + 1e-6


def _brute_k_means(vectors, ids, k, rounds):
    x = np.floor(np.array(vectors) * 256).astype(np.int64)
    first = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), x[i].tolist()))
    at = x[first[:k]].copy()
    for step in range(rounds + 1):
        d = np.square(x[:, None] - at[None]).sum(2)
        home = d.argmin(1)
        if step < rounds:
            for c in range(len(at)):
                if (home == c).any():
                    at[c] = [int(s) // int((home == c).sum()) for s in x[home == c].sum(0)]
    d = d[np.arange(len(x)), home]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.tolist()]
    return Counter((i, int(c), int(v), int(d[home == c].sum()), int(d.sum()), sha[c])
                   for i, c, v in zip(ids, home, d, strict=True))


def _clusters(df):
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                   for r in df.collect())


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_shallot_equals_lloyd(spark, spread):
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 64)) * 0.1
    vectors = (centres[r.integers(0, 12, 700)] + r.normal(size=(700, 64)) * 0.1 * spread).tolist()
    vectors += [vectors[0]] * 60
    ids = [int(i) for i in r.permutation(len(vectors))]
    rows = [(i, v, None, 0, 0, 0, "") for i, v in zip(ids, vectors, strict=True)]
    rows += [(9001, None, 0, 0, 0, 0, ""), (9002, [0.1] * 63, 0, 0, 0, 0, ""), (9003, [0.1] * 65, 0, 0, 0, 0, ""),
             (9004, [0.1] * 63 + [None], 0, 0, 0, 0, ""), (9005, [0.1] * 63 + [float("inf")], 0, 0, 0, 0, ""),
             (9006, [float("nan")] * 64, 0, 0, 0, 0, "")]
    df = spark.createDataFrame(rows, VECTORS)
    assert _clusters(shallot.cluster(df)) == _brute_k_means(vectors, ids, 40, 5)


def test_shallot_of_few_and_none(spark):
    few = [(3, [0.5] * 64), (3, [0.5] * 64), (4, [-0.001] * 64)]
    df = spark.createDataFrame([(i, v, None, 0, 0, 0, "") for i, v in few], VECTORS)
    assert _clusters(shallot.cluster(df)) == _brute_k_means([v for _, v in few], [3, 3, 4], 40, 5)
    assert _clusters(shallot.cluster(df.where("vec_id = 4"))) == _brute_k_means([[-0.001] * 64], [4], 40, 5)
    assert shallot.cluster(df.limit(0)).count() == 0
    unnamed = spark.createDataFrame([(None, [1.0] * 64, 0, 0, 0, 0, "")], VECTORS)
    assert [(r.vec_id, r.cluster, r.distance) for r in shallot.cluster(unnamed).collect()] == [(None, 0, 0)]


def test_search_finds_both_nearest_from_any_start():
    r = np.random.default_rng(0)
    for k in (2, 3, 17, 40):
        x, at = r.integers(-6, 7, (400, 4)), r.integers(-6, 7, (k, 4))
        d = np.square(x[:, None] - at[None]).sum(2)
        first = r.integers(0, k, len(x))
        second = (first + 1 + r.integers(0, k - 1, len(x))) % k
        best, _, best_d, next_d = shallot.search(x, shallot.Centroids.of(at), first, second)
        assert (best == d.argmin(1)).all() and (best_d == d.min(1)).all() and (next_d == np.sort(d, 1)[:, 1]).all()


def _brute_search(docs, items, k=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                          "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n, length = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in items:
        wanted, found = Counter(words(text)), []
        for i, c, size in held:
            m = 25 + 75 * size * n // length
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, q in wanted.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1):
            out[item, rank, i, -s] += 1
    return out


def _ranked(df):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


def test_lexical_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(block_max, "SHARD_DOCS", 300)
    monkeypatch.setattr(block_max, "BLOCK", 8)
    monkeypatch.setattr(block_max, "WINDOW", 32)
    monkeypatch.setattr(block_max, "ITEMS", 7)
    r = random.Random(4)
    vocabulary = [f"w{int(i ** 1.5)}" for i in range(200)] + ["the"] * 60 + ["Größe", "ÄB", "x_y", "don't", "日本"]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 5, 40, 300])))) for i in range(1500)]
    docs += [(5000 + i, docs[7][1]) for i in range(400)] + [(3, docs[3][1])]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 30])))) for i in range(20)]
    items += [(30, "the the THE"), (31, "nowhere"), (32, ""), (33, None), (34, docs[7][1])]
    found = block_max.search(spark.createDataFrame([(*d, "", "", "", "", "") for d in docs], DOCS),
                             spark.createDataFrame([(i, t, "") for i, t in items], "item_id long, text string, i string"))
    assert _ranked(found) == _brute_search(docs, items)


def test_lexical_search_of_hard_rows(spark):
    docs = [(None, None), (1, None), (2, ""), (3, "Fox, fox; dog"), (3, "Fox, fox; dog"), (None, "fox fox dog"),
            (4, "cat " * 60_000), (5, "İstanbul fox"), (6, "dog")]
    items = [(None, "FOX dog"), (1, "fox"), (1, "cat"), (2, None), (3, "i̇stanbul İSTANBUL")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame([(*d, "", "", "", "", "") for d in docs], DOCS)
    want = _brute_search(docs, [(None, "FOX dog"), (1, "cat"), (2, None), (3, "i̇stanbul İSTANBUL")])
    assert _ranked(block_max.search(table, asked)) == want
    assert block_max.search(table.limit(0), asked).count() == 0
    assert block_max.search(table, asked.limit(0)).count() == 0
    assert block_max.search(table.where("doc_id < 3"), asked).count() == 0


def test_max_score_opens_few_blocks(monkeypatch):
    """A rare strong term and a frequent weak one: most blocks of the weak list stay closed."""
    monkeypatch.setattr(block_max, "WINDOW", 512)
    n = 20_000
    rows = []
    for i in range(n):
        rows.append({"doc_id": i, "n": 50 + i % 7, "terms": [0, 1] if i % 400 == 0 else [1], "row": i, "shard": 0,
                     "tfs": [9 if i < 8000 else 1, 1] if i % 400 == 0 else [1 + (i % 3 == 0)]})
    shape = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                       ("tfs", pa.list_(pa.int32())), ("row", pa.int64()), ("shard", pa.int32())])
    index = block_max._shard(pa.Table.from_pylist(rows, schema=shape)).to_pylist()
    lengths, stats = block_max._unpacked(index[0]["high_n"]).astype(np.int64), (n, sum(r["n"] for r in rows))
    lists = [block_max._List(r, lengths, w, stats) for r, w in zip(index[1:], (6000, 20), strict=True)]
    docs, scores = block_max.top([(p, 1) for p in lists], n, 10)
    total = np.zeros(n, np.int64)
    for p in lists:
        doc, score = p.between(0, n)
        total[doc] += score
    order = np.lexsort((np.arange(n), -total))[:10]
    assert docs.tolist() == order.tolist() and scores.tolist() == total[order].tolist()
    lists = [block_max._List(r, lengths, w, stats) for r, w in zip(index[1:], (6000, 20), strict=True)]
    block_max.top([(p, 1) for p in lists], n, 10)
    assert len(lists[1].open) < len(lists[1].last) // 2
