"""Helpers of the corpus operators."""

import random

from pyspark.sql import functions as F

from lakeforge.llm import common, exact_dedup, line_dedup, mixing


def test_filter_finds_every_repeated_key_and_few_others(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 15_000).alias("k"))
    marked = common.BloomFilter.of(rows, "k", 2).probe(rows, "k", "may").groupBy("k", "may").count().collect()
    repeated = {r.k for r in marked if r["count"] > 1}
    assert len(repeated) == 5000 and all(r.may for r in marked if r.k in repeated)
    assert sum(r.may for r in marked if r.k not in repeated) < 1000


def test_results_do_not_depend_on_the_filters_slices(spark, monkeypatch):
    r = random.Random(1)
    lines = [f"line {i} with a few words so that it is long enough" for i in range(60)]
    rows = [(i, "\n".join(lines[j:j + 6]) if (j := r.randrange(120)) < 55 else f"text {i}") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)

    def results():
        return (sorted(map(tuple, exact_dedup.exact_dedup(df).select("doc_id", "keep_id", "group_size").collect())),
                sorted(map(tuple, line_dedup.dedup_lines(df, every_pair=True).select("doc_id", "text").collect())))
    whole = results()
    monkeypatch.setattr(common, "SLICE_BITS", 1 << 14)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert results() == whole
        keys = df.select(F.col("text").alias("t"), F.sha2("text", 256).alias("d"))
        found = common.BloomFilter.of(keys, "d", 2)
        assert found.slices > 1
        plan = found.probe(keys, "d", "may")._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components_of_random_graphs_paths_and_hubs(spark):
    r = random.Random(8)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(50)] + [(5, 5), (3000, 3000)]
    r.shuffle(edges)
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = common.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len(found) == len({n.node for n in found})
    assert {n.node: n.root for n in found} == {i: find(i) for i in root if find(i) != i}
    assert common.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_extra_columns_of_any_name_stay(spark):
    """Names that helpers of the operators might take, too."""
    lines = "a line of some ten words which is long enough to\ngo where it is repeated in another text"
    names = ["epochs", "_key", "_of", "_cut", "_group", "_digest", "_maybe", "_gone", "_lines", "_may", "_left", "_s0",
             "_at", "_block", "_bits", "__key", "of", "key", "row"]
    rows = [(i, lines + ("\nown" if i % 2 else ""), "s", *[f"{n}{i}" for n in names]) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, "
                               + ", ".join(f"{n} string" for n in names))
    for out in (exact_dedup.exact_dedup(df), mixing.mix_sources(df), line_dedup.dedup_lines(df),
                line_dedup.dedup_lines(df, every_pair=True)):
        assert [c for c in out.columns if c in df.columns] == df.columns
        kept = sorted(map(tuple, out.select("doc_id", *names).collect()))
        assert kept == sorted((r[0], *r[3:]) for r in rows)
    assert {r.kept for r in exact_dedup.exact_dedup(df).where("doc_id > 3").collect()} == {True}
    assert [len(r.text) > 5 for r in line_dedup.dedup_lines(df, every_pair=True).orderBy("doc_id").collect()] == [True] + [False] * 5
