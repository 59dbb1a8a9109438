"""Registered queries over the operators of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    block_max,
    compression_quality,
    exact_dedup,
    hyperminhash,
    line_dedup,
    mixing,
    neighbours,
    packing,
    perspectives,
    product_quantisation,
    secret_scan,
    shallot,
    warc,
)
from .common import read_table

QUALITY_THRESHOLD = 0.7


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are kept for tests: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"), query_every=100, k=10)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  phases=2, every_pair=True)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest columns of captures written to archives and read back."""
    captures = warc.round_trip(read_table(spark, sf_dir, "pages"), min_bytes=0)
    revisit = F.col("response.type") == "revisit"
    page = F.regexp_extract(F.decode("metadata.payload", "utf-8"), r"page: (-?\d*)", 1)
    first = F.regexp_extract("response.refers_to", r"^<urn:capture:(-?\d+):", 1)
    return captures.select(
        page.try_cast("long").alias("page_id"),
        F.when(revisit, F.col("response.http_length")).otherwise(F.col("response.payload_bytes"))
        .alias("payload_bytes"),
        F.when(revisit, F.col("response.payload_digest")).otherwise(F.col("response.computed_digest"))
        .alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(revisit, first.try_cast("long")).alias("refers_to"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = perspectives.rotate_perspectives(read_table(spark, sf_dir, "conversations"))
    spans = F.transform("loss_spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return turned.withColumn("loss_spans", F.array_join(spans, " "))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = compression_quality.fit(docs, read_table(spark, sf_dir, "labels"), held_out())
    return compression_quality.classify(docs, model, threshold=QUALITY_THRESHOLD).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def op11_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_quantisation.near_duplicates(read_table(spark, sf_dir, "embeddings"), least=0.93)


def op12_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.cluster(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2)


def op13_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_max.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_exact_dedup, op3_learned_partitions, op4_line_dedup, op5_warc, op6_mix_sources,
        op7_hyperminhash, op8_perspectives, op9_best_fit_packing, op10_compression_quality,
        op11_product_quantisation, op12_shallot, op13_block_max)
}


def _k_means_sql(k: int, rounds: int) -> str:
    """Assignment and means of every round as common tables of their own."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (
            SELECT row, c, d FROM (
                SELECT v.row, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN m{r} AS m ON m.i = v.i
                GROUP BY v.row, m.c)
            QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""
        s{r} AS (SELECT a.c, v.i, sum(v.x)::BIGINT AS s, count(*) AS n FROM v JOIN a{r} AS a ON a.row = v.row
                 GROUP BY a.c, v.i),
        m{r + 1} AS MATERIALIZED (
            SELECT m.c, m.i, CASE WHEN s.n IS NULL THEN m.x ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS x
            FROM m{r} AS m LEFT JOIN s{r} AS s ON s.c = m.c AND s.i = m.i)""")
    return f"""
        WITH r AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS e
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
        v AS MATERIALIZED (SELECT row, unnest(range(64)) AS i, unnest(e) AS x FROM r),
        b AS (SELECT row, row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, e) - 1 AS c FROM r),
        m0 AS MATERIALIZED (SELECT b.c, v.i, v.x FROM b JOIN v ON v.row = b.row WHERE b.c < {k}),
        {",".join(steps)},
        h AS (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256
              FROM m{rounds} GROUP BY c)
        SELECT r.vec_id, a.c::INT AS cluster, a.d::BIGINT AS distance,
               (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
               h.centroid_sha256
        FROM r JOIN a{rounds} AS a ON a.row = r.row JOIN h ON h.c = a.c
    """


ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
            FROM pages)
        SELECT page_id, octet_length(encode(body)) AS payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1), 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM p
    """,
    "op6_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   greatest(0.05::DOUBLE, length(translate(coalesce(text, ''), '|!#$%&*', ''))
                            / greatest(length(coalesce(text, '')), 1)) AS quality,
                   (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
                    + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
            FROM documents),
        k AS (SELECT *, -ln(u) / quality AS key FROM d),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (
            SELECT *, [5.0::DOUBLE, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)] AS w,
                   source_size * 2.0::DOUBLE AS cap
            FROM s),
        l AS (
            SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE - coalesce(sum(cap) OVER (
                       ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM w),
        t AS (SELECT source, source_size, least(cap, max(level) OVER () * w) AS target FROM l),
        b AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs
            FROM t),
        r AS (
            SELECT k.doc_id, k.source, k.size, b.source_size, b.target, b.epochs, k.key,
                   sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                                     ROWS UNBOUNDED PRECEDING) - k.size AS before
            FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, source, size, source_size, target,
               (size * (epochs + CASE WHEN size > 0 AND before + size / 2.0::DOUBLE
                                           <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM r
    """,
    "op7_hyperminhash": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                   WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS sh
            FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        e AS (
            SELECT a.doc_id AS u, b.doc_id AS v
            FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
            JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reach AS (
            SELECT doc_id AS node, doc_id AS root FROM documents
            UNION
            SELECT e.u, reach.root FROM reach JOIN e ON e.v = reach.node),
        c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
        SELECT c.node AS doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.node = c.component_id AS kept
        FROM c LEFT JOIN n ON n.doc_id = c.node
    """,
    "op8_perspectives": r"""
        WITH t AS (
            SELECT conv_id, role, regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<\1>', 'g') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                                      text NULLS FIRST) - 1 AS pos
            FROM conversations),
        p AS (SELECT DISTINCT conv_id, role AS participant FROM conversations
              WHERE role IS NOT NULL AND role <> 'system'),
        s AS (
            SELECT p.conv_id, participant, pos // 64 AS win, pos, role IS NOT DISTINCT FROM participant AS own,
                   CASE WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
                        WHEN role = participant THEN '<|im_start|>assistant' || chr(10)
                        ELSE '<|im_start|>user' || coalesce(' name=' || replace(replace(replace(replace(replace(
                             replace(replace(replace(role, '%', '%25'), ' ', '%20'), chr(9), '%09'), chr(10), '%0A'),
                             chr(11), '%0B'), chr(12), '%0C'), chr(13), '%0D'), '<', '%3C'), '') || chr(10) END AS head, text || '<|im_end|>' AS body
            FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
        o AS (
            SELECT *, (sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, participant, win ORDER BY pos)
                       - length(body) - 1)::BIGINT AS lo
            FROM s)
        SELECT conv_id, participant, win AS "window", count(*)::INT AS n_turns,
               string_agg(head || body || chr(10), '' ORDER BY pos) AS text,
               coalesce(string_agg(CASE WHEN own THEN lo || '-' || (lo + length(body)) END, ' ' ORDER BY pos), '')
                   AS loss_spans
        FROM o GROUP BY conv_id, participant, win
    """,
    "op11_product_quantisation": """
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS row, vec_id, label, embedding::DOUBLE[] AS e,
                   coalesce(len(embedding) > 0 AND label IS NOT NULL
                            AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
                            AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS fine
            FROM embeddings),
        l AS MATERIALIZED (
            SELECT a.row AS u, b.row AS v
            FROM d a JOIN d b ON a.label = b.label AND len(a.e) = len(b.e) AND a.row <> b.row
            WHERE a.fine AND b.fine
              AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
        reach AS (
            SELECT row AS node, vec_id AS root FROM d
            UNION
            SELECT l.u, reach.root FROM reach JOIN l ON l.v = reach.node),
        c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
        n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
        SELECT d.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, d.vec_id IS NOT DISTINCT FROM c.component_id AS kept
        FROM d JOIN c ON c.node = d.row LEFT JOIN n ON n.u = d.row
    """,
    "op12_shallot": _k_means_sql(k=40, rounds=5),
    "op13_block_max": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM documents),
        q AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(min(text), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM benchmark GROUP BY item_id),
        g AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
        p AS (
            SELECT row, doc_id, n, term, count(*) AS tf
            FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY row, doc_id, n, term),
        w AS (
            SELECT term, floor(1000 * ln((2 * g.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM p, g GROUP BY term, g.n),
        a AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest(t) AS term FROM q) GROUP BY 1, 2),
        s AS (
            SELECT a.item_id, p.row, p.doc_id,
                   sum(a.qtf * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * g.n) // g.l))))::BIGINT
                       AS score
            FROM a JOIN w USING (term) JOIN p USING (term), g GROUP BY a.item_id, p.row, p.doc_id)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank,
               doc_id, score
        FROM s WHERE score > 0
        QUALIFY rank <= 10
    """,
}
