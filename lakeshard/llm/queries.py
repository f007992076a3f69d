"""The named queries of this package, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshard.llm import (bpe, centroids, cover_tree, exact_dedup, huffman, jaccard_join, lm_score, merkle, mixing, quality,
                           token_scan, toxicity, url_filter)
from lakeshard.llm.common import prepare
from lakeshard.sources.tables import read_table

#: the public vocabulary files, at the same place on every machine
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return f

    return register


@query("op5_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op5(spark, sf_dir):
    return exact_dedup.decide(read_table(spark, sf_dir, "documents")).drop("id_rows")


@query("op10_quality")
def op10(spark, sf_dir):
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op1_mixing", r"""
    WITH d AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
               md5(coalesce(doc_id::VARCHAR, text, '')) AS key FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS turn
          FROM d GROUP BY source),
    w AS (SELECT *, [5.0, 2.0, 1.0][turn + 1]::DOUBLE AS weight, source_size * 2 AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s),
    f AS (SELECT *, (budget - coalesce(sum(cap) OVER o1, 0)::DOUBLE) / sum(weight) OVER o2 AS level FROM w
          WINDOW o1 AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                 o2 AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    m AS (SELECT min_by(level, cap / weight) AS fill FROM f WHERE cap / weight > level),
    t AS (SELECT source, source_size, turn, coalesce(least(cap::DOUBLE, fill * weight), cap::DOUBLE) AS target FROM f, m),
    o AS (SELECT doc_id, size, source_size, turn, target, floor(target)::BIGINT AS goal,
                 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size, doc_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    c AS (SELECT *, greatest(least(size, goal - off), 0)::BIGINT AS one,
                 greatest(least(size, goal - source_size - off), 0)::BIGINT AS two FROM o),
    a AS (SELECT *, (off + one::DOUBLE / 2) / goal * [5.0, 2.0, 1.0][turn + 1]::DOUBLE AS area FROM c)
    SELECT doc_id, size, source_size, target, one + two AS taken,
           CASE WHEN one = 0 THEN NULL
                WHEN turn = 0 THEN 2.0::DOUBLE * area / (8.0::DOUBLE + sqrt(greatest(64.0::DOUBLE - 12.0::DOUBLE * area, 0)))
                WHEN turn = 1 THEN 2.0::DOUBLE * area / 4.0::DOUBLE
                WHEN area < 0.25 THEN 2.0::DOUBLE * area / 1.0::DOUBLE
                ELSE 0.5::DOUBLE + 2.0::DOUBLE * (area - 0.25::DOUBLE) / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 8.0::DOUBLE * (area - 0.25::DOUBLE))) END AS position
    FROM a""")
def op1(spark, sf_dir):
    return mixing.plan_mix(read_table(spark, sf_dir, "documents"))


@query("op9_bpe")
def op9(spark, sf_dir):
    return bpe.digests(read_table(spark, sf_dir, "documents"), WORD_BPE)


@query("op3_jaccard_join")
def op3(spark, sf_dir):
    return jaccard_join.link_classes(read_table(spark, sf_dir, "documents"))


@query("op7_huffman")
def op7(spark, sf_dir):
    return huffman.round_trip(read_table(spark, sf_dir, "documents"), BYTE_BPE, size=50257)


@query("op4_cover_tree", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM v),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
          FROM p q JOIN p c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 10""")
def op4(spark, sf_dir):
    return cover_tree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query("op6_lm_score", r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT r, generate_subscripts(w, 1) AS i, unnest(w) AS b FROM d),
    e AS (SELECT r, i, b, lag(b) OVER (PARTITION BY r ORDER BY i) AS a FROM p),
    one AS (SELECT b, count(*) AS c FROM e GROUP BY b),
    two AS (SELECT a, b, count(*) AS c FROM e WHERE a IS NOT NULL GROUP BY a, b HAVING count(*) >= 2),
    s AS (SELECT e.r, two.c IS NOT NULL AS seen,
                 CASE WHEN two.c IS NOT NULL THEN ln(two.c) - ln(x.c)
                      ELSE ln(y.c) - ln((SELECT count(*) FROM e)) + CASE WHEN e.a IS NULL THEN 0 ELSE ln(0.4) END END AS l
          FROM e LEFT JOIN two ON e.a = two.a AND e.b = two.b LEFT JOIN one x ON e.a = x.b JOIN one y ON e.b = y.b),
    t AS (SELECT r, count(*) AS n, sum(seen::INTEGER) AS k, sum(l) AS l FROM s GROUP BY r)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(k, 0)::BIGINT AS n_seen, round(coalesce(l, 0), 3) AS log_score
    FROM d LEFT JOIN t USING (r)""")
def op6(spark, sf_dir):
    return lm_score.score(read_table(spark, sf_dir, "documents")).withColumn("log_score", F.round("log_score", 3))


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_scan.token_counts(read_table(spark, sf_dir, "documents"), BYTE_BPE)


RULES = url_filter.rules("allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/")


@query("op11_url_filter")
def op11(spark, sf_dir):
    return url_filter.judge(read_table(spark, sf_dir, "pages"), RULES)


@query("op12_merkle", """
    WITH RECURSIVE f AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, '') AS g,
               concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
                      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
               text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
               list_reduce([4294967295]::BIGINT[] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])),
                           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS crc
        FROM documents),
    l AS (SELECT r, doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                 CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS changed FROM f),
    p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM l),
    inner_tree AS (
        SELECT g, 0 AS lvl, pos, n, leaf AS digest FROM p
        UNION ALL
        SELECT g, lvl + 1, pos // 16, max((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos)) FROM inner_tree WHERE n > 1 GROUP BY g, lvl, pos // 16),
    tops AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM inner_tree WHERE n = 1),
    outer_tree AS (
        SELECT 0 AS lvl, pos, n, subroot AS digest FROM tops
        UNION ALL
        SELECT lvl + 1, pos // 16, max((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos)) FROM outer_tree WHERE n > 1 GROUP BY lvl, pos // 16),
    nodes AS (SELECT g, lvl, pos, n, digest FROM inner_tree UNION ALL SELECT NULL, lvl, pos, n, digest FROM outer_tree),
    beside AS (
        SELECT a.g, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
               coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
        FROM nodes a JOIN nodes b ON a.g IS NOT DISTINCT FROM b.g AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY a.g, a.lvl, a.pos),
    up AS (
        SELECT r, g, 0 AS lvl, pos, n, coalesce(changed, leaf) AS folded, '' AS proof FROM p
        UNION ALL
        SELECT u.r, u.g, u.lvl + 1, u.pos // 16, (u.n + 15) // 16, sha256(before || u.folded || after), u.proof || before || after
        FROM up u JOIN beside s ON s.g = u.g AND s.lvl = u.lvl AND s.pos = u.pos WHERE u.n > 1),
    up2 AS (
        SELECT u.r, 0 AS lvl, t.pos, t.n, u.folded, u.proof FROM up u JOIN tops t ON u.g = t.g WHERE u.n = 1
        UNION ALL
        SELECT u.r, u.lvl + 1, u.pos // 16, (u.n + 15) // 16, sha256(before || u.folded || after), u.proof || before || after
        FROM up2 u JOIN beside s ON s.g IS NULL AND s.lvl = u.lvl AND s.pos = u.pos WHERE u.n > 1),
    top AS (SELECT digest AS root FROM outer_tree WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM p JOIN tops USING (g) JOIN (SELECT r, folded, proof FROM up2 WHERE n = 1) USING (r), top""")
def op12(spark, sf_dir):
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def _round(before: str, after: str) -> str:
    """DuckDB steps of one round: the nearest centroid of each vector, and the floor of the mean of each centroid's vectors."""
    return f"""
    near{after} AS (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT r, c, sum((p.x - m.x) * (p.x - m.x))::BIGINT AS d FROM p JOIN c{before} m USING (i) GROUP BY r, c) GROUP BY r),
    mean{after} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM p JOIN near{after} USING (r) GROUP BY c, i),
    c{after} AS (SELECT m.c, m.i, coalesce((s - ((s % n) + n) % n) // n, m.x) AS x FROM c{before} m LEFT JOIN mean{after} USING (c, i)),"""


@query("op13_centroids", """
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
               WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (SELECT r, unnest(range(1, 65)) AS i, unnest(v) AS x FROM v),
    s AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c FROM v QUALIFY c < 16),
    c0 AS (SELECT c, i, x FROM s JOIN p USING (r)),""" + _round("0", "1") + _round("1", "2") + _round("2", "3") + _round("3", "4") + """
    h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY c)
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
    FROM near4 JOIN v USING (r) JOIN h USING (c)""")
def op13(spark, sf_dir):
    return centroids.with_inertia(*centroids.cluster(read_table(spark, sf_dir, "embeddings")))
