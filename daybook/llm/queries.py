"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    best_fit,
    exact_dedup,
    html_text,
    jaccard,
    language,
    merkle,
    mixing,
    packing,
    phrases,
    pii,
    quality,
    sharding,
    vector_search,
)
from daybook.llm.common import read_table
from daybook.llm.sampling import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@_query("op2_mix_sources")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


OP7_SQL = r"""
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS len,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT doc_id, text_sha256,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""


@_query("op7_exact_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read_table(spark, sf_dir, "documents"))


@_query("op9_pack")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


@_query("op10_shard")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    model = quality.learn_quality(docs, labels, remainder(3) != 1)
    return quality.score_quality(docs, model).select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query("op4_main_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@_query("op5_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language.learn_language(docs.where(remainder(4) != 2))
    return language.predict_language(docs, model).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score"
    )


@_query("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read_table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[pii.counted(spans, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.listed(spans, pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.listed(spans, pii.KINDS).alias("spans"),
    )


OP8_SQL = """
WITH v AS (
    SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), q AS (
    SELECT vec_id AS query_id, v AS qv FROM v WHERE vec_id % 20 = 0
), pairs AS (
    SELECT query_id, vec_id, CAST(list_inner_product(qv, v) AS BIGINT) AS score
    FROM q JOIN v ON query_id <> vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@_query("op8_top_k", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op1_ngram_jaccard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return jaccard.near_duplicates(docs, jaccard.Similarity(words=3, part=90, of=100))


@_query("op11_best_fit")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(read_table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH RECURSIVE fields AS (
    SELECT doc_id, lang, text,
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
        || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
        || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
        || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END
            AS head,
        CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
        CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || translate(
            text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS lower_tail
    FROM documents
), digests AS (
    SELECT doc_id, lang, sha256(head || tail) AS leaf, sha256(head || lower_tail) AS lower_leaf
    FROM fields
), leaves AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM digests
), nodes AS (
    SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
    UNION ALL
    SELECT lang, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 7) // 8
    FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 8
), subroots AS (
    SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, pos, h, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 7) // 8
    FROM tops WHERE n > 1 GROUP BY level, pos // 8
), lower_steps AS (
    SELECT l.lang, l.pos AS leaf_pos, n.level,
        coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < n.pos), '') AS before,
        coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > n.pos), '') AS after
    FROM leaves l
    JOIN nodes n ON n.lang IS NOT DISTINCT FROM l.lang AND n.n > 1
        AND n.pos = l.pos // CAST(power(8, n.level) AS BIGINT)
    JOIN nodes s ON s.lang IS NOT DISTINCT FROM n.lang AND s.level = n.level
        AND s.pos // 8 = n.pos // 8
    GROUP BY l.lang, l.pos, n.level
), upper_steps AS (
    SELECT b.lang, n.level,
        coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < n.pos), '') AS before,
        coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > n.pos), '') AS after
    FROM subroots b
    JOIN tops n ON n.n > 1 AND n.pos = b.pos // CAST(power(8, n.level) AS BIGINT)
    JOIN tops s ON s.level = n.level AND s.pos // 8 = n.pos // 8
    GROUP BY b.lang, n.level
), steps AS (
    SELECT lang, leaf_pos, level, before, after FROM lower_steps
    UNION ALL
    SELECT l.lang, l.pos, 100 + u.level, u.before, u.after
    FROM leaves l JOIN upper_steps u ON u.lang IS NOT DISTINCT FROM l.lang
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY lang, leaf_pos ORDER BY level) AS step FROM steps
), proofs AS (
    SELECT lang, leaf_pos, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256
    FROM numbered GROUP BY lang, leaf_pos
), crc(b, v) AS (
    SELECT CAST(range AS BIGINT), CAST(range AS BIGINT) FROM range(256)
), crc8 AS (
    SELECT b, v, 0 AS turn FROM crc
    UNION ALL
    SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, turn + 1
    FROM crc8 WHERE turn < 8
), crc_table AS (
    SELECT list(v ORDER BY b) AS t FROM crc8 WHERE turn = 8
), ids AS (
    SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL
), crc_run AS (
    SELECT doc_id, s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM ids
    UNION ALL
    SELECT doc_id, s, i + 1,
        xor(v >> 8, t[CAST(xor(v & 255, CAST(ascii(s[i + 1]) AS BIGINT)) AS INTEGER) + 1])
    FROM crc_run, crc_table WHERE i < length(s)
), tampered AS (
    SELECT doc_id FROM crc_run WHERE i = length(s) AND xor(v, 4294967295) % 3 = 0
), folds AS (
    SELECT l.lang, l.pos, 0 AS step,
        CASE WHEN t.doc_id IS NULL THEN l.leaf ELSE l.lower_leaf END AS h
    FROM leaves l LEFT JOIN tampered t ON t.doc_id = l.doc_id
    UNION ALL
    SELECT f.lang, f.pos, f.step + 1, sha256(s.before || f.h || s.after)
    FROM folds f JOIN numbered s ON s.lang IS NOT DISTINCT FROM f.lang
        AND s.leaf_pos = f.pos AND s.step = f.step + 1
), folded AS (
    SELECT lang, pos, arg_max(h, step) AS folded_root FROM folds GROUP BY lang, pos
)
SELECT l.doc_id, l.leaf, b.h AS subroot, r.h AS root,
    coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.folded_root,
    f.folded_root = r.h AS verified
FROM leaves l
JOIN subroots b ON b.lang IS NOT DISTINCT FROM l.lang
JOIN tops r ON r.n = 1
JOIN folded f ON f.lang IS NOT DISTINCT FROM l.lang AND f.pos = l.pos
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_pos = l.pos
"""

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@_query("op12_merkle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in merkle.FIELDS[:-1]]
    lower = F.translate("text", _CAPITALS, _CAPITALS.lower())
    tampered = F.when(remainder(3) == 0, merkle.record_digest(*fields, lower))
    proven = merkle.manifest(docs.withColumn("tampered", tampered), carry=["tampered"])
    start = F.coalesce("tampered", "leaf")
    return proven.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle.folded(start, F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = r"""
WITH split AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?
-
]')), '[^ 	]+') AS w
    FROM documents
), sized AS (
    SELECT lang, w, unnest([1, 2, 3, 4]) AS size FROM split
), counted AS (
    SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS n
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized
          WHERE len(w) >= size)
    GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang
), frequent AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE n >= 30
), cuts AS (
    SELECT f.lang, f.phrase, f.size, f.n AS a, k, l.n AS l, r.n AS r,
        (CAST(2000000 AS HUGEINT) * f.n) // (l.n + r.n) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1) f
    JOIN frequent l ON l.lang = f.lang AND l.phrase = array_to_string(f.w[1 : f.k], ' ')
    JOIN frequent r ON r.lang = f.lang AND r.phrase = array_to_string(f.w[f.k + 1 :], ' ')
), weakest AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, array_to_string(w[i : i + part - 1], ' ') AS phrase, max(n) AS n
    FROM (SELECT *, unnest(range(1, size - part + 2)) AS i
          FROM (SELECT *, unnest(range(2, size)) AS part FROM frequent WHERE size > 2))
    GROUP BY ALL
), kept AS (
    SELECT w.* FROM weakest w LEFT JOIN longer b ON b.lang = w.lang AND b.phrase = w.phrase
    WHERE b.n IS NULL OR 100 * b.n < 80 * w.a
)
SELECT k.lang,
    row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, t.n, CAST(score AS BIGINT) AS score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""


@_query("op13_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(read_table(spark, sf_dir, "documents"))
    return found.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase",
        F.col("n_phrase").alias("a"), "l", "r", F.col("n_words").alias("n"), "score",
    )
