"""Queries of the operators on the test tables, and the SQL that expresses them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.llm import (
    byte_bpe, exact_dedup, html_text, importance, knn, line_dedup, mixing, packing, pii, rule_quality, simhash_dedup, spelling, substring_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the packed sequences."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes that they decode to."""
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for personal data."""
    out = pii.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), "test corpus")
    return out.select("doc_id", "text", "n_replaced", "kinds")


def op4_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return rule_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of each group of equal texts stays."""
    return exact_dedup.dedup(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and digest of the remaining text of every document."""
    out = line_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and digest of the kept words of every document."""
    return substring_dedup.dedup(_table(spark, sf_dir, "documents")).drop("kept_text")


def op10_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every vector whose id is divisible by 100."""
    vectors = _table(spark, sf_dir, "embeddings")
    return knn.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document against the benchmark, and the rank of the tenth that is drawn."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), share=(10, 100), seed=2024)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources by weights 5, 2, 1 takes of every document."""
    return mixing.account(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, most=3.0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word that occurs three times or more in the documents."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_rule_quality": op4_rule_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_html_text": op7_html_text,
    "op8_simhash": op8_simhash,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_voronoi_knn": op10_voronoi_knn,
    "op11_importance": op11_importance,
    "op12_mixing": op12_mixing,
    "op13_spelling": op13_spelling,
}

#: The table of CRC-32, which DuckDB has no function for.
_CRC = """
WITH RECURSIVE crc AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS r(i)
    )
)"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: CRC-32, unsigned, of the UTF-8 bytes of a column ``s`` beside the table ``t``.
_CRC_OF = """xor(list_reduce(
        list_prepend(4294967295, list_transform(range(octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::UTINYINT::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
    ), 4294967295)"""


ORACLES: dict[str, str] = {
    "op5_exact_dedup": r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
    SELECT doc_id, text_sha256, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op10_voronoi_knn": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), e AS (
    SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v
), s AS (
    SELECT q.vec_id AS query_id, d.vec_id, sum(q.x * d.x)::BIGINT AS score
    FROM e q JOIN e d ON q.i = d.i AND q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_substring_dedup": r"""
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM w, unnest(range(1, len(w) - 18)) AS r(i)
), f AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS late FROM s
), c AS (
    SELECT DISTINCT doc_id, i + j AS k FROM f, range(0, 20) AS r(j) WHERE late
), g AS (
    SELECT doc_id, list(k) AS gone FROM c GROUP BY doc_id
), k AS (
    SELECT w.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
        list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)) AS kept
    FROM w LEFT JOIN g USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k""",
    "op11_importance": _CRC + rf""", w AS (
    SELECT 0 AS part, doc_id, row_number() OVER () AS r, text FROM documents UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark
), x AS (
    SELECT part, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM w
), d AS (
    SELECT DISTINCT unnest(words) AS word FROM x
), b AS (
    SELECT word, {_CRC_OF} % 10000 AS bucket FROM (SELECT word, word AS s FROM d), crc
), f AS (
    SELECT part, r, bucket, count(*) AS n FROM (SELECT part, r, unnest(words) AS word FROM x) JOIN b USING (word) GROUP BY ALL
), c AS (
    SELECT i AS bucket, coalesce(sum(n) FILTER (part = 0), 0) AS s, coalesce(sum(n) FILTER (part = 1), 0) AS t
    FROM range(10000) AS r(i) LEFT JOIN f ON bucket = i GROUP BY i
), g AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM c
), m AS (
    SELECT r, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM f JOIN g USING (bucket) WHERE part = 0 GROUP BY r
), k AS (
    SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, ('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT AS h
    FROM x LEFT JOIN m USING (r) WHERE part = 0
), z AS (
    SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM k
), o AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS pos,
        10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn FROM z
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND pos <= drawn THEN pos END AS rank FROM o""",
    "op13_spelling": _CRC + rf""", r AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents
), u AS (
    SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL
), h AS (
    SELECT run, n, {_CRC_OF} AS h FROM (SELECT run, n, doc_id || ':' || run AS s FROM u), crc
), a AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % len(run))::INT) || substr(run, (h % len(run))::INT + 2) ELSE run END AS word, n FROM h
), v AS (
    SELECT word, sum(n)::BIGINT AS n FROM a WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), i AS (
    SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v
), c AS (
    SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM i
), p AS (
    SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM c x JOIN c y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
), l AS (
    SELECT DISTINCT c.word AS long, c.n AS long_n, v.word AS short, v.n AS short_n FROM c JOIN v ON v.word = c.a || c.b
), e AS (
    SELECT * FROM p UNION ALL SELECT long, long_n, short, short_n FROM l UNION ALL SELECT short, short_n, long, long_n FROM l
), t AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS pos, count(*) OVER (PARTITION BY word) AS n_near FROM e
), f AS (
    SELECT v.word, v.n, CASE WHEN near_n >= 2 * v.n THEN near END AS form, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
    FROM v LEFT JOIN (SELECT * FROM t WHERE pos = 1) t ON t.word = v.word
), s AS (
    SELECT word, form AS root, 1 AS step FROM f WHERE form IS NOT NULL
    UNION ALL SELECT s.word, f.form, step + 1 FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL
)
SELECT word, form, coalesce((SELECT arg_max(root, step) FROM s WHERE s.word = f.word), word) AS root, n, n_near, form_n FROM f""",
}
