"""The text queries registered with the driver, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import langid, toxicity
from .byte_bpe import encode_documents
from .exact_dup import exact_duplicates
from .license_scan import license_scan
from .near_dup import near_duplicates
from .packing import pack_documents
from .quality import ablations, ledger, verdicts
from .sharding import ROUNDS, feistel_shards
from .token_counts import count_tokens


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return langid.identify(docs, langid.learn(docs))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir), percent=85)


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_documents(spark, sf_dir))


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards(_documents(spark, sf_dir), _SHARDS, _SEED)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(ledger(_documents(spark, sf_dir)))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy rejects, alone and with the others."""
    return ablations(ledger(_documents(spark, sf_dir)))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


#: Shards, seed and rounds of op8, as its SQL needs them.
_SHARDS, _SEED = 24, 20


def _feistel_sql(value: str) -> str:
    """One pass of the permutation over a numbered row, round by round, as nested SQL."""
    left, right = f"({value} // side)", f"({value} % side)"
    for k in range(ROUNDS):
        keyed = f"(CAST('0x' || substr(md5('{_SEED}:{k}:' || CAST({right} AS VARCHAR)), 1, 15) AS BIGINT) % side)"
        left, right = right, f"(({left} + {keyed}) % side)"
    return f"({left} * side + {right})"


#: The byte table of crc32, from its polynomial.
_CRC = "(SELECT list(list_reduce(range(8), lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) ORDER BY i) FROM range(256) t(i))"

#: The ledger of the quality rules, up to its rows ``b``.
_LEDGER = r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
        u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
        g AS (SELECT doc_id, i, CASE WHEN lead(word, 7) OVER o IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o,
                     lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o) END AS win
              FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        f AS (SELECT doc_id, i, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 THEN 1 ELSE 0 END AS dup FROM g),
        c AS (SELECT doc_id, max(dup) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM f),
        r AS (SELECT doc_id, sum(covered) AS n FROM c GROUP BY doc_id),
        m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                     CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                     CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                     CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
                     CAST(len(ls) AS BIGINT) AS n_lines,
                     CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
              FROM w LEFT JOIN r USING (doc_id)),
        b AS (SELECT *, CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                     + CASE WHEN 10 * n_symbols > 2 * n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
                     + CASE WHEN word_chars > 40 * n_words THEN 16 ELSE 0 END + CASE WHEN 2 * word_chars < 3 * n_words THEN 32 ELSE 0 END
                     + CASE WHEN 2 * n_capitals > word_chars THEN 64 ELSE 0 END AS INTEGER) AS failed FROM m)
        """

QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_toxicity, op3_token_counts, op4_language, op5_near_duplicates, op6_exact_duplicates, op7_license_scan, op8_feistel_shards, op9_quality_rules, op10_packing, quality_ablations)}

ORACLE_SQL = {
    "op5_near_duplicates": r"""
        WITH RECURSIVE
        w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        u AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
        g AS (SELECT doc_id, CASE WHEN n < 5 THEN (CASE WHEN i = 1 THEN concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) END)
                                  WHEN i <= n - 4 THEN concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS s
              FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        sh AS (SELECT DISTINCT doc_id, s FROM g WHERE s IS NOT NULL),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        reach(a, b) AS (SELECT DISTINCT x, x FROM e UNION SELECT r.a, e.y FROM reach r JOIN e ON e.x = r.b),
        m AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id, coalesce(m.root, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id
    """,
    "op8_feistel_shards": f"""
        WITH RECURSIVE
        crc AS (SELECT {_CRC} AS tbl),
        h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        r AS (SELECT doc_id, CAST(length(x) // 2 + 8 AS BIGINT) AS size,
                     xor(list_reduce(list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
                                     lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM h, crc),
        s AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row_number, count(*) OVER () AS n FROM r),
        t AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS side FROM s),
        step(doc_id, size, text_crc32, row_number, n, side, v) AS (
            SELECT doc_id, size, text_crc32, row_number, n, side, {_feistel_sql("row_number")} FROM t
            UNION ALL SELECT doc_id, size, text_crc32, row_number, n, side, {_feistel_sql("v")} FROM step WHERE v >= n)
        SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(v % {_SHARDS} AS INTEGER) AS shard, v // {_SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard, row_number FROM step WHERE v < n
    """,
    "op6_exact_duplicates": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
             k AS (SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM k
    """,
    "op9_quality_rules": _LEDGER + "SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM b",
    "quality_ablations": _LEDGER
    + """, each AS (SELECT unnest(['few_words', 'repeated_words', 'symbols', 'duplicate_lines', 'long_words', 'short_words', 'capitals']) AS rule, unnest([1, 2, 4, 8, 16, 32, 64]) AS bit)
        SELECT rule, CAST(sum(CASE WHEN failed & bit <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed, CAST(sum(CASE WHEN failed = bit THEN 1 ELSE 0 END) AS BIGINT) AS only_by_rule,
               CAST(sum(CASE WHEN failed = 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept_with, CAST(sum(CASE WHEN failed & (127 - bit) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept_without
        FROM b, each GROUP BY rule""",
}
