"""The queries opN_<name> over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op1_quality import quality

    return quality(read(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op2_ngram_join import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op3_toxicity import toxicity

    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("passages")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from factloom.llm.op4_tokens import token_counts

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op5_warc import round_trip

    return round_trip(read(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from factloom.llm.op6_packing import pack

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op7_line_dedup import line_digests

    return line_digests(read(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op8_embeddings import near_vectors

    return near_vectors(read(spark, sf_dir, "embeddings"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op9_suffix_dedup import dedup_digests

    return dedup_digests(read(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from factloom.llm.op10_bpe import encode_digests

    return encode_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op11_filter_audit import filter_audit

    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.llm.op12_chat_format import PLANTED, format_digests

    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return format_digests(rows.unionByName(spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from factloom.llm.op13_alignment import alignment

    return alignment(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


_OPERATORS = (
    op1_quality_rules, op2_ngram_jaccard, op3_toxicity, op4_token_counts, op5_warc, op6_packing, op7_line_dedup, op8_embedding_dedup,
    op9_suffix_dedup, op10_byte_bpe, op11_filter_audit, op12_chat_format, op13_token_alignment,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in _OPERATORS}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": r"""
        WITH w AS (
            SELECT doc_id, coalesce(source, chr(1) || 'null') AS host, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        g AS (SELECT doc_id, unnest(range(len(words) - 7)) AS i, words FROM w WHERE len(words) >= 8),
        k AS (SELECT doc_id, i, array_to_string(words[i + 1 : i + 8], ' ') AS gram FROM g),
        d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM k),
        p AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM d WHERE c > 1),
        r AS (SELECT doc_id, CAST(sum(CASE WHEN prev IS NULL THEN 8 ELSE least(8, i - prev) END) AS BIGINT) AS n FROM p GROUP BY doc_id),
        m AS (
            SELECT w.doc_id, host, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                   CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
                   CAST(length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals,
                   CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   coalesce(r.n, 0) AS n_repeat_words
            FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
        f AS (
            SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
                   CAST(10 * n_symbols > n_words AS INT) + CAST(10 * n_capitals > 3 * word_chars AS INT) + CAST(2 * n_dup_lines > n_lines AS INT)
                   + CAST(word_chars < 2 * n_words OR word_chars > 15 * n_words AS INT) AS broken FROM m),
        h AS (SELECT host, count(*) AS n, sum(CASE WHEN base_failed OR broken > 0 THEN 1 ELSE 0 END) AS bad FROM f GROUP BY host),
        a AS (SELECT avg(bad / n) AS mean, coalesce(var_samp(bad / n), 0) AS v FROM h),
        b AS (SELECT mean, greatest(1e0, least(1000e0, mean * (1 - mean) / greatest(v, 1e-12) - 1)) AS weight FROM a),
        s AS (SELECT host, (bad + mean * weight) / (n + weight) AS rate FROM h, b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               (NOT base_failed AND rate <= 0.9 AND broken <= CASE WHEN rate < 0.05 THEN 1 ELSE 0 END) AS kept
        FROM f JOIN s ON f.host = s.host""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        t AS (SELECT body, max(page_id) AS target FROM p WHERE octet_length(encode(body)) >= 1000 GROUP BY body)
        SELECT p.page_id, octet_length(encode(p.body)) AS payload_bytes, sha1(p.body) AS payload_digest,
               CASE WHEN t.target <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN t.target <> p.page_id THEN t.target END AS refers_to
        FROM p LEFT JOIN t ON p.body = t.body""",
    "op11_filter_audit": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(text) THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
            FROM t LEFT JOIN l ON t.doc_id = l.doc_id),
        g AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
        p AS (
            SELECT '' AS o, 'ABCDE' AS rest UNION ALL
            SELECT o || x, replace(rest, x, '') FROM (SELECT o, rest, unnest(string_split(rest, '')) AS x FROM p WHERE rest <> '')),
        s AS (SELECT o AS filter_order, i AS step, o[i] AS x, o[1:i-1] AS before FROM p, range(1, 6) AS r(i) WHERE rest = ''),
        m AS (
            SELECT part, filter_order, step, x, contains(failed, x) AS fails, failed = x AS alone, n, good, toxic,
                   translate(failed, before, '') <> failed AS gone
            FROM g, s),
        a AS (
            SELECT part, filter_order, step, any_value(x) AS x,
                   CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
                   CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
                   CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
                   CAST(sum(CASE WHEN alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                   CAST(sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
                   CAST(sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
            FROM m GROUP BY part, filter_order, step)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
        FROM a""",
    "op12_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)),
        e AS (
            SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?ROLE\]|</?SYS>>|/?s>)', '\1\\\2\3', 'g')) AS chars,
                   length(regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?ROLE\]|</?SYS>>|/?s>)', '\1\\\2\3', 'g')) AS role_chars FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 WHEN 'system' THEN 15 ELSE 17 + role_chars END) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
}
