"""The operators' queries on the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relmod.llm import (
    chat,
    embed_dedup,
    exact_dedup,
    jaccard,
    langid,
    lexical,
    line_dedup,
    merkle,
    packing,
    pieces,
    sharding,
    token_counts,
    url_filter,
)
from relmod.llm.common import table

SHARDS = 40


def _crc_table() -> list[int]:
    table = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        table.append(b)
    return table


def _crc_sql(body: str) -> str:
    """CRC-32 of a string's UTF-8 bytes in SQL, byte by byte."""
    step = f"xor(c >> 8, ({_crc_table()}::BIGINT[])[xor(c & 255, b) + 1])"
    hexed = f"hex(encode({body}))"
    digits = f"list_transform(range(0, length({hexed}) // 2), lambda i: ('0x' || {hexed}[2 * i + 1 : 2 * i + 2])::BIGINT)"
    return f"xor(list_reduce({digits}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


#: (verdict, rule); fixed values of the url rules.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


#: The byte-level BPE vocabulary of 50,257 ids.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


#: The SentencePiece model of 32,000 pieces with byte fallback.
PIECES = "piece_bpe_32k.model"
NBEST = 4


def op3_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pieces.encode_nbest(documents, tokenizer_path(PIECES), NBEST, with_ids=False, check=True)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train(documents.filter(~langid.held_out()))
    return langid.predict(documents, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"), words=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.manifest(table(spark, sf_dir, "documents"), SHARDS)


#: The columns that a leaf covers, in this order.
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    manifest = merkle.build(table(spark, sf_dir, "documents"), LEAF_COLUMNS, altered={"text": lowered})
    return merkle.proofs(manifest, with_proof=False).withColumnRenamed("key", "doc_id")


#: Results per query.
RESULTS = 20


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), RESULTS)


#: A document of more tokens is over the limit.
TOKEN_LIMIT = 4096


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(PIECES), TOKEN_LIMIT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_url_filter,
        op3_sentencepiece_nbest,
        op4_exact_dedup,
        op5_packing,
        op6_language_id,
        op7_embedding_dedup,
        op8_ngram_jaccard,
        op9_chat_format,
        op10_sharding,
        op11_merkle_manifest,
        op12_lexical_search,
        op13_token_counts,
    )
}


def _leaf_sql(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in (*LEAF_COLUMNS[:-1], text)]
    return f"sha256({' || '.join(fields)})"


SQL: dict[str, str] = {
    "op12_lexical_search": lexical.search_sql(RESULTS, _UPPER, _LOWER),
    "op11_merkle_manifest": merkle.proofs_sql(
        f"""SELECT doc_id, lang AS grp, {_leaf_sql("text")} AS leaf,
                   CASE WHEN {_crc_sql("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 AND doc_id IS NOT NULL
                        THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS altered
            FROM documents"""
    ),
    "op1_line_dedup": rf"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
        k AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        c AS (
            SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= {line_dedup.MIN_CHARS}
            GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
        m AS (SELECT k.*, keep IS NOT NULL AND keep <> doc_id AS gone FROM k LEFT JOIN c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op2_url_filter": url_filter.judge_sql(URL_RULES),
    "op9_chat_format": chat.ROTATE_SQL,
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents),
        w AS (
            SELECT doc_id, content, count(*) OVER (PARTITION BY content) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id
            FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM w
    """,
    "op10_sharding": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, coalesce(text, '') AS body,
                   ((doc_id::HUGEINT % 18446744073709551616) + 18446744073709551616) % 18446744073709551616 AS seed
            FROM documents),
        jumps AS (
            SELECT DISTINCT doc_id, seed AS k, 0::BIGINT AS pos FROM d
            UNION ALL
            SELECT doc_id, k2, CAST(floor((pos + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE)) AS BIGINT)
            FROM (SELECT doc_id, pos, (k * {sharding.MULTIPLIER} + 1) % 18446744073709551616 AS k2 FROM jumps WHERE pos <= {SHARDS})),
        s AS (
            SELECT doc_id, max(pos) FILTER (WHERE pos < {SHARDS}) AS shard, max(pos) FILTER (WHERE pos <= {SHARDS}) AS grown
            FROM jumps GROUP BY doc_id)
        SELECT d.doc_id, size, {_crc_sql("body")} AS text_crc32, 'key' AS law, shard::INTEGER AS shard, grown::INTEGER AS grown_shard,
               row_number() OVER (PARTITION BY shard ORDER BY d.doc_id) - 1 AS slot
        FROM d JOIN s USING (doc_id)
    """,
}
