"""The registered queries of this package and their SQL, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbflow.llm import (
    alignment,
    decontaminate,
    fill_middle,
    fuzzy_dedup,
    language,
    nearest,
    online_packing,
    packing,
    secrets,
    sharding,
    substrings,
    token_ids,
    toxicity,
)
from ebbflow.llm.common import ship, table
from ebbflow.session import settled, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def shipped(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_token_ids")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    files = shared_dir(spark)
    token_ids.write_token_ids(table(spark, folder, "documents"), files, end_id=0)
    return token_ids.read_token_ids(spark, files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


# The checksum goes half a byte at a time, low half first, over the text's hexadecimal digits.
# The walk is the published one: unsigned 64-bit products by way of wider integers.
SHARD_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), nibbles AS (
  SELECT doc_id, length(digits) // 2 + 1 AS size,
         list_transform(string_split(regexp_replace(digits, '(.)(.)', '\\2\\1', 'g'), ''),
                        lambda d: CAST(instr('0123456789ABCDEF', d) - 1 AS BIGINT)) AS halves
  FROM texts
), entries AS (
  SELECT list(CAST(x AS BIGINT) ORDER BY k) AS t FROM (
    SELECT k, list_reduce(list_prepend(k, [0, 0, 0, 0]),
                lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS x
    FROM (SELECT CAST(range AS BIGINT) AS k FROM range(16)))
), sums AS (
  SELECT doc_id, size, CASE WHEN size = 1 THEN 0 ELSE
           xor(list_reduce(halves, lambda c, h: xor(c // 16, t[xor(c % 16, h) + 1]), 4294967295),
               4294967295) END AS text_crc32
  FROM nibbles, entries
), walk AS (
  SELECT doc_id, n, -1::BIGINT AS last, 0::BIGINT AS next,
         CAST(CASE WHEN k < 0 THEN k::HUGEINT + 18446744073709551616 ELSE k END AS HUGEINT) AS key
  FROM (SELECT DISTINCT doc_id, coalesce(doc_id, 0) AS k FROM documents), (VALUES (8), (9)) AS v(n)
  UNION ALL
  SELECT doc_id, n, next,
         CAST(floor((next + 1) * (2147483648.0::DOUBLE / CAST(grown // 8589934592 + 1 AS DOUBLE))) AS BIGINT), grown
  FROM (SELECT *, (((key % 4294967296) * 2862933555777941757
                    + ((((key // 4294967296) * (2862933555777941757 % 4294967296)) % 4294967296) * 4294967296)
                    + 1) % 18446744073709551616) AS grown FROM walk)
  WHERE next < n
), shards AS (
  SELECT doc_id, CAST(max(last) FILTER (n = 8) AS INT) AS shard,
         CAST(max(last) FILTER (n = 9) AS INT) AS grown_shard
  FROM walk WHERE next >= n GROUP BY doc_id
)
SELECT s.doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY s.doc_id) - 1 AS slot, grown_shard
FROM sums s JOIN shards h ON s.doc_id = h.doc_id
"""


@query("op2_jump_shards", SHARD_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard(rows, ["doc_id"], 8).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


# Every window of every document that holds shingles of an item, scored in full.
LEAK_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT item_id, w, len(w) AS n_words, least(5, len(w)) AS k FROM (
    SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
    FROM benchmark) WHERE len(w) > 0
), item_grams AS (
  SELECT item_id, n_words, k, n_words - k + 1 AS n, g, count(*) AS in_item FROM (
    SELECT item_id, n_words, k,
           unnest(list_transform(range(1, n_words - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS g FROM i)
  GROUP BY ALL
), grams AS (
  SELECT doc_id, k, len(w) - k + 1 AS total, unnest(range(0, len(w) - k + 1)) AS pos,
         unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS g
  FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k
), hits AS (
  SELECT DISTINCT doc_id, item_id, n_words, n, total, in_item, pos, g FROM grams JOIN item_grams USING (k, g)
), starts AS (
  SELECT doc_id, item_id, unnest(range(greatest(0, min(pos) - n + 1), least(max(pos), any_value(total) - n) + 1)) AS s
  FROM hits GROUP BY doc_id, item_id, n
), windows AS (
  SELECT doc_id, item_id, n_words, n, s, g, in_item, count(*) AS in_window
  FROM starts JOIN hits USING (doc_id, item_id) WHERE pos BETWEEN s AND s + n - 1 GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, n_words, s, sum(least(in_window, in_item)) / (2 * n - sum(least(in_window, in_item))) AS similarity
  FROM windows GROUP BY doc_id, item_id, n_words, n, s
)
SELECT doc_id, item_id, CAST(s AS INT) AS start_word, CAST(n_words AS INT) AS n_words, CAST(similarity AS DOUBLE) AS similarity
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) = 1
"""


@query("op3_decontamination", LEAK_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "n_words", "similarity")


@query("op4_golay_near_duplicates")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = fuzzy_dedup.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op5_markov_secrets")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.train(docs))

    def count(kind: int):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


@query("op6_complement_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), 1024, end_id=2)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def fold(column: str, parts: int):
    """crc32 of the id as text, modulo; the split that the contract fixes."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = language.train(docs.where(fold("doc_id", 3) != 1))
    found = language.identify(docs.select("doc_id", "text"), network)
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_repeated_passages")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "start", "stop", "n_words", "kept_doc_id", "kept_words")


@query("op9_nearest")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"), F.pmod(F.col("id"), F.lit(50)) == 0, k=5)


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.where(fold("doc_id", 4) != 2), labels.where(fold("doc_id", 4) != 2))
    found = toxicity.score(docs, model)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query("op11_online_packing")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    packed = online_packing.pack_online(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096, end_id=2
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


MIDDLE_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, x, u, len(u) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
         x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>')
           OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 AS plain,
         CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 AS suffix_first
  FROM units
), cut AS (
  SELECT doc_id, x, n, CASE WHEN plain THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:n], '') AS s
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM cut
"""


@query("op12_fill_in_middle", MIDDLE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    aligned = settled(
        alignment.align(
            table(spark, folder, "documents"),
            public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("piece_bpe_32k.model"),
            digest=True,
        )
    )
    found = alignment.scored(aligned, settled(alignment.pair_counts(aligned)))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
