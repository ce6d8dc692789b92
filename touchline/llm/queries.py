"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (chat, decontaminate, embedding_dedup, lexical_search, line_dedup, packing, pii, prefix_trie,
                           quality, simhash, suffix_dedup, urls, warc)
from touchline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query()
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN firsts USING (payload_digest)
""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


#: A conversation whose texts hold control strings.
HARD_TURN = "\\### Assistant: </turn> ok"
_ESCAPED = "replace(replace(replace({}, '\\', '\\b'), '###', '\\h'), '</turn>', '\\t')"


@query(rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{HARD_TURN}' UNION ALL SELECT -7, 1, 'assistant', '{HARD_TURN}'
), escaped AS (
  SELECT *, {_ESCAPED.format("text")} AS t, replace({_ESCAPED.format("role")}, ':', '\c') AS r FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(length(r) + length(t) + length('###  : </turn>')) - 1)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
""")
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TURN), (-7, 1, "assistant", HARD_TURN)],
                                 "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(hard)
    read = chat.parse_conversations(chat.format_conversations(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.array_join(F.transform("loss_spans", lambda s: chat.unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


# crc32 of a decimal number, bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, c: list_reduce(list_concat([xor(crc, c)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""


@query(rf"""
WITH given AS (
  SELECT conv_id, count(*) AS n, {_CRC32} % 4 AS h, conv_id - conv_id % 20 AS base,
    list(md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ids,
    list(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS words
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
convs AS (
  SELECT g.conv_id, list_concat(coalesce(b.ids, [])[1:g.h], g.ids[g.h + 1:]) AS ids,
    list_concat(coalesce(b.words, [])[1:g.h], g.words[g.h + 1:]) AS words
  FROM given g LEFT JOIN given b ON g.base = b.conv_id),
steps AS (SELECT conv_id, ids, words, unnest(range(len(ids) + 1)) AS depth FROM convs),
named AS (SELECT *, md5(array_to_string(ids[1:depth], '')) AS node FROM steps),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(ids[1:depth]) AS path,
    CASE WHEN depth > 0 THEN (count(*) - 1) * any_value(words[depth]) ELSE 0 END AS saved,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(ids)) AS ends
  FROM named GROUP BY node, depth),
linked AS (SELECT *, CASE WHEN depth > 0 THEN md5(array_to_string(path[1:depth - 1], '')) END AS up FROM nodes),
children AS (SELECT up AS node, count(*) AS n FROM linked WHERE up IS NOT NULL GROUP BY up),
valued AS (SELECT l.*, coalesce(n, 0) AS n_children FROM linked l LEFT JOIN children USING (node)),
above AS (SELECT path, saved, n_children, unnest(range(depth + 1)) AS d FROM valued),
sums AS (
  SELECT md5(array_to_string(path[1:d], '')) AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM above GROUP BY ALL)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN sums USING (node) LEFT JOIN nodes p ON v.up = p.node
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
    return nodes.join(prefix_trie.ends_digest(ends), prefix_trie.KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
given AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, {_STRIP}), {_A_TO_Z}) AS key FROM given),
shared AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id < last) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (last IS NULL OR doc_id >= last), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
""")
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_shared_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_TERMS = rf"regexp_extract_all(translate(text, {_A_TO_Z}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
norms AS (SELECT doc_id, 25 + (75 * n * docs) // total AS m FROM lengths, whole),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, whole GROUP BY term, docs),
asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
held AS (SELECT item_id, term, count(*) AS q FROM asked GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM held JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
