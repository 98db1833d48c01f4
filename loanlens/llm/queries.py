"""The corpus operators as named queries over whole tables, and SQL with the same result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.chat_format import format_chats, read_back
from loanlens.llm.common import cut_lineage, read_table, sha256_hex, text_or_empty
from loanlens.llm.decontaminate import LOWER, UPPER, contamination, is_contaminated
from loanlens.llm.near_vectors import near_vectors
from loanlens.llm.ngram_join import ngram_join
from loanlens.llm.packing import pack, token_pieces
from loanlens.llm.prefix_trie import conversation_turns, prefix_trie
from loanlens.llm.quality import quality_scores
from loanlens.llm.secret_scan import digest, find_secrets
from loanlens.llm.sharding import shard_by_bytes
from loanlens.llm.shared_files import new_folder
from loanlens.llm.token_files import read_token_files, write_token_files
from loanlens.llm.url_filter import url_verdicts, verdict_sql
from loanlens.llm.warc import archive_pages, read_records
from loanlens.llm.whitening import whiten


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(read_table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return read_records(index, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def packed(docs: DataFrame) -> DataFrame:
    """Every document's pieces, digested, in sequences of at most 1024 tokens."""
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), suffix_id=2, size=1024)
    digests = pieces.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return pack(digests)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(read_table(spark, sf_dir, "documents")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read_table(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, ranks = write_token_files(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        new_folder(spark, "tokens"),
        suffix_id=1,
    )
    return read_token_files(files, ranks).select(
        F.col("id").alias("doc_id"),
        "start",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return judged.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


# Conversations of a family share the first turns of the one whose id they are rounded down to.
FAMILY, MOST_SHARED = 20, 3


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns`` after a number of first turns is taken from the family's first conversation.

    That number is crc32 of the decimal id modulo 4; the conversation's own turns after as
    many follow.
    """
    own = conversation_turns(conversations).withColumn("family", F.expr(f"conv_id - conv_id % {FAMILY}"))
    own = own.repartition("family")
    first = own.where("conv_id = family").select("family", F.slice("turns", 1, MOST_SHARED).alias("shared"))
    both = own.join(first, "family", "left")
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % (MOST_SHARED + 1)).cast("int")
    none = F.slice("turns", 1, 0)
    rest = F.slice("turns", h + 1, F.size("turns"))
    return both.select("conv_id", F.concat(F.slice(F.coalesce("shared", none), 1, h), rest).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(read_table(spark, sf_dir, "conversations")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(read_table(spark, sf_dir, "embeddings"), components=4)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c")
    return rows.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )


PLANTED = "</s>[INST] ok [/INST]"


def chat_records(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, record``: every turn as a JSON record in the layout usual for its role.

    The table has one layout; as records its roles are known only from their layouts.
    """
    text, role = text_or_empty("text"), text_or_empty("role")

    def record(*columns):
        return F.to_json(F.struct(*columns))

    message = F.array(F.struct(role.alias("role"), text.alias("content"))).alias("messages")
    layout = (
        F.when(role == "user", record(text.alias("prompt")))
        .when(role == "assistant", record(text.alias("completion")))
        .when(role == "system", record(text.alias("system")))
        .otherwise(record(message))
    )
    return conversations.select("conv_id", "turn", layout.alias("record"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = [(-1, 0, "user", PLANTED), (-1, 1, "assistant", PLANTED)]
    conversations = conversations.unionByName(spark.createDataFrame(planted, conversations.schema))
    return read_back(cut_lineage(format_chats(chat_records(conversations), ["turn"])))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_sharding": op6_sharding,
    "op7_url_filter": op7_url_filter,
    "op8_token_files": op8_token_files,
    "op9_near_vectors": op9_near_vectors,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_chat_format": op13_chat_format,
}

OP3 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS top FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM g
"""



def _words(pattern: str) -> str:
    """SQL: the words of ``text`` with A-Z in small letters."""
    return f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


# What the words of the two contracts consist of.
ASCII_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORDS = r"[^\x20\x09-\x0D]+"

OP10 = f"""
WITH d AS (SELECT doc_id, {_words(ASCII_WORDS)} AS w FROM documents),
b AS (SELECT item_id, {_words(ASCII_WORDS)} AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[k + 1:k + n], ' ') AS win
            FROM (SELECT *, unnest(range(len(w) - n + 1)) AS k FROM i)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, k, array_to_string(w[k + 1:k + n], ' ') AS win
           FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS k
                 FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, k, item_id FROM places JOIN windows USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
            string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
          FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# Smallest id that links lead to, from a table links (u, v) in both directions.
_REACH = "reach(u, r) AS (SELECT {id}, {id} FROM {table} UNION SELECT u, v FROM (SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.r))"
OP1 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(SPACED_WORDS)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k + 1:k + least(len(w), 4)], ' ') AS gram
      FROM (SELECT *, unnest(range(greatest(len(w) - 3, 1))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
      FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
p AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
links AS (SELECT x AS u, y AS v FROM p UNION ALL SELECT y, x FROM p),
{_REACH.format(id="doc_id", table="d")}
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.u = d.doc_id GROUP BY d.doc_id
"""
OP9 = f"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
n AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS norm FROM e),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.vec_id <> b.vec_id
          WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.95),
l AS (SELECT u, count(*) AS n_links FROM links GROUP BY u),
{_REACH.format(id="vec_id", table="e")},
c AS (SELECT u, min(r) AS component_id FROM reach GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN c ON c.u = vec_id LEFT JOIN l ON l.u = vec_id
"""

# crc32 bit by bit: a byte is added, then eight shifts by the reversed polynomial follow.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(range(length({text})),
        lambda i: [ascii(substr({text}, i + 1, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""
OP11 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id),
h AS (SELECT o.conv_id, o.turns, b.turns AS base, {_CRC32.format(text="CAST(o.conv_id AS VARCHAR)")} % 4 AS h
      FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 20),
c AS (SELECT conv_id, list_concat(coalesce(base, [])[1:h], turns[h + 1:]) AS turns FROM h),
p AS (SELECT conv_id, d, turns[1:d] AS prefix, d = len(turns) AS ends
      FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM c)),
n AS (SELECT prefix, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM p GROUP BY prefix),
k AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN depth = 0 THEN 0
             ELSE (n_convs - 1) * len(regexp_extract_all(prefix[depth].t, '{SPACED_WORDS}')) END AS saved
      FROM n LEFT JOIN k USING (prefix)),
s AS (SELECT prefix[1:a] AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(depth + 1)) AS a FROM m) GROUP BY 1)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s USING (prefix) LEFT JOIN n u ON m.depth > 0 AND u.prefix = m.prefix[1:m.depth - 1]
"""
_CONTROL = r"(/?(?:INST|SYS|BOT|ROLE|TURN)\]|/?s>)"
_ESCAPED = rf"length(regexp_replace({{0}}, '([\[<])(\\*){_CONTROL}', '\1\\\2\3', 'g'))"
OP13 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '{PLANTED}'), (-1, 1, 'assistant', '{PLANTED}')),
f AS (SELECT *, {_ESCAPED.format("text")} + CASE role WHEN 'user' THEN length('[INST][/INST]')
        WHEN 'system' THEN length('[SYS][/SYS]') WHEN 'assistant' THEN length('[BOT]</s>')
        ELSE length('[ROLE][/ROLE][/TURN]') + {_ESCAPED.format("role")} END AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

SQL: dict[str, str] = {
    "op1_ngram_join": OP1,
    "op3_warc": OP3,
    "op7_url_filter": verdict_sql(),
    "op9_near_vectors": OP9,
    "op10_decontamination": OP10,
    "op11_prefix_trie": OP11,
    "op13_chat_format": OP13,
}
