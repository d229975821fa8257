"""Registered queries of the corpus operators; each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from massloom.llm import bpe, chat, decontaminate, filter_audit, language, pii, pivot_search, prefix_trie, quality, secrets, substring
from massloom.llm.common import in_held_out, table, written
from massloom.llm.exact_dedup import exact_dedup
from massloom.llm.simhash import simhash_groups

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The byte-level vocabulary file; the package that holds it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind_no"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")  # noqa: E731
    return found.select("doc_id", *[count(k) for k in range(4)], F.sha2(secrets.written_spans(F.col("base"), pii.KINDS), 256).alias("base_sha256"), secrets.written_spans(F.col("spans"), pii.KINDS).alias("spans"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(~in_held_out()))
    return quality.score(docs, model).select("doc_id", in_held_out().alias("held_out"), "score", "predicted")


_CONTROL = "\\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", _CONTROL), (-7, 1, "assistant", _CONTROL)], "conv_id long, turn long, role string, text string")
    read = chat.read_back(chat.format_chat(rows.unionByName(extra)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *, length(replace(replace(text, '\', '\b'), '<', '\l')) + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), chr(10), '\n')) + 15 AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, cast(sum(chars) AS bigint) AS formatted_chars
FROM sized GROUP BY conv_id
"""

def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind_no"] < 3)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.written_spans(base), 256).alias("base_sha256"), secrets.written_spans(F.col("spans")).alias("spans"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_ids", "n_words", "n_covered")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    languages, probabilities = language.train(docs.filter(~in_held_out()))
    return language.identify(docs, languages, probabilities).select("doc_id", in_held_out().alias("held_out"), "lang_pred", "score")



def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = written(prefix_trie.turn_ids(table(spark, sf_dir, "conversations")))
    nodes = prefix_trie.prefix_trie(prefix_trie.with_donor_heads(own))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


OP11_SQL = """
WITH turns AS (
  SELECT conv_id, turn, sha256(cast(octet_length(encode(coalesce(role, ''))) AS varchar) || ':' || coalesce(role, '') || coalesce(text, '')) AS tok,
    octet_length(encode(coalesce(text, ''))) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT conv_id, list(tok ORDER BY turn NULLS FIRST, tok) AS toks, list(size ORDER BY turn NULLS FIRST, tok) AS sizes FROM turns GROUP BY conv_id
), bits AS (
  SELECT conv_id, list_prepend(4294967295, flatten(list_transform(string_split(cast(conv_id AS varchar), ''), lambda c: [cast(ascii(c) AS bigint), 0, 0, 0, 0, 0, 0, 0]))) AS feed FROM own
), heads AS (
  SELECT conv_id, xor(list_reduce(feed, lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END), 4294967295) % 9 AS h FROM bits
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(d.toks[1:h], []), o.toks[h + 1:]) AS toks, list_concat(coalesce(d.sizes[1:h], []), o.sizes[h + 1:]) AS sizes
  FROM own o JOIN heads USING (conv_id) LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % 5
), places AS (
  SELECT conv_id, d, array_to_string(toks[1:d], '') AS path, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size, d = len(toks) AS ends
  FROM (SELECT *, unnest(range(0, len(toks) + 1)) AS d FROM rebuilt) r
), nodes AS (
  SELECT path, d, left(path, 64 * (d - 1)) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
    sha256(coalesce(string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM places GROUP BY path, d
), kids AS (SELECT up, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up
), whole AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids ON nodes.path = kids.up
), sums AS (
  SELECT left(path, 64 * k) AS path, cast(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS bigint) AS n_leaves, cast(sum(saved) AS bigint) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM whole) w GROUP BY 1
)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM whole w JOIN sums USING (path) LEFT JOIN nodes p ON w.d > 0 AND p.path = w.up
"""


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x AS double))) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.vec, c.vec) AS bigint) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.vec) = len(c.vec)
)
SELECT query_id, cast(row_number() OVER w AS int) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH marks AS (SELECT doc_id, max(cast(quality = 1 AS int)) AS good, max(cast(toxic = 1 AS int)) AS toxic FROM labels GROUP BY doc_id
), words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS words, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents
), bits AS (
  SELECT part, cast(len(words) < 100 AS int) + 2 * cast(100 * len(list_distinct(words)) < 80 * len(words) AS int)
    + 4 * cast(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS int) + 8 * cast(regexp_matches(text, '[#$%&*|]') AS int) + 16 * cast(coalesce(doc_id > first, false) AS int) AS mask,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM words LEFT JOIN marks USING (doc_id)
), letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(l, b)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS masks FROM letters a, letters b, letters c, letters d, letters e
  WHERE (a.b | b.b | c.b | d.b | e.b) = 31
), steps AS (SELECT filter_order, s AS step, masks[s] AS own, cast(coalesce(list_sum(masks[1:s - 1]), 0) AS int) AS before FROM orders, unnest([1, 2, 3, 4, 5]) t(s)
), counted AS (
  SELECT part, filter_order, step, own, count_if(mask & own = 0 AND mask & before = 0) AS kept, count_if(mask & own <> 0 AND mask & before = 0) AS removed,
    count_if(mask & own <> 0 AND mask & before <> 0) AS redundant, count_if(mask = own) AS unique_fails,
    count_if(mask & own <> 0 AND mask & before = 0 AND good = 1) AS good_lost, count_if(mask & own <> 0 AND mask & before = 0 AND toxic = 1) AS toxic_lost
  FROM bits, steps GROUP BY ALL
)
SELECT part, filter_order, step, cast(kept AS bigint) AS kept, cast(removed AS bigint) AS removed, cast(redundant AS bigint) AS redundant, cast(unique_fails AS bigint) AS unique_fails,
  cast(good_lost AS bigint) AS good_lost, cast(toxic_lost AS bigint) AS toxic_lost, cast(sum(removed) OVER (PARTITION BY part, own) AS bigint) AS shapley
FROM counted
"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_personal_data, op2_quality, op3_chat_format, op4_exact_dedup, op5_bpe, op6_secrets, op7_substring_dedup, op8_simhash_near_dedup, op9_decontaminate, op10_language, op11_prefix_trie, op12_top_k, op13_filter_audit)
}
ORACLES: dict[str, str] = {"op3_chat_format": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op11_prefix_trie": OP11_SQL, "op12_top_k": OP12_SQL, "op13_filter_audit": OP13_SQL}
