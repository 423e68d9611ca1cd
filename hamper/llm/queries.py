"""Registered queries of the operators: each applies one to its whole table.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` holds DuckDB SQL for
those that SQL can express. The others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hamper.llm import (alignment, bagminhash, exact_dedup, licenses, mixing, prefix_trie, rans, spm, substrings, token_rollup, topk,
                        toxicity, url_filter)
from hamper.llm.common import shared_dir, stage, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- 1 token counts
ALNUM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after four batches: all documents come in under tokenizer words-1, those
    labelled toxic are deleted, those labelled of good quality are recounted under alnum-2,
    and the deletion is sent a second time (which must change nothing)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    marks = (table(spark, sf_dir, "labels").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality")))
    counts = stage(docs.select("doc_id", "source", "lang", word_count(F.col("text")).alias("words"),
                               F.regexp_count("text", F.lit(ALNUM)).alias("runs")), "counts")
    marked = counts.join(marks, "doc_id")
    toxic = marked.where("toxic = 1")
    good = marked.where("quality = 1 and coalesce(toxic, 0) <> 1")
    rollup = token_rollup.TokenRollup(spark, shared_dir(spark, "rollup"))
    rollup.commit("insert-all", token_rollup.inserts(counts, "words-1", F.col("words")))
    rollup.commit("delete-toxic", token_rollup.deletes(toxic, "words-1", F.col("words")))
    rollup.commit("revise-good", token_rollup.revisions(good, "words-1", F.col("words"), "alnum-2", F.col("runs")))
    rollup.commit("delete-toxic", token_rollup.deletes(toxic, "words-1", F.col("words")))
    return rollup.totals()


ORACLE["op1_token_counts"] = r"""
WITH m AS (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT source, lang, coalesce(quality, 0) = 1 AS good,
             coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words,
             coalesce(len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 0) AS runs
      FROM documents LEFT JOIN m USING (doc_id) WHERE coalesce(toxic, 0) <> 1)
SELECT source, lang, CASE WHEN good THEN 'alnum-2' ELSE 'words-1' END AS tokenizer, count(*) AS n_docs,
       CAST(sum(CASE WHEN good THEN runs ELSE words END) AS BIGINT) AS n_tokens
FROM d GROUP BY ALL
"""


# ---------------------------------------------------------------- 2 mixing sources
@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    light = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              mixing.quality_weight(F.col("text")).alias("weight"),
                              F.xxhash64("text").alias("text_hash")), "mix-docs")
    mixed = mixing.mix(light, F.col("size"), F.col("weight"), text_hash=F.col("text_hash"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


# ---------------------------------------------------------------- 3 exact top-k search
@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")))
               .select("vec_id", topk.quantize(F.col("embedding")).alias("vector")))
    return topk.exact_topk(vectors, vectors.where("vec_id % 50 = 0"), k=5)


ORACLE["op3_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM s
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5
"""


# ---------------------------------------------------------------- 4 token-id output
@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents, then reads them back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    root = rans.new_root(spark)
    rans.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), root, end_id=1)
    return rans.read_token_digests(spark, root)


# ---------------------------------------------------------------- 5 toxicity
@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


# ---------------------------------------------------------------- 6 near-duplicates
@query
def op6_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---------------------------------------------------------------- 7 licence scans
@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).drop("matches")


# ---------------------------------------------------------------- 8 URL filters
#: The rules of the query (fixed values): verdict, host, path.
URL_RULES = """
  SELECT * FROM VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                       ('allow', 'com', '/fr/'), ('block', 'com', '/de/') AS r(verdict, host, path)
"""


@query
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, spark.sql(URL_RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


ORACLE["op8_url_rules"] = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (SELECT page_id, host, path, ends_with('.' || host, '.org') AS org, ends_with('.' || host, '.com') AS com,
             ends_with('.' || host, '.example.org') AS ex FROM p)
SELECT page_id, host, path,
       CASE WHEN ex AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN ex AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN com AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN com AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN org AND starts_with(path, '/') THEN 'org/' END AS rule,
       CASE WHEN ex AND (starts_with(path, '/en/1') OR starts_with(path, '/es/')) THEN 'block'
            WHEN com AND starts_with(path, '/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


# ---------------------------------------------------------------- 9 exact dedup
@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = exact_dedup.exact_groups(docs)
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


# ---------------------------------------------------------------- 10 SentencePiece
@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids (number and crc32) and whether decoding them gives back its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spm.check_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


# ---------------------------------------------------------------- 11 conversation prefix trie
@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    nodes = prefix_trie.conversation_trie(
        table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"),
        base=conv - conv % 5, head=F.crc32(conv.cast("string").cast("binary")) % 9)
    return nodes.drop("node")


ORACLE["op11_prefix_trie"] = r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, step) AS pos, step, bytes
  FROM (SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
               sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS step
        FROM conversations WHERE conv_id IS NOT NULL)),
-- crc32 of the decimal number, a bit a round
crc(c, s, k, x) AS (
  SELECT c, CAST(c AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT c FROM t)
  UNION ALL
  SELECT c, s, k + 1, xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(x, ascii(s[k // 8 + 1])) ELSE x END AS y FROM crc WHERE k < 8 * length(s))),
h AS (SELECT c, c - c % 5 AS base, xor(x, 4294967295) % 9 AS h FROM crc WHERE k = 8 * length(s)),
r AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, step, bytes
      FROM (SELECT h.c, false AS own, pos, step, bytes FROM h JOIN t ON t.c = base AND pos <= h
            UNION ALL SELECT h.c, true, pos, step, bytes FROM h JOIN t ON t.c = h.c AND pos > h)),
p AS (SELECT c, d, bytes, sha256(string_agg(step, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS node,
             d = max(d) OVER (PARTITION BY c) AS last FROM r),
paths AS (SELECT c, d, bytes, node, lag(node, 1, '') OVER (PARTITION BY c ORDER BY d) AS up, last FROM p
          UNION ALL SELECT c, 0, 0, '', NULL, c NOT IN (SELECT c FROM p) FROM h),
nodes AS (SELECT node, any_value(d) AS depth, any_value(up) AS up, any_value(bytes) AS bytes, min(c) AS rep, count(*) AS n,
                 count(*) FILTER (last) AS ending, coalesce(string_agg(c, ',' ORDER BY c) FILTER (last), '') AS ends
          FROM paths GROUP BY node),
kids AS (SELECT up, count(*) AS k FROM nodes WHERE up IS NOT NULL GROUP BY up),
sums AS (SELECT a.node, count(*) FILTER (u.n = u.ending) AS leaves, sum((u.n - 1) * u.bytes) AS saved
         FROM nodes u JOIN paths a ON a.c = u.rep AND a.d <= u.depth GROUP BY a.node)
SELECT x.rep AS conv_id, x.depth, y.rep AS parent_conv_id, x.n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes x JOIN sums USING (node) LEFT JOIN nodes y ON y.node = x.up LEFT JOIN kids ON kids.up = x.node
"""


# ---------------------------------------------------------------- 12 cross-tokenizer alignment
@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.linked_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("piece_bpe_32k.model"))


# ---------------------------------------------------------------- 13 substring dedup
@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed",
                                                  F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op13_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
gone AS (SELECT DISTINCT doc_id, i + k AS i
         FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS low FROM win), range(13) AS r(k)
         WHERE low < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
"""
