"""One registered query per corpus operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import (
    chunk_dedup, hnsw, html_crf, line_dedup, merkle, minhash, mixing, ngram_join, packing,
    quality, spelling, token_files, topk)
from harvestry.plans.registry import table
from harvestry.session import scratch_path

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(plan):
        QUERIES[plan.__name__] = plan
        if sql:
            ORACLE_SQL[plan.__name__] = sql
        return plan
    return add


LINES_SQL = r"""
WITH numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS document, doc_id, text FROM documents),
split AS (
  SELECT document, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM numbered),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key
  HAVING count(DISTINCT document) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key)
GROUP BY document, doc_id
"""


@query(LINES_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_common_lines(documents)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2("text", 256).alias("kept_sha256"))


@query()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path,
                                  public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_documents(spark, path, token_files.ids_crc32, "long").select(
        "doc_id", "start", "n_tokens", F.col("value").alias("ids_crc32"))


@query()
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).drop("source")


@query()
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


@query()
def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, sf_dir, "labels"))
    return quality.scored(documents, model).select(
        "doc_id", quality.is_held_out().alias("held_out"), "score", "predicted")


@query()
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


@query()
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeats(table(spark, sf_dir, "documents"), within=True).drop("row")


TOP_K_SQL = """
WITH usable AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT)
            AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query(TOP_K_SQL)
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


@query()
def op8_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.search(table(spark, sf_dir, "embeddings"))


@query()
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def crc32_sql(text: str) -> str:
    """crc32 of a text's UTF-8 bytes, half a byte at a time."""
    digits = f"hex(encode({text}))"
    # What half a byte does to a crc32.
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(
      [[('0x' || {digits}[2 * i + 2])::BIGINT, ('0x' || {digits}[2 * i + 1])::BIGINT]
       FOR i IN range(len({digits}) // 2)])), lambda acc, x: xor(acc >> 4,
         [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
          3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896,
          3183342108][(xor(acc, x) & 15) + 1])))"""


MERKLE_SQL = f"""
WITH RECURSIVE fields AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
       || coalesce(strlen(source) || ':' || source, '-')
       || coalesce(strlen(lang) || ':' || lang, '-')
       || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 5 = 0
              THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS changed
  FROM fields),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaves),
inner_nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS many FROM inner_nodes)
  WHERE many > 1 GROUP BY tree, level, idx // 16),
tops AS (SELECT tree, max(level) AS level FROM inner_nodes GROUP BY tree),
subroots AS (
  SELECT i.tree, i.digest, i.level AS height FROM inner_nodes i JOIN tops USING (tree, level)),
upper_nodes AS (
  SELECT 0 AS level, tree - 1 AS idx, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS many FROM upper_nodes)
  WHERE many > 1 GROUP BY level, idx // 16),
-- One address space: the levels above a subroot continue those below it.
nodes AS (
  SELECT i.tree, i.level, i.idx, i.digest
  FROM inner_nodes i JOIN tops t ON i.tree = t.tree AND i.level < t.level
  UNION ALL SELECT t.tree, t.level + u.level, u.idx, u.digest
  FROM tops t, upper_nodes u WHERE u.level < (SELECT max(level) FROM upper_nodes)),
walk AS (
  SELECT p.doc_id, p.leaf, p.tree, 0 AS level, p.idx, s.height,
         coalesce(p.changed, p.leaf) AS folded, '' AS proof, true AS more
  FROM placed p JOIN subroots s USING (tree)
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.level + 1, any_value(w.at) // 16, w.height,
         sha256(string_agg(CASE WHEN n.idx = w.at THEN w.folded ELSE n.digest END, ''
                           ORDER BY n.idx)),
         any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.idx)
                                        FILTER (WHERE n.idx <> w.at), ''), true
  FROM (SELECT *, CASE WHEN level = height THEN tree - 1 ELSE idx END AS at FROM walk) w
  JOIN nodes n ON n.tree = w.tree AND n.level = w.level AND n.idx // 16 = w.at // 16
  GROUP BY w.doc_id, w.leaf, w.tree, w.level, w.height),
ends AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, leaf, tree ORDER BY level DESC) AS turn
  FROM walk)
SELECT e.doc_id, e.leaf, s.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
       e.folded AS folded_root, e.folded = r.digest AS verified
FROM ends e JOIN subroots s USING (tree)
CROSS JOIN (SELECT digest FROM upper_nodes ORDER BY level DESC LIMIT 1) r
WHERE turn = 1
"""


@query(MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", spelling.UPPER, spelling.LOWER)
    return merkle.proofs(*merkle.manifest(
        table(spark, sf_dir, "documents"), picked, lowered))


SPELLING_SQL = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS raw
  FROM documents),
runs AS (
  SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         AS run FROM found WHERE length(raw) >= 7),
hashed AS (
  SELECT run, {crc32_sql("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs),
spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT)
              || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
words AS (
  SELECT word, count(*) AS n FROM spelled WHERE length(word) >= 7
  GROUP BY word HAVING count(*) >= 2),
cuts AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b
    ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS turn FROM pairs),
judged AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.other_n >= 10 * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= 10 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.turn = 1),
walk AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL SELECT walk.word, j.word, j.form FROM walk JOIN judged j ON j.word = walk.next)
SELECT j.word, j.form, w.root, j.n, j.n_near, j.form_n
FROM judged j JOIN walk w ON w.word = j.word AND w.next IS NULL
"""


@query(SPELLING_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.corpus_words(
        table(spark, sf_dir, "documents").select("doc_id", "text"), misspell=31))
