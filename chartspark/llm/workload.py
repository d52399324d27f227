"""The registered queries of the operators, and their SQL for DuckDB where SQL can express them."""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartspark.llm import (
    alignment,
    conversations,
    decontamination,
    extraction,
    langid,
    lines,
    mixing,
    naming,
    packing,
    quality,
    simhash,
    topk,
    toxicity,
)
from chartspark.llm.common import table

SPACES = "[\\x20\\x09-\\x0D]+"
WORDS = "[^\\x20\\x09-\\x0D]+"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = naming.exact_dedup(table(spark, sf, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept", "text_sha256"
    )


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.withColumnRenamed("key", "doc_id")


def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    found = packing.best_fit_packing(table(spark, sf, "documents"), tokenizer_path())
    return found.drop("row").withColumnRenamed("key", "doc_id")


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf, "documents"))
    return found.select(F.col("key").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


def op5_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.extract(table(spark, sf, "pages")).withColumnRenamed("key", "page_id")


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.withColumnRenamed("key", "doc_id")


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    found = mixing.mix(table(spark, sf, "documents"))
    return found.select(F.col("key").alias("doc_id"), "source", "tokens", "pass", "block", "place")


def op8_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("key") % 50 == 0)


def op9_language(spark: SparkSession, sf: str) -> DataFrame:
    return langid.language(table(spark, sf, "documents")).withColumnRenamed("key", "doc_id")


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = lines.line_dedup(table(spark, sf, "documents"))
    return found.select(F.col("key").alias("doc_id"), "text", "n_lines", F.size("removed").alias("n_removed"))


def op11_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = decontamination.n_covered(F.col("spans"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    found, _ = alignment.alignment(table(spark, sf, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    return found.drop("row").withColumnRenamed("key", "doc_id")


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return conversations.repair_report(rows).withColumnRenamed("conv", "conv_id")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash": op4_simhash,
    "op5_html_extraction": op5_html_extraction,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_exact_topk": op8_exact_topk,
    "op9_language": op9_language,
    "op10_line_dedup": op10_line_dedup,
    "op11_decontamination": op11_decontamination,
    "op12_alignment": op12_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}

LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
ITEM_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
INK = "[^\\x20\\x09-\\x0D]"

ORACLES = {
    "op1_exact_dedup": f"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '{SPACES}', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '{SPACES}', '', 'g') AS squeezed
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER best AS keep_id,
         count(*) OVER (PARTITION BY squeezed) AS group_size,
         row_number() OVER best = 1 AS kept
  FROM texts
  WINDOW best AS (PARTITION BY squeezed ORDER BY points DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
""",
    "op7_mixing": f"""
WITH RECURSIVE facts AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS name,
         substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {mixing.BLOCK_DIGITS}) AS block,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS tokens
  FROM documents
), totals AS (
  SELECT name, CAST(sum(tokens) AS BIGINT) AS tokens FROM facts GROUP BY name
), ends AS (
  SELECT CAST(max(tokens) AS DOUBLE) / min(tokens) AS spread, CAST(max(tokens) AS DOUBLE) AS most
  FROM totals WHERE tokens > 0
), halved AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
  UNION ALL
  SELECT step + 1,
         CASE WHEN pow(spread, 1 - (low + high) / 2) <= 2 + 1e-12 THEN low ELSE (low + high) / 2 END,
         CASE WHEN pow(spread, 1 - (low + high) / 2) <= 2 + 1e-12 THEN (low + high) / 2 ELSE high END
  FROM halved, ends WHERE step < 45
), exponent AS (
  SELECT CASE WHEN spread <= 2 THEN 0 ELSE least(1, ceil(high * 1e6 - 1e-4) / 1e6) END AS a
  FROM halved, ends WHERE step = 45
), repeated AS (
  SELECT name, tokens, CASE WHEN tokens > 0 THEN pow(most / tokens, 1 - a) ELSE 1 END AS repeats
  FROM totals, exponent, (SELECT max(most) AS most FROM ends)
), quotas AS (
  SELECT name, tokens AS total, CAST(floor(repeats + 1e-9) AS BIGINT) AS full_passes,
         greatest(CAST(floor((repeats - floor(repeats + 1e-9)) * tokens) AS BIGINT), 0) AS rest
  FROM repeated
), blocks AS (
  SELECT name, block, CAST(sum(tokens) AS BIGINT) AS tokens FROM facts GROUP BY name, block
), passes AS (
  SELECT b.name, b.block, b.tokens, q.total, q.full_passes, q.rest, p.pass,
         sum(b.tokens) OVER (PARTITION BY b.name, p.pass
                             ORDER BY md5('mix|' || b.name || '|' || p.pass || '|' || b.block), b.block
                             ROWS UNBOUNDED PRECEDING) AS upto
  FROM blocks b JOIN quotas q ON b.name = q.name, LATERAL (SELECT unnest(range(q.full_passes + 1)) AS pass) p
)
SELECT f.doc_id, f.source, f.tokens, CAST(p.pass AS INTEGER) AS pass, f.block,
       CAST(p.pass * p.total + p.upto - p.tokens AS BIGINT) AS place
FROM facts f JOIN passes p ON f.name = p.name AND f.block = p.block
WHERE p.pass < p.full_passes OR (p.rest > 0 AND p.upto <= p.rest)
""",
    "op8_exact_topk": """
WITH parts AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
), whole AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))
), units AS (
  SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM parts JOIN whole USING (vec_id)
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM units q JOIN units c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5
""",
    "op10_line_dedup": """
WITH lined AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), windows AS (
  SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS w
  FROM lined, LATERAL (SELECT unnest(range(len(lines) - 2)) AS pos)
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS nth FROM windows
  ) WHERE nth > 1
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest(range(3)) AS k)
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM lined) l
  ANTI JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos
  GROUP BY l.doc_id
), gone AS (
  SELECT doc_id, CAST(count(*) AS INTEGER) AS n FROM covered GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN g.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text,
       CAST(len(d.lines) AS INTEGER) AS n_lines, coalesce(g.n, 0) AS n_removed
FROM lined d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN gone g ON d.doc_id = g.doc_id
""",
    "op11_decontamination": f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{ITEM_WORDS}') AS w FROM documents
), items AS (
  SELECT item_id, w, least({decontamination.WINDOW}, len(w)) AS size
  FROM (SELECT item_id, regexp_extract_all({LOWER}, '{ITEM_WORDS}') AS w FROM benchmark)
  WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS said
  FROM items, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
), places AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS said
  FROM words, (SELECT DISTINCT size FROM windows) s, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
), found AS (
  SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, said)
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM found, LATERAL (SELECT unnest(range(size)) AS k) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(n.n, 0) AS n_items,
       sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit h ON w.doc_id = h.doc_id LEFT JOIN named n ON w.doc_id = n.doc_id
""",
    "op13_conversation_repair": f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), hashed AS (  -- CRC-32, bit by bit
  SELECT *, xor(list_reduce(
    flatten(list_transform(range(1, length(name) + 1), lambda i: list_transform(range(8), lambda k: CAST((ascii(name[i]) >> CAST(k AS INTEGER)) & 1 AS BIGINT)))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS how
  FROM named
), spoilt AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, LATERAL (SELECT unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy)
  WHERE how <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM spoilt
), judged AS (
  SELECT conv_id, turn, role, text, i, role[1] AS initial, NOT regexp_matches(text, '{INK}') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         regexp_extract(text, '({INK})[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed
), faults AS (
  SELECT *, blank OR again AS goes, CAST(NOT blank AND NOT again AND cut AS BIGINT) AS truncated FROM judged
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         CAST(sum(CAST(blank AS BIGINT)) AS BIGINT) AS blank, CAST(sum(CAST(again AND NOT blank AS BIGINT)) AS BIGINT) AS duplicate,
         CAST(sum(truncated) AS BIGINT) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id
), steps(state, initial, then_) AS (
  VALUES ('empty', 's', 'system'), ('empty', 'u', 'user'), ('system', 'u', 'user'), ('full', 'u', 'user'), ('user', 'a', 'full')
), edits AS (  -- of one row
  SELECT state, 'K' AS letter, 0 AS cost, initial, then_ FROM steps
  UNION ALL SELECT state, 'R', 2, NULL, then_ FROM steps WHERE initial <> 's'
  UNION ALL SELECT DISTINCT state, 'D', 3, NULL, state FROM steps
), inserts AS (SELECT state, then_ FROM steps WHERE initial <> 's'
), moves AS (  -- of one row, after up to two new ones
  SELECT state, letter AS letters, cost, initial, then_, letter FROM edits
  UNION ALL SELECT i.state, 'I' || letter, cost + 2, initial, e.then_, letter FROM inserts i JOIN edits e ON i.then_ = e.state
  UNION ALL SELECT i.state, 'II' || letter, cost + 4, initial, e.then_, letter
  FROM inserts i JOIN inserts j ON i.then_ = j.state JOIN edits e ON j.then_ = e.state
), best(conv_id, i, state, least) AS (
  SELECT conv_id, n, state, {{'cost': CAST(cost AS BIGINT), 'letters': letters}} FROM counted,
    (VALUES ('empty', 0, ''), ('full', 0, ''), ('user', 2, 'I'), ('system', 4, 'II')) last(state, cost, letters)
  UNION ALL
  SELECT b.conv_id, b.i - 1, m.state,
         min({{'cost': CAST((b.least).cost + m.cost + CASE WHEN m.letter = 'D' THEN 0 ELSE f.truncated END AS BIGINT),
               'letters': m.letters || (b.least).letters}})
  FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i
       JOIN moves m ON m.then_ = b.state AND (m.initial IS NULL OR m.initial = f.initial) AND (m.letter = 'D' OR NOT f.goes)
  GROUP BY b.conv_id, b.i - 1, m.state
), chosen AS (
  SELECT conv_id, (least).cost AS cost, (least).letters AS audit FROM best WHERE i = 0 AND state = 'empty'
), written AS (
  SELECT conv_id, audit, letter, p, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER so_far AS i,
         sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER so_far AS place
  FROM (SELECT conv_id, audit, audit[p] AS letter, p FROM chosen, LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS p))
  WINDOW so_far AS (PARTITION BY conv_id ORDER BY p)
), kept AS (
  SELECT w.*, f.role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text,
         max(CASE WHEN place = 1 AND letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY w.conv_id) AS system
  FROM written w LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i WHERE letter <> 'D'
), told AS (
  SELECT conv_id, string_agg(
    CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY p) AS said
  FROM kept GROUP BY conv_id
)
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
       coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, coalesce(x.cost, 0) AS cost,
       coalesce(x.audit, '') AS audit, sha256(coalesce(t.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN chosen x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
""",
}
