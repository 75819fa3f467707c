"""Thin queries over the given tables, one per operator, and their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.llm import bpe_tree, chat_format, hard_negatives, html_wrapper, kmeans_tree, license_scan, line_dedup, ngram_join, ngram_quality, suffix_dedup, temperature_mix, toxicity, vector_codes
from codesieve.llm.common import table


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("runs").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return ngram_quality.judged_table(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "surprise")


def op1_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.jaccard_classes(docs, k=4, percent=85)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def tokenizer_path() -> str:
    """The public byte-level vocabulary that is installed on every machine; the operator takes any path."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe_tree.encode(docs, path, decoded=True).drop("text")
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every taken copy of every document, at most two epochs a source more than the largest source."""
    order, _ = temperature_mix.mix(table(spark, sf_dir, "documents"))
    return order.select("doc_id", "source", "n_tokens", "epoch", "ahead")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(*chat_format.format_chats(rows))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_error(codes)
    digest = F.lit(vector_codes.books_digest(books))
    return rows.select("vec_id", vector_codes.hex_codes().alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_wrapper": op1_html_wrapper,
    "op2_ngram_join": op2_ngram_join,
    "op3_nearest": op3_nearest,
    "op4_bpe": op4_bpe,
    "op5_license_scan": op5_license_scan,
    "op6_temperature_mix": op6_temperature_mix,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_chat_format": op12_chat_format,
    "op13_vector_codes": op13_vector_codes,
}

LINES_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT doc_id, line, pos, coalesce(first_doc < doc_id, false) AS gone FROM keyed LEFT JOIN firsts USING (key)
)
"""



def license_sql() -> str:
    """Every block against every template, without filters."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = "regexp_extract_all(translate(coalesce({0}, ''), '%s', '%s'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')" % (upper, lower)
    places = " || ".join(
        f"[x FOR x IN range(len(words)) IF {' AND '.join(f'words[x + {k + 1}] = {chr(39)}{w}{chr(39)}' for k, w in enumerate(phrase.split(' ')))}]"
        for phrase in license_scan.PHRASES
    )
    base = " || ".join(
        f"CASE WHEN len([x FOR x IN range(len(words)) IF {' AND '.join(f'words[x + {k + 1}] = {chr(39)}{w}{chr(39)}' for k, w in enumerate(phrase.split(' ')))}]) > 0 THEN ['{label}'] ELSE [] END"
        for phrase, label in license_scan.PHRASES.items()
    )
    rows = ", ".join(f"('{label}', {license_scan.word_count(text)}, {license_scan.template_words(text)})" for label, text in license_scan.TEMPLATES)
    return f"""
WITH docs AS (SELECT doc_id, text, {words.format("text")} AS words FROM documents),
based AS (SELECT doc_id, len(words) AS n_words, {places} AS places, {base} AS base FROM docs),
templates(label, n, tokens) AS (VALUES {rows}),
blocks AS (
  SELECT doc_id, label, tokens, list_slice(words, s + 1, s + 2 * n) AS block
  FROM (SELECT doc_id, words, label, n, tokens, unnest(range(0, len(words), n)) AS s FROM docs, templates)
),
hits AS (SELECT doc_id, label, len(list_intersect(block, tokens)) / len(tokens) AS part
         FROM blocks WHERE len(list_intersect(block, tokens)) >= ceil({license_scan.THRESHOLD} * len(tokens) - 1e-9)),
best AS (SELECT doc_id, list(DISTINCT label) AS more, max(part) AS part FROM hits GROUP BY doc_id)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(part, 0.0) END AS score
FROM based LEFT JOIN best USING (doc_id)
"""


MIX_SQL = f"""
WITH RECURSIVE toks AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents
), totals AS (
  SELECT source, sum(n_tokens)::BIGINT AS total, count(*) AS n_docs FROM toks GROUP BY source
), every AS (SELECT sum(total)::DOUBLE AS t FROM totals
), shares AS (SELECT list(total / t) AS ps FROM totals, every WHERE total > 0
), steps(n, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT n + 1, CASE WHEN flat THEN middle ELSE low END, CASE WHEN flat THEN high ELSE middle END
  FROM (SELECT n, low, high, (low + high) / 2 AS middle,
               list_max([pow(p, (low + high) / 2) / p FOR p IN ps]) / list_min([pow(p, (low + high) / 2) / p FOR p IN ps])
                 > {temperature_mix.MAX_REPEATS} AS flat
        FROM steps, shares WHERE n < {temperature_mix.STEPS})
), fitted AS (
  SELECT CASE WHEN list_max([1 / p FOR p IN ps]) / list_min([1 / p FOR p IN ps]) > {temperature_mix.MAX_REPEATS}
              THEN high ELSE 0.0 END AS a, ps FROM steps, shares WHERE n = {temperature_mix.STEPS}
), plan AS (
  SELECT source, total, n_docs,
         CASE WHEN total > 0 THEN round(pow(total / t, a) * list_max([pow(p, 1 - a) FOR p IN ps]) * t)::BIGINT ELSE 0 END AS budget
  FROM totals, every, fitted
), copies AS (
  SELECT doc_id, toks.source, n_tokens, total, n_docs, budget,
         unnest(range(greatest(CASE WHEN total > 0 THEN ceil(budget / total) ELSE 1 END, 1)::INT)) AS epoch
  FROM toks JOIN plan ON toks.source IS NOT DISTINCT FROM plan.source
), keyed AS (
  SELECT *, md5('{temperature_mix.SEED}:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS key FROM copies
), blocked AS (
  SELECT *, floor(('0x' || substr(key, 1, 8))::BIGINT * greatest(ceil(n_docs / {temperature_mix.BLOCK_ROWS}), 1) / 4294967296.0)::BIGINT AS block FROM keyed
), placed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY block, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM blocked
)
SELECT doc_id, source, n_tokens, epoch::INT AS epoch, ahead FROM placed
WHERE CASE WHEN total > 0 THEN ahead < budget - epoch * total OR budget - epoch * total >= total ELSE true END
"""

NUMBERS_SQL = """
numbers AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
"""

NEGATIVES_SQL = f"""
WITH {NUMBERS_SQL}, rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM numbers WHERE label IS NOT NULL
), pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {hard_negatives.POSITIVES}
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND {hard_negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= {hard_negatives.NEGATIVES}
"""


CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '{CONTROL_TEXT}'
), turns AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS joins, row_number() OVER w AS pos,
         length(replace(replace(text, chr(92), chr(92) || 'b'), '<|', '<' || chr(92) || 'p')) AS n_text,
         length(replace(replace(replace(role, chr(92), chr(92) || 'b'), '<|', '<' || chr(92) || 'p'), chr(10), chr(92) || 'n')) AS n_role
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS said,
         coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '') AS lost,
         sum(n_text + CASE WHEN joins THEN {len(chat_format.NEXT)} ELSE n_role + {len(chat_format.START) + 1 + len(chat_format.END)} END)::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(lost) AS loss_chars, sha256(lost) AS loss_sha256, formatted_chars FROM said
"""


def codes_sql() -> str:
    """Every part against every entry, round by round."""
    entries, parts = vector_codes.ENTRIES, vector_codes.PARTS
    steps = [
        f"""
parts AS (
  SELECT n.vec_id, p.pos, list_slice(v, p.pos * (len(v) // {parts}) + 1, (p.pos + 1) * (len(v) // {parts})) AS part
  FROM numbers n, (SELECT unnest(range({parts})) AS pos) p
), starts AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM numbers QUALIFY entry < {entries}
), books0 AS (SELECT pos, entry, part AS book FROM parts JOIN starts USING (vec_id))"""
    ]
    for i in range(vector_codes.ROUNDS + 1):
        steps.append(f"""near{i} AS (
  SELECT vec_id, pos, part, list_min(list((d, entry)))[1]::BIGINT AS error, list_min(list((d, entry)))[2] AS entry
  FROM (SELECT vec_id, pos, part, entry, list_sum(list_transform(list_zip(part, book), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts JOIN books{i} USING (pos)) GROUP BY vec_id, pos, part
)""")
        if i < vector_codes.ROUNDS:
            steps.append(f"""means{i} AS (
  SELECT pos, entry, list(mean ORDER BY slot) AS mean FROM (
    SELECT pos, entry, slot, floor(sum(part[slot])::DOUBLE / count(*))::BIGINT AS mean
    FROM near{i}, (SELECT unnest(range(1, 1 + (SELECT max(len(part)) FROM parts))) AS slot) GROUP BY pos, entry, slot) GROUP BY pos, entry
), books{i + 1} AS (SELECT pos, entry, coalesce(mean, book) AS book FROM books{i} LEFT JOIN means{i} USING (pos, entry))""")
    last = vector_codes.ROUNDS
    return f"""
WITH {NUMBERS_SQL}, {", ".join(steps)},
digest AS (SELECT sha256(string_agg(array_to_string(book, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM books{last}),
coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY pos) AS code, sum(error)::BIGINT AS error FROM near{last} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN numbers USING (vec_id), digest
"""


ORACLES: dict[str, str] = {
    "op11_hard_negatives": NEGATIVES_SQL,
    "op12_chat_format": CHAT_SQL,
    "op13_vector_codes": codes_sql(),
    "op5_license_scan": license_sql(),
    "op6_temperature_mix": MIX_SQL,
    "op9_line_dedup": LINES_SQL
    + """
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
