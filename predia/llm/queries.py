"""The registered queries of the operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predia.llm import (chat_format, exact_dedup, html_extraction, jaccard_join, kneser_ney, license_scan,
                        merkle_manifest, packing, quality_rules, sentencepiece_fst, spelling_variants,
                        token_counts, toxicity)
from predia.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).drop("blocks")


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"

CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g'))
    + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'),
        '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g'))
    + length('<|im_start|>') + length('<|im_end|>') + 2 AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(role, ' ' ORDER BY turn, role, text), '(system )?user assistant( user assistant)*') AS valid
FROM sized GROUP BY conv_id
"""


@query("op4_chat_format", CHAT_SQL)
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat_format.digests(chat_format.segments(turns.unionByName(control)))


@query("op5_kneser_ney")
def op5_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.quality_classifier(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.length_table(table(spark, folder, "documents"))


QUALITY_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
worded AS (
  SELECT doc_id, stratum, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
lined AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
places AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM worded WHERE len(w) >= 3),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
                         FROM places) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM repeated, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
m AS (
  SELECT doc_id, stratum, t, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals,
    length(t) - length(translate(t, '!', '')) AS n_exclamations
  FROM worded LEFT JOIN covered USING (doc_id) LEFT JOIN lined USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [
    {'rule': 'symbols', 'value': 100 * (1000 * n_symbols // greatest(word_chars, 1)) // 100},
    {'rule': 'repeated_words', 'value': 100 * (1000 * n_repeat_words // greatest(n_words, 1)) // 400},
    {'rule': 'repeated_lines', 'value': 100 * (1000 * n_dup_lines // greatest(n_lines, 1)) // 500},
    {'rule': 'capitals', 'value': 100 * (1000 * n_capitals // greatest(word_chars, 1)) // 300},
    {'rule': 'exclamations', 'value': 100 * (1000 * n_exclamations // greatest(word_chars, 1)) // 50}] AS rules FROM m),
trials AS (
  SELECT stratum, quality, md5(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS same,
    max(list_max(list_transform(rules, lambda r: r.value))) AS severity
  FROM judged JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE quality IN (0, 1)) USING (doc_id)
  WHERE NOT base_failed GROUP BY ALL),
tested AS (
  SELECT stratum, severity, sum(quality) AS good, sum(1 - quality) AS bad FROM trials GROUP BY ALL),
size AS (
  SELECT stratum, n, floor(least(exp(ln(0.05) - n * ln(1 - 0.02)), pow(2, 40))) AS could
  FROM (SELECT stratum, sum(good) AS n FROM tested GROUP BY ALL)),
level AS (
  SELECT 0.05 / (SELECT min(k) FROM (SELECT unnest(range(1, (SELECT count(*) + 2 FROM size))) AS k)
                 WHERE (SELECT count(*) FROM size WHERE could >= k) <= k) AS level),
terms AS (
  SELECT stratum, n, unnest(range(0, floor(n * 0.02)::BIGINT + 1)) AS k FROM size),
cdf AS (
  SELECT stratum, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.02) + (n - k) * ln(1 - 0.02)))
    OVER (PARTITION BY stratum ORDER BY k) AS p FROM terms),
allowed AS (SELECT stratum, max(k) AS most FROM cdf, level WHERE p <= level GROUP BY ALL),
reached AS (
  SELECT stratum, severity, bad, sum(good) OVER (PARTITION BY stratum ORDER BY severity DESC) AS rejected_good
  FROM tested),
cutoff AS (
  SELECT stratum, min(severity) - 1 AS cutoff FROM reached JOIN allowed USING (stratum)
  WHERE rejected_good <= most AND bad > 0 GROUP BY ALL),
rejected AS (
  SELECT doc_id, string_agg(r.rule, ',' ORDER BY r.rule) AS rejected_by
  FROM (SELECT doc_id, stratum, unnest(rules) AS r FROM judged) AS j
  JOIN cutoff ON cutoff.stratum = j.stratum AND j.r.value > cutoff.cutoff GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rejected_by IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by
FROM judged LEFT JOIN rejected USING (doc_id)
"""


@query("op7_quality_rules", QUALITY_SQL)
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_fst.encode_decode(table(spark, folder, "documents"))


@query("op9_packing")
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


DEDUP_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER best = 1 AS kept, text_sha256
FROM texts WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
"""


@query("op10_exact_dedup", DEDUP_SQL)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


# The checksum byte by byte: a byte is taken in, then eight times -1 shifts one bit out.
SPELLING_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
checked AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
      range(0, strlen(named)), lambda i: [16 * (strpos('0123456789ABCDEF', named_hex[2 * i + 1]) - 1)
        + strpos('0123456789ABCDEF', named_hex[2 * i + 2]) - 1, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS h
  FROM (SELECT *, hex(encode(named)) AS named_hex FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run AS named FROM runs))),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2)
      ELSE run END AS word FROM checked)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT word, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM shorter AS a JOIN shorter AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT shorter.word, words.word FROM shorter JOIN words ON rest = words.word
  UNION SELECT words.word, shorter.word FROM shorter JOIN words ON rest = words.word),
best AS (
  SELECT near.word, count(*) AS n_near, first(words.word ORDER BY n DESC, words.word) AS best, max(n) AS best_n
  FROM near JOIN words ON words.word = other GROUP BY near.word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
    CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM words LEFT JOIN best USING (word)),
ends AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT ends.word, formed.form, steps + 1 FROM ends JOIN formed ON formed.word = root
  WHERE formed.form IS NOT NULL),
last AS (SELECT word, arg_max(root, steps) AS root FROM ends GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN last USING (word)
"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants(table(spark, folder, "documents"))


def value_of(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}) || ':' || {column} END"


def leaf_of(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(value_of(v) for v in values)})"


MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS r, doc_id, source, {leaf_of("text")} AS leaf,
    {leaf_of("replace(text, chr(10), '')")} AS without_lines,
    list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) & 1 = 1
      AS tampered FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
below AS (
  SELECT source, 0 AS height, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
  UNION ALL SELECT source, height + 1, list_transform(range(0, (len(nodes) + 2) // 3),
    lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM below WHERE len(nodes) > 1),
subroots AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM below WHERE len(nodes) = 1),
over_all AS (
  SELECT 0 AS height, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL SELECT height + 1, list_transform(range(0, (len(nodes) + 2) // 3),
    lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM over_all WHERE len(nodes) > 1),
spots AS (
  SELECT r, height, nodes, CAST(floor(place / pow(3, height)) AS BIGINT) AS p
  FROM placed JOIN below ON placed.source IS NOT DISTINCT FROM below.source WHERE len(nodes) > 1
  UNION ALL SELECT r, 100 + height, nodes, CAST(floor(subroots.place / pow(3, height)) AS BIGINT)
  FROM placed JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source, over_all WHERE len(nodes) > 1),
steps AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY height) AS step,
    array_to_string(nodes[p // 3 * 3 + 1:p], '') AS before, array_to_string(nodes[p + 2:p // 3 * 3 + 3], '') AS after
  FROM spots),
folds AS (
  SELECT r, 0 AS step, CASE WHEN tampered THEN without_lines ELSE leaf END AS digest FROM placed
  UNION ALL SELECT folds.r, steps.step, sha256(before || digest || after)
  FROM folds JOIN steps ON folds.r = steps.r AND steps.step = folds.step + 1),
proofs AS (
  SELECT r, max(step) AS steps, string_agg(before || after, '' ORDER BY step) AS siblings FROM steps GROUP BY r),
found AS (
  SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM over_all WHERE len(nodes) = 1) AS root,
    sha256(coalesce(siblings, '')) AS proof_sha256, digest AS folded_root
  FROM placed JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source LEFT JOIN proofs USING (r)
  JOIN folds ON folds.r = placed.r AND folds.step = coalesce(steps, 0))
SELECT *, folded_root = root AS verified FROM found
"""


@query("op12_merkle_manifest", MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.digests(merkle_manifest.manifest(table(spark, folder, "documents")))


@query("op13_html_extraction")
def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract(table(spark, folder, "pages"))
