"""The thin queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, collocations, common, decontaminate, manifest, packing, quality, reshard, simhash, token_files, toxicity,
               urls, warc)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_table(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return found.withColumn("fired_rules", F.array_join("fired_rules", ","))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_table(common.table(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination_table(common.table(spark, sf_dir, "documents"),
                                              common.table(spark, sf_dir, "benchmark"))
    return found.drop("items")


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: a page with less HTML than this puts its URL on the list
THIN_PAGE = 1500


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    listed = pages.where(F.length("html") < THIN_PAGE).select(urls.canonical(F.col("url")).alias("url"))
    return urls.filter_table(pages, listed, URL_RULES).drop("possible")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


def op4_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshard.shard_table(common.table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') "
                      "AS t(conv_id, turn, role, text)")
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.chat_table(turns, public_tokenizers.path("byte_bpe_50k.json")).drop("n_tokens", "loss_tokens")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_table(common.table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocation_table(common.table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_table(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_table(common.table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash": op3_simhash,
    "op4_reshard": op4_reshard,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_chat": op6_chat,
    "op7_decontaminate": op7_decontaminate,
    "op8_url_filter": op8_url_filter,
    "op9_token_files": op9_token_files,
    "op10_warc": op10_warc,
    "op11_collocations": op11_collocations,
    "op12_packing": op12_packing,
    "op13_manifest": op13_manifest,
}

_LOWER_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER_AZ.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP7 = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS t
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
gram AS (SELECT k, s, n, array_to_string(w[s:s + n - 1], ' ') AS t
         FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s
               FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT k, s, gram.n, item_id FROM gram JOIN win USING (n, t)),
pos AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM hit) GROUP BY k),
its AS (SELECT k, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
        FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN pos USING (k) LEFT JOIN its USING (k)
"""

_HOST = _LOWER_AZ.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1)")
_OP8 = f"""
WITH page AS (
  SELECT page_id, html, {_HOST} AS host, regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path,
         list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '://[^?#]*\\?([^#]*)', 1), '&'),
                               lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))) AS params FROM pages),
canon AS (
  SELECT *, CASE WHEN regexp_replace(host, '^(www|m)\\.', '') <> '' THEN
    regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/$', '') ||
    CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS key FROM page),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM canon),
listed AS (SELECT DISTINCT key AS k FROM canon WHERE length(html) < 1500 AND key IS NOT NULL)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block'
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN k IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       rule IS NULL AND k IS NOT NULL AS listed
FROM ruled LEFT JOIN listed ON key = k
"""

#: the cutoffs are written out, as the bound on false rejections is (2% over five rules, level 5%)
_OP2 = r"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM doc),
win AS (SELECT k, s, count(*) OVER (PARTITION BY k, g) AS n
        FROM (SELECT k, s, array_to_string(w[s:s + 2], ' ') AS g
              FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS s FROM split WHERE len(w) > 2))),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([s, s + 1, s + 2]) AS p FROM win WHERE n > 1) GROUP BY k),
sig AS (SELECT k, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
               CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
               CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_upper
        FROM split LEFT JOIN rep USING (k)),
rated AS (SELECT k, lang, 1 AS r, CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS v FROM sig
          UNION ALL SELECT k, lang, 2, CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END FROM sig
          UNION ALL SELECT k, lang, 3, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END FROM sig
          UNION ALL SELECT k, lang, 4, CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END FROM sig
          UNION ALL SELECT k, lang, 5, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END FROM sig),
cuts AS (SELECT r, rule, unnest(c)::DOUBLE AS cut, generate_subscripts(c, 1) AS i FROM (VALUES
           (1, 'symbols', [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03]),
           (2, 'repeats', [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05]),
           (3, 'copied_lines', [0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]),
           (4, 'capitals', [0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]),
           (5, 'long_words', [40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 10.0])) AS x(r, rule, c)),
lab AS (SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT rated.*, q = 1 AS good FROM rated JOIN doc USING (k) JOIN lab USING (doc_id)),
tally AS (SELECT held.lang, r, rule, i, cut, count(*) FILTER (good) AS n, count(*) FILTER (good AND v >= cut) AS d,
                 count(*) FILTER (NOT good AND v >= cut) AS b
          FROM held JOIN cuts USING (r) GROUP BY ALL),
tested AS (SELECT *, (SELECT 0.05 / (5 * count(DISTINCT coalesce('=' || lang, ''))) FROM held) AS level,
                  CASE WHEN n = 0 OR d >= n * 0.004 THEN 1 ELSE list_sum(list_transform(range(0, d + 1), lambda j:
                    exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.004) + (n - j) * ln(0.996)))) END AS tail
           FROM tally),
certified AS (SELECT *, bool_and(tail <= level) OVER (PARTITION BY lang, r ORDER BY i) AS ok, b - 10 * d AS gain FROM tested),
used AS (SELECT lang, r, rule, arg_max(cut, (gain, -i)) AS cut FROM certified WHERE ok AND gain > 0 GROUP BY lang, r, rule),
fired AS (SELECT k, string_agg(rule, ',' ORDER BY rated.r) AS rules
          FROM rated JOIN used ON rated.r = used.r AND rated.lang IS NOT DISTINCT FROM used.lang WHERE v >= cut GROUP BY k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND rules IS NULL AS kept,
       coalesce(rules, '') AS fired_rules
FROM sig LEFT JOIN fired USING (k)
"""

_ESCAPED = r"""regexp_replace({0}, '([<\[])(\\*(?:/?s>|/?(?:INST|OUT|SYS|ROLE)\]))', '\1\\\2', 'g')"""
_OP6 = rf"""
WITH said AS (SELECT conv_id, turn, role, text FROM conversations
              UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
turns AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS t FROM said),
sized AS (SELECT *, length({_ESCAPED.format('t')}) + CASE r WHEN 'user' THEN 15 WHEN 'assistant' THEN 13 WHEN 'system' THEN 13
            ELSE 16 + length({_ESCAPED.format("replace(replace(r, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")}) END AS chars
          FROM turns),
conv AS (SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
                string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS every,
                coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, text NULLS FIRST) FILTER (r = 'assistant'), '') AS loss
         FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(7 + chars AS BIGINT) AS formatted_chars
FROM conv
"""

#: base 32 by way of the digest's bits
_OP10 = """
WITH page AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
first AS (SELECT t, min(page_id) AS f, sha1(t) AS x FROM page GROUP BY t),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
           lpad(bin(strpos('0123456789abcdef', substr(x, i, 1)) - 1), 4, '0')), '') AS b FROM first),
named AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
              16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT)
              + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT) + CAST(substr(b, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest FROM bits)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN f IS NULL OR page_id IS NOT DISTINCT FROM f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f IS NULL OR page_id IS NOT DISTINCT FROM f THEN NULL ELSE f END AS refers_to
FROM page JOIN named USING (t)
"""

_OP11 = r"""
WITH piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p
               FROM (SELECT coalesce(lang, 'und') AS lang, {lower} AS t FROM documents)),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
freq AS (SELECT lang, phrase, k, count(*) AS f FROM (
           SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
           FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s
                 FROM (SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM words) WHERE len(w) >= k))
         GROUP BY lang, phrase, k HAVING count(*) >= 30),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM freq WHERE k >= 2),
cut AS (SELECT c.lang, c.phrase, c.k, c.f AS a, s, l.f AS l, r.f AS r,
               (2000000 * c.f::HUGEINT) // (l.f::HUGEINT + r.f::HUGEINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS s FROM cand) c
        JOIN freq l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:s], ' ')
        JOIN freq r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[s + 1:], ' ')),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, s) AS i FROM cut),
inner_part AS (SELECT lang, array_to_string(w[b:b + size - 1], ' ') AS phrase, max(f) AS longer
               FROM (SELECT *, unnest(range(1, k - size + 2)) AS b
                     FROM (SELECT *, unnest(range(2, k)) AS size FROM cand WHERE k > 2))
               GROUP BY ALL),
ranked AS (SELECT low.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
           FROM low LEFT JOIN inner_part USING (lang, phrase)
           WHERE i = 1 AND (longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""".replace("{lower}", _LOWER_AZ.format("coalesce(text, '')"))

#: ranks within a level say which nodes form a run; the last runs of a group fall away when one node is left
_OP13 = """
WITH RECURSIVE field AS (
  SELECT doc_id, lang, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
         coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i:
           ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)), lambda c, b:
             list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda x, _: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM documents),
told AS (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN {lower} ELSE text END AS now FROM field),
leaves AS (SELECT doc_id, lang, leaf, sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS changed,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM told),
node AS (
  SELECT 0 AS level, lang, r AS i, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT level + 1, lang, i // 8, sha256(string_agg(d, '' ORDER BY i)), (n + 7) // 8 FROM node WHERE n > 1
  GROUP BY level, lang, i // 8, n),
subroot AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, r AS i, subroot AS d, count(*) OVER () AS n FROM subroot
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, i // 8, n),
run AS (SELECT lang, level, i // 8 AS g, list(d ORDER BY i) AS ds FROM node WHERE n > 1 GROUP BY ALL),
top_run AS (SELECT level, i // 8 AS g, list(d ORDER BY i) AS ds FROM top WHERE n > 1 GROUP BY ALL),
lower_proof AS (
  SELECT l.lang, l.r, list(array_to_string(ds[:(l.r // (8 ** level)::BIGINT) % 8], '') ORDER BY level) AS before,
         list(array_to_string(ds[(l.r // (8 ** level)::BIGINT) % 8 + 2:], '') ORDER BY level) AS after
  FROM leaves l JOIN run ON run.lang IS NOT DISTINCT FROM l.lang AND g = l.r // (8 ** (level + 1))::BIGINT GROUP BY ALL),
upper_proof AS (
  SELECT s.r AS s, list(array_to_string(ds[:(s.r // (8 ** level)::BIGINT) % 8], '') ORDER BY level) AS before,
         list(array_to_string(ds[(s.r // (8 ** level)::BIGINT) % 8 + 2:], '') ORDER BY level) AS after
  FROM subroot s JOIN top_run ON g = s.r // (8 ** (level + 1))::BIGINT GROUP BY ALL),
proven AS (
  SELECT l.doc_id, l.leaf, l.changed, s.subroot, (SELECT d FROM top WHERE n = 1) AS root,
         coalesce(p.before, []) || coalesce(u.before, []) AS before, coalesce(p.after, []) || coalesce(u.after, []) AS after
  FROM leaves l JOIN subroot s ON s.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN lower_proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.r = l.r LEFT JOIN upper_proof u ON u.s = s.r),
folded AS (
  SELECT *, list_reduce(list_prepend(changed, list_transform(range(1, len(before) + 1), lambda i: CAST(i AS VARCHAR))),
                        lambda d, i: sha256(before[CAST(i AS INT)] || d || after[CAST(i AS INT)])) AS folded_root FROM proven)
SELECT doc_id, leaf, subroot, root, folded_root, folded_root = root AS verified,
       sha256(array_to_string(list_transform(range(1, len(before) + 1), lambda i: before[i] || after[i]), '')) AS proof_sha256
FROM folded
""".replace("{lower}", _LOWER_AZ.format("text"))

ORACLE_SQL: dict[str, str] = {"op2_quality_rules": _OP2, "op6_chat": _OP6, "op7_decontaminate": _OP7, "op8_url_filter": _OP8,
                              "op10_warc": _OP10, "op11_collocations": _OP11, "op13_manifest": _OP13}
