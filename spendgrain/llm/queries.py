"""The operators of this subpackage over their whole tables, and SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrain.llm import brown, chat, collocations, decontaminate, language, mixing, order_minhash, passages, quality, secret_scan, spans, url_filter, variants
from spendgrain.sources.testdata import table

#: Names of hosts that the URL list is made of. Fixed values.
LISTED_HOSTS = r"(^|\.)(casino-win|spam-farm|cheap-pills|free-bets|ads-track|adult-x)\.example\."
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The tables hold no URL list, so it is made of the canonical URLs of pages on LISTED_HOSTS."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    on_list = pages.where(url_filter.host(F.col("url")).rlike(LISTED_HOSTS))
    listed = on_list.select(url_filter.canonical_url(F.col("url")).alias("canonical"))
    return url_filter.filter_urls(pages, listed, RULES)


def labelled_findings(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The tables hold no reviewed findings, so those of the documents in `labels` are labelled by
    format. Labels share their ids with the documents; repeated ones count once. Findings meet the labels,
    not texts; a semi join would be moved below the search and shuffle whole texts."""
    found = secret_scan.label_by_format(secret_scan.with_features(secret_scan.candidates(documents)))
    return found.select("doc_id", *secret_scan.FEATURES, "label").join(labels.select("doc_id").distinct(), "doc_id")


def op2_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "source")
    return secret_scan.scan(documents, labelled_findings(documents, table(spark, sf, "labels")))


def op3_span_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return spans.dedup_spans(table(spark, sf, "documents"))


def op4_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    return chat.format_chats(table(spark, sf, "conversations"))


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.find(documents, table(spark, sf, "benchmark")).drop("text")


def op6_mix(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "source")
    taken = (F.size("shards") * F.col("size")).cast("long").alias("taken")
    return mixing.mix(documents).select("doc_id", "size", "source_size", "target", taken, "shards")


def op7_brown_lm(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose id has a checksum of 2 modulo 7 are held out; all others train."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    model, counts = brown.learn(documents.where(~held_out))
    return brown.score(documents, model, counts).withColumn("held_out", held_out)


def op8_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf, "documents"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents")).drop("lang", "source")


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose id has a checksum of 2 modulo 4 are held out; all others train."""
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.learn(documents.where(~held_out))
    found = language.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.mine(table(spark, sf, "documents").select("lang", "text"))


def op12_variants(spark: SparkSession, sf: str) -> DataFrame:
    """One in 97 words of a document loses a code point, so that there are misspellings of known origin."""
    counts = variants.word_counts(table(spark, sf, "documents").select("doc_id", "text"), slips=97)
    return variants.group_variants(counts)


def op13_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of documents whose id has a checksum of 0 modulo 5 are held out."""
    documents, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = passages.learn(documents, labels.where(~held_out))
    found = passages.score(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_url_filter,
        op2_secret_scan,
        op3_span_dedup,
        op4_chat_format,
        op5_decontaminate,
        op6_mix,
        op7_brown_lm,
        op8_order_minhash,
        op9_quality,
        op10_language,
        op11_collocations,
        op12_variants,
        op13_passages,
    )
}

_URL = r"""
WITH parts AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))) AS params
  FROM pages),
urls AS (
  SELECT page_id, host, path, CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, ':(80|443)?$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
  FROM parts),
listed AS (
  SELECT DISTINCT canonical FROM urls
  WHERE regexp_matches(host, '(^|\.)(casino-win|spam-farm|cheap-pills|free-bets|ads-track|adult-x)\.example\.')),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM urls)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  r.canonical, l.canonical IS NOT NULL AS listed
FROM ruled r LEFT JOIN listed l ON r.canonical = l.canonical
"""

_CHAT = r"""
WITH whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id),
reps AS (SELECT min(conv_id) AS conv_id, turns, count(*) AS n_equal FROM whole GROUP BY turns),
proper AS (
  SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM reps))
SELECT conv_id, CAST(len(turns) AS INTEGER) AS n_turns, n_equal,
  array_to_string(list_transform(turns, lambda t: '<|im_start|>' || regexp_replace(coalesce(t.role, 'unknown'), '<\|im_(start|end)\|>', '', 'g')
    || chr(10) || regexp_replace(coalesce(t.text, ''), '<\|im_(start|end)\|>', '', 'g') || '<|im_end|>' || chr(10)), '') AS text
FROM reps r WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.turns = r.turns)
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
sized AS (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS size FROM words),
starts AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized WHERE len(w) >= size),
counts AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM starts GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, 1000 * c.a * t.n // (x.f * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scored),
longer AS (SELECT lang, f, size, string_split(phrase, ' ') AS w FROM counts WHERE size > 2),
inside AS (SELECT lang, f, w, size, unnest(range(2, size)) AS short FROM longer),
parts AS (SELECT lang, f, w, short, unnest(range(1, size - short + 2)) AS i FROM inside),
covering AS (SELECT lang, array_to_string(w[i:i + short - 1], ' ') AS phrase, max(f) AS f FROM parts GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN covering c ON c.lang = b.lang AND c.phrase = b.phrase
  WHERE pick = 1 AND (c.f IS NULL OR 100 * c.f < 100 * a))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

LLM_ORACLE: dict[str, str] = {"op11_collocations": _PHRASES, "op1_url_filter": _URL, "op4_chat_format": _CHAT}
