"""Queries over the given tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, cotrain, fingerprints, line_dedup, packing, pii, quality_rules, ranked_search, secrets, simhash, substring_dedup, suffix_dedup, whitening

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_WORD = r"'[^\x20\x09-\x0D]+'"

#: Every window of 35 words with its text; a word is removed when one that covers it occurs twice.
OP2_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
  spot AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
  win AS (SELECT r, i, md5(array_to_string(d.w[i:i + 34], ' ')) AS h FROM spot JOIN d USING (r)),
  again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
  gone AS (SELECT DISTINCT r, i + k AS i FROM win SEMI JOIN again USING (h), range(0, 35) AS t(k)),
  word AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
  kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

#: Measures by lists and windows of three words, then the thresholds of both rule tables.
OP7_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
  p AS (SELECT *, regexp_extract_all(t, {_WORD}) AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_WORD})) AS l FROM d),
  spot AS (SELECT r, unnest(range(1, len(w) - 1)) AS i FROM p WHERE len(w) >= 3),
  win AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(p.w[i:i + 2], ' ')) AS n FROM spot JOIN p USING (r)),
  rep AS (SELECT r, count(DISTINCT i + k) AS n FROM win, range(0, 3) AS t(k) WHERE n > 1 GROUP BY r),
  m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    len(l) AS n_lines, len(list_filter(w, lambda x: ends_with(x, '!!'))) AS n_shout,
    len(list_filter(w, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', '')) IN ({_STOP}))) AS n_stop,
    len(list_filter(l, lambda x: regexp_matches(x, '^[ 	-
]*[-*•‣▪●]'))) AS n_bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ 	-
]*$'))) AS n_ellipses
    FROM p LEFT JOIN rep USING (r)),
  b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND word_chars BETWEEN 1.5 * n_words AND 20 * n_words AND n_symbols <= 0.3 * n_words
    AND n_shout <= 0.5 * n_words AND n_stop >= 0.01 * n_words AND n_dup_lines <= 0.5 * n_lines
    AND n_bullets <= 0.9 * n_lines AND n_ellipses <= 0.5 * n_lines AS kept FROM b"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Lines by number, and the keys that ten documents have.
OP11_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
  line AS (SELECT r, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS x FROM d),
  keyed AS (SELECT *, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_UPPER.lower()}') AS k FROM line),
  often AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
  kept AS (SELECT r, count(*) AS n, string_agg(x, chr(10) ORDER BY i) AS t FROM keyed ANTI JOIN often USING (k) GROUP BY r)
  SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_dropped,
    sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


def _terms(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), {_TERM})"


#: Every document is scored for every item that shares a term with it.
OP13_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text")} AS t FROM documents),
  q AS (SELECT DISTINCT item_id, unnest({_terms("text")}) AS term FROM benchmark),
  s AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
  word AS (SELECT r, unnest(t) AS term FROM d),
  tf AS (SELECT r, term, count(*) AS tf FROM word SEMI JOIN q USING (term) GROUP BY r, term),
  weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
  part AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(t) * n_docs) // n_terms))) AS x
    FROM tf JOIN weight USING (term) JOIN d USING (r), s),
  total AS (SELECT item_id, r, doc_id, CAST(sum(x) AS BIGINT) AS score FROM q JOIN part USING (term) GROUP BY item_id, r, doc_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k FROM total WHERE score > 0)
  SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM ranked WHERE k <= 50"""


@query("op1_cost_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 4,096 ids; each document is closed by id 2."""
    return packing.pack(documents(spark, sf_dir), packing.Packing(public_tokenizers.path("word_bpe_49k.json")), with_ids=False)


@query("op3_secret_scans")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


@query("op4_information_sanitisation")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir)).drop("found")


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, two differing bits."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, limit=2)


@query("op6_bpe_chunk_reuse")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coded(documents(spark, sf_dir), bpe.Coding(public_tokenizers.path("word_bpe_49k.json"))).drop("ids", "decoded")


@query("op7_quality_rules", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_substring_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 35 words."""
    return substring_dedup.without_repeats(documents(spark, sf_dir), length=35).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes."""
    return suffix_dedup.without_repeats(documents(spark, sf_dir), length=100).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op10_document_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.versions(documents(spark, sf_dir))


@query("op9_cotrained_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op11_line_dedup", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that ten documents have."""
    return line_dedup.without_common_lines(documents(spark, sf_dir), documents=10, least=1).drop("kept")


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight greatest components of whole-number embeddings."""
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_ranked_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty documents an item."""
    return ranked_search.best_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
