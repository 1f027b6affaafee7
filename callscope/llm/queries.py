"""The queries of this package and, where SQL can express them, the SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from callscope.llm import alignment, bpe, decontamination, exact_dedup, html_text, katz, near_dedup, quality, repetition, runs, substring_dedup, token_counts, token_files
from callscope.llm.vocabularies import vocabulary_file
from callscope.llm.work import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_words, expected_grade (0 toxic, 1 poor, 2 good), P(good), selected."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, quality.graded(_table(spark, sf_dir, "labels")))
    return quality.score(docs, model, selected=2, keep=["doc_id"])


@_query(
    "op2_substring_dedup",
    r"""
    WITH d AS (SELECT doc_id, string_split(trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS s
               FROM documents),
    words AS (SELECT doc_id, CASE WHEN s = [''] THEN [] ELSE s END AS w FROM d),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
                FROM words, unnest(range(1, greatest(len(w) - 11, 1))) t(i)),
    firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
    gone AS (SELECT DISTINCT doc_id, p FROM windows JOIN firsts USING (s), unnest(range(i, i + 13)) t(p) WHERE first < doc_id),
    by_doc AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
                       ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(ps, i)), ' ') END) AS kept_sha256
    FROM words LEFT JOIN by_doc USING (doc_id)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words removed as repeats, and the hash of what is kept."""
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


@_query("op3_katz_scores")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, known tokens, add-one base score and the model's log10 probability."""
    return katz.scored(_table(spark, sf_dir, "documents"))


@_query(
    "op4_decontamination",
    r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(trim(regexp_replace(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w
               FROM documents),
    words AS (SELECT doc_id, r, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM d),
    items AS (SELECT item_id, string_split(trim(regexp_replace(translate(text,
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w
              FROM benchmark WHERE text IS NOT NULL),
    windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
                FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) WHERE w <> ['']),
    sizes AS (SELECT DISTINCT n FROM windows),
    starts AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
               FROM words, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) t(i)),
    found AS (SELECT DISTINCT r, x.n, i, item_id FROM starts x JOIN windows y ON x.n = y.n AND x.s = y.s),
    hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) t(p) GROUP BY r),
    which AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN hit USING (r) LEFT JOIN which USING (r)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words in benchmark windows, and the items they are from."""
    return decontamination.contamination_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and hash of its token ids, and the hash of the text decoded from them."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


@_query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, tokens, and whether there are more tokens than 4096."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


@_query("op7_html_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: the main text and its length."""
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


@_query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, read back from the files: first place, number and checksum of its ids."""
    docs = _table(spark, sf_dir, "documents")
    files = token_files.write_token_files(docs, vocabulary_file("word_bpe_49k.json"), Scratch(spark, "token-files"))
    return token_files.read_digest(files)


@_query(
    "op9_near_dedup",
    r"""
    WITH RECURSIVE d AS (SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w
               FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
          FROM d, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE w <> ['']),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
    sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT x, b FROM reach JOIN sym ON a = y),
    least AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
    FROM documents LEFT JOIN n USING (doc_id) JOIN least ON x = doc_id
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its number of shingles and its component of near copies."""
    return near_dedup.near_components(_table(spark, sf_dir, "documents"))


@_query(
    "op10_exact_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the equal document that stays, the group's size, and the hash of the text."""
    return exact_dedup.dedup_groups(_table(spark, sf_dir, "documents"))


@_query(
    "op11_repetition_rules",
    r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
                      string_split(trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS s FROM documents),
    words AS (SELECT doc_id, r, t, CASE WHEN s = [''] THEN [] ELSE s END AS w FROM d),
    sizes AS (SELECT unnest([3, 8, 101]) AS k),
    windows AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
                FROM words, sizes, unnest(range(1, greatest(len(w) - k + 2, 1))) u(i)),
    often AS (SELECT r, k, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, k, s) > 1),
    marked AS (SELECT r, k, count(DISTINCT p) AS n FROM often, unnest(range(i, i + k)) u(p) GROUP BY r, k),
    by_doc AS (SELECT r, coalesce(max(n) FILTER (k = 3), 0) AS n3, coalesce(max(n) FILTER (k = 8), 0) AS n8,
                      count(*) FILTER (k = 101) > 0 AS too_long FROM marked GROUP BY r),
    lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM words),
    figures AS (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n3, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n8, 0) AS BIGINT) AS n_covered,
               coalesce(too_long, false) AS too_long
        FROM words JOIN lines USING (r) LEFT JOIN by_doc USING (r)),
    based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
    SELECT * EXCLUDE (too_long), NOT base_failed AND 100 * n_covered <= 30 * n_words AND NOT too_long AS kept FROM based
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: base figures, words in repeats of 8 words and more, and whether it is kept."""
    return repetition.repetition_rules(_table(spark, sf_dir, "documents")).drop("longest_repeat")


@_query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens of both vocabularies, their groups and links, and the links' counts in the corpus."""
    paths = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
    return alignment.align(_table(spark, sf_dir, "documents"), *paths)


@_query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, a tenth of them made periodic: its runs, the strongest one, and the text without them."""
    return runs.collapse_runs(runs.with_periodic_tails(_table(spark, sf_dir, "documents")))
