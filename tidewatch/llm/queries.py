"""The registered queries of this subpackage: thin calls of its operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id: str, folds: int) -> Column:
    """The part of the data that a document is in; rows without an id are in none."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % folds


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.language_id import identify

    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    found = identify(table(spark, folder, "documents"), fold("doc_id", 5) != 0)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.masked_lm import learn_words, score_words

    docs = table(spark, folder, "documents")
    return score_words(docs, learn_words(docs))


@query
def op3_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.quality_outliers import judge

    judged = judge(table(spark, folder, "documents"), keep=["doc_id"])
    return judged.select(
        "doc.doc_id",
        *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed",
        "kept",
        "distance",
    )


@query
def op4_token_attribution(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tidewatch.llm.token_attribution import attribute, passages

    docs, ranks = table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return attribute(docs, ranks, public_tokenizers.PATTERN, passages(docs["text"], 1000))


@query
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.jaccard_join import link

    return link(table(spark, folder, "documents"))


ORACLES["op5_jaccard_join"] = r"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS shingle FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reached.doc_id, links.y FROM reached JOIN links ON links.x = reached.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


@query
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.quality_classifier import classify

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return classify(docs, labels, fold("doc_id", 4) != 2).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.token_files import tokenize

    return tokenize(table(spark, folder, "documents"), word_tokenizer())


@query
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.html_extraction import extract, learn

    pages = table(spark, folder, "pages")
    return extract(pages, learn(pages))


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.decontamination import leaks

    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.entropy_mix import mix

    mixed = mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query
def op13_bpe_stream(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.bpe_stream import round_trips

    return round_trips(table(spark, folder, "documents"), word_tokenizer())


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.periodic_runs import run_digests

    return run_digests(table(spark, folder, "documents"))


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    from tidewatch.llm.collocations import collocations

    return collocations(table(spark, folder, "documents"))


ORACLES["op11_collocations"] = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), phrases AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, range(1, 6) AS sizes(k) WHERE len(w) >= k
), counted AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY 1, 2, 3
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY 1
), frequent AS (SELECT * FROM counted WHERE f >= 100
), cuts AS (
  SELECT lang, k, phrase, f AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS x,
    array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') AS y
  FROM frequent, range(1, 5) AS places(j) WHERE j < k
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, p.f AS l, q.f AS r, n, ((1000::HUGEINT * c.a * n) // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM cuts c JOIN counted p ON p.lang = c.lang AND p.phrase = c.x JOIN counted q ON q.lang = c.lang AND q.phrase = c.y
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM frequent s JOIN frequent g ON g.lang = s.lang AND g.k > s.k AND g.f >= s.f
    AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ') WHERE s.k >= 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN inside USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""
