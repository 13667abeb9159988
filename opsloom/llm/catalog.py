"""The registered queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.llm import collocations, decontaminate, fingerprints, html, language, licenses, near_dedup, periodic_runs, pieces, quality, suffix_dedup, token_counts, toxicity
from opsloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> bytes:
    """A public vocabulary file, read on the driver and sent to the executors from there."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.held_out("doc_id", 3, 1)
    labels = table(spark, sf_dir, "labels").where(~out)
    model = quality.fit_quality(documents, labels)
    scored = quality.score_quality(documents.withColumn("held_out", out), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contaminated(documents, table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return marked.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = quality.held_out("doc_id", 4, 2)
    model = language.fit_languages(documents.where(~out))
    texts = documents.select("doc_id", "text", out.alias("held_out"))
    return language.predict_language(texts, model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's ids and of the text decoded from them again."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_file("piece_bpe_32k.model")
    decoded = pieces.decode_pieces(pieces.encode_texts(documents, model), model)
    return decoded.select(
        "doc_id",
        "n_pieces",
        F.sha2("pieces", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    definition = tokenizer_file("byte_bpe_50k.json").decode()
    counted = token_counts.count_tokens(documents, definition)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = licenses.scan_licenses(documents)
    return scanned.select("doc_id", "n_licenses", F.array_join("licenses", ",").alias("licenses"))


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = suffix_dedup.remove_repeats(documents)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.held_out("doc_id", 5, 0)
    model = toxicity.fit_toxicity(documents, table(spark, sf_dir, "labels").where(~out))
    scored = toxicity.score_toxicity(documents.withColumn("held_out", out), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_periodic_tails(documents)))


ORACLES["op2_decontamination"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM texts, sizes WHERE len(ws) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, ws[i:i + k - 1] AS p
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)),
counts AS (SELECT lang, k, p, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
held AS (
  SELECT DISTINCT c.lang, c.k, c.p FROM counts c JOIN (
    SELECT lang, k - 1 AS k, p[1:k - 1] AS p, a FROM counts UNION ALL SELECT lang, k - 1, p[2:k], a FROM counts) w
  ON c.lang = w.lang AND c.k = w.k AND c.p = w.p AND w.a >= c.a),
cuts AS (
  SELECT c.lang, c.p, c.a, x.a AS l, y.a AS r, n, j,
         (1000::HUGEINT * c.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
  FROM (SELECT lang, k, p, a, unnest(range(1, k)) AS j FROM counts WHERE k > 1) c
  JOIN counts x ON x.lang = c.lang AND x.k = c.j AND x.p = c.p[1:c.j]
  JOIN counts y ON y.lang = c.lang AND y.k = c.k - c.j AND y.p = c.p[c.j + 1:c.k]
  JOIN totals t ON t.lang = c.lang
  ANTI JOIN held h ON h.lang = c.lang AND h.k = c.k AND h.p = c.p),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, p, a, l, r, n, score FROM best)
SELECT lang, rank, array_to_string(p, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


def _license_sql() -> str:
    quoted = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in licenses.TEMPLATES.items())
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH templates(name, text) AS (VALUES {quoted}),
known AS (
  SELECT DISTINCT name, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT name, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM (SELECT name, {words} AS ws FROM templates))),
found AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM (SELECT doc_id, {words} AS ws FROM documents))),
held AS (SELECT doc_id, name, count(*) AS n FROM found JOIN known USING (shingle) GROUP BY ALL),
sizes AS (SELECT name, count(*) AS size FROM known GROUP BY name),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS listed
  FROM held JOIN sizes USING (name) WHERE n >= 0.75 * size GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(listed, '') AS licenses
FROM documents LEFT JOIN named USING (doc_id)
"""


ORACLES["op8_licenses"] = _license_sql()
