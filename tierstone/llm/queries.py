"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm import (
    alignment,
    decontaminate,
    fill_middle,
    html_text,
    line_dedup,
    neighbours,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    substrings,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    marked = decontaminate.mark_contaminated(docs.select("doc_id", "text"), benchmark)
    items = F.col("leak.items")
    return marked.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        "rating.expected_grade",
        F.col("rating.tails")[0].alias("p_not_toxic"),
        F.col("rating.tails")[1].alias("p_good"),
        "rating.accepted",
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.responses(table(spark, sf_dir, "pages"))
    return warc.derive(records).select(
        "page_id", "type", "record_id", "refers_to", "target_uri", "content_length",
        "block_digest", "source_payload_digest", F.sha2("record", 256).alias("record_sha256"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256")
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("base")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", kept)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(embeddings, lambda vec_id: vec_id % neighbours.QUERY_EVERY == 0)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths).drop("groups")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_middle.restored(F.col("fim.output"), F.col("fim.form"))
    return cut.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def queries():
    return {
        "op1_decontamination": op1_decontamination,
        "op2_quality": op2_quality,
        "op3_warc": op3_warc,
        "op4_line_dedup": op4_line_dedup,
        "op5_pii": op5_pii,
        "op6_html": op6_html,
        "op7_packing": op7_packing,
        "op8_simhash": op8_simhash,
        "op9_substrings": op9_substrings,
        "op10_neighbours": op10_neighbours,
        "op11_alignment": op11_alignment,
        "op12_secrets": op12_secrets,
        "op13_fill_middle": op13_fill_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1, "op4_line_dedup": OP4, "op13_fill_middle": OP13}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(words[s:s + 9], ' ') AS phrase,
    least(len(words), 10) AS n
  FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS s FROM iw
        WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT doc_id, n, s, array_to_string(words[s:s + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
        FROM dw, sizes WHERE len(words) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM spots JOIN windows USING (phrase, n)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS list
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = rf"""
WITH lines AS (
  SELECT doc_id, i, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
    FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN frequent USING (key) GROUP BY doc_id
"""

OP13 = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
hashed AS (
  SELECT doc_id, t, n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
    ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM drawn),
placed AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a,
    greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed),
parts AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s
  FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
