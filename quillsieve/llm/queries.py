"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillsieve.llm import decontam, html_text, idfiles, langid, merkle, minhash, negatives, packing, quality, substring, tokencounts, topk, toxicity
from quillsieve.llm.tokens import vocabulary
from quillsieve.runtime import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.stored_pieces(texts(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
    # Only the checksums of the ids travel to their windows.
    packed = packing.pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.learn(docs))
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return html_text.extract(pages).select("page_id", F.col("page_text").alias("text"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(texts(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = 50256  # the end-of-text id of this vocabulary, which no text yields
    written = tokencounts.write_flat(
        texts(spark, sf_dir), vocabulary("byte_bpe_50k.json"), run_dir(spark, "flat"), separator=end
    )
    files = written.groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    counts = tokencounts.count_tokens(files, separator=end)
    return tokencounts.with_doc_ids(counts, written).select("doc_id", "n_tokens", "terminated")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(texts(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    scored = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = idfiles.roundtrip(texts(spark, sf_dir), vocabulary("word_bpe_49k.json"))
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.quantised(vectors.withColumn("label", moved))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = docs.columns
    # Wide enough for one more than the largest number.
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    altered = merkle.leaf_hash(*(more if c == "n_chars" else F.col(c) for c in columns))
    touched = F.col("n_chars").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    docs = docs.withColumn("altered", F.when(touched, altered))
    made = merkle.manifest(docs, F.col("lang"), ["doc_id"], columns, ["doc_id", "altered"])
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("path"))
    checked = made.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def encoded(value: str) -> str:
    """SQL of one field of a leaf."""
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(encoded(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


CRC32_SQL = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, step: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

MERKLE_SQL = f"""WITH RECURSIVE leaves AS (
      SELECT doc_id, lang, {leaf_sql('n_chars')} AS leaf,
        CASE WHEN n_chars IS NOT NULL AND doc_id IS NOT NULL AND {CRC32_SQL} % 7 = 0 THEN {leaf_sql('(n_chars + 1)')} END AS altered
      FROM documents),
    d AS (SELECT *, row_number() OVER () AS key, count(*) OVER (PARTITION BY lang) AS n,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
    nodes AS (
      SELECT lang, 0 AS level, i, n, leaf AS h FROM d
      UNION ALL
      SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes
      WHERE n > 1 GROUP BY lang, level, i // 2, n),
    subroots AS (SELECT lang, h, count(*) OVER () AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM nodes WHERE n = 1),
    tops AS (
      SELECT 0 AS level, i, n, h FROM subroots
      UNION ALL
      SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 2, n),
    steps AS (
      SELECT d.key, own.level, own.i, s.h FROM d
        JOIN nodes own ON own.lang IS NOT DISTINCT FROM d.lang AND own.n > 1 AND own.i = d.i >> own.level
        LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM d.lang AND s.level = own.level AND s.i = xor(own.i, 1)
      UNION ALL
      SELECT d.key, 1000 + own.level, own.i, s.h FROM d JOIN subroots r ON r.lang IS NOT DISTINCT FROM d.lang
        JOIN tops own ON own.n > 1 AND own.i = r.i >> own.level
        LEFT JOIN tops s ON s.level = own.level AND s.i = xor(own.i, 1)),
    paths AS (SELECT key, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof,
        list(CASE WHEN i % 2 = 0 THEN '|' || coalesce(h, '') ELSE h || '|' END ORDER BY level) AS run FROM steps GROUP BY key),
    answer AS (
      SELECT d.doc_id, d.leaf, r.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
        list_reduce(list_prepend(coalesce(altered, leaf), coalesce(p.run, [])),
          lambda own, step: sha256(split_part(step, '|', 1) || own || split_part(step, '|', 2))) AS folded_root
      FROM d JOIN subroots r ON r.lang IS NOT DISTINCT FROM d.lang LEFT JOIN paths p USING (key))
    SELECT *, folded_root = root AS verified FROM answer"""

NEGATIVES_SQL = """WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, CAST(list_dot_product(a.e, o.e) AS BIGINT) AS score
      FROM v a, v o WHERE a.vec_id % 100 = 0 AND o.vec_id <> a.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
      CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
      s.vec_id AS negative_id, positive_score, s.score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 5"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [op1_packing, op2_top_k, op3_language_id, op4_html_text, op5_substring_dedup, op6_token_counts, op7_minhash, op8_quality, op9_id_files, op10_decontamination, op11_toxicity, op12_hard_negatives, op13_merkle]
    return {q.__name__: q for q in listed}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_top_k": """WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
              FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
              vec_id, score FROM s
            QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""",
        "op12_hard_negatives": NEGATIVES_SQL,
        "op13_merkle": MERKLE_SQL,
    }
