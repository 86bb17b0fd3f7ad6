"""The registered queries over the given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.common import table
from oreflow.llm.leaks import decontaminate
from oreflow.llm.licenses import scan_licenses
from oreflow.llm.lines import dedup_lines
from oreflow.llm.merkle import fold, leaf_digest, manifest, siblings
from oreflow.llm.near import near_duplicates
from oreflow.llm.oracles import ARCHIVE_SQL, LINES_SQL, MANIFEST_SQL, NEAR_SQL, PHRASES_SQL
from oreflow.llm.packing import pack_documents
from oreflow.llm.personal import KINDS, find_personal
from oreflow.llm.phrases import best_phrases, mine_phrases
from oreflow.llm.quality import quality_rules
from oreflow.llm.substrings import remove_repeats
from oreflow.llm.suffixes import score_texts
from oreflow.llm.toxicity import score_toxicity
from oreflow.llm.warc import round_trip


def _is(kind: str):
    return lambda span: span["kind"] == kind


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", F.col("item").alias("item_id"), "first_word", "n_words", "shared", "mass"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [
        F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS
    ]
    return find_personal(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_lines",
        F.size("removed").alias("n_removed"),
        F.array_join(F.transform("removed", lambda n: n.cast("string")), ",").alias("removed_lines"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = [F.try_add("n_chars", F.lit(1)) if c == "n_chars" else F.col(c) for c in columns]
    rows = manifest(table(spark, sf_dir, "documents"), columns=columns, carry={"tampered": F.when(tampered, leaf_digest(changed))})
    rows = rows.withColumn("folded_root", fold(F.col("path"), F.coalesce("tampered", "leaf")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    scored = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", ~F.col("trained")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = best_phrases(mine_phrases(table(spark, sf_dir, "documents")))
    return phrases.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {f.__name__: f for f in (op1_benchmark_decontamination, op2_best_fit_packing, op3_toxicity, op4_pii, op5_ngram_jaccard_join, op6_quality_rules, op7_substring_dedup, op8_warc, op9_license_scan, op10_line_dedup, op11_merkle_manifest, op12_lm_scoring, op13_phrase_collocations)}
# Windows counted by their texts, kept words put together again.
SUBSTRING_SQL = r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
starts AS (SELECT doc_id, words, unnest(range(0, len(words) - 34)) AS s FROM w),
hashed AS (SELECT doc_id, s, md5(array_to_string(words[s + 1 : s + 35], ' ')) AS h FROM starts),
again AS (SELECT doc_id, s FROM hashed WHERE h IN (SELECT h FROM hashed GROUP BY h HAVING COUNT(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM again),
places AS (SELECT doc_id, unnest(range(0, len(words))) AS p, unnest(words) AS word FROM w),
kept AS (SELECT doc_id, COUNT(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - COALESCE(n, 0) AS BIGINT) AS n_removed,
  sha256(COALESCE(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

ORACLES = {
    "op5_ngram_jaccard_join": NEAR_SQL,
    "op7_substring_dedup": SUBSTRING_SQL,
    "op8_warc": ARCHIVE_SQL,
    "op10_line_dedup": LINES_SQL,
    "op11_merkle_manifest": MANIFEST_SQL,
    "op13_phrase_collocations": PHRASES_SQL,
}
