"""Queries of the training-text problems."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from archivolt.llm import language, leakage, mixing, mojibake, neardup_index, ranking, scans, stuffing
from archivolt.session import materialize, shared_dir, ship_package


#: The vocabulary that sizes are counted with.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p2_found(spark, sf_dir):
    return mojibake.repaired(_t(spark, sf_dir, "pdf_quality"), _t(spark, sf_dir, "pages")).select("table_name", "url").distinct()


def p2_repaired(spark, sf_dir):
    return mojibake.repaired(_t(spark, sf_dir, "pdf_quality"), _t(spark, sf_dir, "pages"))


def p2_validation(spark, sf_dir):
    return mojibake.Repair(_t(spark, sf_dir, "pdf_quality"), _t(spark, sf_dir, "pages")).validation()


def p3_ranking(spark, sf_dir):
    return ranking.pdf_ranking(_t(spark, sf_dir, "pdf_quality"))


def p4_found(spark, sf_dir):
    return scans.ScanNoise(_t(spark, sf_dir, "pdf_quality"), _t(spark, sf_dir, "md_texts")).found()


def p4_repaired(spark, sf_dir):
    return scans.ScanNoise(_t(spark, sf_dir, "pdf_quality"), _t(spark, sf_dir, "md_texts")).repaired()


def p5_found(spark, sf_dir):
    rows, model = language.learned(_t(spark, sf_dir, "pdf_quality"))
    segments = materialize(language.judged(rows, model), "language-segments")
    return language.label_findings(rows, model, segments).distinct()


def p5_segments(spark, sf_dir):
    return language.judged(*language.learned(_t(spark, sf_dir, "pdf_quality")))


def p5_languages(spark, sf_dir):
    return language.main_languages(language.judged(*language.learned(_t(spark, sf_dir, "pdf_quality"))))


def p7_found(spark, sf_dir):
    root = f"{shared_dir(spark)}/rare-shingles-{uuid.uuid4().hex}"
    return neardup_index.queue_duplicates(_t(spark, sf_dir, "pdf_upgrade_queue"), _t(spark, sf_dir, "pages"), root).distinct()


def p8_found(spark, sf_dir):
    return leakage.leaks(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark")).select("doc_id", "item_id").distinct()


def p8_items(spark, sf_dir):
    return leakage.leaked_items(leakage.leaks(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark")))


def p10_found(spark, sf_dir):
    return stuffing.stuffed_documents(_t(spark, sf_dir, "documents")).select("doc_id").distinct()


def p9_mixture(spark, sf_dir):
    return mixing.mix(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "mix_targets"), TOKENIZER)


def p9_shares(spark, sf_dir):
    return mixing.Mixture(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "mix_targets"), TOKENIZER).report()


QUERIES = {"p3_ranking": p3_ranking, "p4_found": p4_found, "p4_repaired": p4_repaired, "p5_found": p5_found, "p5_segments": p5_segments, "p5_languages": p5_languages, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p2_found": p2_found, "p2_repaired": p2_repaired, "p2_validation": p2_validation, "p7_found": p7_found, "p8_found": p8_found, "p8_items": p8_items, "p10_found": p10_found}
ORACLE: dict[str, str] = {}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)
