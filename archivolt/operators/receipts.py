"""Receipts of converted documents: a JSON of stages, scores and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_SHAPE = "struct<stages:array<struct<stage:string,pages_affected:long>>,quality:struct<baseline:struct<composite_score:double>,per_stage:map<string,double>>,decisions:map<string,string>>"


def receipt_steps(rows: DataFrame, key: str, receipt: str, order: tuple[str, ...] = ("s3", "s4", "s5", "s6", "s7")) -> DataFrame:
    """(key, step, pages, delta): the stages that touched pages, with what each added in hundredths to the last score known
    before it; NULL where a stage has none. Receipts that are no JSON give nothing."""
    x = rows.select(key, F.from_json(receipt, _SHAPE).alias("r")).where("r.stages IS NOT NULL")
    s = x.select(key, "r.quality", F.explode("r.stages").alias("s")).where(F.col("s.stage").isin(*order) & (F.col("s.pages_affected") > 0))
    score = F.try_element_at("quality.per_stage", F.col("s.stage"))
    y = s.select(key, F.col("s.stage").alias("step"), F.col("s.pages_affected").alias("pages"), score.alias("score"), F.coalesce(F.try_element_at("quality.per_stage", F.lit("s0")), F.col("quality.baseline.composite_score")).alias("base"))
    before = F.last("score", ignorenulls=True).over(Window.partitionBy(key).orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    return y.select(key, "step", "pages", F.floor((F.col("score") - F.coalesce(before, "base")) * 100 + 0.5).cast("double").alias("delta"))


def receipt_decisions(rows: DataFrame, key: str, receipt: str) -> DataFrame:
    """(key, engines, blocks, consensus, synthesised): what the log of decisions says. Its keys are `<engine>_pN`, `blocks_pN`
    and `synth_pN` (numbers that add up), and `consensus_pN_bM` (one a block)."""
    x = rows.select(key, F.from_json(receipt, _SHAPE)["decisions"].alias("d")).where("d IS NOT NULL").select(key, F.explode("d").alias("k", "v"))
    name = F.regexp_extract("k", r"^([a-z]+)_p\d+", 1)
    other = ["blocks", "synth", "consensus", "page", ""]
    number = F.expr("try_cast(v AS long)")
    return x.groupBy(key).agg(
        F.array_join(F.array_sort(F.array_distinct(F.collect_list(F.when(~name.isin(other), name)))), ",").alias("engines"),
        F.coalesce(F.sum(F.when(name == "blocks", number)), F.lit(0)).alias("blocks"), F.count_if(name == "consensus").alias("consensus"), F.coalesce(F.sum(F.when(name == "synth", number)), F.lit(0)).alias("synthesised"),
    )


def receipts(queue: DataFrame) -> DataFrame:
    """(queue_id, receipt) of finished queue rows, which hold scores and pages but no receipt of their own."""
    before, after, n = F.col("before_score"), F.col("after_score"), F.coalesce("pages_processed", F.lit(0)).cast("long")
    stage = lambda s, pages: F.struct(F.lit(s).alias("stage"), pages.alias("pages_affected"))
    mid = (F.coalesce(before, F.lit(0.0)) + F.coalesce(after, F.lit(0.0))) / 2
    scores = F.map_filter(F.create_map(F.lit("s3"), mid, F.lit("s6"), after), lambda k, v: v.isNotNull())
    even = F.col("queue_id") % 2 == 0
    told = F.map_from_entries(F.array_compact(F.array(*[F.struct(F.lit(k), v) for k, v in (("tesseract_p1", F.lit("88.5")), ("surya_p1", F.lit("91.0")), ("blocks_p1", n.cast("string")), ("blocks_p2", F.lit("3")), ("consensus_p1_b1", F.lit("yes")), ("consensus_p1_b2", F.lit("no")), ("page_1", F.lit("x")))], F.when(even, F.struct(F.lit("synth_p1"), F.lit("4"))))))
    whole = F.struct(F.array(stage("s3", n), stage("s4", F.lit(1).cast("long")), stage("s6", n)).alias("stages"), F.struct(F.struct(before.alias("composite_score")).alias("baseline"), scores.alias("per_stage")).alias("quality"), told.alias("decisions"))
    return queue.where("status = 'done'").select("queue_id", F.to_json(whole).alias("receipt"))
