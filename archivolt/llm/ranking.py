"""One ranking from several differently scaled scores, by closeness to the ideal point.

Scores are cleaned, winsorised at quantiles, divided by their Euclidean length over all rows and weighted; the rank
follows from the distances to the best and the worst point: d- / (d+ + d-).

Scale: quantiles come from counts of values rounded to four significant digits (at most some hundred thousand of them a
score, summed by partial aggregation), lengths and extremes from one aggregation. The order is a range partitioning, so
ties and a hot value are spread over tasks by url; ranks are places within a partition plus counts of the earlier ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivolt.session import materialize


@dataclass(frozen=True)
class Criterion:
    """A score: its column expression, its weight, and what a missing value counts as (None: the median)."""

    name: str
    value: Column
    weight: float = 1.0
    missing: float | None = None


def usable(c: Column, least: float = 0.0, most: float | None = None) -> Column:
    """The score as a double, NULL where NaN, infinite, below `least` or above `most`."""
    x = c.cast("double")
    ok = ~F.isnan(x) & (x >= least) & (x < float("inf"))
    return F.when(ok & (x <= most) if most is not None else ok, x)


def share(c: Column) -> Column:
    """A share given as 0-1 or as per cent."""
    x = usable(c, 0.0, 100.0)
    return F.when(x > 1, x / 100).otherwise(x)


def rounded(x: Column) -> Column:
    """Four significant digits, so that a score has few distinct values whatever the number of rows."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.greatest(F.abs(x), F.lit(1e-9)))) - 3)
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / unit) * unit)


def quantiles(rows: DataFrame, names: list[str], points: list[float]) -> dict[str, list[float]]:
    """Lower quantiles of the rounded values of each column: the least value with at least that share at or below it."""
    if not names:
        return {}
    pairs = rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), rounded(F.col(n)).alias("x")) for n in names])).alias("p")).select("p.*").where("x IS NOT NULL")
    counts = pairs.groupBy("name", "x").count()
    along = Window.partitionBy("name").orderBy("x")
    cum = counts.select("name", "x", F.sum("count").over(along).alias("c"), F.sum("count").over(Window.partitionBy("name")).alias("n"))
    found = cum.groupBy("name").agg(*[F.min(F.when(F.col("c") >= p * F.col("n"), F.col("x"))).alias(f"q{i}") for i, p in enumerate(points)]).collect()
    return {r["name"]: [r[f"q{i}"] for i in range(len(points))] for r in found}


def ideal_point_closeness(rows: DataFrame, key: str, criteria: list[Criterion], tails: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """(key, one column per criterion as used, closeness in 0-1), higher is better; all criteria are benefits.

    A criterion without any usable value, or of one single value, decides nothing. A row on both points (all criteria
    single-valued) gets 0.5. Rows are kept whatever they miss.
    """
    names = [c.name for c in criteria]
    base = rows.select(F.col(key), *[c.value.alias(c.name) for c in criteria])
    marks = quantiles(base, names, [tails[0], 0.5, tails[1]])
    clean = []
    for c in criteria:
        low, mid, high = marks.get(c.name, [0.0, 0.0, 0.0])
        fill = mid if c.missing is None else c.missing
        clean.append(F.least(F.greatest(F.coalesce(F.col(c.name), F.lit(float(fill))), F.lit(float(low))), F.lit(float(high))).alias(c.name))
    base = base.select(key, *clean)
    stats = base.agg(*[f(n).alias(f"{n}_{i}") for n in names for i, f in enumerate((F.min, F.max))], *[F.sum(F.col(n) * F.col(n)).alias(f"{n}_2") for n in names]).first()
    total = sum(c.weight for c in criteria) or 1.0
    to_best, to_worst = F.lit(0.0), F.lit(0.0)
    for c in criteria:
        length = (stats[f"{c.name}_2"] or 0.0) ** 0.5 or 1.0
        w = c.weight / total / length
        to_best += F.pow((F.lit(float(stats[f"{c.name}_1"] or 0.0)) - F.col(c.name)) * w, 2)
        to_worst += F.pow((F.col(c.name) - F.lit(float(stats[f"{c.name}_0"] or 0.0))) * w, 2)
    far, near = F.sqrt(to_best), F.sqrt(to_worst)
    return base.withColumn("closeness", F.when(far + near > 0, F.round(near / (far + near), 9)).otherwise(0.5))


def ranked(rows: DataFrame, score: str, key: str) -> DataFrame:
    """`rows` with rank 1.. by `score` descending, then `key`: a total order, found without one task seeing all rows."""
    ordered = materialize(rows.repartitionByRange(F.col(score).desc(), F.col(key)).sortWithinPartitions(F.col(score).desc(), F.col(key)).withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    before = ordered.groupBy(part.alias("part")).count()
    offsets = before.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("offset"))  # one row a partition
    joined = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    return joined.withColumn("rank", F.col("offset") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("part", "offset", "place")


def pdf_ranking(pdf_quality: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(url, the four scores as used, closeness, rank) of every PDF, best first.

    Of several rows of a url the latest scored counts, exact repeats once. Negative, NaN and infinite scores count as
    missing, per cents above 1 are divided by 100; a missing score counts as the median, a missing text layer as none.
    Rows without url are left out; ties in closeness are ordered by url. An empty table gives an empty result.
    """
    scores = ["avg_chars_per_page", "readable_pages_pct", "word_quality_estimate", "has_text_layer"]
    w = {"avg_chars_per_page": 1.0, "readable_pages_pct": 1.5, "word_quality_estimate": 2.0, "has_text_layer": 0.5} | (weights or {})
    latest = pdf_quality.where("url IS NOT NULL").groupBy("url").agg(F.max(F.struct("scored_at", *scores)).alias("r")).select("url", "r.*")
    criteria = [
        Criterion("avg_chars_per_page", usable(F.col("avg_chars_per_page")), w["avg_chars_per_page"]),
        Criterion("readable_pages_pct", share(F.col("readable_pages_pct")), w["readable_pages_pct"]),
        Criterion("word_quality_estimate", share(F.col("word_quality_estimate")), w["word_quality_estimate"]),
        Criterion("has_text_layer", usable(F.col("has_text_layer"), 0.0, 1.0), w["has_text_layer"], 0.0),
    ]
    return ranked(ideal_point_closeness(latest, "url", criteria), "closeness", "url")
