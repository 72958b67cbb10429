"""Mixing sources to target shares of the total size.

Tokens are counted once per document, summed per source, and turned into repetition rates; every document is then emitted
floor(rate) times, plus once more where a hash of its id and the seed falls below the fraction.

Scale: counting and emitting are maps; the sums are one aggregation with partial sums, and the rates one row a source.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from archivolt.session import materialize, spread

#: Fixed value: the splitting pattern of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def counted(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, source, tokens) of every document with a source; NULL texts have no tokens.

    The vocabulary file is read by the driver and sent along, so that executors need no copy of it.
    """
    with open(tokenizer, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    shared = documents.sparkSession.sparkContext.broadcast(ranks)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoding = tiktoken.Encoding("archive", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "tokens": [len(x) for x in encoding.encode_ordinary_batch([t or "" for t in pdf["text"]], num_threads=1)]})

    return spread(documents.where("doc_id IS NOT NULL AND source IS NOT NULL").select("doc_id", "source", "text")).mapInPandas(count, "doc_id long, source string, tokens long")


def repetition_rates(available: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """Copies per document and source. `targets`: share and most copies. `total`: tokens wanted, by default all there are.

    Sources that cannot fill their share within their cap are taken as often as allowed; what they lack is spread over the
    others in proportion to their shares, so that the total is kept as far as the caps let it.
    """
    have = {s: available.get(s, 0) for s in targets}
    wanted = float(sum(have.values()) if total is None else total)
    rates = {s: 0.0 for s in targets}
    open_ = {s for s in targets if have[s] > 0 and targets[s][0] > 0 and targets[s][1] > 0}
    left = wanted
    while open_:
        share = sum(targets[s][0] for s in open_)
        full = {s for s in open_ if left * targets[s][0] / share >= have[s] * targets[s][1]}
        if not full:
            for s in open_:
                rates[s] = left * targets[s][0] / share / have[s]
            break
        for s in full:
            rates[s] = float(targets[s][1])
            left -= have[s] * targets[s][1]
        open_ -= full
        if left <= 0:
            break
    return rates


class Mixture:
    """The emitted copies and the report of one mix."""

    def __init__(self, documents: DataFrame, targets: DataFrame, tokenizer: str, total: float | None = None, seed: int = 17):
        self.sizes = materialize(counted(documents, tokenizer), "token-counts")
        self.targets = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in targets.where("source IS NOT NULL AND target_share IS NOT NULL").select("source", "target_share", F.coalesce("max_repeats", F.lit(1)).alias("max_repeats")).collect()}  # one row a source
        named = [*self.targets]
        sums = self.sizes.where(F.col("source").isin(named)).groupBy("source").agg(F.sum("tokens").alias("tokens")).collect() if named else []
        self.available = {r["source"]: r["tokens"] or 0 for r in sums}
        self.rates = repetition_rates(self.available, self.targets, total)
        self.seed = seed

    def copies(self, documents: DataFrame | None = None) -> DataFrame:
        """(doc_id, source, ..., copy_no): each document as often as drawn, copies numbered from 1; the draw depends on its id,
        its source's rate and the seed alone, so that any table of the documents can be drawn from. By default (doc_id,
        source, tokens)."""
        rows = self.sizes if documents is None else documents
        spark = rows.sparkSession
        told = [(s, int(np.floor(r)), float(r - np.floor(r))) for s, r in self.rates.items()]
        rates = spark.createDataFrame(told, "source string, whole int, part double")
        draw = F.pmod(F.xxhash64(F.lit(self.seed), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
        times = F.col("whole") + F.when(draw < F.col("part"), 1).otherwise(0)
        drawn = rows.where("doc_id IS NOT NULL").join(F.broadcast(rates), "source").withColumn("times", times).where("times > 0")  # rates: one row a source
        return drawn.select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy_no"))

    def report(self) -> DataFrame:
        """(source, target_share, reached_share, tokens_available, tokens_emitted, rate, capped)."""
        spark = self.sizes.sparkSession
        emitted = {r["source"]: r["t"] for r in self.copies().groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
        whole = sum(emitted.values()) or 1
        rows = [(s, sh, emitted.get(s, 0) / whole, int(self.available.get(s, 0)), int(emitted.get(s, 0)), self.rates[s], self.rates[s] >= most) for s, (sh, most) in sorted(self.targets.items())]
        return spark.createDataFrame(rows, "source string, target_share double, reached_share double, tokens_available long, tokens_emitted long, rate double, capped boolean")


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str, **options) -> DataFrame:
    """(doc_id, source, copy_no, text) of the mix, emitted by the scan of the texts: no text is shuffled.

    Documents without id or source, or of a source without target, are left out; blank texts have no tokens and are drawn
    like others. Equal texts under several ids are several records. Empty tables give an empty mix. Targets that no
    rate can reach are reported as capped by `Mixture.report`.
    """
    copies = Mixture(documents, targets, tokenizer, **options).copies(documents.select("doc_id", "source", "text"))
    return copies.select("doc_id", "source", "copy_no", "text")
