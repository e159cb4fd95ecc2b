"""Curation of products: merge, score, reject, sort, cap, validate, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam import schemas
from loam.operators import merging, reporting, scoring, validation
from loam.operators.checkpoints import checkpointed


@dataclass(frozen=True)
class Curated:
    enriched: DataFrame
    scored: DataFrame
    rejected: DataFrame
    accepted: DataFrame
    failed: DataFrame
    target: int

    def published(self) -> DataFrame:
        """Accepted products with the published columns only."""
        return self.accepted.select(*schemas.TOOL)

    def report(self, raw: int | None = None, verified: int | None = None) -> DataFrame:
        """One row of metrics; raw and verified are counts of the stages before, if known."""
        judged = self.scored.withColumn("rejection_reason", scoring.rejection())
        return reporting.curation_report(self.enriched, judged, self.accepted, self.failed, self.target, raw, verified)


def top(tools: DataFrame, n: int, order: str = "input_idx") -> DataFrame:
    """The n best by score, ties in order of input: each task keeps n rows at most."""
    return tools.orderBy(F.desc("quality_score"), F.asc(order)).limit(n)


def curate(tools: DataFrame, as_of: Column, target: int = 1000, merge: bool = True, order: str = "input_idx") -> Curated:
    """All of it. The cap comes before validation, so that fewer than `target` may be accepted."""
    merged = merging.merge_duplicates(tools, order) if merge else tools
    # both are read more than once, and a plan of all steps together is more than the optimizer takes
    scored = checkpointed(scoring.score(merged, as_of))
    kept, rejected = scoring.split_rejected(scored)
    # of products with one site the best one passes, as they come by score
    accepted, failed = validation.split_valid(checkpointed(validation.validate(top(kept, target, order), [F.desc("quality_score"), F.asc(order)])))
    return Curated(tools, scored, rejected, accepted, failed, target)
