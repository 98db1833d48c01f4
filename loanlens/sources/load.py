"""Everything a run reads, declared in one call."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from loanlens.config import Config
from loanlens.sources.borrowers import load_demographics, load_nps
from loanlens.sources.snapshots import load_snapshots


@dataclass(frozen=True)
class SourceLayout:
    """Where the inputs are: snapshot folder, borrower tables by sheet, survey."""

    credit_dir: str
    demographics: Mapping[str, str] = field(default_factory=dict)
    nps: str | None = None


@dataclass(frozen=True)
class Sources:
    credit: DataFrame
    demographics: Mapping[str, DataFrame] = field(default_factory=dict)
    nps: DataFrame | None = None


def load_all(spark: SparkSession, layout: SourceLayout, cfg: Config | None = None) -> Sources:
    cfg = cfg or Config()
    return Sources(
        credit=load_snapshots(spark, cfg.snapshot_files, layout.credit_dir),
        demographics=load_demographics(spark, layout.demographics),
        nps=load_nps(spark, layout.nps),
    )
