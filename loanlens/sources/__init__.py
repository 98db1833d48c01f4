"""Readers and writers. Readers only declare scans; they start no data job."""

from loanlens.sources.borrowers import load_demographics, load_nps, sheet_role
from loanlens.sources.files import INGEST_ORDER, read_table
from loanlens.sources.load import SourceLayout, Sources, load_all
from loanlens.sources.sinks import write_metrics, write_report, write_scores, write_snapshots
from loanlens.sources.snapshots import infer_numeric, load_snapshots, union_snapshots

__all__ = [
    "INGEST_ORDER",
    "SourceLayout",
    "Sources",
    "infer_numeric",
    "load_all",
    "load_demographics",
    "load_nps",
    "load_snapshots",
    "read_table",
    "sheet_role",
    "union_snapshots",
    "write_metrics",
    "write_report",
    "write_scores",
    "write_snapshots",
]
