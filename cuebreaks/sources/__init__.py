"""Inputs, staged relations and the target table."""

from cuebreaks.sources.exchange import recover
from cuebreaks.sources.schemas import CORRECTIONS, CUES, METADATA, SUMMARY, check_schema
from cuebreaks.sources.staging import Stage, release_staged, shared_dir
from cuebreaks.sources.tables import read_table, replace_table

__all__ = [
    "CORRECTIONS",
    "CUES",
    "METADATA",
    "SUMMARY",
    "Stage",
    "check_schema",
    "read_table",
    "recover",
    "release_staged",
    "replace_table",
    "shared_dir",
]
