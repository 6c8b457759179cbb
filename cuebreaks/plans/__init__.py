"""Whole jobs composed of the operators."""

from cuebreaks.plans.cue_summary import build_summary_table, cue_summary, current_cues

__all__ = ["build_summary_table", "cue_summary", "current_cues"]
