"""Ad cue points on Spark: column rules, DataFrame operators and the summary job."""

from cuebreaks.plans import build_summary_table, cue_summary
from cuebreaks.session import build_session

__all__ = ["build_session", "build_summary_table", "cue_summary"]
