"""Run-date stamp."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the stamp follows the calendar of this zone.
REPORT_ZONE = "America/New_York"


def run_date_stamp(run_date: dt.date | None = None, instant: Column | None = None) -> Column:
    """The day before the run, in New York; the same in every session time zone.

    ``run_date`` pins the day of the run, for reruns and tests; ``instant`` (a timestamp) its moment,
    which is now by default.
    """
    if run_date is not None:
        return F.date_sub(F.lit(run_date).cast("date"), 1)
    # Counted from the epoch, the time in UTC does not pass through the session's zone.
    micros = F.unix_micros(F.current_timestamp() if instant is None else instant)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))
    return F.date_sub(F.convert_timezone(F.lit("UTC"), F.lit(REPORT_ZONE), utc).cast("date"), 1)
