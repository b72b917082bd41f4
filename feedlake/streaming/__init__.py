"""The daily run as a stream over the landing zone."""

from feedlake.streaming.daily import DayLoad, run_daily_stream, start_daily_stream

__all__ = ["DayLoad", "run_daily_stream", "start_daily_stream"]
