"""Names of run folders as column expressions."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two spellings of a run name.
RUN_FORMAT = "yyyy_MM_dd_HH_mm_ss_SSSSSS"
ISO_RUN_FORMAT = "yyyy-MM-dd'T'HH-mm-ss"


def run_name(moment: Column, fmt: str = RUN_FORMAT) -> Column:
    return F.date_format(moment, fmt)


def run_time(name: Column, fmt: str = RUN_FORMAT) -> Column:
    """Time a run name stands for; NULL when it does not follow ``fmt``."""
    return F.try_to_timestamp(name, F.lit(fmt))


def basename(path: Column) -> Column:
    """Last part of a path, trailing slashes ignored."""
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def new_run_name(now: datetime | None = None) -> str:
    """Name of a run that starts now; in UTC, so that names keep their order."""
    return (now or datetime.now(UTC)).strftime("%Y_%m_%d_%H_%M_%S_%f")
