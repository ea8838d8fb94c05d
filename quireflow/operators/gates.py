"""What becomes of a volume by the pages that failed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerant_gate(expected: Column, skipped: Column, errors: Column, early: Column, share: float = 0.05) -> Column:
    """terminal if no page reached the model (``early`` ones failed before it) and none was skipped on purpose; else retryable if more than the share of the pages that
    were tried failed, else done."""
    none = (expected - skipped - early == 0) & (skipped == 0)
    return F.when(none, "terminal").when(errors / F.greatest(expected - skipped, F.lit(1)) > share, "retryable").otherwise("done")


def strict_gate(errors: Column, dropped: Column) -> Column:
    """retryable if the pipeline lost a page, else terminal if any failed."""
    return F.when(dropped > 0, "retryable").when(errors > 0, "terminal").otherwise("done")
