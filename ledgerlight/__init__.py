"""Transaction analytics as composable Spark DataFrame functions."""

from ledgerlight.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
