"""Helpers shared by the join operators.

No side is marked for broadcast here: adaptive execution measures the bytes of a side at run time and
broadcasts it if they are few. Plans are built without running a job.
"""

from pyspark.sql import functions as F


def valid_on(day: str, start: str, end: str):
    """``day`` lies in the closed interval ``[start, end]``."""
    return (F.col(start) <= F.col(day)) & (F.col(day) <= F.col(end))
