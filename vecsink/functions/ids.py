"""Object ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def position_id(topic: Column, partition: Column, offset: Column) -> Column:
    """UUID text made from a record's position, the same on every run.

    SHA-1 of `topic:partition:offset` with the version and variant digits of a
    name-based UUID, so a task that runs twice sends the same ids. A null part
    gives a null id.
    """
    name = F.concat(topic, F.lit(":"), partition.cast("string"), F.lit(":"), offset.cast("string"))
    digest = F.sha1(name.cast("binary"))
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-8"),
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def random_id() -> Column:
    """A new UUID per row and run; a task that runs twice sends new ids."""
    return F.uuid()
