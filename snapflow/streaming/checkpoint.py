"""Choice of a stream's checkpoint folder."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from ..workspace import remove

POLICIES = ("keep", "unique", "reset")


def resolve_checkpoint_dir(spark: SparkSession, base_dir: str, policy: str = "keep") -> str:
    """``keep`` resumes from ``base_dir``; ``unique`` starts afresh below it; ``reset`` empties it first.

    Works on any file system Spark can write to.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    if policy == "unique":
        return f"{base_dir.rstrip('/')}/run_{int(time.time())}_{uuid.uuid4().hex[:8]}"
    if policy == "reset":
        remove(spark, base_dir)
    return base_dir
