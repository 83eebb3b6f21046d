"""Layer tables: what one step has made is written once to the shared folder and read by the steps above it.

Without them each table would be planned anew inside every table made from it, and plans would multiply by layer.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local sessions without a shared one, by application.
_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, or set as the checkpoint folder; a temporary one in local sessions only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[\d*,]+\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _OWN_DIRS.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="courtframes-layers-")
        _OWN_DIRS[spark.sparkContext.applicationId] = found
    return found


def stored(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The layer `name` of the tables in `source`, built in this application when first asked for.

    A half-written layer, of a job that was stopped, is not taken for a whole one: it has no success mark and is made anew.
    """
    folder = f"{shared_dir(spark)}/layers-{spark.sparkContext.applicationId}/{hashlib.sha256(source.encode()).hexdigest()[:16]}/{name}"
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        build().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)
