"""Places and joins that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: list[str] = []

#: Rows and bytes up to which a side that was measured is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every machine of the cluster can reach.

    A session that runs on one machine (master ``local``) may leave the setting out and gets a temporary folder; elsewhere
    that is an error, since executors would write where nobody reads.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        if not _fallback:
            _fallback.append("file://" + tempfile.mkdtemp(prefix="annospark-"))
        base = _fallback[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends in a table that survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fitted(small: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``small`` with a broadcast hint if it was measured to hold at most ``limit`` rows and ``size`` bytes, else as it is, for a shuffled join.

    Text counts by its length, any other column as 8 bytes.
    """
    width = [F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(8) for c, kind in small.dtypes]
    held = small.select(sum(width, F.lit(0)).alias("width")).agg(F.count("*"), F.coalesce(F.sum("width"), F.lit(0))).first()
    return F.broadcast(small) if held[0] <= limit and held[1] <= size else small


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with as many underscores as it takes to differ from all ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
