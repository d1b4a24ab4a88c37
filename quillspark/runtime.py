"""Session helpers: the shared scratch folder and lineage cuts.

Intermediate results that are read more than once (breadth-first levels, row
numbering, positioned text) are written to the shared folder the cluster names
in ``spark.checkpoint.dir``, so they survive the loss of an executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    A folder of our own is made only for a local master with none set; on a
    cluster a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = sc.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="quillspark-")
        named = _local_roots[app]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name of the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and continue from the written copy."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
