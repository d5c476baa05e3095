"""Session helpers shared by every module: lineage cuts and table access."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

from kstate.functions.canon import KStateError


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder named in spark.checkpoint.dir. Only local mode may do without: other nodes cannot read a local folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if named is None and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise KStateError("spark.checkpoint.dir has to name a folder all nodes share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "kstate-checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the lineage ends in files every executor can read again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
