"""Session helpers shared by all operators: session, durable checkpoints, skew-proof joins."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot if it holds at least this share of a table's rows; so at most 1 / HOT_SHARE keys can be hot.
HOT_SHARE = 1e-3


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """The session that tests and bench.py use; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("correlia")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir; make one only where none is set and all runs in one process (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="correlia-ckpt-"))


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint: its files outlive any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, nulls: bool = False) -> list:
    """Keys that hold at least `share` of the rows: at most 1 / share of them, whatever the input; with `nulls`, None may be one."""
    counts = (df if nulls else df.where(F.col(key).isNotNull())).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    rows = counts.crossJoin(F.broadcast(total)).where((F.col("n") >= F.col("total") * share) & (F.col("n") > 1)).select(key).collect()
    return [r[0] for r in rows]


def lookup_join(df: DataFrame, table: DataFrame, key: str, how: str = "left", hot: list | None = None) -> DataFrame:
    """Join `df`, whose `key` may be skewed, with `table`, in which `key` is unique.

    Hot keys are at most 1 / HOT_SHARE, so their part of `table` is broadcast; all other rows are
    joined by a shuffle in which no key holds more than HOT_SHARE of the rows. Null keys meet nothing; if they are
    many, they stay out of the shuffle. `how` is `left` or `inner`; a caller that gives `hot` has no null keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    hot = hot_keys(df, key, nulls=True) if hot is None else hot
    if None in hot:
        rest = lookup_join(df.where(F.col(key).isNotNull()), table, key, how, [k for k in hot if k is not None])
        if how == "inner":
            return rest
        more = [F.lit(None).cast(t).alias(c) for c, t in table.dtypes if c != key]
        return rest.unionByName(df.where(F.col(key).isNull()).select("*", *more))
    if not hot:
        return df.join(table, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    warm = df.where(is_hot).join(F.broadcast(table.where(F.col(key).isin(hot))), key, how)
    cold = df.where(~is_hot).join(table.where(~F.col(key).isin(hot)), key, how)
    return cold.unionByName(warm)
