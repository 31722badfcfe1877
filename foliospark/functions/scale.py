"""What follows the cluster instead of the machine the driver runs on: checkpoints, broadcasts, the package on the
executors.
"""

from __future__ import annotations

import os
import shutil
import site
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; only where it is unset on one machine (tests) a local one
    is made.
    """
    context = spark.sparkContext
    # written tables are deleted once nothing refers to them any more
    context._jsc.sc().conf().setIfMissing("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    given = context._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "foliospark-checkpoints")
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: one computation, and no lineage to repeat when
    an executor is lost.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a few short columns that every executor may hold.
BROADCAST_ROWS = 200_000


def broadcast_if(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` for a broadcast join where it has at most ``most`` rows (they are counted, so let it be a table that is
    already written); beyond that as it is, for Spark to shuffle.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def carry(
    df: DataFrame, values: dict[str, Column], keys: tuple[str, ...], order: str, width: int, current: bool = True
) -> DataFrame:
    """``df`` with columns ``values``: of each the last value that is not null up to the row (``current``) or before
    it, in ``order`` (a number) within ``keys``.

    A key with a large part of all rows is no single task's window: rows are cut
    into ranges of ``order`` of the given ``width``, the last values of the ranges
    (a row each) are carried over them, and a window inside each range goes on
    from there.
    """
    # a null key is a key of its own in a window, but not in a join; rows without an order come first
    named = [F.coalesce(F.concat(F.lit("k"), F.col(k).cast("string")), F.lit("")) for k in keys]
    r = df.withColumn(
        "_r", F.coalesce(F.floor(F.col(order) / width), F.lit(-(1 << 62)))
    ).withColumn("_k", F.concat_ws("\n", *named)).withColumns({f"_v_{n}": v for n, v in values.items()})
    ends = r.groupBy("_k", "_r").agg(
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(order))).alias(n) for n in values]
    )
    upto = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select("_k", "_r", *[F.last(n, ignorenulls=True).over(upto).alias(f"_b_{n}") for n in values])
    inside = Window.partitionBy("_k", "_r").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if current else -1
    )
    out = r.join(before, ["_k", "_r"]).withColumns(
        {n: F.coalesce(F.last(f"_v_{n}", ignorenulls=True).over(inside), f"_b_{n}") for n in values}
    )
    return out.select(*df.columns, *values)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, where they would not find it: not installed, and not
    on the PYTHONPATH they inherit.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [
        os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p
    ] + site.getsitepackages()
    context = spark.sparkContext
    if root in known or getattr(context, "_foliospark_sent", False):
        return
    folder = tempfile.mkdtemp()
    context.addPyFile(shutil.make_archive(os.path.join(folder, "foliospark"), "zip", root, "foliospark"))
    context._foliospark_sent = True
