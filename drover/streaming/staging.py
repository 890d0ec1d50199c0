"""Stage rows as a sequence of landing files for replay through a file stream.

The file source orders new files by modification time, so files are written in event
order and given increasing modification times; files written together but read out of
order would make later events arrive before earlier ones and fall behind a watermark.
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, functions as F

from drover.session import local_path


def stage_in_order(df: DataFrame, path: str, order_col: str, n_files: int,
                   sequential: bool | None = None) -> int:
    """Write ``df`` as ``n_files`` Parquet files holding consecutive ranges of ``order_col``.
    Returns the number of data files (-1 when unknown).

    On a local filesystem the files are written by one job and then given increasing
    modification times. Elsewhere (HDFS, object stores) the ranges are written one after
    another into the same folder, so each file is newer than the previous range's
    (``sequential`` forces either route)."""
    lp = local_path(path)
    if sequential or (sequential is None and lp is None):
        bounds = df.approxQuantile(order_col, [i / n_files for i in range(1, n_files)], 0.001)
        edges = [None] + sorted(set(bounds)) + [None]
        for lo, hi in zip(edges, edges[1:]):
            # rows without a place in the order come first, as in the other route
            part = df if lo is None else df.where(F.col(order_col) > F.lit(lo))
            if hi is not None:
                part = part.where((F.col(order_col) <= F.lit(hi)) | (F.col(order_col).isNull() if lo is None else F.lit(False)))
            part.coalesce(1).sortWithinPartitions(order_col).write.mode("append").parquet(path)
        return -1
    (df.repartitionByRange(int(n_files), F.col(order_col)).sortWithinPartitions(order_col)
     .write.mode("overwrite").parquet(path))
    files = sorted(glob.glob(os.path.join(lp, "part-*.parquet")))
    base = os.path.getmtime(files[0]) - 10 * len(files) if files else 0
    for i, f in enumerate(files):
        os.utime(f, (base + 10 * i, base + 10 * i))
    return len(files)
