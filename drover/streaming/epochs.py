"""Commit epochs: which life of a checkpoint wrote a batch.

Batch numbers start again at 0 when a query loses its checkpoint, so a batch is known by
(epoch, batch number). The epoch number lies inside the query's own checkpoint folder: a
restart finds it and goes on in the same epoch (a batch that was written but not committed
overwrites itself), a lost checkpoint takes the number with it and the next start claims a
newer one (nothing that older epochs wrote is touched). Claims lie beside the sink, where
they survive the checkpoint; they also fence the sink: a query whose epoch is no longer
the newest must not write.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F

from drover.session import path_exists


class StaleEpoch(RuntimeError):
    """A newer epoch has claimed the sink."""


def _path(spark: SparkSession, name: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(name)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    p, fs = _path(spark, folder)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def _create(spark: SparkSession, name: str) -> bool:
    """Create an empty file; False if another has created it before."""
    p, fs = _path(spark, name)
    try:
        fs.create(p, False).close()
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    return True


def _claims(sink: str) -> str:
    return sink.rstrip("/") + ".epochs"


def claimed(spark: SparkSession, sink: str) -> list[int]:
    """Epochs that queries have claimed for ``sink``, in order."""
    return _numbers(spark, _claims(sink))


def written(spark: SparkSession, sink: str) -> int:
    """Newest epoch with rows in ``sink`` (0: none); from its partition folders."""
    if not path_exists(spark, sink):
        return 0
    try:
        return int(spark.read.parquet(sink).agg(F.max("run")).first()[0] or 0)
    except AnalysisException:      # a folder without a file yet
        return 0


def epoch_of(spark: SparkSession, checkpoint: str, sink: str) -> int:
    """The epoch of the query with this checkpoint; a new checkpoint claims a new one."""
    own = _numbers(spark, f"{checkpoint}/epoch")
    if own:
        return own[-1]
    newest = max([*claimed(spark, sink), written(spark, sink)])
    if newest and path_exists(spark, f"{checkpoint}/offsets"):
        n = newest      # a checkpoint from before epochs were kept: its rows are the newest
        _create(spark, f"{_claims(sink)}/{n}")
    else:
        n = newest + 1
        while not _create(spark, f"{_claims(sink)}/{n}"):
            n += 1
    _create(spark, f"{checkpoint}/epoch/{n}")
    return n


def fence(spark: SparkSession, sink: str, epoch: int) -> None:
    """Raise if a newer epoch has claimed the sink (checked before each batch is written)."""
    newest = max(claimed(spark, sink), default=0)
    if newest > epoch:
        raise StaleEpoch(f"epoch {epoch} of {sink} was superseded by epoch {newest}")
