"""Lazily built, shared DataFrames for one query over one data folder.

Reusing one DataFrame object for a sub-result that a plan needs twice lets Spark reuse
its exchange instead of computing it again.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from drover.config import FIXTURE_PARAMS, Params
from drover.operators import alert_log as AL
from drover.operators import alerts as A
from drover.operators import metrics as M
from drover.operators import reconcile as R
from drover.operators import status as S
from drover.operators.clean import clean, enrich
from drover.session import prepare
from drover.sources import fixtures as X
from drover.sources.telemetry import decode_wire


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.params = params

    @cached_property
    def raw(self) -> DataFrame:
        """Raw telemetry rows (wire field types)."""
        return X.telemetry_rows(self.spark, self.sf_dir)

    @cached_property
    def wire(self) -> DataFrame:
        return X.telemetry_wire(self.spark, self.sf_dir)

    @cached_property
    def decoded(self) -> DataFrame:
        return decode_wire(self.wire)

    @cached_property
    def events(self) -> DataFrame:
        """Clean, enriched events, decoded from broker messages like the production path."""
        return enrich(clean(self.decoded), self.params)

    @cached_property
    def expenses(self) -> DataFrame:
        return X.expense_rows(self.spark, self.sf_dir)

    @cached_property
    def earnings(self) -> DataFrame:
        return M.daily_earnings(self.events)

    @cached_property
    def report(self) -> DataFrame:
        return R.profitability(self.expenses, self.earnings)

    @cached_property
    def spells(self) -> DataFrame:
        return S.status_spells(self.events, self.params)

    @cached_property
    def latest(self) -> DataFrame:
        return S.latest_status(self.events, self.params)

    @cached_property
    def recent(self) -> DataFrame:
        return S.recent_status(self.events, self.params, self.params.status_recency_s)

    @cached_property
    def zones_1min(self) -> DataFrame:
        return M.zone_metrics(self.events, self.params, "1 minute")

    def alert_rounds(self, offsets=(-86400, 0)) -> str:
        """A fresh alert log after a round at ``as_of`` plus each offset; returns its path."""
        from drover.session import scratch_path
        store = scratch_path(self.spark, "alerts")
        for off in offsets:
            p = self.params.replace(as_of=self.params.as_of + off)
            latest = self.latest if off == 0 else S.latest_status(self.events, p)
            AL.evaluate_round(self.spark, store, A.alert_conditions(self.events, self.report, p, latest=latest), p)
        return store

    def alert_state(self) -> DataFrame:
        """Alerts after two rounds: the conditions firing a day before ``as_of`` are raised,
        then the conditions at ``as_of`` applied."""
        return AL.alerts_as_of(self.spark, self.alert_rounds())


def export(df: DataFrame, digits: int = 6) -> DataFrame:
    """Portable result form: timestamps as epoch microseconds (bigint), doubles rounded half
    up to ``digits`` decimals as ``floor(x * 10^d + 0.5) / 10^d`` (addition order differs
    between engines; this formula is the same IEEE operations in the SQL oracle, unlike
    each engine's own ``round``, which disagree on values just below a tie). Names are kept."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(f.dataType, T.DoubleType):
            scale = float(10 ** digits)
            c = F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
        cols.append(c.alias(f.name))
    return df.select(*cols)
