"""Savings reports straight from the exports of a month.

The detail rows are stored once; the report, the totals, the tables by account and whoever asks for
the details read them from there and not from the exports again. What has to be known of all lines
is observed in the pass that makes the details.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession

from spendlake.operators import savings
from spendlake.operators.columns import RI_COLUMNS, SP_COLUMNS
from spendlake.sinks.reports import write_csv_report
from spendlake.sources.exports import find_exports, read_exports, typed_lines
from spendlake.sources.files import stored
from spendlake.sources.lists import read_ids, read_optional_ids


@dataclass(frozen=True)
class Savings:
    """Results of a job.

    The detail rows, the one-row totals, the files that were left out, and a row for each account
    (savings plans: and payer). ``plans`` has the detail rows next to the totals of their account
    (savings plans only). ``n_lines`` and ``on_demand_total`` are of all lines before any filter
    (reservations only); when the cost is zero throughout, that is a warning.
    """

    details: DataFrame
    totals: DataFrame
    rejected: DataFrame
    accounts: DataFrame
    plans: DataFrame | None = None
    n_lines: int | None = None
    on_demand_total: Decimal | None = None

    @property
    def on_demand_all_zero(self) -> bool | None:
        return None if self.on_demand_total is None else self.on_demand_total == 0


def ri_from_lines(
    lines: DataFrame,
    rejected: DataFrame,
    period: str,
    ids: DataFrame | None = None,
    report: str | None = None,
) -> Savings:
    """Reserved instances of lines with the usual columns, in one pass over them."""
    seen = Observation()
    watched = savings.observed_cost(lines, seen)
    details = stored(savings.ri_savings(watched, period, ids), "ri-details")
    if report:
        write_csv_report(savings.ri_report(details), report)
    found = seen.get
    if found["total"] == 0:
        warnings.warn(
            f"{savings.ON_DEMAND} is zero in all {found['n_lines']} lines: is that right?", stacklevel=2
        )
    return Savings(
        details,
        savings.overall_totals(details, savings.RI_MEASURES),
        rejected,
        savings.ri_account_summary(details),
        n_lines=found["n_lines"],
        on_demand_total=found["total"],
    )


def sp_from_lines(
    lines: DataFrame, rejected: DataFrame, period: str, ids: DataFrame, report: str | None = None
) -> Savings:
    """Savings plans of lines with the usual columns, in one pass over them."""
    details = stored(savings.sp_savings(lines, period, ids), "sp-details")
    if report:
        write_csv_report(savings.sp_report(details), report)
    return Savings(
        details,
        savings.sp_totals(details),
        rejected,
        savings.account_summary(details),
        savings.account_plan_detail(details),
    )


def ri_from_exports(
    spark: SparkSession,
    root: str,
    period: str,
    prefix: str = "",
    ids_path: str | None = None,
    report: str | None = None,
    store: str | None = None,
) -> Savings:
    """Reserved instances; without an id list (or when it is missing) all of them.

    ``store`` keeps the exports that were read, for a later run: see ``read_exports``.
    """
    ids = read_optional_ids(spark, ids_path) if ids_path else None
    exports = read_exports(spark, find_exports(spark, root, prefix), RI_COLUMNS, store=store)
    return ri_from_lines(typed_lines(exports.lines), exports.rejected, period, ids, report)


def sp_from_exports(
    spark: SparkSession,
    root: str,
    period: str,
    ids_path: str,
    prefix: str = "",
    report: str | None = None,
    store: str | None = None,
) -> Savings:
    """Savings plans of an id list, which has to exist and to name at least one."""
    ids = read_ids(spark, ids_path)
    exports = read_exports(spark, find_exports(spark, root, prefix), SP_COLUMNS, store=store)
    return sp_from_lines(typed_lines(exports.lines), exports.rejected, period, ids, report)
