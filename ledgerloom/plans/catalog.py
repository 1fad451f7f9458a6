"""The report registry: the only list of what is built, published and verified."""

from dataclasses import dataclass

from ledgerloom.operators.grains import GRAINS

# Names of datasets and their columns, which readers rely on, and the
# conditions F4 (the error text is not empty; a missing text is no error) and F5.
ERROR = "has_errors <> ''"
FRAUD = "is_fraud = 'Yes'"

COUNT = "count(*)"
TOTAL = "sum(amount_vnd)"
#: Exact integer sum over count: the same digits whatever the order of the rows.
AVERAGE = "try_divide(sum(amount_vnd), count(amount_vnd))"


#: What is added up of each user and day; with the distinct counts of ``plans/spread.py`` it is a rollup.
DAY_MEASURES = {
    "n": COUNT,
    "total": TOTAL,
    "amounts": "count(amount_vnd)",
    "largest": "max(amount_vnd)",
    "smallest": "min(amount_vnd)",
    "errors": f"count_if({ERROR})",
    "frauds": f"count_if({FRAUD})",
}
#: Reports made of these measures and distinct counts, by the columns that they take from them.
SPREAD = {
    "user_analysis": {
        "transaction_count": "n",
        "total_spent_vnd": "total",
        "avg_transaction_vnd": "try_divide(total, amounts)",
        "unique_merchants": "merchants",
        "unique_cities": "cities",
        "error_count": "errors",
    },
    "daily_summary": {
        "total_transactions": "n",
        "total_revenue_vnd": "total",
        "avg_transaction_vnd": "try_divide(total, amounts)",
        "unique_users": "users",
        "unique_merchants": "merchants",
        "unique_cities": "cities",
        "error_transactions": "errors",
        "fraud_transactions": "frauds",
        "max_transaction_vnd": "largest",
        "min_transaction_vnd": "smallest",
    },
}


@dataclass(frozen=True)
class Report:
    """One report family.

    ``measures`` maps output columns to aggregates over the rows of ``where``.
    ``first_keys`` and ``first_measures`` describe an aggregation underneath it,
    whose output the outer one reads (``having`` filters between the two).
    ``ratio`` is an output computed from the measures.
    """

    id: str
    name: str
    keys: tuple[str, ...]
    measures: dict[str, str]
    sort: str | None
    reads: tuple[str, ...]
    by_grain: bool = False
    where: str | None = None
    high_value: bool = False
    first_keys: tuple[str, ...] = ()
    first_measures: dict[str, str] | None = None
    having: str | None = None
    ratio: tuple[str, str, str] | None = None

    @property
    def columns(self) -> list[str]:
        extra = [self.ratio[0]] if self.ratio else []
        return [*self.keys, *self.measures, *extra]

    @property
    def one_file(self) -> bool:
        """Published as one file: rows are bounded by hours, days or places. Reports by user or
        merchant grow with the business and are always a folder of files."""
        return not {"user_id", "merchant_name"} & set(self.keys)

    @property
    def order(self) -> list[tuple[str, bool]]:
        """(column, descending): the report's measure, then the keys to settle ties."""
        lead = [(self.sort, True)] if self.sort else []
        return lead + [(key, False) for key in self.keys]


REPORTS: dict[str, Report] = {
    r.name: r
    for r in (
        Report(
            "R1", "hourly_analysis", ("hour",),
            {"transaction_count": COUNT},
            sort="transaction_count", by_grain=True,
            reads=("time", "ds"),
        ),
        Report(
            "R2", "hourly_unusual_analysis", ("hour",),
            {"error_transaction_count": COUNT},
            sort="error_transaction_count", by_grain=True, where=ERROR,
            reads=("time", "has_errors", "ds"),
        ),
        Report(
            "R3", "city_analysis", ("merchant_city", "merchant_state"),
            {"transaction_count": COUNT, "total_amount_vnd": TOTAL, "avg_amount_vnd": AVERAGE},
            sort="total_amount_vnd", by_grain=True,
            reads=("merchant_city", "merchant_state", "amount_vnd", "ds"),
        ),
        Report(
            "R4", "merchant_analysis", ("merchant_name", "merchant_city", "merchant_state"),
            {
                "transaction_count": COUNT,
                "total_amount_vnd": TOTAL,
                "avg_amount_vnd": AVERAGE,
                "max_amount_vnd": "max(amount_vnd)",
                "unique_customers": "count(DISTINCT user_id)",
            },
            sort="total_amount_vnd", by_grain=True,
            reads=("user_id", "merchant_name", "merchant_city", "merchant_state", "amount_vnd", "ds"),
        ),
        Report(
            "R5", "user_analysis", ("ds", "user_id"),
            {
                "transaction_count": COUNT,
                "total_spent_vnd": TOTAL,
                "avg_transaction_vnd": AVERAGE,
                "unique_merchants": "count(DISTINCT merchant_name)",
                "unique_cities": "count(DISTINCT merchant_city)",
                "error_count": f"count_if({ERROR})",
            },
            sort="transaction_count",
            reads=("user_id", "merchant_name", "merchant_city", "has_errors", "amount_vnd", "ds"),
        ),
        Report(
            "R6", "user_frequent", ("user_id",),
            {
                "frequent_hour_count": COUNT,
                "total_rapid_transactions": "sum(transaction_count)",
                "avg_txn_per_hour": "try_divide(sum(transaction_count), count(*))",
            },
            sort="frequent_hour_count",
            first_keys=("ds", "hour", "user_id"),
            first_measures={"transaction_count": COUNT},
            having="transaction_count > 1",
            reads=("user_id", "time", "ds"),
        ),
        Report(
            "R7", "high_value_analysis", ("hour", "merchant_city", "merchant_name"),
            {"high_value_count": COUNT, "max_amount_vnd": "max(amount_vnd)"},
            sort="high_value_count", by_grain=True, high_value=True,
            reads=("time", "merchant_city", "merchant_name", "amount_vnd", "ds"),
        ),
        # Days are aggregated first, so each is one row of the second step: the
        # per-day average and the number of days need no join and no distinct.
        Report(
            "R8", "weekday_vs_weekend", ("day_type",),
            {
                "transaction_count": "sum(day_count)",
                "total_amount_vnd": "sum(day_total)",
                "avg_amount_vnd": "try_divide(sum(day_total), sum(day_amounts))",
                "unique_days": "count(ds)",
                "avg_transactions_per_day": "try_divide(sum(day_count), count(*))",
            },
            sort=None,
            first_keys=("ds", "day_type"),
            first_measures={
                "day_count": COUNT,
                "day_total": TOTAL,
                "day_amounts": "count(amount_vnd)",
            },
            reads=("transaction_date", "amount_vnd", "ds"),
        ),
        Report(
            "R9", "user_error_analysis", ("user_id",),
            {"error_count": COUNT, "total_error_amount_vnd": TOTAL},
            sort="error_count", by_grain=True, where=ERROR,
            reads=("user_id", "has_errors", "amount_vnd", "ds"),
        ),
        Report(
            "R10", "user_fraud_analysis", ("user_id",),
            {"fraud_count": COUNT},
            sort="fraud_count", by_grain=True, where=FRAUD,
            reads=("user_id", "is_fraud", "ds"),
        ),
        Report(
            "R11", "fraud_by_hour", ("hour",),
            {"fraud_count": COUNT},
            sort="fraud_count", by_grain=True, where=FRAUD,
            reads=("time", "is_fraud", "ds"),
        ),
        Report(
            "R12", "fraud_by_merchant", ("merchant_name", "merchant_city"),
            {"fraud_count": COUNT},
            sort="fraud_count", by_grain=True, where=FRAUD,
            reads=("merchant_name", "merchant_city", "is_fraud", "ds"),
        ),
        Report(
            "R13", "fraud_by_city", ("merchant_city", "merchant_state"),
            {"fraud_count": COUNT},
            sort="fraud_count", by_grain=True, where=FRAUD,
            reads=("merchant_city", "merchant_state", "is_fraud", "ds"),
        ),
        # One pass of conditional counts in place of two aggregates and a join,
        # which also counts fraud where the merchant is unknown.
        Report(
            "R14", "fraud_rate_by_merchant", ("ds", "merchant_name"),
            {"total_transactions": COUNT, "fraud_transactions": f"count_if({FRAUD})"},
            ratio=("fraud_rate_percent", "fraud_transactions", "total_transactions"),
            sort="fraud_rate_percent",
            reads=("merchant_name", "is_fraud", "ds"),
        ),
        Report(
            "R15", "daily_summary", ("ds",),
            {
                "total_transactions": COUNT,
                "total_revenue_vnd": TOTAL,
                "avg_transaction_vnd": AVERAGE,
                "unique_users": "count(DISTINCT user_id)",
                "unique_merchants": "count(DISTINCT merchant_name)",
                "unique_cities": "count(DISTINCT merchant_city)",
                "error_transactions": f"count_if({ERROR})",
                "fraud_transactions": f"count_if({FRAUD})",
                "max_transaction_vnd": "max(amount_vnd)",
                "min_transaction_vnd": "min(amount_vnd)",
            },
            sort=None,
            reads=(
                "user_id", "merchant_name", "merchant_city",
                "has_errors", "is_fraud", "amount_vnd", "ds",
            ),
        ),
    )
}


@dataclass(frozen=True)
class Dataset:
    """A report at one grain: one stored table and one published file."""

    report: Report
    grain: str | None

    @property
    def id(self) -> str:
        return f"{self.report.name}_{self.grain}" if self.grain else self.report.name

    @property
    def path(self) -> str:
        return f"{self.report.name}/{self.grain}" if self.grain else self.report.name

    @property
    def file_stem(self) -> str:
        return f"{self.grain}_{self.report.name}" if self.grain else self.report.name


DATASETS: dict[str, Dataset] = {
    d.id: d
    for r in REPORTS.values()
    for d in (Dataset(r, g) for g in (GRAINS if r.by_grain else (None,)))
}


def select_datasets(names=None, grains=None) -> list[Dataset]:
    """The datasets of the given report families and grains; all by default."""
    for given, known in ((names, REPORTS), (grains, GRAINS)):
        unknown = set(given or ()) - set(known)
        if unknown:
            raise ValueError(f"unknown: {sorted(unknown)}")
    return [
        d
        for d in DATASETS.values()
        if (names is None or d.report.name in names)
        and (grains is None or d.grain is None or d.grain in grains)
    ]
