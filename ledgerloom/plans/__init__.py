from ledgerloom.plans.catalog import DATASETS, REPORTS, Dataset
from ledgerloom.plans.reports import report
from ledgerloom.plans.shared import build_reports

__all__ = ["DATASETS", "REPORTS", "Dataset", "build_reports", "report"]
