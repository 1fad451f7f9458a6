"""Failures of single datasets, gathered while the others go on."""


class DatasetFailures(RuntimeError):
    """Some datasets failed; ``failures`` maps their ids to the errors."""

    def __init__(self, failures: dict[str, Exception]):
        self.failures = dict(failures)
        details = "; ".join(f"{name}: {error}" for name, error in self.failures.items())
        super().__init__(f"{len(self.failures)} dataset(s) failed: {details}")
