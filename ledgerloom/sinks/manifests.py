"""What each batch stored where: one small file for each batch of a lake.

``lake/_batches/<batch>.json`` has a line for the batch (when it was stored, its accepted and refused
records, counted by the write itself) and one for each folder that holds rows of it. So storing a batch
again touches the folders listed there and no others, however many days the lake has, and what changed since
a report was made is a comparison of two tables.

An attempt to store a batch has a key of its own, which every row stored by it carries. A manifest is
first written as ``pending``, with the folders of the attempt before and of this one, then as ``stored`` with
this one's alone: after a crash in between, the next attempt finds every folder there is.
"""

import json
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sinks import paths

PENDING, STORED = "pending", "stored"
SCHEMA = (
    "batch string, attempt string, state string, accepted long, refused long, "
    "outcome string, ds string, folder string, files long, bytes long"
)


@dataclass(frozen=True)
class Folder:
    """A folder with rows of a batch. ``ds`` is a day as it stands in the path."""

    outcome: str
    ds: str
    folder: str
    attempt: str
    files: int
    bytes: int

    @property
    def day(self) -> tuple[str, str]:
        return self.outcome, self.ds

    def path(self, lake: str) -> str:
        return f"{lake}/outcome={self.outcome}/ds={self.ds}/batch={self.folder}"


@dataclass(frozen=True)
class Manifest:
    batch: str
    attempt: str
    state: str
    folders: tuple[Folder, ...] = ()
    accepted: int = 0
    refused: int = 0

    def text(self) -> str:
        head = {"batch": self.batch, "state": self.state}
        lines = [head | {"attempt": self.attempt, "accepted": self.accepted, "refused": self.refused}]
        lines += [head | asdict(folder) for folder in self.folders]
        return "".join(json.dumps(line) + "\n" for line in lines)

    def with_folders(self, state: str, folders: tuple[Folder, ...]) -> "Manifest":
        return replace(self, state=state, folders=folders)


def escaped(name: str) -> str:
    """As Spark writes a value into a path."""
    plain = set(" !$&()+,-.;@_|~")
    return "".join(c if c.isalnum() or c in plain else f"%{ord(c):02X}" for c in name)


def manifest_path(lake: str, batch: str) -> str:
    return f"{lake}/_batches/{escaped(batch)}.json"


def read_manifest(spark: SparkSession, lake: str, batch: str) -> Manifest | None:
    text = paths.read_text(spark, manifest_path(lake, batch))
    if text is None:
        return None
    head, *lines = map(json.loads, text.splitlines())
    fields = ("outcome", "ds", "folder", "attempt", "files", "bytes")
    folders = tuple(Folder(**{f: line[f] for f in fields}) for line in lines)
    return Manifest(head["batch"], head["attempt"], head["state"], folders, head["accepted"], head["refused"])


def write_manifest(spark: SparkSession, lake: str, manifest: Manifest) -> None:
    paths.write_text(spark, manifest_path(lake, manifest.batch), manifest.text())


def read_manifests(spark: SparkSession, lake: str) -> DataFrame:
    """All manifests of a lake as a table, read by executors: a row for each batch (``outcome`` NULL) and
    for each folder."""
    path = f"{lake}/_batches"
    if not paths.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def batch_counts(spark: SparkSession, lake: str) -> DataFrame:
    """(batch, accepted, refused): what each batch took in, without reading the batches."""
    return read_manifests(spark, lake).where("outcome IS NULL").select("batch", "accepted", "refused")
