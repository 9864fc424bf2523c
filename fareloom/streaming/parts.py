"""Tables of parts, whose files are seen from the moment that one small file names them.

A batch writes its rows as a new part, into folders that no reader looks at yet, and then publishes: a file with the next number
in ``_parts`` says which parts of which tables there are. Readers follow the file with the highest number, so they see whole
batches only; a batch that is cut off before leaves nothing but folders that nobody names, and ``sweep`` removes them.

Parts are merged ``MERGED_AT_ONCE`` of one level into one of the next, so their number grows with the logarithm of the number of
batches, and a row is written again once a level. Parts that were replaced stay for ``KEPT_AFTER`` batches more, for readers
that have begun.
"""

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from fareloom.session import delete_path, matching_paths, path_exists, read_text, write_text

MERGED_AT_ONCE = 8
KEPT_AFTER = 10
#: Files of ``_parts`` that are kept behind the newest.
KEPT_FILES = 20
FOLDER = "_parts"


@dataclass(frozen=True)
class Part:
    """One part of a table: its level, the last batch in it, and what its writer notes about it."""

    table: str
    name: str
    level: int
    last_batch: int
    notes: dict = field(default_factory=dict)


@dataclass
class Ledger:
    """What is published: all batches up to ``through``, the live parts, the replaced folders, and the writer's notes."""

    through: int = -1
    parts: list[Part] = field(default_factory=list)
    retired: list[list] = field(default_factory=list)
    notes: dict = field(default_factory=dict)

    def of(self, table: str) -> list[Part]:
        return [part for part in self.parts if part.table == table]

    def retire(self, folders: Iterable[str], batch_id: int) -> None:
        """Have folders (path patterns) deleted some batches from now."""
        self.retired += [[folder, batch_id] for folder in folders]

    def due(self, table: str) -> list[Part]:
        """Parts of one level that are as many as are merged at once, the lowest level first."""
        by_level: dict[int, list[Part]] = {}
        for part in self.of(table):
            by_level.setdefault(part.level, []).append(part)
        ready = (by_level[level] for level in sorted(by_level) if len(by_level[level]) >= MERGED_AT_ONCE)
        return next(ready, [])

    def replace(self, old: list[Part], new: Part, folder_of: Callable[[Part], str], batch_id: int) -> None:
        self.parts = [part for part in self.parts if part not in old] + [new]
        self.retire(map(folder_of, old), batch_id)


def part_name(batch_id: int) -> str:
    """A name that no earlier attempt at the batch has used."""
    return f"{batch_id:012d}-{uuid.uuid4().hex[:8]}"


def _files(spark: SparkSession, root: str) -> list[str]:
    return matching_paths(spark, f"{root.rstrip('/')}/{FOLDER}/*.json")


def is_published(spark: SparkSession, root: str) -> bool:
    """Whether the folder is a table of parts."""
    return path_exists(spark, f"{root.rstrip('/')}/{FOLDER}")


def read_ledger(spark: SparkSession, root: str) -> Ledger:
    """The newest published state; an empty one before the first batch."""
    while files := _files(spark, root):
        text = read_text(spark, files[-1])
        if text is not None:  # else it was removed since it was listed, as newer ones came
            stored = json.loads(text)
            return Ledger(**{**stored, "parts": [Part(**part) for part in stored["parts"]]})
    return Ledger()


def publish(spark: SparkSession, root: str, ledger: Ledger) -> None:
    """Make the state of the ledger the one that readers see; then delete what is long replaced."""
    gone = [entry for entry in ledger.retired if entry[1] + KEPT_AFTER < ledger.through]
    ledger.retired = [entry for entry in ledger.retired if entry not in gone]
    write_text(spark, f"{root.rstrip('/')}/{FOLDER}/{ledger.through:012d}.json", json.dumps(asdict(ledger)))
    for pattern, _ in gone:
        for folder in matching_paths(spark, pattern):
            delete_path(spark, folder)
    for file in _files(spark, root)[:-KEPT_FILES]:
        delete_path(spark, file)


def sweep(spark: SparkSession, pattern: str, ledger: Ledger) -> None:
    """Delete the part folders that match a pattern and that the ledger does not name: leftovers of broken attempts."""
    named = {part.name for part in ledger.parts}
    kept = {folder for old, _ in ledger.retired for folder in matching_paths(spark, old)}
    for folder in matching_paths(spark, pattern):
        if folder.rsplit("part=", 1)[-1].split("/")[0] not in named and folder not in kept:
            delete_path(spark, folder)


def read_folders(spark: SparkSession, root: str, folders: list[str], schema) -> DataFrame:
    """The rows of these folders of a table."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)
