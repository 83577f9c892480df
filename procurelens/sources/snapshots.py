"""Tables that are replaced as a whole without a moment at which no complete version can be read.

A table's folder holds one folder per version below ``_versions`` and one small pointer file per
commit below ``_pointers``. A writer fills a new version folder first, then makes the pointer with
the next number; the pointer with the greatest number counts. So a job that dies, whenever it does,
leaves the version before it in force, and a reader sees one version or the other. The pointer is
made only if no other writer has made that number, so of two writers that began on the same version
one gets a ``Conflict``. Files of a version never change: plans that read an older one go on while
it is kept.

A folder of plain Parquet files without pointers is read as it is, and is version 0 until the first
commit.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from procurelens.sources import files

POINTERS, VERSIONS = "_pointers", "_versions"
#: Versions that stay readable, the one in force counted.
KEEP = 3
#: Version folders that no pointer names may belong to a running writer; they go after this time.
ORPHAN_HOURS = 48


class Conflict(RuntimeError):
    """Another writer has replaced the table in the meantime."""


@dataclass(frozen=True)
class Version:
    """A commit: its number and time, the folders below the table's that hold its data, and notes of the writer."""

    number: int
    parts: tuple[str, ...]
    committed_ms: int = 0
    notes: dict = field(default_factory=dict, compare=False)


def _root(path: str) -> str:
    return path.rstrip("/")


def _pointer(number: int) -> str:
    return f"v{number:012d}"


def _parsed(number: int, text: str) -> Version | None:
    """The commit of a pointer; None for one whose writer died before the text was whole."""
    if not text.endswith("\n"):
        return None
    told = json.loads(text)
    return Version(number, tuple(told["parts"]), told["committed_ms"], told["notes"])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = [e.name for e in files.entries(spark, f"{_root(path)}/{POINTERS}")]
    return sorted((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), reverse=True)


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All commits that are kept, the one in force first."""
    found = (_parsed(n, files.read_text(spark, f"{_root(path)}/{POINTERS}/{_pointer(n)}")) for n in _numbers(spark, path))
    return [v for v in found if v]


def current(spark: SparkSession, path: str) -> Version | None:
    """The commit in force; None without one."""
    for n in _numbers(spark, path):
        if version := _parsed(n, files.read_text(spark, f"{_root(path)}/{POINTERS}/{_pointer(n)}")):
            return version
    return None


def folders(path: str, version: Version) -> list[str]:
    return [f"{_root(path)}/{VERSIONS}/{part}" for part in version.parts]


def resolve(spark: SparkSession, path: str, number: int | None = None) -> str:
    """The folder to read for a table of one part: of the version in force, or of a kept one by its number."""
    if number is None:
        version = current(spark, path)
        return folders(path, version)[0] if version else path
    if number == 0:
        return path
    for version in versions(spark, path):
        if version.number == number:
            return folders(path, version)[0]
    raise LookupError(f"{path} has no version {number}")


def new_part() -> str:
    return uuid.uuid4().hex


def commit(
    spark: SparkSession, path: str, parts: list[str], base: Version | None, keep: int = KEEP, notes: dict | None = None
) -> Version:
    """Put parts in force that are written already. ``base`` is the version that the writer began with."""
    numbers = _numbers(spark, path)
    now = current(spark, path)
    if (now.number if now else 0) != (base.number if base else 0):
        raise Conflict(f"{path} was replaced while the new version was written")
    version = Version(max(numbers, default=0) + 1, tuple(parts), int(time.time() * 1000), notes or {})
    told = {"parts": parts, "committed_ms": version.committed_ms, "notes": version.notes}
    if not files.create_text(spark, f"{_root(path)}/{POINTERS}/{_pointer(version.number)}", json.dumps(told) + "\n"):
        raise Conflict(f"{path} was replaced while the new version was written")
    prune(spark, path, keep)
    return version


def replace(
    df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None, keep: int = KEEP, notes: dict | None = None,
    options: dict[str, str] | None = None,
) -> Version:
    """Write a frame as the table's new version. ``check`` sees the written rows and raises to refuse them.

    ``options`` are those of the Parquet writer.
    """
    spark, part = df.sparkSession, new_part()
    base = current(spark, path)
    folder = f"{_root(path)}/{VERSIONS}/{part}"
    df.write.options(**(options or {})).parquet(folder)
    if check:
        try:
            check(spark.read.schema(df.schema).parquet(folder))
        except Exception:
            files.delete(spark, folder)
            raise
    return commit(spark, path, [part], base, keep, notes)


def restore(spark: SparkSession, path: str, number: int) -> Version:
    """Put a kept version in force again, as a new commit."""
    for version in versions(spark, path):
        if version.number == number:
            return commit(spark, path, list(version.parts), current(spark, path), notes={"restored": number})
    raise LookupError(f"{path} has no version {number}")


def prune(spark: SparkSession, path: str, keep: int = KEEP, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
    """Drop commits beyond ``keep``, then parts that no commit names; returns the parts that went."""
    known = versions(spark, path)
    kept, gone = known[: max(1, keep)], known[max(1, keep) :]
    for version in gone:
        files.delete(spark, f"{_root(path)}/{POINTERS}/{_pointer(version.number)}")
    named = {part for v in kept for part in v.parts}
    left = {part for v in gone for part in v.parts}
    limit = time.time() * 1000 - orphan_hours * 3_600_000
    dropped = []
    for entry in files.entries(spark, f"{_root(path)}/{VERSIONS}"):
        if entry.name not in named and (entry.name in left or entry.modified_ms < limit):
            files.delete(spark, f"{_root(path)}/{VERSIONS}/{entry.name}")
            dropped.append(entry.name)
    return dropped
