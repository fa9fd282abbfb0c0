"""Tables in folders, changed by commits.

Rows are written to a new folder under the table's path, and then a numbered file under ``_commits`` names the
folders that make up the table from now on, the runs that wrote them and what else belongs to them. That file is
renamed into place, which fails where another writer has taken the number. So a job that fails midway changes
nothing, readers see one version or the next, and a run that is repeated finds itself among the committed ones.

Old versions stay readable until ``sweep`` deletes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

COMMITS = "_commits"
# Folders are named like those of a partition column, so that Spark reads several as one table.
COLUMN = "commit"
DATA = f"{COLUMN}="


@dataclass(frozen=True)
class Version:
    """What a commit says: the table's folders, the runs in it, and facts about it."""

    number: int
    folders: tuple[str, ...]
    runs: tuple[str, ...] = ()
    facts: Mapping[str, object] = field(default_factory=dict)


class _Files:
    """The few calls to the table's file system that Spark's readers and writers do not make."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self.path(path).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> dict[str, int]:
        """What is in the folder, and since when, in milliseconds."""
        if not self._fs.exists(self.path(folder)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(self.path(folder))}

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A whole file under a name that must be free; False where it is taken."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self._fs.create(self.path(draft))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(name).toUri(), self._conf)
        # No options: a file that is there already is not replaced.
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(self._fs.makeQualified(self.path(draft)), self._fs.makeQualified(self.path(name)), options)
        except Py4JJavaError as error:
            self._fs.delete(self.path(draft), False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
                return False
            raise
        return True

    def delete(self, folder: str) -> None:
        self._fs.delete(self.path(folder), True)


def _base(path: str) -> str:
    return path.rstrip("/")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    names = _Files(spark, path).names(f"{_base(path)}/{COMMITS}")
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A committed version, by default the last; None where there is none."""
    known = versions(spark, path)
    if not known or (number is not None and number not in known):
        return None
    at = known[-1] if number is None else number
    said = json.loads(_Files(spark, path).read(_commit_file(path, at)))
    return Version(at, tuple(said["folders"]), tuple(said["runs"]), said["facts"])


def _commit_file(path: str, number: int) -> str:
    return f"{_base(path)}/{COMMITS}/{number:020d}.json"


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], Mapping[str, object] | None],
    run: str | None = None,
    keep: bool = True,
) -> Version:
    """Commit what ``write`` puts into the folder it is given, and the facts that it returns.

    With ``keep`` the table's folders stay beside the new one; without, the new one replaces them. A ``run``
    that is committed already writes nothing. Several writers may commit at a time: each adds to, or
    replaces, what is there when its own turn comes.
    """
    files = _Files(spark, path)
    before = version(spark, path)
    if before and run in before.runs:
        return before
    folder = f"{DATA}{uuid.uuid4().hex}"
    facts = write(f"{_base(path)}/{folder}") or {}
    while True:
        before = version(spark, path)
        if before and run in before.runs:
            # The same run, started twice, came first from elsewhere.
            files.delete(f"{_base(path)}/{folder}")
            return before
        kept = before if before and keep else Version(before.number if before else 0, ())
        runs = kept.runs if run is None else (*kept.runs, run)
        after = Version(kept.number + 1, (*kept.folders, folder), runs, facts)
        said = {"folders": after.folders, "runs": after.runs, "facts": dict(after.facts)}
        if files.create(_commit_file(path, after.number), json.dumps(said)):
            return after


def write_table(
    df: DataFrame, path: str, run: str | None = None, keep: bool = True, partition_by: Sequence[str] = ()
) -> Version:
    """Append ``df`` to a committed table, or with ``keep`` off replace the table by it."""

    def write(folder: str) -> None:
        df.write.partitionBy(*partition_by).parquet(folder) if partition_by else df.write.parquet(folder)

    return publish(df.sparkSession, path, write, run, keep)


def folders(spark: SparkSession, path: str, number: int | None = None) -> list[str]:
    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"{path}: no committed version" if number is None else f"{path}: no version {number}")
    return [f"{_base(path)}/{name}" for name in found.folders]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, number: int | None = None) -> DataFrame:
    """A committed table as of its last version, or of the one asked for."""
    reader = spark.read.option("basePath", _base(path))
    found = (reader.schema(schema) if schema else reader).parquet(*folders(spark, path, number))
    return found.select(schema.names) if schema else found.drop(COLUMN)


def sweep(spark: SparkSession, path: str, keep: int = 2, hours: float = 24) -> list[str]:
    """Delete folders that none of the last ``keep`` versions names and that are older than ``hours``.

    Younger ones may belong to a writer that has not committed yet. Returns their names.
    """
    files, known = _Files(spark, path), versions(spark, path)
    used = {name for number in known[-keep:] for name in version(spark, path, number).folders}
    for number in known[:-keep]:
        files.delete(_commit_file(path, number))
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    gone = [
        name
        for name, since in files.names(_base(path)).items()
        if name.startswith(DATA) and name not in used and now - since >= hours * 3_600_000
    ]
    for name in gone:
        files.delete(f"{_base(path)}/{name}")
    return gone
