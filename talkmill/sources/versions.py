"""A store of several tables that change together: files are staged first, and one manifest of a new version publishes them all at once.

Readers resolve the newest manifest (or the one they ask for) and read the folders it names, so they see all tables of one version, also
while a batch is being written or after a writer was lost half-way. A version is published by a rename that fails if it is there already:
of two writers that began at the same version one is refused.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .files import Conflict, Files  # noqa: F401


@dataclass(frozen=True)
class Version:
    """What a manifest says: its number, the accepted total, and for each batch its facts and its folder for each table."""

    number: int = 0
    accepted_total: int = 0
    batches: list[dict] = field(default_factory=list)

    def folders(self, table: str) -> list[str]:
        return [b["folders"][table] for b in self.batches if table in b["folders"]]


class Store:
    """``schemas``: the tables' names and schemas, which also tell what an empty store looks like."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas
        self._files = Files(spark, self.root)

    def current(self) -> Version:
        names = self._files.names("_versions")
        return Version(**self._files.read(f"_versions/{names[-1]}")) if names else Version()

    def stage(self, table: str, rows: DataFrame, batch: str) -> str:
        """Writes a batch's rows of a table to their folder, anew if it was begun before; no reader sees it yet."""
        folder = f"{table}/{batch}"
        rows.write.mode("overwrite").parquet(f"{self.root}/{folder}")
        return folder

    def publish(self, base: Version, batch: str, folders: dict[str, str], added: int, **facts) -> Version:
        """The version after ``base``, with a batch more (in place of an earlier one of its name). Conflict if someone else was first."""
        entry = {"batch": batch, "folders": folders, "added": added, **facts}
        new = Version(base.number + 1, base.accepted_total + added, [b for b in base.batches if b["batch"] != batch] + [entry])
        self._files.create(f"_versions/{new.number:012d}.json", asdict(new))
        return new

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        """A table's rows as of a version, by default the newest one."""
        folders = (self.current() if version is None else version).folders(table)
        if not folders:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*(f"{self.root}/{f}" for f in folders))

    def read_folders(self, table: str, folders: list[str]) -> DataFrame:
        """Rows of folders that need not be published, for checks before they are."""
        return self.read(table, Version(batches=[{"batch": "", "folders": {table: f}} for f in folders]))

    def note(self, batch: str, phase: str, facts: dict) -> None:
        """Adds an entry to a batch's journal; Conflict if two do so at once."""
        seq = len(self.journal(batch))
        self._files.create(f"_journal/{batch}/{seq:06d}.json", {"batch": batch, "seq": seq, "phase": phase, "facts": facts})

    def journal(self, batch: str) -> list[dict]:
        """A batch's entries in order, a handful."""
        return [self._files.read(f"_journal/{batch}/{n}") for n in self._files.names(f"_journal/{batch}")]

    def journals(self) -> DataFrame:
        """All entries of all batches: batch, seq, phase, facts."""
        schema = "batch string, seq long, phase string, facts map<string,string>"
        if not self._files.names("_journal"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{self.root}/_journal")
