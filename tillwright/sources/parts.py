"""A folder of parts of which some are replaced at a time, all of a batch becoming visible at once."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillwright.session import commit_text, files_in, make_folder, read_text, remove_folder, subfolders

COMMITS = "commits"


@dataclass(frozen=True)
class Parts:
    """Rows in named parts. The file of the last committed batch has the folder of every part.

    Readers take the newest such file, so they see whole batches only, and go on with the files they began with.
    """

    folder: str
    schema: StructType

    def _last(self, spark: SparkSession) -> dict:
        names = [name for name in files_in(spark, f"{self.folder}/{COMMITS}") if name.endswith(".json")]
        return json.loads(read_text(spark, f"{self.folder}/{COMMITS}/{max(names)}")) if names else {"batch": -1, "parts": {}}

    def batch(self, spark: SparkSession) -> int:
        """Number of the last batch that counts, -1 before the first."""
        return self._last(spark)["batch"]

    def paths(self, spark: SparkSession) -> dict[str, str]:
        """The folder of every part."""
        return {part: f"{self.folder}/{place}" for part, place in self._last(spark)["parts"].items()}

    def read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        """The rows of some parts."""
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows after the last batch."""
        return self.read(spark, list(self.paths(spark).values()))

    def replace(self, spark: SparkSession, batch: int, df: DataFrame, column: str, parts: list | None = None, together: bool = False) -> list[str]:
        """Write rows parted by a column that is not stored, then let them stand for the given parts from now on, or for those they have.

        A given part without rows is empty from then on. The rows of a part are brought together for writing, where they are not
        ``together`` already; adaptive execution splits large ones. Returns the parts.
        """
        place = f"batch-{batch:012d}"
        rows = df if together else df.hint("rebalance", F.col(column))
        rows.write.mode("overwrite").partitionBy(column).parquet(f"{self.folder}/{place}")
        if parts is None:
            folders = [path.rsplit("/", 1)[1] for path in subfolders(spark, f"{self.folder}/{place}")]
            parts = sorted(unquote(name.removeprefix(f"{column}=")) for name in folders if name.startswith(f"{column}="))
        new = {str(part): f"{place}/{column}={part}" for part in parts}
        for path in new.values():
            make_folder(spark, f"{self.folder}/{path}")
        self._commit(spark, batch, new)
        return list(new)

    def _commit(self, spark: SparkSession, batch: int, new: Mapping[str, str]) -> None:
        make_folder(spark, f"{self.folder}/{COMMITS}")
        told = json.dumps({"batch": batch, "parts": self._last(spark)["parts"] | dict(new)})
        commit_text(spark, f"{self.folder}/{COMMITS}/{batch:012d}.json", told)

    def remove_replaced(self, spark: SparkSession) -> list[str]:
        """Delete folders that the last batch does not show; for when no reader is at an older one."""
        shown = [path.removeprefix(self.folder) for path in self.paths(spark).values()]
        gone = []
        for batch in subfolders(spark, self.folder):
            for path in subfolders(spark, batch):
                if "=" in path.rsplit("/", 1)[1] and not any(path.endswith(kept) for kept in shown):
                    remove_folder(spark, path)
                    gone.append(path)
        return gone
