"""The narrow target table: fixed schema with column comments, stored as one
parquet folder per version.

A run reads version *n* and writes the complete next state as version
*n+1* into its own folder, so a table is never overwritten by a query that
reads it, a failed job leaves the current version intact and earlier
versions stay readable for change feeds until they are expired.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.functions.answers import SCORE_COLUMNS
from dealscope.session import freed_shuffles
from dealscope.settings import DIMENSIONS

_COMMENTS = {
    "usecase_id": "Primary key: use case identifier of the source",
    "last_modified_date": "Change date of the source row (detects updates)",
    "processed_date": "Date the row was last enriched (the watermark column)",
    "competition_string": "Competition text carried from the source for inference",
    "num_of_blockers": "Number of blockers carried from the source",
    "context": "Summary of notes, impact, outcome, contact and funding",
    "one_liner": "One-line summary of the business objective",
    "next_steps_summary": "Summary of the next steps",
    "implementation_notes_summary": "Summary of the implementation notes",
    "blockers_summary": "Summary of the latest blocker",
    "usecase_type": "Technical category from a closed label set",
    "business_usecase_type": "Short business label",
    "soundbyte": "One-sentence executive pitch",
    "ai_confidence_score_advanced": "Raw structured assessment answer",
    "confidence_score": "Parsed confidence score 0-100 (after the blocker override)",
    "confidence_level": "Self-reported level (High, Medium, Low)",
    "rationale_for_confidence_score": "Parsed rationale",
    "confidence_level_normalized": "Level from score thresholds (High, Medium, Low, Not computed)",
    "next_best_action_recommendation": "Recommended next action and its rationale",
    "likely_to_slip": "True when the normalised level is Medium",
    "slippage_category": "Main slippage reason from a closed label set",
    "can_be_accelerated": "True when the normalised level is Medium or High",
    "accel_category": "Main acceleration lever from a closed label set",
}
for _d, _c in zip(DIMENSIONS, SCORE_COLUMNS):
    _COMMENTS[_c] = f"Parsed {_d} dimension score 0-10"

_TYPES = {
    "usecase_id": T.StringType(), "last_modified_date": T.DateType(), "processed_date": T.DateType(),
    "competition_string": T.StringType(), "num_of_blockers": T.LongType(),
    "confidence_score": T.IntegerType(), "likely_to_slip": T.BooleanType(), "can_be_accelerated": T.BooleanType(),
    **{c: T.IntegerType() for c in SCORE_COLUMNS},
}


def target_schema() -> T.StructType:
    from dealscope.operators.enrich import ENRICHED_COLUMNS
    return T.StructType([
        T.StructField(c, _TYPES.get(c, T.StringType()), nullable=(c != "usecase_id"),
                      metadata={"comment": _COMMENTS[c]})
        for c in ENRICHED_COLUMNS
    ])


def conform(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Project ``df`` onto the target schema by name (types cast, comments
    attached) -- the ``UPDATE SET * / INSERT *`` contract."""
    schema = schema or target_schema()
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])


class VersionedTable:
    """Versioned parquet table at ``path`` (a shared, cluster-visible URI).

    Every version is a folder ``v=00000001`` of its own, valid only with the
    ``_SUCCESS`` marker in it; versions are found by listing folder names, so
    no data file is opened and a half-written version is never current.

    A writer claims its folder by creating a file that must not exist yet, so
    no two writers share one.  What makes a version count is a second such
    file, named after the version that it follows: of several writers that
    started from the same version, the first one succeeds and the others are
    told so, and no committed row is lost.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema or target_schema()

    # -- files ------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version:08d}"

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the sub-folders ``<prefix><number>`` of a folder, ascending."""
        fs = self._fs()
        if not fs.exists(self._path(folder)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._path(folder)) if s.isDirectory()]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())

    def _create(self, name: str, content: str = "") -> bool:
        """Create a file that must not exist yet; False if it does."""
        try:
            out = self._fs().create(self._path(name), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(content.encode()))
        out.close()
        return True

    # -- versions -----------------------------------------------------------

    def versions(self) -> list[int]:
        """Committed versions in ascending order."""
        fs = self._fs()
        return [v for v in self._numbers(self.path, "v=") if fs.exists(self._path(self._folder(v) + "/_SUCCESS"))]

    def exists(self) -> bool:
        return bool(self.versions())

    def current_version(self) -> int:
        current = max(self.versions(), default=0)
        # a writer that ended between its commit and the marker: the commit holds, so set the marker
        after = self._path(self._after(current))
        if self._fs().exists(after):
            stream = self._fs().open(after)
            follower = int(bytes(stream.readNBytes(32)).decode())
            stream.close()
            if self._fs().exists(self._path(self._folder(follower))):
                self._create(self._folder(follower) + "/_SUCCESS")
                return max(self.versions(), default=0)
        return current

    def _after(self, version: int) -> str:
        return f"{self.path}/_commits/after-{version:08d}"

    def _claim(self, current: int | None) -> int:
        """The number of a folder that no other writer has used, left-overs of crashed runs included."""
        version = 0 if current is None else current + 1
        while self._fs().exists(self._path(self._folder(version))) or \
                not self._create(f"{self.path}/_commits/claim-{version:08d}"):
            version += 1
        return version

    def _write(self, df: DataFrame, folder: str, *partition_by: str) -> None:
        """Write files without Spark's marker: the version counts only once it is committed."""
        writer = df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        with freed_shuffles(self.spark):
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)

    def _commit(self, version: int, after: int | None) -> int:
        if after is not None and not self._create(self._after(after), str(version)):
            raise RuntimeError(f"another writer has committed a version after version {after}")
        if not self._create(self._folder(version) + "/_SUCCESS") and after is None:
            raise RuntimeError(f"version {version} exists already")
        return version

    def create_if_missing(self) -> bool:
        """Create an empty table unless one exists; True if created.  Its
        version is 0, or the next number that no half-written folder holds."""
        if self.exists():
            return False
        self._commit(self._write_whole(self.spark.createDataFrame([], self.schema), self._claim(None)), None)
        return True

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        return self.spark.read.schema(self.schema).parquet(self._folder(v))

    def _write_whole(self, df: DataFrame, version: int) -> int:
        self._write(conform(df, self.schema), self._folder(version))
        return version

    def _expected(self, expected: int | None) -> int:
        current = self.current_version()
        if expected is not None and current != expected:
            raise RuntimeError(f"table moved from version {expected} to {current} during the run")
        return current

    def write_next(self, df: DataFrame, expected_version: int | None = None) -> int:
        """Write the complete next state as a new version; returns it.

        A folder without its marker, left by a crashed run, is skipped: the
        version after it is written."""
        current = self._expected(expected_version)
        return self._commit(self._write_whole(df, self._claim(current)), current if self.exists() else None)

    def expire(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed versions; returns the deleted ones."""
        old = self.versions()[:-keep] if keep > 0 else []
        for v in old:
            self._fs().delete(self._path(self._folder(v)), True)
        return old
