"""Outputs of several tables that appear together, and tell whether they are whole.

Every version of an output names, per table, the folders that hold its rows, how many rows
they have and a checksum that doesn't depend on their order. Tables are written first, into
folders of their own, and become visible with the manifest, all at once; earlier versions stay
readable. Counts and checksums are observed while the rows are written, so they cost no pass.
"""

from __future__ import annotations

import json
import re
import uuid
import warnings
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.sources.manifest import Manifest, StaleVersion

_MODULUS = 1 << 64


class NoTable(LookupError):
    """The version, or the table in it, does not exist."""


@dataclass(frozen=True)
class Loaded:
    """Rows of a table, and why there are none where it could not be read."""

    rows: DataFrame
    reason: str | None = None


def _seal(columns: list[str]) -> list[Column]:
    """Count and order-independent checksum of rows: the sum of their hashes."""
    hashed = F.xxhash64(*columns).cast("decimal(20,0)") if columns else F.lit(0).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(hashed), F.lit(0)).cast("string").alias("checksum")]


class VersionedOutput:
    """The versions under ``path``; ``keep`` of them stay readable."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 1000) -> None:
        self.spark, self.path = spark, path
        self.manifest = Manifest(spark, f"{path}/versions", keep)

    def latest(self) -> int:
        """Number of the latest version; 0 before the first."""
        return self.manifest.read()[0]

    def write(self, df: DataFrame) -> dict:
        """Write rows into a folder that no version names yet; returns what a version says of it."""
        folder = f"data/{uuid.uuid4().hex}"
        seen = Observation()
        df.observe(seen, *_seal(df.columns)).write.parquet(f"{self.path}/{folder}")
        return {"folder": folder, "rows": seen.get["rows"], "checksum": int(seen.get["checksum"]) % _MODULUS, "schema": df.schema.json()}

    def publish(self, tables: dict[str, list[dict]], after: int | None = None, notes: dict | None = None) -> int:
        """Make what :meth:`write` returned the next version's tables; those not named stay as
        they are in the version before. With ``after``, raises :class:`StaleVersion` where
        that is no longer the latest."""
        version, held = self.manifest.read()
        if after is not None and after != version:
            raise StaleVersion(f"version {version} of {self.path} is later than {after}")
        made = {"tables": {**held.get("tables", {}), **tables}, "notes": {**held.get("notes", {}), **(notes or {})}}
        version = self.manifest.commit(version, made)
        self._forget()
        return version

    def _forget(self) -> None:
        """Remove versions that are no longer kept, and the folders that only they name."""
        gone = {p["folder"] for held in self.manifest.forget() for parts in held["tables"].values() for p in parts}
        if gone:
            held = [self.manifest.read(v)[1] for v in self.manifest.versions()]
            gone -= {p["folder"] for h in held for parts in h["tables"].values() for p in parts}
        for folder in gone:
            self.manifest.remove(f"{self.path}/{folder}")

    def save(self, **tables: DataFrame) -> int:
        """Write tables and publish them together."""
        return self.publish({name: [self.write(df)] for name, df in tables.items()})

    def notes(self, version: int | None = None) -> dict:
        return self.manifest.read(version)[1].get("notes", {})

    def parts(self, name: str, version: int | None = None) -> list[dict]:
        """What the version says of a table's folders."""
        found, held = self.manifest.read(version)
        if name not in held.get("tables", {}):
            raise NoTable(f"{name} in version {found} of {self.path}")
        return held["tables"][name]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """Rows of a table in a version, the latest by default."""
        return self.rows_of(self.parts(name, version))

    def rows_of(self, parts: list[dict]) -> DataFrame:
        """Rows of written folders."""
        schema = T.StructType.fromJson(json.loads(parts[0]["schema"]))
        folders = [f"{self.path}/{p['folder']}" for p in parts]
        return self.spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(*folders)

    def damage(self, name: str, version: int | None = None) -> str | None:
        """Why a table is not what was written, found out in one pass over it; None if it is."""
        parts = self.parts(name, version)
        try:
            rows = self.rows_of(parts)
            seen = rows.agg(*_seal(rows.columns)).first()
        except (PySparkException, Py4JJavaError) as error:
            # only what the files are at fault for; a lost cluster, say, is no damage
            found = re.search("FAILED_READ_FILE[.A-Z_]*|PATH_NOT_FOUND", str(error))
            if not found:
                raise
            return f"unreadable: {found[0]}"
        if seen["rows"] != sum(p["rows"] for p in parts):
            return f"{seen['rows']} rows instead of {sum(p['rows'] for p in parts)}"
        if int(seen["checksum"]) % _MODULUS != sum(p["checksum"] for p in parts) % _MODULUS:
            return "the checksum differs"
        return None

    def load(self, name: str, schema: T.StructType | str) -> Loaded:
        """A table as an earlier run's output: without rows, and with the reason, where it is
        missing or damaged. A reason is also given out as a warning."""
        try:
            reason = self.damage(name)
        except NoTable:
            return Loaded(self.spark.createDataFrame([], schema))
        if reason is None:
            return Loaded(self.read(name))
        warnings.warn(f"{name} under {self.path} counts as absent: {reason}", stacklevel=2)
        return Loaded(self.spark.createDataFrame([], schema), reason)
