"""Area and plot tables kept on shared storage, batch by batch.

The feature tables are small and written anew for each version. Vertices are only ever
added: a version holds those of the features it wrote, and a feature row names the version
its geometry is in, so only folders that hold something current are read. ``compact`` writes
them as one, ``vacuum`` deletes the others. A version counts once its row in ``commits`` is there, so a batch that
failed half-way leaves no trace, and a batch with a label is stored once however often it runs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from geotracks.plans import derive
from geotracks.plans.importer import LEVEL_KEYS, Features, ImportResult
from geotracks.sources import files

DERIVATIONS = ("convex", "concave", "polygon")

_VERTICES = "fid long, line_no int, pt_no long, x double, y double, version int, kind string"


class TrackStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def version(self) -> int | None:
        """Latest whole version; None in a new store."""
        return self._latest("commits")

    def has_batch(self, label: str) -> bool:
        """True if a batch with this label was stored."""
        commits = self._marks("commits")
        return commits is not None and not commits.where(F.col("label") == label).isEmpty()

    def features(self, level: str) -> Features | None:
        """Current areas or plots."""
        version = self.version()
        if version is None:
            return None
        stored = self._stored(level, version)
        places = stored.select("fid", F.col("geom_version").alias("version"))
        # At most one version for each commit since the last compaction: other folders are not read.
        live = [v for (v,) in places.select("version").distinct().collect() if v is not None]
        stored_vertices = self.spark.read.schema(_VERTICES).parquet(f"{self.base}/vertices")
        vertices = stored_vertices.where((F.col("kind") == level) & F.col("version").isin(live))
        current = vertices.join(places, ["fid", "version"], "left_semi")
        return Features(
            stored.drop("geom_version"), current.select("fid", "line_no", "pt_no", "x", "y")
        )

    def commit(self, result: ImportResult, label: str | None = None) -> int:
        """Store what a batch changed as the next version, and return its number."""
        last = self.version()
        version = 0 if last is None else last + 1
        result.fresh_vertices.write.mode("overwrite").partitionBy("kind").parquet(
            f"{self.base}/vertices/version={version}"
        )
        for level in LEVEL_KEYS:
            table = result.level(level).table
            touched = result.changed.where(F.col("kind") == level)
            versioned = table.join(touched.select("fid", F.lit(version).alias("_new")), "fid", "left")
            place = F.col("_new")
            if last is not None:
                before = self._stored(level, last).select("fid", "geom_version")
                versioned = versioned.join(before, "fid", "left")
                place = F.coalesce("_new", "geom_version")
            versioned.select(*table.columns, place.cast("int").alias("geom_version")).write.mode(
                "overwrite"
            ).parquet(f"{self.base}/{level}/version={version}")
        result.rejects.write.mode("overwrite").parquet(f"{self.base}/rejects/version={version}")
        self._mark("commits", version, label)
        return version

    def compact(self) -> int | None:
        """Write all current vertices together, as a version of its own.

        Reading then takes one folder of vertices, whatever the number of batches before. The
        features are the same. None in a new store.
        """
        last = self.version()
        if last is None:
            return None
        version = last + 1
        for level in LEVEL_KEYS:
            self.features(level).vertices.write.mode("overwrite").parquet(
                f"{self.base}/vertices/version={version}/kind={level}"
            )
            place = F.when(F.col("geom_version").isNotNull(), version).cast("int")
            self._stored(level, last).withColumn("geom_version", place).write.mode(
                "overwrite"
            ).parquet(f"{self.base}/{level}/version={version}")
        self._mark("commits", version)
        return version

    def vacuum(self) -> list[str]:
        """Delete the folders that the current version does not need, and return their names.

        Rejects stay. What the derivations were last made of stays too.
        """
        version = self.version()
        if version is None:
            return []
        needed = {name: {version} for name in LEVEL_KEYS}
        needed["vertices"] = set()
        for level in LEVEL_KEYS:
            places = self._stored(level, version).select("geom_version").distinct().collect()
            needed["vertices"] |= {v for (v,) in places}
            for kind in DERIVATIONS:
                needed[f"{level}_{kind}"] = {self._latest(f"{level}_refreshed")}
        gone = []
        for table, versions in needed.items():
            for folder in files.children(self.spark, f"{self.base}/{table}"):
                number = folder.removeprefix("version=")
                if number.isdigit() and int(number) not in versions:
                    files.delete(self.spark, f"{self.base}/{table}/{folder}")
                    gone.append(f"{table}/{folder}")
        return gone

    def refresh(self, level: str = "all") -> bool:
        """Rebuild the stored derivations of a level, or of both.

        False when there is nothing to derive from. Readers see the old ones until all of a
        level's derivations are written.
        """
        levels = list(LEVEL_KEYS) if level == "all" else [level]
        version = self.version()
        if version is None:
            return False
        for name in levels:
            if self._latest(f"{name}_refreshed") == version:
                continue
            features = self.features(name)
            polygon = derive.polygon if name == "area" else derive.plot_polygon
            tables = {
                "convex": derive.convex(features),
                "concave": derive.concave(features),
                "polygon": polygon(features),
            }
            for kind, table in tables.items():
                path = f"{self.base}/{name}_{kind}/version={version}"
                table.write.mode("overwrite").parquet(path)
            self._mark(f"{name}_refreshed", version)
        return True

    def derived(self, level: str, kind: str) -> DataFrame:
        """A stored derivation, as of the last refresh."""
        if kind not in DERIVATIONS:
            raise ValueError(f"kind must be one of {DERIVATIONS}")
        version = self._latest(f"{level}_refreshed")
        if version is None:
            raise ValueError(f"{level} derivations were never refreshed")
        return self.spark.read.parquet(f"{self.base}/{level}_{kind}/version={version}")

    def _stored(self, level: str, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{level}/version={version}")

    def _marks(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.schema("version int, label string").parquet(f"{self.base}/{name}")
        except AnalysisException as error:
            # any other failure must not pass for an empty store, which the next commit overwrites
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _latest(self, name: str) -> int | None:
        marks = self._marks(name)
        return None if marks is None else marks.agg(F.max("version")).collect()[0][0]

    def _mark(self, name: str, version: int, label: str | None = None) -> None:
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(version).cast("int").alias("version"), F.lit(label).cast("string").alias("label")
        )
        row.write.mode("append").parquet(f"{self.base}/{name}")
