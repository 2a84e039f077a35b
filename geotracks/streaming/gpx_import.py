"""Continuous import of GPX files from a landing folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from geotracks.plans.importer import import_tracks
from geotracks.schemas import TRACK_VERTICES
from geotracks.session import materialize
from geotracks.sources.files import children
from geotracks.sources.gpx import file_ends, literal_path, split_gpx, store_rows, stream_gpx_rows
from geotracks.sources.store import TrackStore


def import_batch(
    store: TrackStore, vertices: DataFrame, label: str | None = None, keep_clazz: bool = False
) -> bool:
    """Upsert one batch of track vertices into the store.

    A batch whose label is in the store already is skipped, so a replay changes nothing.
    """
    if label is not None and store.has_batch(label):
        return False
    result = import_tracks(vertices, store.features("area"), store.features("plot"), keep_clazz)
    if result.status:
        store.commit(result, label)
    return result.status


def stream_gpx(
    spark: SparkSession,
    folder: str,
    store: TrackStore,
    checkpoint: str,
    files_per_batch: int | None = None,
    keep_clazz: bool = False,
) -> StreamingQuery:
    """Import every GPX file now in ``folder`` not imported before, then stop.

    Run it again for files that came later. ``TrackStore.refresh`` rebuilds the derivations.
    A batch is known to the store by the query's id and its number. Broken files are listed
    in ``broken_files`` of the store by both.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = store_rows(batch)
        # names of one batch's files, which the driver listed before
        paths = [literal_path(r.src) for r in rows.select("src").distinct().collect()]
        if not paths:
            return
        stream = query_id(spark, checkpoint)
        vertices, broken = split_gpx(rows, file_ends(spark, paths))
        broken.write.mode("overwrite").parquet(f"{store.base}/broken_files/query={stream}/batch={batch_id}")
        import_batch(store, vertices, f"{stream} {batch_id}", keep_clazz)

    return _start(stream_gpx_rows(spark, folder, files_per_batch), handle, checkpoint)


def stream_vertices(
    spark: SparkSession,
    folder: str,
    store: TrackStore,
    checkpoint: str,
    keep_clazz: bool = False,
    totals: str | None = None,
) -> StreamingQuery:
    """The same for parquet files of track vertices, where a track may span many rows.

    ``totals`` is a folder of parquet rows (src, ogc_fid, parts, points): what each track has in
    all. A track is then held in the store until all of it is there, in whatever batches its
    vertices came, and imported with the batch that makes it whole.

    Without it a batch must hold its tracks whole: the points of each part number 1 to n. Other
    tracks are not imported but listed in ``broken_tracks`` of the store. Files that arrive
    together are one batch, so a track may span those.
    """
    rows = spark.readStream.schema(TRACK_VERTICES).parquet(folder)

    def release(batch: DataFrame, batch_id: int) -> None:
        stream = query_id(spark, checkpoint)
        held = f"{store.base}/held/query={stream}"
        # A replayed batch finds what the one before it held, and holds the same again.
        before = _read(spark, f"{held}/batch={batch_id - 1}", TRACK_VERTICES)
        together = materialize(batch if before is None else batch.unionByName(before))
        whole = materialize(_whole_tracks(together, _read(spark, totals, _TOTALS)))
        same = F.col("src").eqNullSafe(F.col("_src")) & F.col("ogc_fid").eqNullSafe(F.col("_fid"))
        together.join(whole, same, "left_anti").write.mode("overwrite").parquet(f"{held}/batch={batch_id}")
        import_batch(store, together.join(whole, same, "left_semi"), f"{stream} {batch_id}", keep_clazz)

    def handle(batch: DataFrame, batch_id: int) -> None:
        stream = query_id(spark, checkpoint)
        cut = materialize(cut_tracks(batch))
        cut.write.mode("overwrite").parquet(f"{store.base}/broken_tracks/query={stream}/batch={batch_id}")
        whole = batch.join(
            cut.select(F.col("src").alias("_src"), F.col("ogc_fid").alias("_fid")),
            F.col("src").eqNullSafe(F.col("_src")) & F.col("ogc_fid").eqNullSafe(F.col("_fid")),
            "left_anti",
        )
        import_batch(store, whole, f"{stream} {batch_id}", keep_clazz)

    return _start(rows, handle if totals is None else release, checkpoint)


_TOTALS = "src string, ogc_fid long, parts int, points long"


def held_tracks(spark: SparkSession, store: TrackStore, checkpoint: str) -> DataFrame:
    """(src, ogc_fid, points) of the tracks that are held after the stream's last batch."""
    folder = f"{store.base}/held/query={query_id(spark, checkpoint)}"
    batches = [int(name.removeprefix("batch=")) for name in children(spark, folder)]
    rows = spark.read.schema(TRACK_VERTICES).parquet(f"{folder}/batch={max(batches)}")
    return rows.groupBy("src", "ogc_fid").agg(F.count("*").alias("points"))


def _whole_tracks(vertices: DataFrame, totals: DataFrame | None) -> DataFrame:
    """(_src, _fid) of the tracks that have all the parts and points that are stated for them."""
    there = vertices.groupBy("src", "ogc_fid").agg(
        F.count_distinct("seg_no").alias("_parts"), F.count_distinct("seg_no", "pt_no").alias("_points")
    )
    keys = there.select(F.col("src").alias("_src"), F.col("ogc_fid").alias("_fid"), "_parts", "_points")
    if totals is None:
        return keys.select("_src", "_fid").limit(0)
    same = F.col("src").eqNullSafe(F.col("_src")) & F.col("ogc_fid").eqNullSafe(F.col("_fid"))
    full = (F.col("parts") == F.col("_parts")) & (F.col("points") == F.col("_points"))
    return keys.join(totals, same & full, "left_semi").select("_src", "_fid")


def _read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """Parquet rows of a folder, None if there is no such folder."""
    return spark.read.schema(schema).parquet(path) if children(spark, path) else None


def cut_tracks(vertices: DataFrame) -> DataFrame:
    """(src, ogc_fid, reason) of the tracks with a part whose points do not number 1 to n."""
    parts = vertices.groupBy("src", "ogc_fid", "seg_no").agg(
        F.count("*").alias("n"),
        F.count_distinct("pt_no").alias("numbers"),
        F.min("pt_no").alias("first"),
        F.max("pt_no").alias("last"),
    )
    whole = (F.col("first") == 1) & (F.col("last") == F.col("n")) & (F.col("numbers") == F.col("n"))
    return parts.where(~F.coalesce(whole, F.lit(False))).groupBy("src", "ogc_fid").agg(
        F.lit("track is not whole").alias("reason")
    )


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint folder; a new folder has a new one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _start(
    rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
