"""Files and folders of whatever file system a path is in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of ``path``, and the path in its form."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, place = file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it."""
    system, place = file_system(spark, path)
    system.delete(place, True)


def join(spark: SparkSession, folder: str, path: str) -> None:
    """Make one file of a folder's part files, in the order of their names; the folder goes.

    A file system that can append files to one another does so without moving a byte. Where
    it cannot, they are copied one after the other, through a buffer of fixed size.
    """
    system, place = file_system(spark, folder)
    hadoop = spark._jvm.org.apache.hadoop
    parts = [hadoop.fs.Path(f"{folder}/{name}") for name in children(spark, folder) if name.startswith("part-")]
    target = hadoop.fs.Path(path)
    system.delete(target, True)
    if system.hasPathCapability(place, "fs.capability.paths.concat"):
        rest = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(parts) - 1)
        for n, part in enumerate(parts[1:]):
            rest[n] = part
        if len(parts) > 1:
            system.concat(parts[0], rest)
        system.rename(parts[0], target)
    else:
        out = system.create(target, True)
        for part in parts:
            source = system.open(part)
            hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            source.close()
        out.close()
    system.delete(place, True)
