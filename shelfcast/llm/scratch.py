"""Tables that an operator wrote for itself and needs no more."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.durable import shared_folder


def discard(settled: DataFrame) -> None:
    """Delete a table that ``durable.settle`` wrote, once what was made of it is written too.

    Only folders below the shared folder go.  Nothing may read the table afterwards: a result
    that still depends on it could not be computed again after the loss of an executor.
    """
    spark = settled.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(shared_folder(spark))
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    inside = system.makeQualified(root).toString().rstrip("/") + "/"
    for folder in {name.rsplit("/", 1)[0] for name in settled.inputFiles()}:
        path = system.makeQualified(hadoop.Path(folder))
        if path.toString().startswith(inside):
            system.delete(path, True)
