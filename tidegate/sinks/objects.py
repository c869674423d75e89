"""Writing rows as separate named files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.large_files import open_store, qualified


def write_objects(objects: DataFrame, root: str) -> int:
    """Write each ``(key, content)`` row as the file ``root/key`` and return how many were written.

    Table writers choose their own file names; this one is for partners that
    expect a named file. Files are written by the tasks that hold the rows and
    a retried task writes the same bytes to the same name.
    """
    root = qualified(objects.sparkSession, root)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_store(root)
        for batch in batches:
            for key, content in zip(batch["key"], batch["content"]):
                path = f"{base}/{key}"
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path, compression=None) as out:
                    out.write(content)
            yield pd.DataFrame({"n": [len(batch)]})

    written = objects.select("key", "content").mapInPandas(write, "n bigint")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
