"""Zip archives of csv chunks made from a table, as input for the archive scan."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from launchcohort.sources.snapshots import USED_COLUMNS, file_system


def write_archives(df: DataFrame, folder: str) -> DataFrame:
    """Every task writes one archive with a csv member per batch of its rows; (path, members).

    A repeated task writes the same archive again, so a lost executor does no harm.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"{folder}/archive_{TaskContext.get().partitionId():06d}.zip"
        fs, path = file_system(name)
        fs.create_dir(path.rsplit("/", 1)[0])
        n = 0
        with fs.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for n, b in enumerate(batches, 1):
                z.writestr(f"chunk{n - 1:04d}.csv", b.to_csv(index=False))
        yield pd.DataFrame({"path": [name], "members": [n]})

    columns = [c for c in USED_COLUMNS if c in df.columns]
    return df.select(*columns).mapInPandas(write, "path string, members int")
