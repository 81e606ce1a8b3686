"""Are the snapshot archives complete? Expected against found chunks and sizes."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchcohort.sources.snapshots import csv_members, open_file

SIZE_TOLERANCE = 0.02


def archive_facts(files: DataFrame) -> DataFrame:
    """(path, mb, valid_zip, chunks) for files (path, length); reads the archive directories only."""
    def facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            chunks = []
            for path in b["path"]:
                try:
                    with open_file(path) as handle, zipfile.ZipFile(handle) as z:
                        chunks.append(len(csv_members(z)))
                except (zipfile.BadZipFile, ValueError):  # no archive, or too short to be one
                    chunks.append(-1)
            yield pd.DataFrame({"path": b["path"], "length": b["length"], "chunks": chunks})

    spread = files.select("path", "length").repartition(max(1, files.count()), "path")
    found = spread.mapInPandas(facts, "path string, length bigint, chunks bigint")
    return found.select("path", (F.col("length") / F.lit(1 << 20)).alias("mb"), (F.col("chunks") >= 0).alias("valid_zip"),
                        F.when(F.col("chunks") >= 0, F.col("chunks")).alias("chunks"))


def verdicts(manifest: DataFrame, facts: DataFrame, key: str = "stamp") -> DataFrame:
    """manifest (stamp, expected_chunks, expected_mb) against facts (stamp, mb, valid_zip, chunks).

    Adds `ok` and `reason`. The chunk count is judged before the size; an expected count of NULL
    is not judged.
    """
    megabytes = F.bround("mb", 0).cast("bigint").cast("string")
    expected = F.bround("expected_mb", 0).cast("bigint").cast("string")
    short = F.col("expected_chunks").isNotNull() & (F.col("chunks") != F.col("expected_chunks"))
    off = F.abs(F.col("mb") - F.col("expected_mb")) / F.col("expected_mb") > SIZE_TOLERANCE
    reason = (
        F.when(F.col("valid_zip").isNull(), "not downloaded")
        .when(~F.col("valid_zip"), "not a valid zip")
        .when(short, F.concat(F.lit("truncated: "), F.col("chunks").cast("string"), F.lit(" csv chunks, expected "),
                              F.col("expected_chunks").cast("string")))
        .when(off, F.concat(F.lit("size "), megabytes, F.lit(" MB differs from expected "), expected, F.lit(" MB")))
        .otherwise(F.concat(F.col("chunks").cast("string"), F.lit(" chunks, "), megabytes, F.lit(" MB"))))
    ok = F.col("valid_zip").isNotNull() & F.col("valid_zip") & ~short & ~off
    return manifest.join(facts, key, "left").withColumns({"ok": F.coalesce(ok, F.lit(False)), "reason": reason})


def failures(judged: DataFrame) -> DataFrame:
    return judged.filter(~F.col("ok"))
