"""Tokens and stop words."""

from __future__ import annotations

import glob
import os
import zipfile
from functools import lru_cache

import pyspark
from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of at least two letters, digits or underscores, of any script.
TOKEN = r"[\p{L}\p{N}_]{2,}"


@lru_cache
def english_stop_words() -> tuple[str, ...]:
    """Spark's own English list, read from the file Spark ships. Callers may pass another."""
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    (jar,) = glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar"))
    with zipfile.ZipFile(jar) as z:
        words = z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split("\n")
    return tuple(w for w in words if w)


def tokens(text: Column, stop_words: tuple[str, ...] | None = None) -> Column:
    """Lower-case tokens in text order, without stop words."""
    stops = english_stop_words() if stop_words is None else stop_words
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(list(stops))) if stops else found
