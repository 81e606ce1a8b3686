"""Left lookups of level values that stay even when one level holds much of the rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1000


def table_bytes(table: DataFrame, key: str) -> int:
    """Estimated size of a lookup table in memory: texts by their bytes, arrays by their elements."""
    size = F.lit(16 * len(table.columns))
    for name, kind in table.dtypes:
        if kind == "string" or name == key:
            size = size + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
        elif kind.startswith("array"):
            size = size + 16 * F.greatest(F.coalesce(F.size(name), F.lit(0)), F.lit(0))
        elif kind == "vector":
            size = size + 8 * F.coalesce(F.size(vector_to_array(F.col(name))), F.lit(0))
    total = table.agg(F.sum(size)).first()[0]
    return int(total or 0)


def lookup(rows: DataFrame, table: DataFrame, key: str, rows_of: str | None = None,
           spread: str = "id", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left join of `rows` with `table` (unique `key`), which should be a written table.

    A table of checked small size is broadcast. Beyond that, `rows_of` names the column that says
    how many rows each key has: the keys with more than 1/1000 of all rows, at most 1000 of them,
    are broadcast, and only rows of the other keys meet the table by shuffle. Rows that are done
    already travel under keys that match nothing, spread by the hash of `spread`.
    """
    if table_bytes(table, key) <= limit:
        return rows.join(F.broadcast(table), key, "left")
    if rows_of is None:
        return rows.join(table, key, "left")
    values = [c for c in table.columns if c != key]
    total = table.agg(F.sum(rows_of).alias("n")).scalar()
    hot = table.filter(F.col(rows_of) * HOT_SHARE > total)
    cold = table.filter(F.col(rows_of) * HOT_SHARE <= total)
    hot_values = hot.select(key, F.struct(*values).alias("_hot"))
    cold_values = cold.select(F.col(key).alias("_key"), F.lit(0).alias("_slot"), F.struct(*values).alias("_cold"))
    met = rows.join(F.broadcast(hot_values), key, "left")
    done = F.col("_hot").isNotNull() | F.col(key).isNull()
    slotted = met.withColumns({
        "_key": F.when(~done, F.col(key)),
        "_slot": F.when(done, F.pmod(F.xxhash64(spread), F.lit(4096)) + 1).otherwise(0).cast("int"),
    })
    same = [slotted["_key"].eqNullSafe(cold_values["_key"]), slotted["_slot"] == cold_values["_slot"]]
    joined = slotted.join(cold_values, same, "left")
    picked = {v: F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")) for v in values}
    return joined.select(*[F.col(c) for c in rows.columns], *[c.alias(v) for v, c in picked.items()])
