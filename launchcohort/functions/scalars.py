"""Row-level column expressions. All stay inside code generation; none needs Python workers."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400
UNKNOWN = "unknown"

# Texts a CSV reader of the pandas kind takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Final states and the label each stands for.
FINAL_STATES = {"successful": 1, "failed": 0}

# Text forms taken as a number; anything else is missing.
NUMBER = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"

# Unicode white space, written out so that every regex engine reads the same class.
SPACE = (r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# The same and its opposite for Spark's regex engine, which tries the ranges of a class one by one: visible
# ASCII, most of a text, is settled by the first.
SPACES = rf"[[^!-~]&&[{SPACE}]]"
NO_SPACES = rf"[!-~[^{SPACE}]]"


def missing_to_null(col: Column) -> Column:
    """NULL for the texts in `NULL_TOKENS`."""
    return F.when(~col.isin(NULL_TOKENS), col)


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{SPACES}+|{SPACES}+$", "")


def json_field(col: Column, field: str) -> Column:
    """Text field of a JSON object; 'unknown' when the JSON or the field is missing or broken.

    Read as the only element of a list, so that nothing may follow the object.
    """
    parsed = F.from_json(F.concat(F.lit("["), col, F.lit("]")), "array<struct<name:string,slug:string,type:string>>", {"allowSingleQuotes": "false"})
    whole = col.rlike(r"^[ \t\n\r]*\{(?s:.*)\}[ \t\n\r]*$") & (F.size(parsed) == 1)
    return F.coalesce(F.when(whole, F.get(parsed, F.lit(0))[field]), F.lit(UNKNOWN))


def parent_of_slug(slug: Column) -> Column:
    """'Games/Tabletop' -> 'games'."""
    return F.lower(strip(F.split(slug, "/", -1)[0]))


def to_number(col: Column) -> Column:
    """Double, or NULL where the text is no number."""
    text = col.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def to_whole(col: Column) -> Column:
    """Long, cut towards zero, or NULL where the text is no number, not finite or too large."""
    number = to_number(col)
    return F.when(F.abs(number) < 9.2e18, number.try_cast("bigint"))


def label(state: Column) -> Column:
    out = None
    for name, value in FINAL_STATES.items():
        out = F.when(state == name, value) if out is None else out.when(state == name, value)
    return out.cast("int")


def log_goal(goal_usd: Column) -> Column:
    return F.log1p(goal_usd)


def launch_date(epoch: Column) -> Column:
    """UTC date of epoch seconds, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(epoch / F.lit(DAY)).cast("int"))


def epoch_of(day: str | None) -> int | None:
    """'YYYY-MM-DD' -> epoch seconds at 00:00 UTC; None passes."""
    if day is None:
        return None
    return int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp())


def epoch_of_date(day: Column) -> Column:
    """The column form of `epoch_of`."""
    return F.unix_date(F.to_date(day)).cast("bigint") * F.lit(DAY)


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"{NO_SPACES}+"), F.lit(0)))


def sentences(text: Column) -> Column:
    """Parts after '.', '!' or '?' and white space; the whole text when nothing is left."""
    parts = F.filter(F.split(strip(text), f"(?<=[.!?]){SPACES}+", -1), lambda s: s != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(text))


def key_hash(key: Column, seed: int) -> Column:
    """32-bit number from (seed, key), equal on every engine that has md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def verdict(probability: Column) -> Column:
    return F.when(probability >= 0.5, "Likely to reach its goal").otherwise("More likely to fall short")


def band(probability: Column) -> Column:
    return F.when(probability >= 0.5, "good").when(probability >= 0.35, "mid").otherwise("bad")
