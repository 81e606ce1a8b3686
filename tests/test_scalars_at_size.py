"""Classes of white space that are quick on ASCII are those written out."""

from pyspark.sql import functions as F

from launchcohort.functions import scalars as S


def test_quick_classes_hold_the_same_characters(spark):
    ids = spark.range(0x30000).filter("id < 55296 or id >= 57344")  # no halves of pairs
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    same = ids.select(char.alias("c")).select(
        (F.col("c").rlike(f"^{S.SPACES}$") == F.col("c").rlike(f"^[{S.SPACE}]$")).alias("a"),
        (F.col("c").rlike(f"^{S.NO_SPACES}$") == F.col("c").rlike(f"^[^{S.SPACE}]$")).alias("b"), F.col("c").rlike(f"^{S.SPACES}$").alias("space"))
    got = same.agg(F.count_if(~F.col("a") | ~F.col("b")), F.count_if("space")).first()
    assert got[0] == 0 and got[1] > 20
