import os

from pyspark.sql import functions as F

from launchcohort.catalog import queries as Q
from launchcohort.sources import cache, snapshots, synthetic


def test_gzipped_snapshots_give_the_same_rows(spark, tmp_path):
    made = synthetic.make_synthetic(spark, 400, seed=5).withColumn("blurb", F.concat("blurb", F.lit('\n"it", said\r\n')))
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    synthetic.write_csv_snapshot(made, plain)
    synthetic.write_csv_snapshot(made, packed, compression="gzip")
    names = [n for n in os.listdir(packed) if n.endswith(".csv.gz")]
    assert names and not [n for n in os.listdir(packed) if n.endswith(".csv")]
    one, two = (sorted(map(tuple, snapshots.read_snapshots(spark, p).select(*snapshots.USED_COLUMNS).collect()), key=str) for p in (plain, packed))
    assert one == two and len(one) == 400
    # No file is too large for one task here, but where one is, it is still read whole.
    files = snapshots.list_files(spark, packed)
    assert snapshots.read_csv(spark, files, split_over=1).count() == 400
    table, stats = cache.load_dataset(spark, packed, cache=str(tmp_path / "cache"))
    assert table.count() == stats.first()["n_final"] > 0


def test_dump_is_stored_gzipped(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(Q.T, "campaigns_raw", lambda *args: None)
    monkeypatch.setattr(Q.synthetic, "write_csv_snapshot", lambda df, folder, order, compression="none": asked.append(compression))
    Q.dump(spark, "a gzipped dump")
    assert asked == ["gzip"] * 3
