"""Publishing in one step: what readers see before, between and after."""

import pytest
from pyspark.sql import functions as F

from cyclemill.plans import experiment
from cyclemill.sources import batches, series
from cyclemill.sources.versions import Versions


@pytest.fixture
def log(spark):
    rows = [(i, c, float(c), float(i), 9 - c, int(c > 6), int(c > 6)) for i in range(1, 8) for c in range(1, 10)]
    return spark.createDataFrame(rows, "id long, cycle long, wear double, noise double, RUL long, label1 long, label2 long")


def rows_of(spark, path):
    return {p: sorted((r["id"], r["first_pos"], tuple(r["x"])) for r in batches.read_batches(spark, path, p).collect())
            for p in ("train", "val", "test")}


class Killed(Exception):
    pass


def killed(*_):
    raise Killed


@pytest.mark.parametrize("where", ["write", "publish", "rename"])
def test_a_failed_ingestion_leaves_the_old_rows(spark, log, tmp_path, monkeypatch, where):
    path = str(tmp_path / "batches")
    experiment.ingest(log, log, path, ["wear"], "RUL", rescale=False)
    before = rows_of(spark, path)
    doubled = log.withColumn("wear", F.col("wear") * 2)
    with monkeypatch.context() as m:
        if where == "write":  # the rows are there in part
            m.setattr(batches, "write_batches", lambda rows, at: (rows.where("id < 3").write.parquet(at), killed()))
        elif where == "publish":
            m.setattr(Versions, "publish", killed)
        else:  # the manifest is written, not yet renamed
            m.setattr(Versions, "_at", lambda self, p, real=Versions._at: killed() if "manifest-0000000002" in p else real(self, p))
        with pytest.raises(Killed):
            experiment.ingest(doubled, doubled, path, ["wear"], "RUL", rescale=False)
    assert rows_of(spark, path) == before
    experiment.ingest(doubled, doubled, path, ["wear"], "RUL", rescale=False)
    after = rows_of(spark, path)
    assert after != before and {p: len(r) for p, r in after.items()} == {p: len(r) for p, r in before.items()}
    # of the failed attempt nothing is left
    assert len(list((tmp_path / "batches").glob("data-*"))) == 2 and not list((tmp_path / "batches").glob(".pending-*"))


def test_a_version_got_before_stays_whole(spark, log, tmp_path):
    path = str(tmp_path / "batches")
    experiment.ingest(log, log, path, ["wear"], "RUL", rescale=False)
    held = Versions(spark, path).current()
    train = batches.read_batches(spark, path, "train", held)
    want = sorted(map(str, train.collect()))
    doubled = log.withColumn("wear", F.col("wear") * 2)
    experiment.ingest(doubled, doubled, path, ["wear"], "RUL", rescale=False)
    assert sorted(map(str, batches.read_batches(spark, path, "train", held).collect())) == want
    assert sorted(map(str, batches.read_batches(spark, path, "train").collect())) != want


def test_versions_are_kept_and_collected(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.current() == {}
    versions.collect()  # of nothing
    places = []
    for k in range(4):
        place = versions.fresh()
        spark.range(k + 1).write.parquet(place)
        versions.publish({"a" if k else "b": place})  # b stays with the first
        places.append(place)
    lost = versions.fresh()
    spark.range(1).write.parquet(lost)
    assert versions.current() == {"a": places[3], "b": places[0]}
    versions.collect()
    left = {p.name for p in (tmp_path / "v").iterdir()}
    data = {n for n in left if n.startswith("data-")}
    assert data == {p.rsplit("/", 1)[-1] for p in (places[0], places[2], places[3])}
    assert sorted(n for n in left if n.startswith("manifest-")) == ["manifest-0000000003", "manifest-0000000004"]
    assert [spark.read.parquet(versions.current()[p]).count() for p in "ab"] == [4, 1]


def test_a_table_without_versions_is_read_as_it_is(spark, log, tmp_path):
    path = str(tmp_path / "plain")
    table = log.withColumn("batch_id", F.col("cycle") % 2).withColumn("phase", F.lit("train"))
    batches.write_batches(table, path)
    assert batches.read_batches(spark, path, "train").count() == table.count()


def test_features_and_labels_change_together(spark, log, tmp_path, monkeypatch):
    folder = str(tmp_path / "series")
    series.publish_series(log, folder, "train", buckets=3)
    schema = log.drop("RUL", "label1", "label2").schema
    with monkeypatch.context() as m:
        m.setattr(Versions, "publish", killed)
        with pytest.raises(Killed):
            series.publish_series(log.where("id = 1"), folder, "train", buckets=3)

    def count():
        place = series.published(spark, folder, "train")
        return series.read_series(spark, place, "train", "features", schema, buckets=3).count()

    assert count() == 63
    series.publish_series(log.where("id = 1"), folder, "train", buckets=3)
    assert count() == 9
