"""Published versions of tables and models."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import foldmodels as FM
from tidemark.sources import versions as V


def rows(spark, n, add=0):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") + add).alias("v"))


def test_readers_follow_the_manifest(spark, tmp_path):
    root = str(tmp_path / "t")
    assert V.latest(spark, root) is None
    with pytest.raises(FileNotFoundError):
        V.read(spark, root)
    assert V.replace(rows(spark, 5), root, {"note": "first"}).number == 1
    old = V.read(spark, root)
    assert V.upsert(rows(spark, 3, 100).unionByName(rows(spark, 8).where("k >= 5")), root, ["k"]).number == 2
    assert {r.k: r.v for r in V.read(spark, root).collect()} == {0: 100, 1: 101, 2: 102, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7}
    assert old.count() == 5 and V.read(spark, root, 1).count() == 5 and V.latest(spark, root).properties == {"note": "first"}
    assert [(r.number, r.row_count) for r in V.versions(spark, root).collect()] == [(1, 5), (2, 8)]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    V.replace(rows(spark, 4), root)
    broken = rows(spark, 4).withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        V.replace(broken, root)
    assert V.latest(spark, root).number == 1 and V.read(spark, root).count() == 4
    assert V.replace(rows(spark, 2), root).number == 2


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    root = str(tmp_path / "t")
    V.replace(rows(spark, 1), root)
    V.replace(rows(spark, 2), root, after=1)
    with pytest.raises(V.VersionTaken):
        V.replace(rows(spark, 3), root, after=1)
    assert V.read(spark, root).count() == 2


def test_a_loaded_model_scores_as_the_one_in_memory(spark, tmp_path):
    from test_foldmodels import CLASSES, NAMES, frame, panel

    df, root = frame(spark, panel(300)), str(tmp_path / "model")
    folds = FM.prefix_folds(df, ["k"], "d", NAMES, "y", CLASSES, FM.whole_cuts(["k"], 100))
    fitted = FM.fit(folds)
    names = [f"prob_{c}" for c in CLASSES]
    assert FM.save(folds, fitted, root).number == 1
    model, loaded = FM.load(spark, root)
    assert (model.features, model.classes) == (NAMES, CLASSES)
    score = lambda m, f: sorted(tuple(r) for r in FM.score_newest(m, f, df, "d", names).collect())
    got = score(model, loaded)
    assert got == score(folds, fitted) and len(got) == 2
    with pytest.raises(FileNotFoundError):
        FM.load(spark, root + "-none")
