"""The forest's rows are dealt out to all cores, however few files they come from."""

from casegrid.operators import forecast as fc


def test_forest_rows_are_dealt_out(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "one")
    spark.range(400).selectExpr(
        "id as row_id", "concat('d', id % 2) as district", "cast(id % 2 as double) as latitude",
        "cast(id % 7 as double) as longitude",
    ).coalesce(1).write.parquet(path)
    seen = []
    fit = fc.RandomForestClassifier.fit
    monkeypatch.setattr(
        fc.RandomForestClassifier, "fit",
        lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df),
    )
    row = fc.fit_location_classifier(spark.read.parquet(path), trees=5, depth=3).first()
    assert seen[0] >= spark.sparkContext.defaultParallelism
    assert (row.n_samples, row.n_features, row.test_accuracy) == (400, 2, 1.0)
