"""The fit brings the features of its texts to the driver as one Arrow buffer, not as rows."""

from fundtide.llm import toxicity


def test_features_reach_the_driver_without_row_objects(llm_spark, documents, monkeypatch):
    labels = llm_spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    frames = type(documents)
    collect = frames.collect

    def guarded(frame):
        assert "features" not in frame.columns, "a Row per text on the driver"
        return collect(frame)

    monkeypatch.setattr(frames, "collect", guarded)
    model = toxicity.fit(documents, labels, kept=500)
    assert len(model.weight) and 0 < model.slope
