"""Argument parsing of the command-line jobs (defaults follow the reference)."""

from pathlib import Path

from pawprint.cli import parse_args

from conftest import SF001


def test_prepare_args():
    a = parse_args(["prepare", "raw.csv"])
    assert (a.raw_csv_path, a.output_dir, a.test_size, a.random_state) == \
        (Path("raw.csv"), Path("data/split_data"), 0.2, 42)
    b = parse_args(["prepare", "raw.csv", "--output-dir", "out", "--test-size", "0.3",
                    "--random-state", "7"])
    assert (b.output_dir, b.test_size, b.random_state) == (Path("out"), 0.3, 7)


def test_train_args():
    a = parse_args(["train"])
    assert (a.features_path, a.target_path, a.models_dir) == (
        Path("data/split_data/train_features.csv"), Path("data/split_data/train_target.csv"),
        Path("models"))
    b = parse_args(["train", "f.csv", "t.csv", "--models-dir", "m"])
    assert (b.features_path, b.target_path, b.models_dir) == (Path("f.csv"), Path("t.csv"),
                                                              Path("m"))


def test_evaluate_args():
    a = parse_args(["evaluate"])
    assert (a.test_features, a.test_target, a.models_dir, a.output_metrics) == (
        Path("data/split_data/test_features.csv"), Path("data/split_data/test_target.csv"),
        Path("models"), Path("metrics.json"))
    b = parse_args(["evaluate", "--test-features", "x", "--test-target", "y",
                    "--models-dir", "m", "--output-metrics", "o.json"])
    assert (b.test_features, b.test_target, b.models_dir, b.output_metrics) == (
        Path("x"), Path("y"), Path("m"), Path("o.json"))


def test_cli_end_to_end(spark, tmp_path):
    """prepare -> train (minimal grid) -> evaluate through the command-line jobs."""
    from pawprint.cli import main
    from pawprint.session import scratch_path
    from pawprint.sources import io
    from pawprint.sources.fixture import record_table
    raw = record_table(spark, SF001).filter("rid < 400").drop("rid").toPandas()
    raw_path = tmp_path / "train.csv"
    raw.to_csv(raw_path, index=False)
    base = scratch_path(spark, "cli")
    main(["prepare", str(raw_path), "--output-dir", f"{base}/split"])
    main(["train", f"{base}/split/train_features.csv", f"{base}/split/train_target.csv",
          "--models-dir", f"{base}/models", "--grid", "minimal", "--n-folds", "2"])
    main(["evaluate", "--test-features", f"{base}/split/test_features.csv",
          "--test-target", f"{base}/split/test_target.csv", "--models-dir", f"{base}/models",
          "--output-metrics", f"{base}/metrics.json"])
    metrics = io.read_json_row(spark, f"{base}/metrics.json")["metrics"]
    assert {m["group"] for m in metrics} == {"Dog", "Cat", "all"}
