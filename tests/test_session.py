from pathlib import Path

from cadenza.operators import evaluation
from cadenza.session import _own_folder, release, stored
from cadenza.sources import sinks


def test_stored_tables_are_released(spark):
    frame = stored(spark.range(5))
    folder = Path(_own_folder(spark).removeprefix("file:"))
    assert frame.count() == 5 and any(folder.iterdir())
    assert release(spark) and not folder.exists()
    assert stored(spark.range(3)).count() == 3


def test_metrics_are_written(spark, tmp_path):
    errors = evaluation.rating_errors(spark.createDataFrame([(2, 1.0), (4, 4.5)], "implicit_rating int, prediction double"))
    sinks.write_tsv(errors, str(tmp_path / "metrics"))
    lines = [line for p in (tmp_path / "metrics").glob("part-*") for line in p.read_text().splitlines()]
    assert {line.split("\t")[0] for line in lines} == {"RMSE", "MAE"} and all(float(line.split("\t")[1]) > 0 for line in lines)
