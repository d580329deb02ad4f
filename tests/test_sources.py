"""CSV, zip staging and sinks on files written by the test."""

import zipfile

import pandas as pd
import pytest
from tributary.session import materialize, shared_dir
from tributary.sources import files, sinks


def test_csv_nulls_and_cap(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,x,s\n1,nan,a\n2,,\n3,4.5,c\n")
    df = files.read_csv(spark, str(path), "id long, x double, s string")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, None, "a"), (2, None, None), (3, 4.5, "c")]
    assert files.read_csv(spark, str(path), rows=2).count() == 2
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "a.csv.zip"))


def test_zip_staging(spark, tmp_path):
    path = tmp_path / "a.csv.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", 'id,name,x\n' + "".join(f'{i},"n, {i}",{i / 2 if i % 3 else ""}\n' for i in range(1000)))
    df = files.stage_zip(spark, str(path), "id long, name string, x double, gone int", str(tmp_path / "out"))
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 1000 and rows[7]["name"] == "n, 7" and rows[7]["x"] == 3.5
    assert rows[9]["x"] is None and rows[9]["gone"] is None


def test_metadata_files(spark, tmp_path):
    names = tmp_path / "names.txt"
    names.write_text("A\nB\n\n C \n")
    assert files.read_names(spark, str(names)) == ["A", "B", "C"]
    wide = tmp_path / "wide.csv"
    wide.write_text(",f,fold0,fold1\n0,A,1,2\n1,B,3,4\n")
    assert files.read_fold_importance(spark, str(wide)).columns == ["f", "fold0", "fold1"]
    train, test = tmp_path / "p1.csv", tmp_path / "p2.csv"
    train.write_text("SK_ID_CURR,fold_id,TARGET\n1,0,0.5\n")
    test.write_text("SK_ID_CURR,TARGET\n2,0.25\n")
    got = files.read_predictions(spark, [str(train), str(test)], "SK_ID_CURR", "other").orderBy("SK_ID_CURR").collect()
    assert [tuple(r) for r in got] == [(1, "other", 0.5), (2, "other", 0.25)]


def test_sinks(spark, tmp_path):
    scores = spark.createDataFrame([(1, "m", 0.2), (1, "m", 0.4), (2, "m", 1.0)], "id long, model string, score double")
    sinks.write_submission(scores, "id", str(tmp_path / "sub"))
    out = pd.concat(pd.read_csv(p) for p in (tmp_path / "sub").glob("part-*.csv"))
    assert out.sort_values("id")["TARGET"].tolist() == [pytest.approx(0.3), 1.0]
    metrics = spark.createDataFrame([("r", "m", 0, 0.5)], "run string, model string, fold int, auc double")
    for _ in range(2):
        sinks.append_metrics(metrics, str(tmp_path / "metrics"))
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 2


def test_shared_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    df = materialize(spark.range(10).selectExpr("id", "cast(id % 2 as int) p"), "t", ("p",))
    assert df.columns == ["id", "p"] and df.where("p = 1").count() == 5
