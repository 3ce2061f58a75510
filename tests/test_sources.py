"""File formats: what the sinks write, the sources read back."""
import csv

import pytest
from pyspark.sql import functions as F

from tessera.operators import data as D
from tessera.sources import sinks
from tessera.sources import tables as T


def test_class_csvs_to_design_matrix(spark, tmp_path):
    for name, rows in (("a", [(1, "Right", 0.5, "inf"), (2, "Left", 1.5, "2.0"), (1, "Left", -1.0, "NaN")]), ("b", [(1, "Right", 3.0, "4.0"), (2, "Right", 5.0, "6.0")])):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            csv.writer(f).writerows([("PatientIndex", "SideStandard", "Feature_0001", "Feature_0002"), *rows])
    df = D.load_samples(spark, {"N": (str(tmp_path / "a.csv"), 0), "P": (str(tmp_path / "b.csv"), 1)})
    df, names = D.feature_array(df)
    df, sides = D.one_hot(df, "SideStandard")
    df = D.inf_to_null(D.assemble(df, ["features", sides]))
    got = [(r["patient_id"], r["label"], r["features"], r["n_nonfinite"]) for r in df.collect()]
    assert names == ["Feature_0001", "Feature_0002"] and sides == ["SideStandard_Left", "SideStandard_Right"]
    want = [("N_1", 0, [0.5, None, 0.0, 1.0], 1), ("N_2", 0, [1.5, 2.0, 1.0, 0.0], 0), ("N_1", 0, [-1.0, None, 1.0, 0.0], 1),
            ("P_1", 1, [3.0, 4.0, 0.0, 1.0], 0), ("P_2", 1, [5.0, 6.0, 0.0, 1.0], 0)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_and_summary_tables_round_trip(spark, tmp_path):
    rows = [(m, r, *[0.1 * k + r / 7 for k in range(9)]) for m in ("LR", "RF") for r in range(3)]
    metrics = spark.createDataFrame(rows, T.metrics_long_schema())
    sinks.write_csv(metrics, f"{tmp_path}/long")
    assert sorted(T.read_metrics_long(spark, f"{tmp_path}/long").collect()) == sorted(metrics.collect())
    long = metrics.unpivot(["model", "repeat"], list(T.METRIC_COLUMNS), "metric", "v").groupBy("model", "metric").agg(
        F.avg("v").alias("mean"), F.stddev("v").alias("std")).unpivot(["model", "metric"], ["mean", "std"], "stat", "value")
    sinks.write_summary_two_header(long, f"{tmp_path}/summary")
    back = T.read_summary_two_header(spark, f"{tmp_path}/summary")
    want = {(r["model"], r["metric"], r["stat"]): r["value"] for r in long.collect()}
    assert {(r["model"], r["metric"], r["stat"]): r["value"] for r in back.collect()} == want and len(want) == 36


def test_json_documents_round_trip(spark, tmp_path):
    doc = spark.createDataFrame([(42, 1.5, 'a "b"')], "seed int, seconds double, note string")
    sinks.write_json_document(doc, f"{tmp_path}/doc")
    assert T.read_json_document(spark, f"{tmp_path}/doc", "seed int, seconds double, note string").collect() == doc.collect()
    top = spark.createDataFrame([(2, 'f"2', 0.25), (1, "f1", 0.5)], "rank int, name string, value double")
    sinks.write_json_pairs(top, f"{tmp_path}/top")
    assert [tuple(r) for r in T.read_json_pairs(spark, f"{tmp_path}/top").orderBy("rank").collect()] == [(1, "f1", 0.5), (2, 'f"2', 0.25)]


def test_unreadable_class_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("PatientIndex,SideStandard,Feature_0001\nx,Right,1.0\n")
    with pytest.raises(Exception):
        T.read_class_csv(spark, str(tmp_path / "bad.csv")).collect()
