import numpy as np
import pytest
from pyspark.sql import functions as F

from linkmill.functions import layers as L
from linkmill.functions import schedule as S
from linkmill.functions import vectors as V
from linkmill.operators import images as I
from linkmill.operators import metrics as M


def one(spark, values, expr):
    df = spark.createDataFrame([([float(v) for v in values],)], "v array<double>")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


def test_softmax_stays_finite(spark):
    got = one(spark, [1000.0, 999.0, -1000.0], V.softmax)
    z = np.exp(np.array([0.0, -1.0, -2000.0]))
    assert got == pytest.approx(list(z / z.sum()))
    assert one(spark, [1000.0, 999.0], V.log_sum_exp) == pytest.approx(1000 + np.log(1 + np.exp(-1)))


def test_relu_one_hot_flatten(spark):
    assert one(spark, [-1.0, 2.0], V.relu) == [0.0, 2.0]
    row = spark.createDataFrame([(2,)], "label int").select(V.one_hot(F.col("label"), 4).alias("o"))
    assert row.first()["o"] == [0.0, 0.0, 1.0, 0.0]
    assert one(spark, [1.0, 2.0, 3.0, 4.0], lambda v: V.reshape(v, 2, 2)) == [[1.0, 2.0], [3.0, 4.0]]
    assert one(spark, [1.0, 2.0, 3.0, 4.0], lambda v: V.flatten(V.reshape(v, 2, 2))) == [1.0, 2.0, 3.0, 4.0]


def test_standardize_floors_the_deviation(spark):
    x = np.array([1.0, 2.0, 4.0, 9.0])
    assert one(spark, list(x), V.standardize) == pytest.approx(list((x - x.mean()) / x.std()))
    assert one(spark, [5.0] * 4, V.standardize) == [0.0] * 4
    tiny = np.array([0.0, 0.1, 0.0, 0.1])
    assert one(spark, list(tiny), V.standardize) == pytest.approx(list((tiny - 0.05) / 0.5))


@pytest.mark.parametrize("h,w", [(4, 4), (2, 3), (7, 9), (3, 6), (5, 1)])
def test_crop_or_pad_matches_the_array_form(spark, h, w):
    image = np.arange(1.0, 21.0).reshape(4, 5)
    want = I.fit(image[:, :, None], h, w)[:, :, 0]
    got = one(spark, list(image.ravel()), lambda v: V.crop_or_pad(V.reshape(v, 4, 5), h, w))
    assert np.array_equal(np.array(got), want)


def test_crop_and_pad_offsets():
    image = np.arange(5.0).reshape(1, 5, 1)
    assert I.fit(image, 1, 2).ravel().tolist() == [1.0, 2.0]  # (5 - 2) // 2 cells cut in front
    # 3 // 2 cells added in front
    assert I.fit(image, 1, 8).ravel().tolist() == [0.0, 0.0, 1.0, 2.0, 3.0, 4.0, 0.0, 0.0]


def scored(spark):
    rows = [([0.5, 0.5, 0.0], 0), ([0.1, 0.2, 0.7], 2), ([0.2, 0.6, 0.2], 0), ([0.9, 0.1, 0.0], 1)]
    return spark.createDataFrame(rows, "probs array<double>, label int")


def test_cell_accuracy_rounds_half_to_even(spark):
    # cells right per row: (0,0,0) vs (1,0,0) = 2; 3; (0,1,0) vs (1,0,0) = 1; (1,0,0) vs (0,1,0) = 1
    assert M.cell_accuracy(scored(spark), 3).first()[0] == pytest.approx(7 / 12)


def test_all_zero_prediction_scores_nine_tenths(spark):
    rows = spark.createDataFrame([([0.0] * 10, 3)], "probs array<double>, label int")
    assert M.cell_accuracy(rows, 10).first()[0] == pytest.approx(0.9)


def test_top1_counts_ties(spark):
    row = M.top1_accuracy(scored(spark)).first()
    assert (row["correct"], row["total"], row["precision"]) == (2, 4, 0.5)


def test_cross_entropy_is_finite(spark):
    rows = spark.createDataFrame([([1000.0, 0.0], 1), ([0.0, 0.0], 0)], "logits array<double>, label int")
    assert M.cross_entropy(rows).first()[0] == pytest.approx((1000 + np.log(2)) / 2)


def test_dense_layer(spark):
    x = np.array([[1.0, -2.0], [0.5, 3.0], [0.0, 0.0]])
    w, b = np.array([[1.0, -1.0, 2.0], [0.5, 0.25, -1.0]]), np.array([0.1, 0.2, -0.3])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, features array<float>")
    rows = L.dense_layer(df, w, b, "relu").orderBy("id").collect()
    assert np.allclose([r["activations"] for r in rows], np.maximum(x @ w + b, 0))
    probs = np.array([r["probs"] for r in L.softmax_predict(df, w, b).orderBy("id").collect()])
    assert np.allclose(probs.sum(axis=1), 1)
    with pytest.raises(ValueError):
        L.dense_layer(df, w, b, "tanh")


def test_schedule_stairs(spark):
    df = spark.range(9).select(
        "id", S.exp_decay(F.col("id"), 0.001, 250.0, 4, F.lit(9.0)).alias("lr")
    )
    got = [r["lr"] for r in df.orderBy("id").collect()]
    want = [0.001 * (1 / 250) ** (s / 3) for s in (0, 0, 0, 1, 1, 1, 2, 2, 2)]
    assert got == pytest.approx(want)
    assert [S.exp_decay_at(i, 0.001, 250.0, 4, 9) for i in range(9)] == pytest.approx(want)


def test_settings_lookup_order(spark):
    names = spark.createDataFrame([("fc1/weights",), ("weights",), ("fc/biases",), ("other",)], "var string")
    rules = [("fc", 1.0), ("weights", 2.0), ("biases", 3.0)]
    got = [r[0] for r in names.select(S.pick_setting(F.col("var"), rules, 0.02)).collect()]
    assert got == [1.0, 2.0, 1.0, 0.02]
    groups = S.param_groups(names, "var", F.lit(0), F.lit(10.0)).collect()
    assert [r["learning_rate"] for r in groups] == pytest.approx([0.001, 0.001, 0.002, 0.02])
    assert {r["momentum"] for r in groups} == {0.9}


def test_summary_and_throughput(spark):
    df = spark.createDataFrame([(1.0, 4), (3.0, 8)], "seconds double, rows int")
    row = M.column_summary(df, ["seconds"]).first()
    assert (row["column"], row["mean"], row["stddev"], row["max"], row["min"]) == ("seconds", 2.0, 1.0, 3.0, 1.0)
    assert M.column_summary(df, ["rows"], bins=4).first()["histogram"]
    speed = M.throughput(df).first()
    assert speed["examples_per_sec"] == pytest.approx((4 + 8 / 3) / 2) and speed["sec_per_batch"] == 2.0


def test_penalty_leaves_out_biases(spark):
    rows = [("fc/weights", 0, 3.0), ("fc/weights", 1, 4.0), ("fc/biases", 0, 100.0)]
    df = spark.createDataFrame(rows, "var string, idx long, value double")
    assert M.l2_penalty(df, 0.1).first()[0] == pytest.approx(1.25)
    assert M.l2_penalty(df.where("idx > 5")).first()[0] == 0.0


def test_histogram_counts_every_value_once(spark):
    nan, inf = float("nan"), float("inf")
    values = [0.0, 0.1, 1.0, 1.0, 2.5, 9.99, 10.0, 10.0, None, nan, inf, -inf]
    df = spark.createDataFrame([(v, 7, None) for v in values], "v double, same int, none double")
    rows = M.column_histogram(df, ["v", "same", "none"], 4).collect()
    got = {(r["column"], r["bin"]): (r["low"], r["high"], r["n"]) for r in rows}
    assert got == {
        ("v", 0): (0.0, 2.5, 4), ("v", 1): (2.5, 5.0, 1), ("v", 2): (5.0, 7.5, 0), ("v", 3): (7.5, 10.0, 3),
        ("same", 0): (7.0, 7.0, 12), ("same", 1): (7.0, 7.0, 0), ("same", 2): (7.0, 7.0, 0), ("same", 3): (7.0, 7.0, 0),
    }
    summary = {r["column"]: r["histogram"] for r in M.column_summary(df, ["v", "none"], bins=2).collect()}
    assert [(b["bin"], b["n"]) for b in summary["v"]] == [(0, 5), (1, 3)] and summary["none"] is None
    assert M.column_histogram(df.limit(0), ["v"], 3).collect() == []
