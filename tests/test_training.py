import numpy as np
import pytest
from pyspark.sql import functions as F

from linkmill.operators import gradient as G
from linkmill.operators import metrics as M
from linkmill.operators.order import assign_replicas
from linkmill.plans import training as T

N, D, K = 48, 5, 3
RND = np.random.default_rng(4)
X = RND.normal(size=(N, D)).astype(np.float32)
Y = RND.integers(0, K, size=N)


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, [float(v) for v in X[i]], int(Y[i])) for i in range(N)]
    return spark.createDataFrame(rows, "id int, features array<float>, label int").repartition(4)


def grad(w, b, rows=slice(None)):
    x, y = X[rows].astype(float), Y[rows]
    z = x @ w + b
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    t = np.eye(K)[y]
    loss = -np.log(p[np.arange(len(y)), y]).mean()
    return loss, x.T @ (p - t) / len(y), (p - t).mean(axis=0), (np.rint(p) == t).mean()


def descend(steps, lr, rows_of=lambda t: slice(None)):
    w, b, losses, cells = np.zeros((D, K)), np.zeros(K), [], []
    for t in range(steps):
        loss, gw, gb, cell = grad(w, b, rows_of(t))
        losses.append(loss)
        cells.append(cell)
        w, b = w - lr * gw, b - lr * gb
    return w, b, losses, cells + [grad(w, b, rows_of(steps))[3]]


def test_gradient_table(data):
    w, b = RND.normal(size=(D, K)), RND.normal(size=K)
    _, gw, gb, _ = grad(w, b)
    rows = G.softmax_gradient(data, w, b).collect()
    got = {(r["var"], r["idx"]): r["g"] for r in rows}
    assert len(got) == D * K + K
    assert np.allclose([got["weights", i] for i in range(D * K)], gw.ravel())
    assert np.allclose([got["biases", i] for i in range(K)], gb)


def test_replica_gradients_average_to_the_whole(data):
    w, b = RND.normal(size=(D, K)), RND.normal(size=K)
    marked = data.withColumn("r", F.floor(F.col("id") / 12).cast("int"))
    per = G.softmax_gradient(marked, w, b, replica="r")
    assert per.select("replica").distinct().count() == 4
    got = {(r["var"], r["idx"]): r["g"] for r in M.average_gradients(per).collect()}
    assert np.allclose([got["weights", i] for i in range(D * K)], grad(w, b)[1].ravel())


def test_full_batch_training_and_trace(data):
    run = T.train_softmax(data, K, epochs=4, lr=0.3)
    w, b, losses, cells = descend(4, 0.3)
    assert np.allclose(run.params.weights, w) and np.allclose(run.params.biases, b)
    assert [r[0] for r in run.trace] == [0, 1, 2, 3, 4]
    assert np.allclose([r[1] for r in run.trace], [losses[0], *losses])
    assert np.allclose([r[2] for r in run.trace], cells)
    assert run.trace[0][1] == pytest.approx(np.log(K))


def test_loss_never_rises_at_a_small_rate(data):
    trace = [r[1] for r in T.train_softmax(data, K, epochs=6, lr=0.05).trace]
    assert all(a >= b for a, b in zip(trace, trace[1:]))


def test_mini_batches_in_turn(data):
    run = T.train_softmax(data, K, epochs=5, lr=0.3, batch=20, order=["id"])
    w, b, _, _ = descend(5, 0.3, lambda t: (20 * t + np.arange(20)) % N)
    assert np.allclose(run.params.weights, w) and np.allclose(run.params.biases, b)


def test_batch_larger_than_the_table(data):
    """Three times all rows in one batch is the full batch."""
    rows = data.count()
    run = T.train_softmax(data, K, epochs=2, lr=0.3, batch=3 * rows, order=["id"])
    full = T.train_softmax(data, K, epochs=2, lr=0.3)
    np.testing.assert_allclose(run.params.weights, full.params.weights, atol=1e-12)


def test_replicas_equal_full_batch(data):
    run = T.train_softmax(data, K, epochs=3, lr=0.5, replicas=4, order=["id"])
    assert np.allclose(run.params.weights, descend(3, 0.5)[0])
    with pytest.raises(ValueError, match="equal parts"):
        T.train_softmax(data, K, epochs=1, replicas=5, order=["id"])


def test_replicas_of_unequal_size_weigh_by_their_rows(data):
    """46 rows in four parts, of 12, 11, 12 and 11: any number of rows has a gradient."""
    rows = data.where(f"id < {N - 2}")
    w, b = RND.normal(size=(D, K)), RND.normal(size=K)
    parts = assign_replicas(rows, 4, "id", equal=False)
    assert [r["count"] for r in parts.groupBy("replica_id").count().orderBy("replica_id").collect()] == [12, 11, 12, 11]
    per = G.softmax_gradient(parts, w, b, replica="replica_id")
    got = {(r["var"], r["idx"]): r["g"] for r in M.average_gradients(per, "rows").collect()}
    _, gw, gb, _ = grad(w, b, slice(N - 2))
    assert np.allclose([got["weights", i] for i in range(D * K)], gw.ravel(), rtol=0, atol=1e-12)
    assert np.allclose([got["biases", i] for i in range(K)], gb, rtol=0, atol=1e-12)
    run = T.train_softmax(rows, K, epochs=3, lr=0.5, replicas=4, equal=False, order=["id"])
    assert np.allclose(run.params.weights, descend(3, 0.5, lambda t: slice(N - 2))[0])


@pytest.mark.parametrize("batch,replicas", [(20, 3), (32, 4), (100, 7)])
def test_replicas_within_batches(data, batch, replicas):
    """Stretches of unequal size, batches over the end of an epoch and larger than the table."""
    run = T.train_softmax(data, K, epochs=4, lr=0.3, batch=batch, replicas=replicas, order=["id"])
    w, b, _, _ = descend(4, 0.3, lambda t: (batch * t + np.arange(batch)) % N)
    assert np.allclose(run.params.weights, w) and np.allclose(run.params.biases, b)


def test_given_start_and_trace_of_speed(data):
    first = T.Params(RND.normal(size=(D, K)), RND.normal(size=K))
    run = T.train_softmax(data, K, epochs=1, start=first)
    assert run.trace[0][1] == pytest.approx(grad(first.weights, first.biases)[0])
    assert [row[4] for row in run.trace] == [N, N] and all(row[5] > 0 for row in run.trace)


@pytest.mark.parametrize("chunk", [8192, 7, 1])
def test_a_task_sends_one_piece_per_part_and_chunk(spark, data, monkeypatch, chunk):
    monkeypatch.setattr(G, "CHUNK", chunk)
    shared = spark.sparkContext.broadcast((np.zeros((D, K)), np.zeros(K)))
    part = F.col("id") % 2
    numbers = 3 + D * K + K
    rows = G.task_sums(data, shared, (D, K), "features", "label", part).collect()
    pieces = -(-numbers // chunk)
    assert len(rows) == 4 * 2 * pieces and max(len(r["s"]) for r in rows) == 1 + min(chunk, numbers)
    assert sum(r["s"][0] for r in rows if r["chunk"] == 0) == N
    found = G.step_sums(data, np.zeros((D, K)), np.zeros(K), "features", "label", part)
    assert found.keys() == {0, 1} and found[0]["rows"] == N // 2
    for number in (0, 1):
        _, gw, gb, _ = grad(np.zeros((D, K)), np.zeros(K), slice(number, None, 2))
        assert np.allclose(found[number]["weights"], gw) and np.allclose(found[number]["biases"], gb)
    got = {(r["var"], r["idx"]): r["g"] for r in G.softmax_gradient(data, np.zeros((D, K)), np.zeros(K)).collect()}
    assert len(got) == D * K + K and np.allclose([got["biases", i] for i in range(K)], grad(np.zeros((D, K)), np.zeros(K))[2])


def test_a_reducing_task_sees_one_chunk(data):
    plan = G.softmax_gradient(data, np.zeros((D, K)), np.zeros(K))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part" in plan and "chunk" in plan.split("hashpartitioning(part")[1][:40]
    assert "collect_list" not in plan


def test_settings_by_name_pattern_and_default():
    rule = T.Momentum(4, groups=(("fc", 0.5, 1.0, 2, 0.7), ("fc9", 0.1, 1.0, 2, 0.8)))
    assert rule.setting("fc9", 0) == pytest.approx((0.1, 0.8))
    assert rule.setting("fc8/weights", 0) == pytest.approx((0.5, 0.7))
    assert rule.setting("other", 0) == (T.DEFAULT_RATE, T.DEFAULT_MOMENTUM)


@pytest.mark.parametrize("batch", [None, 24])
def test_held_out_rows_only_score(data, batch):
    train, test = data.where("id < 24"), data.where("id >= 24")
    run = T.train_softmax(train, K, epochs=2, lr=0.3, eval_df=test, batch=batch, order=["id"])
    w, b, _, _ = descend(2, 0.3, lambda t: slice(0, 24))
    assert np.allclose(run.params.weights, w)
    assert run.trace[-1][2] == pytest.approx(grad(w, b, slice(24, 48))[3])


def test_decay_and_momentum(data):
    run = T.train_softmax(data, K, epochs=3, decay=0.1, momentum=T.Momentum(3, nesterov=True))
    w, b = np.zeros((D, K)), np.zeros(K)
    vw, vb = 0.0, 0.0
    for t in range(3):
        _, gw, gb, _ = grad(w, b)
        gw = gw + 0.1 * w
        vw, vb = 0.9 * vw + gw, 0.9 * vb + gb
        w = w - 0.001 * (1 / 250) ** (t // 1 / 3) * (gw + 0.9 * vw)
        b = b - 0.002 * (gb + 0.9 * vb)
    assert np.allclose(run.params.weights, w) and np.allclose(run.params.biases, b)


def test_seeded_normal_start():
    a, b = T.Params.start(3, 2, "normal", 5), T.Params.start(3, 2, "normal", 5)
    assert np.array_equal(a.weights, b.weights) and a.weights.std() > 0
    with pytest.raises(ValueError):
        T.Params.start(3, 2, "ones")


def test_saved_parameters_and_evaluation(spark, data, tmp_path):
    path = str(tmp_path / "model")
    run = T.train_softmax(data, K, epochs=3, lr=0.5, save_to=path, save_every=2)
    step, params = T.load_params(spark, path)
    assert step == 2 and np.allclose(params.weights, run.params.weights)
    assert T.load_params(spark, path, 0)[0] == 0
    row = T.evaluate(data, path).first()
    z = X @ params.weights + params.biases
    assert row["correct"] == int((z.argmax(axis=1) == Y).sum()) and row["total"] == N


def table(spark, rows, column):
    return spark.createDataFrame(rows, f"var string, idx long, {column} double")


@pytest.mark.parametrize("nesterov", [False, True])
def test_momentum_tables(spark, nesterov):
    params = table(spark, [("w", 0, 1.0), ("w", 1, 2.0), ("b", 0, 3.0)], "value")
    grads = table(spark, [("w", 0, 0.5), ("w", 1, -1.0), ("b", 0, 2.0)], "g")
    lr = F.when(F.col("var") == "w", F.lit(0.1)).otherwise(F.lit(0.2))
    once = G.momentum_step(params, None, grads, lr, 0.9, nesterov)
    twice = G.momentum_step(once.select("var", "idx", "value"), once, grads, lr, 0.9, nesterov)
    got = {(r["var"], r["idx"]): (r["value"], r["v"]) for r in twice.collect()}
    for var, idx, value, g, rate in [("w", 0, 1.0, 0.5, 0.1), ("w", 1, 2.0, -1.0, 0.1), ("b", 0, 3.0, 2.0, 0.2)]:
        v = 0.0
        for _ in range(2):
            v = 0.9 * v + g
            value -= rate * (g + 0.9 * v if nesterov else v)
        assert got[var, idx] == pytest.approx((value, v))


def test_sparse_momentum_leaves_the_rest(spark):
    params = table(spark, [("w", 0, 1.0), ("w", 1, 2.0)], "value")
    velocity = table(spark, [("w", 0, 0.5), ("w", 1, 0.25)], "v")
    grads = table(spark, [("w", 0, 0.5), ("w", 0, 0.5)], "g")
    rows = G.momentum_step(params, velocity, grads, 0.1, 0.9, sparse=True).orderBy("idx").collect()
    assert (rows[0]["value"], rows[0]["v"]) == pytest.approx((1.0 - 0.145, 1.45))
    assert (rows[1]["value"], rows[1]["v"]) == (2.0, 0.25)


def test_gradient_step(spark):
    params, grads = table(spark, [("w", 0, 1.0)], "value"), table(spark, [("w", 0, 0.5)], "g")
    assert G.gradient_step(params, grads, 0.1).first()["value"] == pytest.approx(0.95)
