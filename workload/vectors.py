"""Scoring, training and update queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import DECAYED_GROUPS
from linkmill.functions import layers as L
from linkmill.functions import vectors as V
from linkmill.functions.schedule import exp_decay, param_groups, pick_setting
from linkmill.operators import gradient as G
from linkmill.operators import metrics as M
from linkmill.operators.order import assign_replicas, epochs_needed, repeat_epochs, take_batches
from linkmill.plans import training as T
from linkmill.plans.lineage import fresh_path
from linkmill.sinks.text import write_trace
from linkmill.sources.tables import read_feature_table, with_synthetic_features
from workload.graph import ITEM_ORDER, table

DIM, CLASSES = 64, 10
WEIGHTS = np.sin(np.arange(DIM)[:, None] * 10 + np.arange(CLASSES)[None, :])
BIASES = np.cos(np.arange(CLASSES))


def vectors(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return rows.withColumnRenamed("embedding", "features")


def cells(df: DataFrame, column: str, key: str = "vec_id") -> DataFrame:
    exploded = df.select(key, F.posexplode(column).alias("k", "value"))
    return exploded.select(key, "k", F.round(F.col("value").cast("double"), 6).alias("value"))


# --- scoring -----------------------------------------------------------------------


def one_hot(spark, sf_dir):
    rows = vectors(spark, sf_dir).withColumn("target", V.one_hot(F.col("label"), CLASSES))
    return cells(rows, "target")


def feature_table(spark, sf_dir):
    rows = read_feature_table(spark, f"{sf_dir}/embeddings.parquet", "embedding", "label")
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("dim")
    )


def scored(spark, sf_dir, activation="softmax", name="probs"):
    return L.dense_layer(vectors(spark, sf_dir), WEIGHTS, BIASES, activation, name=name)


def softmax_predict(spark, sf_dir):
    return cells(L.softmax_predict(vectors(spark, sf_dir), WEIGHTS, BIASES), "probs")


def dense_relu(spark, sf_dir):
    return cells(scored(spark, sf_dir, "relu", "activations"), "activations")


def cross_entropy(spark, sf_dir):
    loss = M.cross_entropy(scored(spark, sf_dir, None, "logits"))
    return loss.select(F.round("loss", 6).alias("loss"))


def cell_accuracy(spark, sf_dir):
    out = M.cell_accuracy(scored(spark, sf_dir), CLASSES)
    return out.select(F.round("cell_accuracy", 6).alias("cell_accuracy"))


def top1_accuracy(spark, sf_dir):
    out = M.top1_accuracy(scored(spark, sf_dir))
    return out.select("correct", "total", F.round("precision", 6).alias("precision"))


# --- training -------------------------------------------------------------------------


def softmax_gradient(spark, sf_dir):
    grads = G.softmax_gradient(vectors(spark, sf_dir), WEIGHTS, BIASES)
    return grads.select("var", "idx", F.round("g", 8).alias("g"))


def replica_gradients(spark, sf_dir):
    rows = assign_replicas(vectors(spark, sf_dir), 4, "vec_id", equal=False)
    grads = M.average_gradients(G.softmax_gradient(rows, WEIGHTS, BIASES, replica="replica_id"), "rows")
    return grads.select("var", "idx", F.round("g", 8).alias("g"))


def rounded_trace(spark, run: T.Trained) -> DataFrame:
    names = ("loss", "cell_accuracy", "top1_accuracy")
    return run.trace_table(spark).select("step", *[F.round(c, 6).alias(c) for c in names])


def rounded_params(spark, run: T.Trained) -> DataFrame:
    return run.params.table(spark).select("var", "idx", F.round("value", 8).alias("value"))


def train_softmax_trace(spark, sf_dir):
    return rounded_trace(spark, T.train_softmax(vectors(spark, sf_dir), CLASSES, epochs=3))


def train_softmax_weights(spark, sf_dir):
    return rounded_params(spark, T.train_softmax(vectors(spark, sf_dir), CLASSES, epochs=3))


def train_replicas(spark, sf_dir):
    run = T.train_softmax(
        vectors(spark, sf_dir), CLASSES, epochs=3, lr=0.5, replicas=2, equal=False, order=["vec_id"]
    )
    return rounded_params(spark, run)


def train_l2(spark, sf_dir):
    run = T.train_softmax(vectors(spark, sf_dir), CLASSES, epochs=3, decay=0.0005)
    return rounded_params(spark, run)


def train_batches(spark, sf_dir):
    run = T.train_softmax(vectors(spark, sf_dir), CLASSES, epochs=5, batch=128, order=["vec_id"])
    return rounded_params(spark, run)


def train_batch_replicas(spark, sf_dir):
    """Each batch in three stretches, of 43, 43 and 42 rows."""
    run = T.train_softmax(
        vectors(spark, sf_dir), CLASSES, epochs=5, batch=128, replicas=3, order=["vec_id"]
    )
    return rounded_params(spark, run)


def train_speed(spark, sf_dir):
    """Rows of each step in the trace and whether its time was taken."""
    run = T.train_softmax(vectors(spark, sf_dir), CLASSES, epochs=2)
    return run.trace_table(spark).select("step", "rows", (F.col("seconds") > 0).alias("timed"))


def train_full(spark, sf_dir):
    """The full 40 epochs from given parameters."""
    run = T.train_softmax(vectors(spark, sf_dir), CLASSES, start=T.Params(WEIGHTS, BIASES))
    return rounded_trace(spark, run)


def train_all_epochs(spark, sf_dir):
    """All 40 epochs from zeros."""
    return rounded_params(spark, T.train_softmax(vectors(spark, sf_dir), CLASSES))


def train_saved_trace(spark, sf_dir):
    path = fresh_path(spark, "trace")
    run = T.train_softmax(vectors(spark, sf_dir), CLASSES, epochs=2)
    write_trace(run.trace_table(spark), path)
    return spark.read.parquet(path).select("step", F.round("loss", 6).alias("loss"))


def momentum_train(spark, sf_dir):
    run = T.train_softmax(
        vectors(spark, sf_dir), CLASSES, epochs=4, momentum=T.Momentum(total_steps=4)
    )
    return rounded_params(spark, run)


def order_params(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return orders.select(
        F.lit("embed/weights").alias("var"),
        F.col("o_orderkey").alias("idx"),
        (F.col("o_totalprice") / 1000).alias("value"),
    )


def item_grads(spark, sf_dir, flag):
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_discount", "l_returnflag")
    return items.where(F.col("l_returnflag") == flag).select(
        F.lit("embed/weights").alias("var"), F.col("l_orderkey").alias("idx"), F.col("l_discount").alias("g")
    )


def two_momentum_steps(params, first, second, **options):
    rules = [("weights", 0.1)]
    lr, momentum = pick_setting(F.col("var"), rules, 0.02), 0.9
    once = G.momentum_step(params, None, first, lr, momentum, **options)
    twice = G.momentum_step(once.select("var", "idx", "value"), once, second, lr, momentum, **options)
    return twice.select(
        "var", "idx", F.round("value", 6).alias("value"), F.round("v", 6).alias("v")
    )


def momentum_sparse(spark, sf_dir):
    grads = [item_grads(spark, sf_dir, flag) for flag in ("R", "A")]
    return two_momentum_steps(order_params(spark, sf_dir), *grads, sparse=True)


def part_table(spark, sf_dir, column, name):
    part = table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    return part.select(
        F.lit("fc/weights").alias("var"), F.col("p_partkey").alias("idx"), F.col(column).cast("double").alias(name)
    )


def momentum_nesterov(spark, sf_dir):
    grads = part_table(spark, sf_dir, "p_size", "g")
    return two_momentum_steps(part_table(spark, sf_dir, "p_retailprice", "value"), grads, grads, nesterov=True)


def gradient_step(spark, sf_dir):
    params = part_table(spark, sf_dir, "p_retailprice", "value")
    moved = G.gradient_step(params, part_table(spark, sf_dir, "p_size", "g"), 0.05)
    return moved.select("var", "idx", F.round("value", 6).alias("value"))


def average_gradients(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem", "l_partkey", "l_linenumber", "l_returnflag", "l_discount")
    grads = items.select(
        F.col("l_linenumber").alias("replica"),
        F.col("l_returnflag").alias("var"),
        F.col("l_partkey").alias("idx"),
        F.col("l_discount").alias("g"),
    )
    return M.average_gradients(grads).select("var", "idx", F.round("g", 8).alias("g"))


def l2_penalty(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    var = F.when(F.col("label") == 0, F.lit("fc/biases")).otherwise(F.lit("fc/weights"))
    weights = rows.select(var.alias("var"), F.explode(V.as_doubles(F.col("features"))).alias("value"))
    return M.l2_penalty(weights).select(F.round("penalty", 6).alias("penalty"))


# --- schedules, batches, evaluation ------------------------------------------------------


def lr_schedule(spark, sf_dir):
    """One step per batch of 128 line items."""
    items = table(spark, sf_dir, "lineitem", *ITEM_ORDER)
    steps = take_batches(items, 128, *ITEM_ORDER).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.lit(-(-items.count() // 128)).cast("double")
    rates = [
        F.round(exp_decay(F.col("batch_id"), start, target, stairs, total), 10).alias(f"lr_{name}")
        for name, start, target, stairs, _ in DECAYED_GROUPS
    ]
    return steps.select(F.col("batch_id").alias("step"), "n_rows", *rates)


def param_groups_query(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem", "l_linenumber", "l_returnflag")
    kind = (
        F.when(F.col("l_returnflag") == "A", F.lit("weights"))
        .when(F.col("l_returnflag") == "N", F.lit("biases"))
        .otherwise(F.lit("scale"))
    )
    named = items.select(F.format_string("fc%d/%s", "l_linenumber", kind).alias("var"), "l_linenumber")
    variables = named.groupBy("var", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"))
    out = param_groups(variables, "var", F.col("l_linenumber"), F.lit(8.0))
    return out.select(
        "var", "n_rows", F.round("learning_rate", 10).alias("learning_rate"), "momentum"
    )


def mini_batches(spark, sf_dir):
    rows = take_batches(vectors(spark, sf_dir).select("vec_id", "label"), 64, "vec_id")
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("vec_id").alias("first_id"),
        F.max("vec_id").alias("last_id"),
        F.sum("label").alias("label_sum"),
    )


def repeat_epochs_query(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("vec_id", "label")
    epochs = epochs_needed(rows.count(), 128, 24)
    return repeat_epochs(rows, epochs).groupBy("epoch", "label").agg(F.count(F.lit(1)).alias("n"))


def evaluate_saved(spark, sf_dir):
    path = fresh_path(spark, "model")
    T.save_params(spark, T.Params(np.zeros((DIM, CLASSES)), BIASES), path, 0)
    T.save_params(spark, T.Params(WEIGHTS, BIASES), path, 100)
    out = T.evaluate(vectors(spark, sf_dir), path)
    return out.select("step", "correct", "total", F.round("precision", 6).alias("precision"))


def throughput(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity")
    trace = items.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("rows"), (F.sum("l_quantity") / 100).alias("seconds")
    )
    out = M.throughput(trace)
    return out.select(
        F.round("examples_per_sec", 6).alias("examples_per_sec"),
        F.round("sec_per_batch", 6).alias("sec_per_batch"),
        "steps",
    )


def synthetic_features(spark, sf_dir):
    ids = vectors(spark, sf_dir).select("vec_id")
    rows = with_synthetic_features(ids, 16, seed=3, key="vec_id")
    flat = rows.select("vec_id", "label", F.posexplode("features").alias("k", "value"))
    return flat.select("vec_id", "label", "k", F.round(F.col("value").cast("double"), 4).alias("value"))


def synthetic_repeated(spark, sf_dir):
    """One row for all, as its cells and how many rows have them."""
    ids = vectors(spark, sf_dir).select("vec_id")
    rows = with_synthetic_features(ids, 16, seed=3, repeat_one=True, key="vec_id")
    flat = rows.select("label", F.posexplode("features").alias("k", "value"))
    value = F.round(F.col("value").cast("double"), 4).alias("value")
    return flat.groupBy("label", "k", value).agg(F.count(F.lit(1)).alias("n"))


# --- pixels ------------------------------------------------------------------------------------


def standardize(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    return cells(rows.withColumn("s", V.standardize(V.as_doubles(F.col("features")))), "s")


def crop_pad(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    image = V.reshape(V.as_doubles(F.col("features")), 8, 8)
    return cells(rows.withColumn("s", V.flatten(V.crop_or_pad(image, 5, 11))), "s")


def flatten_cast(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    pixels = F.transform("features", lambda v: F.floor(v * 100).cast("int"))
    return cells(rows.withColumn("s", V.as_doubles(V.flatten(V.reshape(pixels, 8, 8)))), "s")


SUMMARY = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def column_summary(spark, sf_dir):
    out = M.column_summary(table(spark, sf_dir, "lineitem", *SUMMARY), list(SUMMARY))
    return out.select("column", *[F.round(c, 5).alias(c) for c in ("mean", "stddev", "max", "min")])


def column_histogram(spark, sf_dir):
    out = M.column_histogram(table(spark, sf_dir, "lineitem", *SUMMARY), list(SUMMARY), 16)
    return out.select("column", "bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


def summary_histogram(spark, sf_dir):
    """The bins beside the summary, with their counts added up."""
    out = M.column_summary(table(spark, sf_dir, "lineitem", *SUMMARY), list(SUMMARY), bins=7)
    total = F.aggregate("histogram", F.lit(0).cast("long"), lambda acc, bar: acc + bar["n"])
    first = F.get("histogram", F.lit(0))["n"]
    return out.select("column", F.round("max", 5).alias("max"), F.size("histogram").alias("bins"), total.alias("n"), first.alias("first_n"))


# --- oracles -------------------------------------------------------------------------------------

CELLS_SQL = """cells as materialized (
  select vec_id, label, unnest(range(64)) as i, unnest(embedding)::double as x from embeddings)"""
FIXED_SQL = f"""{CELLS_SQL},
w as (select i, k, sin(i * 10 + k) as w from range(64) t(i), range(10) u(k)),
logits as materialized (select vec_id, any_value(label) as label, k, sum(x * w) + cos(k) as z
  from cells join w using (i) group by vec_id, k)"""
PROBS_SQL = """probs as materialized (
  select vec_id, label, k, exp(z - m) / sum(exp(z - m)) over (partition by vec_id) as p,
    case when k = label then 1.0 else 0.0 end as y
  from (select *, max(z) over (partition by vec_id) as m from logits))"""
SCORED_SQL = f"with {FIXED_SQL}, {PROBS_SQL}"
GRADIENT_SQL = f"""{SCORED_SQL}
select 'weights' as var, i * 10 + k as idx, round(avg(x * (p - y)), 8) as g
  from cells join probs using (vec_id) group by i, k
union all select 'biases', k, round(avg(p - y), 8) from probs group by k"""
TOP1_SQL = """select sum(hit) as correct, count(*) as total, round(avg(hit), 6) as precision from (
  select vec_id, max(case when k = label and p >= m then 1 else 0 end) as hit
  from (select *, max(p) over (partition by vec_id) as m from probs) group by vec_id)"""
PARAMS_SQL = """select 'weights' as var, i * 10 + k as idx, round(w, 8) as value from w{n}
union all select 'biases', k, round(b, 8) from b{n}"""


def training_sql(
    rounds: int,
    rate: str = "0.05",
    part: str = "true",
    decay: str = "0",
    momentum: bool = False,
    weights: str = "0.0::double",
    biases: str = "0.0::double",
) -> str:
    """Gradient descent, written out round by round."""
    start = ", 0.0::double as v" if momentum else ""
    ctes = [
        CELLS_SQL,
        "placed as materialized (select vec_id, row_number() over (order by vec_id) - 1 as place from embeddings)",
        f"w0 as (select i, k, {weights} as w{start} from range(64) t(i), range(10) u(k))",
        f"b0 as (select k, {biases} as b{start} from range(10) u(k))",
    ]
    for t in range(rounds + 1):
        ctes.append(
            f"""z{t} as materialized (select vec_id, any_value(label) as label, k, sum(x * w) + any_value(b) as z
            from cells join w{t} using (i) join b{t} using (k) group by vec_id, k)"""
        )
        ctes.append(
            f"""p{t} as materialized (select vec_id, label, k, z, m, s, exp(z - m) / s as p,
              case when k = label then 1.0 else 0.0 end as y
            from (select *, sum(exp(z - m)) over (partition by vec_id) as s
              from (select *, max(z) over (partition by vec_id) as m from z{t})))"""
        )
        if t == rounds:
            break
        fed = f"p{t} join placed using (vec_id) where {part.format(t=t)}"
        ctes.append(
            f"""gw{t} as materialized (select i, k, avg(x * (p - y)) as g
            from cells join (select p{t}.* from {fed}) using (vec_id) group by i, k)"""
        )
        ctes.append(f"gb{t} as materialized (select k, avg(p - y) as g from {fed} group by k)")
        if momentum:
            rates = [
                f"({start} * pow(pow(1.0::double / {target}, 1.0::double / {stairs - 1}),"
                f" floor({t} / ({rounds}.0::double / {stairs - 1}))))"
                for _, start, target, stairs, _ in DECAYED_GROUPS
            ]
            ctes.append(
                f"""w{t + 1} as materialized (select i, k, w - {rates[0]} * (0.9 * v + g) as w, 0.9 * v + g as v
                from w{t} join gw{t} using (i, k))"""
            )
            ctes.append(
                f"""b{t + 1} as materialized (select k, b - {rates[1]} * (0.9 * v + g) as b, 0.9 * v + g as v
                from b{t} join gb{t} using (k))"""
            )
        else:
            ctes.append(
                f"""w{t + 1} as materialized (select i, k, w - {rate} * (g + {decay} * w) as w
                from w{t} join gw{t} using (i, k))"""
            )
            ctes.append(
                f"b{t + 1} as materialized (select k, b - {rate} * g as b from b{t} join gb{t} using (k))"
            )
    return "with " + ", ".join(ctes)


def trace_sql(rounds: int, **options) -> str:
    lines = []
    for t in range(rounds + 1):
        loss = f"(select avg(ln(s) + m - z) from p{max(t - 1, 0)} where k = label)"
        cell = f"(select avg(case when round_even(p, 0) = y then 1.0 else 0.0 end) from p{t})"
        top1 = f"""(select avg(hit) from (select max(case when k = label and p >= top then 1.0 else 0.0 end) as hit
          from (select *, max(p) over (partition by vec_id) as top from p{t}) group by vec_id))"""
        lines.append(
            f"select {t} as step, round({loss}, 6) as loss, round({cell}, 6) as cell_accuracy,"
            f" round({top1}, 6) as top1_accuracy"
        )
    return f"{training_sql(rounds, **options)} {' union all '.join(lines)}"


def momentum_sql(params: str, first: str, second: str, nesterov: bool = False) -> str:
    """Two update rounds; elements without a gradient stay as they are."""
    push = "g + 0.9 * (0.9 * v + g)" if nesterov else "0.9 * v + g"
    step = f"""select idx, case when g is null then value else value - 0.1 * ({push}) end as value,
      case when g is null then v else 0.9 * v + g end as v"""
    return f"""with a as (select idx, value, 0.0::double as v from ({params})),
    b as ({step} from a left join ({first}) using (idx)),
    c as ({step} from b left join ({second}) using (idx))"""


ORDER_PARAMS_SQL = "select o_orderkey as idx, o_totalprice / 1000 as value from orders"
ITEM_GRADS_SQL = (
    "select l_orderkey as idx, sum(l_discount) as g from lineitem where l_returnflag = '{}' group by 1"
)
PART_PARAMS_SQL = "select p_partkey as idx, p_retailprice as value from part"
PART_GRADS_SQL = "select p_partkey as idx, p_size::double as g from part"
UPDATED_SQL = " select '{}' as var, idx, round(value, 6) as value, round(v, 6) as v from c"
EDGE_ROWS = "(select *, list_transform(embedding, lambda x: x::double) as e from embeddings)"
SUMMARY_SQL = " union all ".join(
    f"""select '{c}' as "column", round(avg({c}), 5) as mean, round(stddev_pop({c}), 5) as stddev,
    round(max({c}), 5) as max, round(min({c}), 5) as min from lineitem"""
    for c in SUMMARY
)

HISTOGRAM_SQL = """select '{c}' as "column", bin::int as bin, round(lo + bin * ((hi - lo) / {bins}), 6) as low,
  round(case when bin = {bins} - 1 then hi else lo + (bin + 1) * ((hi - lo) / {bins}) end, 6) as high,
  (select count(*) from lineitem where least(floor(({c}::double - lo) / (hi - lo) * {bins}), {bins} - 1) = bin) as n
  from (select min({c})::double as lo, max({c})::double as hi from lineitem), range({bins}) t(bin)"""
UNIFORM_SQL = "((('0x' || substr(md5('3:' || {key} || ':' || {what}), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)"
SYNTHETIC_SQL = f"""sqrt(-2.0::double * ln({UNIFORM_SQL.format(key="{key}", what="'r' || k")}))
  * cos(2.0::double * pi() * {UNIFORM_SQL.format(key="{key}", what="'a' || k")}) as value,
  floor({UNIFORM_SQL.format(key="{key}", what="'label'")} * 1000)::int as label"""

BATCH_SQL = (
    "(place - 128 * {t} % (select count(*) from embeddings) + (select count(*) from embeddings))"
    " % (select count(*) from embeddings) < 128"
)

QUERIES = {
    "one_hot": (
        one_hot,
        """select vec_id, k, case when k = label then 1.0 else 0.0 end::double as value
        from embeddings, range(10) t(k)""",
    ),
    "feature_table": (
        feature_table,
        "select label, count(*) as n, max(len(embedding)) as dim from embeddings group by label",
    ),
    "softmax_predict": (softmax_predict, f"{SCORED_SQL} select vec_id, k, round(p, 6) as value from probs"),
    "dense_relu": (
        dense_relu,
        f"with {FIXED_SQL} select vec_id, k, round(greatest(z, 0.0), 6) as value from logits",
    ),
    "cross_entropy": (
        cross_entropy,
        f"{SCORED_SQL} select round(avg(-ln(p)), 6) as loss from probs where k = label",
    ),
    "cell_accuracy": (
        cell_accuracy,
        f"""{SCORED_SQL} select round(avg(case when round_even(p, 0) = y then 1.0 else 0.0 end), 6)
        as cell_accuracy from probs""",
    ),
    "top1_accuracy": (top1_accuracy, f"{SCORED_SQL} {TOP1_SQL}"),
    "softmax_gradient": (softmax_gradient, GRADIENT_SQL),
    "replica_gradients": (replica_gradients, GRADIENT_SQL),
    "train_softmax_trace": (train_softmax_trace, trace_sql(3)),
    "train_softmax_weights": (train_softmax_weights, training_sql(3) + PARAMS_SQL.format(n=3)),
    "train_replicas": (train_replicas, training_sql(3, "0.5") + PARAMS_SQL.format(n=3)),
    "train_l2": (train_l2, training_sql(3, decay="0.0005") + PARAMS_SQL.format(n=3)),
    "train_batches": (train_batches, training_sql(5, part=BATCH_SQL) + PARAMS_SQL.format(n=5)),
    "train_batch_replicas": (train_batch_replicas, training_sql(5, part=BATCH_SQL) + PARAMS_SQL.format(n=5)),
    "train_speed": (
        train_speed,
        "select step, (select count(*) from embeddings) as rows, true as timed from range(3) t(step)",
    ),
    "train_full": (train_full, trace_sql(40, weights="sin(i * 10 + k)", biases="cos(k)")),
    "train_all_epochs": (train_all_epochs, training_sql(40) + PARAMS_SQL.format(n=40)),
    "train_saved_trace": (
        train_saved_trace,
        f"select step, loss from ({trace_sql(2)})",
    ),
    "momentum_train": (momentum_train, training_sql(4, momentum=True) + PARAMS_SQL.format(n=4)),
    "momentum_sparse": (
        momentum_sparse,
        momentum_sql(ORDER_PARAMS_SQL, ITEM_GRADS_SQL.format("R"), ITEM_GRADS_SQL.format("A"))
        + UPDATED_SQL.format("embed/weights"),
    ),
    "momentum_nesterov": (
        momentum_nesterov,
        momentum_sql(PART_PARAMS_SQL, PART_GRADS_SQL, PART_GRADS_SQL, nesterov=True)
        + UPDATED_SQL.format("fc/weights"),
    ),
    "gradient_step": (
        gradient_step,
        """select 'fc/weights' as var, p_partkey as idx, round(p_retailprice - 0.05 * p_size, 6) as value
        from part""",
    ),
    "average_gradients": (
        average_gradients,
        """select l_returnflag as var, l_partkey as idx, round(avg(l_discount), 8) as g
        from lineitem group by 1, 2""",
    ),
    "l2_penalty": (
        l2_penalty,
        f"""with {CELLS_SQL} select round(0.0005 * sum(x * x) / 2, 6) as penalty from cells where label <> 0""",
    ),
    "lr_schedule": (
        lr_schedule,
        """with total as (select count(*) as c, ceil(count(*) / 128)::bigint as n from lineitem)
        select step, least(128, c - 128 * step) as n_rows,
          round(0.001 * pow(pow(1.0::double / 250, 1.0::double / 3), floor(step / (n / 3.0::double))), 10) as lr_weights,
          round(0.002 * pow(0.1::double, floor(step / n::double)), 10) as lr_biases
        from total, range(n) t(step)""",
    ),
    "param_groups": (
        param_groups_query,
        """select concat('fc', l_linenumber, '/', kind) as var, count(*) as n_rows,
          round(case kind
            when 'weights' then 0.001 * pow(pow(1.0::double / 250, 1.0::double / 3), floor(l_linenumber / (8.0::double / 3)))
            when 'biases' then 0.002 * pow(0.1::double, floor(l_linenumber / 8.0::double))
            else 0.02 end, 10) as learning_rate, 0.9::double as momentum
        from (select l_linenumber,
          case l_returnflag when 'A' then 'weights' when 'N' then 'biases' else 'scale' end as kind from lineitem)
        group by l_linenumber, kind""",
    ),
    "mini_batches": (
        mini_batches,
        """select place // 64 as batch_id, count(*) as n, min(vec_id) as first_id, max(vec_id) as last_id,
          sum(label) as label_sum
        from (select vec_id, label, row_number() over (order by vec_id) - 1 as place from embeddings) group by 1""",
    ),
    "repeat_epochs": (
        repeat_epochs_query,
        """select epoch, label, count(*) as n from embeddings,
          range((select ceil(128 * 24 / count(*))::bigint from embeddings)) t(epoch) group by 1, 2""",
    ),
    "evaluate_saved": (
        evaluate_saved,
        f"{SCORED_SQL} select 100 as step, correct, total, precision from ({TOP1_SQL})",
    ),
    "throughput": (
        throughput,
        """select round(avg(n / s), 6) as examples_per_sec, round(avg(s), 6) as sec_per_batch, count(*) as steps
        from (select count(*) as n, sum(l_quantity) / 100 as s from lineitem group by l_orderkey)""",
    ),
    "synthetic_features": (
        synthetic_features,
        f"""select vec_id, label, k, round(value::float::double, 4) as value from (
          select vec_id, k, {SYNTHETIC_SQL.format(key="vec_id")} from embeddings, range(16) t(k))""",
    ),
    "synthetic_repeated": (
        synthetic_repeated,
        f"""select label, k, round(value::float::double, 4) as value, count(*) as n from (
          select k, {SYNTHETIC_SQL.format(key="0")} from embeddings, range(16) t(k)) group by all""",
    ),
    "standardize": (
        standardize,
        f"""with {CELLS_SQL} select vec_id, i as k, round((x - mean) / greatest(dev, 0.125), 6) as value
        from (select *, avg(x) over (partition by vec_id) as mean,
          stddev_pop(x) over (partition by vec_id) as dev from cells)""",
    ),
    "crop_pad": (
        crop_pad,
        """select vec_id, r * 11 + c as k,
          round(case when c between 1 and 8 then embedding[(r + 1) * 8 + (c - 1) + 1]::double else 0.0 end, 6)
            as value
        from embeddings, range(5) t(r), range(11) u(c)""",
    ),
    "flatten_cast": (
        flatten_cast,
        """select vec_id, unnest(range(64)) as k,
          unnest(list_transform(embedding, lambda x: floor(x::double * 100)))::double as value from embeddings""",
    ),
    "column_summary": (column_summary, SUMMARY_SQL),
    "column_histogram": (column_histogram, " union all ".join(HISTOGRAM_SQL.format(c=c, bins=16) for c in SUMMARY)),
    "summary_histogram": (
        summary_histogram,
        " union all ".join(
            f"""select "column", (select round(max({c}), 5) from lineitem) as max, count(*) as bins, sum(n)::bigint as n,
            any_value(n) filter (where bin = 0) as first_n from ({HISTOGRAM_SQL.format(c=c, bins=7)}) group by 1"""
            for c in SUMMARY
        ),
    ),
}
