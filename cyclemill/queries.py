"""Every operator as a query over the given tables, with its SQL counterpart.

The cycle log is the ``events`` table: a user is an entity, its events in time
order are its cycles, ``value`` and the number in ``props`` are its sensors.
``customer`` supplies the ground truth of censored series.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemill.functions import expressions as X
from cyclemill.functions.lstm import Adam, Network, Weights
from cyclemill.operators import balance, columns, labels, metrics, parameters, scaling, sequences, splits
from cyclemill.operators.ordering import Extent, measure, number_rows
from cyclemill.plans import comparison, experiment
from cyclemill.plans.pipeline import label_censored, label_complete, prepare
from cyclemill.plans.scoring import score
from cyclemill.plans.training import Settings, average_round, export_rounds, open_rounds, train
from cyclemill.session import delete_table, kept, shared_folder
from cyclemill.sizing import small_side
from cyclemill.sources import logs
from cyclemill.sources.journal import Journal
from cyclemill.sources.models import read_stats, read_steps
from cyclemill.sources.states import put_part, read_parts
from cyclemill.sources.series import count_series, publish_series, published, read_series, write_series
from cyclemill.sources.versions import Versions

FEATURES = ["value", "k", "cycle_norm"]
TIME = ["ts", "event_id"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# ---------------------------------------------------------------- shared inputs


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(F.col("user_id").alias("id"), "ts", "event_id", "value", k.alias("k"))


def numbered(raw: DataFrame) -> tuple[DataFrame, Extent]:
    """The cycle log and the measured size of its longest series."""
    extent = measure(raw, ["id"])
    return number_rows(raw, ["id"], TIME, "cycle", "n_cycles", extent), extent


def cycle_log(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(raw_events(spark, sf))[0]


def labelled_log(spark: SparkSession, sf: str) -> tuple[DataFrame, Extent]:
    """Complete series: the length that numbering already knows gives the remaining life."""
    log, extent = numbered(raw_events(spark, sf))
    with_rul = log.withColumn("RUL", F.col("n_cycles") - F.col("cycle"))
    return scaling.with_cycle_feature(labels.horizon_labels(with_rul)), extent


def lengths(spark: SparkSession, sf: str) -> DataFrame:
    return labels.series_lengths(raw_events(spark, sf))


def phased_log(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_events(spark, sf)
    log, extent = numbered(raw)
    with_norm = scaling.with_cycle_feature(log)
    phases = splits.entity_phases(raw, extent=extent.as_one_group)
    return splits.split_entities(with_norm, phases, entities=extent.groups)


def truth_table(spark: SparkSession, sf: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("more"))


def censored_log(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, Extent]:
    """The log without the last ``more`` cycles of each entity, as if still in service.

    Also its ``(id, max)``. The log is numbered once and written; both come from that table.
    """
    log, extent = numbered(raw_events(spark, sf))
    log = kept(log.select("id", "cycle", "n_cycles", "value", "k"), "numbered")
    left = F.col("n_cycles") - F.col("more")
    known = log.where("cycle = 1").join(small_side(truth_table(spark, sf)), "id").select("id", left.alias("max"))
    seen = log.join(small_side(known, extent.groups), "id").where(F.col("cycle") <= F.col("max"))
    return seen.select("id", "cycle", "value", "k"), known, extent


def as_text(numbers, factor: int = 1):
    """An array as exact text, so that it compares across engines."""
    return F.array_join(F.transform(numbers, lambda x: F.round(x * factor).cast("long").cast("string")), ",")


LOG = """WITH log AS (
  SELECT user_id AS id, event_id, ts, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""
LABELLED = (
    LOG
    + """, labelled AS (
  SELECT *, n - cycle AS rul,
         CAST(CASE WHEN n - cycle <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label1,
         CAST(CASE WHEN n - cycle <= 15 THEN 2 WHEN n - cycle <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label2
  FROM log)"""
)
PHASED = (
    LOG
    + """, entities AS (
  SELECT id, row_number() OVER (ORDER BY id) AS entity_no, count(*) OVER () AS n_entities
  FROM (SELECT DISTINCT user_id AS id FROM events)),
phased AS (
  SELECT log.*, CASE WHEN entity_no <= floor(CAST(0.8 AS DOUBLE) * n_entities) THEN 'train' ELSE 'val' END AS phase
  FROM log JOIN entities USING (id))"""
)
CENSORED = (
    LOG
    + """, censored AS (
  SELECT id, cycle, value, k, CAST(c_nationkey AS BIGINT) AS more
  FROM log JOIN customer ON c_custkey = id WHERE cycle <= n - c_nationkey)"""
)
SCORED = (
    LABELLED
    + """, scored AS (
  SELECT id, cycle, label1, label2, value, list_value(value / 50, k / 50, CAST(cycle AS DOUBLE) / 50) AS z FROM labelled),
normed AS (
  SELECT *, list_transform(z, lambda x: exp(x - list_max(z))) AS e FROM scored),
soft AS (
  SELECT *, list_transform(e, lambda x: x / list_sum(e)) AS p FROM normed),
predicted AS (
  SELECT *, CAST(list_position(p, list_max(p)) - 1 AS BIGINT) AS prediction FROM soft)"""
)
Z_SCORES = """
  round((value - (SELECT avg(value) FROM fit)) / (SELECT stddev_pop(value) FROM fit), 6) AS value,
  round((k - (SELECT avg(k) FROM fit)) / (SELECT stddev_pop(k) FROM fit), 6) AS k,
  round((cycle - (SELECT avg(cycle) FROM fit)) / (SELECT stddev_pop(cycle) FROM fit), 6) AS cycle_norm"""
STATS = """
SELECT 'value' AS feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS low, max(value) AS high FROM {t}
UNION ALL SELECT 'k', round(avg(k), 6), round(stddev_pop(k), 6), min(k), max(k) FROM {t}
UNION ALL SELECT 'cycle_norm', round(avg(cycle), 6), round(stddev_pop(cycle), 6),
  CAST(min(cycle) AS DOUBLE), CAST(max(cycle) AS DOUBLE) FROM {t}"""
SAMPLES = (
    LABELLED
    + """, samples AS (
  SELECT *, row_number() OVER (ORDER BY id, cycle) - 1 AS sample_idx, count(*) OVER () AS n_all
  FROM labelled WHERE cycle > 50)"""
)


# ---------------------------------------------------------------- series and profiles


@query(LOG + " SELECT id, cycle, event_id, value, k FROM log ORDER BY id, cycle")
def cycle_numbering(spark, sf):
    return cycle_log(spark, sf).select("id", "cycle", "event_id", "value", "k").orderBy("id", "cycle")


@query("SELECT user_id AS id, count(*) AS n_cycles FROM events GROUP BY user_id")
def series_length(spark, sf):
    return lengths(spark, sf)


@query(LOG + " SELECT id, max(cycle) AS max FROM log GROUP BY id")
def max_cycle(spark, sf):
    return labels.max_cycles(cycle_log(spark, sf))


@query("SELECT count(DISTINCT user_id) AS n_entities FROM events")
def entity_count(spark, sf):
    return count_series(raw_events(spark, sf))


@query(PHASED + " SELECT phase, count(*) AS n_rows, count(DISTINCT id) AS n_entities FROM phased GROUP BY phase")
def split_shape(spark, sf):
    raw = raw_events(spark, sf)
    sized = labels.series_lengths(raw).join(splits.entity_phases(raw), "id")
    return sized.groupBy("phase").agg(
        F.sum("n_cycles").alias("n_rows"), F.count(F.lit(1)).alias("n_entities")
    )


@query(LOG + " SELECT id, cycle, event_id, value FROM log WHERE cycle <= 5")
def head_of_entity(spark, sf):
    return cycle_log(spark, sf).where("cycle <= 5").select("id", "cycle", "event_id", "value")


@query(
    PHASED
    + """ SELECT id, cycle, value, k FROM log WHERE id BETWEEN
  (SELECT min(id) FROM entities WHERE entity_no > floor(CAST(0.8 AS DOUBLE) * n_entities)) AND (SELECT max(id) FROM entities)"""
)
def entity_range(spark, sf):
    raw = raw_events(spark, sf)
    bounds = splits.entity_phases(raw).where("phase = 'val'").agg(F.min("id"), F.max("id")).first()
    log, _ = numbered(splits.entity_range(raw, *bounds))
    return log.select("id", "cycle", "value", "k")


# ---------------------------------------------------------------- labels


@query(LABELLED + " SELECT id, cycle, rul AS \"RUL\", label1, label2, CAST(cycle AS DOUBLE) AS cycle_norm FROM labelled")
def rul_labels(spark, sf):
    return labelled_log(spark, sf)[0].select("id", "cycle", "RUL", "label1", "label2", "cycle_norm")


@query(
    LOG
    + """ SELECT id, cycle, 60 + c_nationkey - cycle AS "RUL",
  CAST(CASE WHEN 60 + c_nationkey - cycle <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label1,
  CAST(CASE WHEN 60 + c_nationkey - cycle <= 15 THEN 2 WHEN 60 + c_nationkey - cycle <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label2
FROM log LEFT JOIN customer ON c_custkey = id + 20"""
)
def rul_left_join(spark, sf):
    """Ids are shifted, so that the last entities have no match."""
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    summary = customer.select((F.col("c_custkey") - 20).alias("id"), (F.col("c_nationkey") + 60).cast("long").alias("max"))
    log = cycle_log(spark, sf).select("id", "cycle")
    return labels.horizon_labels(labels.remaining_life(log, summary))


TRUTH_SQL = (
    CENSORED
    + """ SELECT id, cycle, max(cycle) OVER (PARTITION BY id) + more - cycle AS "RUL",
  CAST(CASE WHEN max(cycle) OVER (PARTITION BY id) + more - cycle <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label1,
  CAST(CASE WHEN max(cycle) OVER (PARTITION BY id) + more - cycle <= 15 THEN 2
            WHEN max(cycle) OVER (PARTITION BY id) + more - cycle <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label2
FROM censored"""
)


@query(TRUTH_SQL)
def rul_ground_truth(spark, sf):
    log, summary, extent = censored_log(spark, sf)
    out = label_censored(log, truth_table(spark, sf), summary=summary, entities=extent.groups)
    return out.select("id", "cycle", "RUL", "label1", "label2")


@query(TRUTH_SQL)
def rul_ground_truth_positional(spark, sf):
    log, summary, extent = censored_log(spark, sf)
    known = truth_table(spark, sf).join(summary.select("id"), "id", "left_semi")
    by_position = number_rows(known, [], ["id"], "_no", extent=extent.as_one_group)
    by_position = by_position.select(F.col("_no").alias("id"), "more")
    out = label_censored(log, by_position, align="position", summary=summary, entities=extent.groups)
    return out.select("id", "cycle", "RUL", "label1", "label2")


@query(
    PHASED
    + """, fit AS (SELECT * FROM phased WHERE phase = 'train'),
observed AS (
  SELECT p.*, n - cycle AS rul FROM phased p LEFT JOIN customer ON c_custkey = id
  WHERE phase = 'train' OR cycle <= n - c_nationkey)
SELECT phase, id, cycle, rul AS "RUL",
  CAST(CASE WHEN rul <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label1,
  CAST(CASE WHEN rul <= 15 THEN 2 WHEN rul <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label2,"""
    + Z_SCORES
    + " FROM observed"
)
def label_pipeline(spark, sf):
    """Training entities in full and the others cut off, labelled and scaled as users do it: by ``prepare``."""
    truth = truth_table(spark, sf)
    # numbered and split once; labels, statistics and scaling all read the written table
    phased = kept(phased_log(spark, sf).select("phase", "id", "cycle", "n_cycles", "value", "k"), "phased")
    complete = phased.where("phase = 'train'").select("id", "cycle", "value", "k")
    seen = F.col("cycle") <= F.col("n_cycles") - F.col("more")
    cut = phased.where("phase = 'val'").join(small_side(truth), "id").where(seen).select("id", "cycle", "value", "k")
    train_table, test_table, _ = prepare(complete, cut, truth, FEATURES)
    both = train_table.withColumn("phase", F.lit("train")).unionByName(test_table.withColumn("phase", F.lit("val")))
    return rounded(both.select("phase", "id", "cycle", *columns.TARGET_COLUMNS, *FEATURES), FEATURES)


def rounded(df, names, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


@query(
    LABELLED
    + """ SELECT 'features' AS part, value AS s1, k AS s2, cycle, CAST(NULL AS BIGINT) AS label2 FROM labelled
UNION ALL SELECT 'labels', NULL, NULL, NULL, label2 FROM labelled"""
)
def feature_label_split(spark, sf):
    table = labelled_log(spark, sf)[0].drop("ts", "event_id", "n_cycles")
    table = table.withColumnsRenamed({"value": "s1", "k": "s2"})
    features, targets = columns.split_features_labels(table)
    features = features.drop("id", "cycle_norm").withColumn("part", F.lit("features"))
    targets = targets.drop("id", "cycle", "RUL", "label1").withColumn("part", F.lit("labels"))
    return features.unionByName(targets, allowMissingColumns=True)


@query(LABELLED + " SELECT id, cycle, value, k, label2 FROM labelled")
def feature_label_pair(spark, sf):
    table = labelled_log(spark, sf)[0].drop("ts", "event_id", "n_cycles")
    features, targets = columns.split_features_labels(table)
    return columns.pair_features_labels(features, targets).select("id", "cycle", "value", "k", "label2")


@query(
    LABELLED
    + """ SELECT id, cycle, CAST(label2 = 0 AS INT) AS far, CAST(label2 = 1 AS INT) AS near,
  CAST(label2 = 2 AS INT) AS imminent FROM labelled"""
)
def one_hot(spark, sf):
    hot = labelled_log(spark, sf)[0].withColumn("_h", X.one_hot("label2", 3))
    return hot.select(
        "id", "cycle", *[F.col("_h")[i].alias(c) for i, c in enumerate(["far", "near", "imminent"])]
    )


# ---------------------------------------------------------------- scaling


@query(LOG + STATS.format(t="log"))
def scaler_stats(spark, sf):
    log = scaling.with_cycle_feature(cycle_log(spark, sf))
    return rounded(scaling.scaler_table(scaling.fit_scaler(log, FEATURES)), ["mean", "std"])


@query(PHASED + ", fit AS (SELECT * FROM phased WHERE phase = 'train')" + STATS.format(t="fit"))
def scaler_stats_split(spark, sf):
    train = phased_log(spark, sf).where("phase = 'train'")
    return rounded(scaling.scaler_table(scaling.fit_scaler(train, FEATURES)), ["mean", "std"])


@query(
    PHASED
    + ", fit AS (SELECT * FROM phased WHERE phase = 'train') SELECT id, cycle,"
    + Z_SCORES
    + " FROM phased WHERE phase = 'train'"
)
def scale_train(spark, sf):
    train = phased_log(spark, sf).where("phase = 'train'").select("id", "cycle", *FEATURES)
    return rounded(scaling.apply_scaler(train, scaling.fit_scaler(train, FEATURES)), FEATURES)


@query(
    PHASED
    + ", fit AS (SELECT * FROM phased WHERE phase = 'train') SELECT id, cycle,"
    + Z_SCORES
    + " FROM phased WHERE phase = 'val'"
)
def scale_test_with_train_stats(spark, sf):
    phased = phased_log(spark, sf)
    stats = scaling.fit_scaler(phased.where("phase = 'train'"), FEATURES)
    test = phased.where("phase = 'val'").select("id", "cycle", *FEATURES)
    return rounded(scaling.apply_scaler(test, stats), FEATURES)


# ---------------------------------------------------------------- splits and batches


@query(
    PHASED
    + """ SELECT id, entity_no, CASE WHEN entity_no <= floor(CAST(0.8 AS DOUBLE) * n_entities)
  THEN 'train' ELSE 'val' END AS phase FROM entities"""
)
def entity_split(spark, sf):
    return splits.entity_phases(raw_events(spark, sf))


@query(
    SAMPLES
    + """ SELECT id, cycle, sample_idx, CASE WHEN sample_idx < floor(CAST(0.8 AS DOUBLE) * n_all)
  THEN 'train' ELSE 'val' END AS phase FROM samples"""
)
def tail_split(spark, sf):
    return indexed_samples(spark, sf).select("id", "cycle", "sample_idx", "phase")


@query(SAMPLES + " SELECT id, cycle, sample_idx, CAST(sample_idx // 16 AS BIGINT) AS batch_id FROM samples")
def minibatches(spark, sf):
    return indexed_samples(spark, sf).select("id", "cycle", "sample_idx", "batch_id")


def indexed_samples(spark, sf):
    log, extent = numbered(raw_events(spark, sf))
    offsets = splits.sample_offsets(lengths(spark, sf), extent=extent.as_one_group)
    return splits.index_samples(log, offsets, entities=extent.groups)


# ---------------------------------------------------------------- sequences


WINDOW = "(PARTITION BY id ORDER BY cycle ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)"
CELLS = (
    LABELLED
    + """, cells AS (
  SELECT id, cycle, label1, list([CAST(round(value * 100) AS BIGINT), CAST(k * 100 AS BIGINT), cycle * 100])
    OVER """
    + WINDOW
    + """ AS w FROM labelled)"""
)


@query(
    CELLS
    + """ SELECT id, cycle AS label_cycle, array_to_string(flatten(w), ',') AS seq, CAST(label1 AS FLOAT) AS label
FROM cells WHERE cycle > 50"""
)
def sequences_(spark, sf):
    log, extent = labelled_log(spark, sf)
    rows = sequences.sliding_sequences(log, FEATURES, "label1", longest=extent.longest, order=TIME)
    return rows.withColumn("seq", as_text("seq", 100))


@query(
    LABELLED
    + """ SELECT id, cycle AS label_cycle, CAST(rul AS FLOAT) AS "RUL", CAST(label1 AS FLOAT) AS label1,
  CAST(label2 AS FLOAT) AS label2 FROM labelled WHERE cycle > 50"""
)
def sequence_labels(spark, sf):
    """A window's label is its next row's: no window is built to read it."""
    log, _ = labelled_log(spark, sf)
    labelled = log.where(F.col("cycle") > sequences.SEQUENCE_LENGTH)
    return labelled.select(
        "id",
        F.col("cycle").alias("label_cycle"),
        *[F.col(c).cast("float").alias(c) for c in ("RUL", "label1", "label2")],
    )


@query(
    """SELECT user_id AS id, count(*) AS n_cycles, greatest(count(*) - 50, 0) AS n_samples
FROM events GROUP BY user_id"""
)
def sequence_counts(spark, sf):
    return sequences.sequence_counts(lengths(spark, sf))


@query(
    LOG
    + f""" SELECT id, cycle AS label_cycle,
  concat_ws(',', array_to_string(list(CAST(round(value * 100) AS BIGINT)) OVER {WINDOW}, ','),
    array_to_string(list(CAST(k * 100 AS BIGINT)) OVER {WINDOW}, ','),
    array_to_string(list(cycle * 100) OVER {WINDOW}, ',')) AS seq
FROM log QUALIFY count(*) OVER {WINDOW} = 50"""
)
def sequence_layout(spark, sf):
    log, extent = labelled_log(spark, sf)
    rows = sequences.sliding_sequences(log, FEATURES, "label1", longest=extent.longest, order=TIME)
    turned = X.feature_major("seq", sequences.SEQUENCE_LENGTH, len(FEATURES))
    return rows.select("id", "label_cycle", as_text(turned, 100).alias("seq"))


BATCHED = (
    LABELLED
    + """, lives AS (
  SELECT id, count(*) AS steps, (row_number() OVER (ORDER BY id) - 1) // 16 AS batch_id FROM labelled GROUP BY id),
widths AS (
  SELECT id, steps, CAST(batch_id AS BIGINT) AS batch_id, max(steps) OVER (PARTITION BY batch_id) AS batch_steps FROM lives),
grid AS (SELECT *, unnest(range(1, batch_steps + 1)) AS t FROM widths),
padded AS (
  SELECT g.id, g.batch_id, g.t, CAST((g.t - 1) // 50 AS BIGINT) AS block, g.t - g.batch_steps + g.steps AS pos,
    CAST(coalesce(round(value * 100), 0) AS BIGINT) AS a, CAST(coalesce(k * 100, 0) AS BIGINT) AS b,
    coalesce(l.cycle * 100, 0) AS c,
    CASE WHEN l.id IS NULL THEN '0,0,0' WHEN label2 = 0 THEN '1,0,0' WHEN label2 = 1 THEN '0,1,0' ELSE '0,0,1' END AS y,
    CASE WHEN l.id IS NULL THEN '0' ELSE '1' END AS mask
  FROM grid g LEFT JOIN labelled l ON l.id = g.id AND l.cycle = g.t - g.batch_steps + g.steps)"""
)


@query(
    BATCHED
    + """ SELECT batch_id, id, block, min(pos) AS first_pos, string_agg(a || ',' || b || ',' || c, ',' ORDER BY t) AS x,
  string_agg(y, ',' ORDER BY t) AS y, string_agg(mask, ',' ORDER BY t) AS mask
FROM padded GROUP BY batch_id, id, block HAVING max(mask) = '1'"""
)
def pad_align_end(spark, sf):
    padded = padded_log(spark, sf)
    return padded.select(
        "batch_id",
        "id",
        "block",
        "first_pos",
        as_text("x", 100).alias("x"),
        as_text(F.flatten("y")).alias("y"),
        as_text("mask").alias("mask"),
    )


def padded_log(spark, sf):
    log, extent = labelled_log(spark, sf)
    batches = sequences.life_batches(lengths(spark, sf), extent=extent.as_one_group)
    return sequences.padded_lives(log, batches, FEATURES, "label2", 3)


@query(
    LOG
    + """ SELECT id, CAST((cycle - 1) // 50 AS BIGINT) AS chunk, min(cycle) AS first_step, max(cycle) AS last_step,
  count(*) AS n_steps FROM log GROUP BY ALL"""
)
def tbptt_chunks(spark, sf):
    return sequences.step_chunks(cycle_log(spark, sf))


# ---------------------------------------------------------------- scores and metrics


def scored_log(spark, sf):
    """A fixed score per row, so that the metrics below have an exact counterpart."""
    scores = F.array(F.col("value") / 50, F.col("k") / 50, F.col("cycle") / 50.0)
    soft = labelled_log(spark, sf)[0].withColumn("prob", X.activation(scores, 3))
    return soft.withColumns(
        {"prediction": X.arg_max("prob"), "score": F.col("value") / (1 + F.col("value"))}
    )


@query(
    SCORED
    + """ SELECT id, cycle, round(p[1], 6) AS p0, round(p[2], 6) AS p1, round(p[3], 6) AS p2, prediction,
  round(1 / (1 + exp(-z[1])), 6) AS sigmoid, round(tanh(z[2]), 6) AS tanh,
  greatest(least(z[2] - 1, 0.5::DOUBLE), -0.5::DOUBLE) AS clipped
FROM predicted"""
)
def softmax_scores(spark, sf):
    p = F.col("prob")
    return scored_log(spark, sf).select(
        "id",
        "cycle",
        *[F.round(p[i], 6).alias(f"p{i}") for i in range(3)],
        "prediction",
        F.round(X.sigmoid(F.col("value") / 50), 6).alias("sigmoid"),
        F.round(F.tanh(F.col("k") / 50), 6).alias("tanh"),
        X.clip(F.col("k") / 50 - 1).alias("clipped"),
    )


@query(
    SCORED
    + """ SELECT 'multiclass' AS kind, round(avg(-ln(greatest(least(p[label2 + 1], 1 - 1e-7), 1e-7))), 6) AS loss,
  count(*) AS n FROM soft
UNION ALL
SELECT 'binary', round(avg(-ln(greatest(least(
    CASE WHEN label1 = 1 THEN value / (1 + value) ELSE 1 - value / (1 + value) END, 1 - 1e-7), 1e-7))), 6), count(*)
FROM scored"""
)
def cross_entropy(spark, sf):
    scored = scored_log(spark, sf)
    multi = metrics.cross_entropy(scored, "prob", "label2").withColumn("kind", F.lit("multiclass"))
    binary = metrics.binary_cross_entropy(scored, "score", "label1").withColumn("kind", F.lit("binary"))
    return rounded(multi.unionByName(binary), ["loss"])


CONFUSION = SCORED + """, confusion AS (
  SELECT label2 AS label, prediction, count(*) AS n FROM predicted GROUP BY ALL)"""
CLASSES = (
    CONFUSION
    + """, classes AS (
  SELECT c AS class, coalesce(sum(n) FILTER (label = c AND prediction = c), 0) AS tp,
    coalesce(sum(n) FILTER (label = c), 0) AS actual, coalesce(sum(n) FILTER (prediction = c), 0) AS predicted
  FROM confusion, (SELECT DISTINCT unnest([label, prediction]) AS c FROM confusion) GROUP BY c),
rated AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted END AS precision,
    CASE WHEN actual > 0 THEN tp / actual END AS recall,
    CASE WHEN actual + predicted > 0 THEN 2 * tp / (actual + predicted) END AS f1 FROM classes)"""
)


@query(CONFUSION + " SELECT * FROM confusion")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored_log(spark, sf), "label2")


@query(
    CLASSES
    + """ SELECT class, CAST(tp AS BIGINT) AS tp, CAST(actual AS BIGINT) AS actual, CAST(predicted AS BIGINT) AS predicted,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM rated"""
)
def class_metrics(spark, sf):
    matrix = metrics.confusion_matrix(scored_log(spark, sf), "label2")
    return rounded(metrics.per_class_metrics(matrix), ["precision", "recall", "f1"])


@query(
    CLASSES
    + """ SELECT round(sum(tp) / sum(actual), 6) AS accuracy, round(avg(precision), 6) AS precision,
  round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, count(precision) AS precision_classes,
  count(recall) AS recall_classes FROM rated"""
)
def summary_metrics(spark, sf):
    matrix = metrics.confusion_matrix(scored_log(spark, sf), "label2")
    return rounded(metrics.summary_metrics(matrix), ["accuracy", "precision", "recall", "f1"])


@query(
    CLASSES
    + """ SELECT (SELECT round(avg(-ln(greatest(least(p[label2 + 1], 1 - 1e-7), 1e-7))), 6) FROM soft) AS loss,
  round(sum(tp) / sum(actual), 6) AS accuracy, round(avg(precision), 6) AS precision,
  round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, count(precision) AS precision_classes,
  count(recall) AS recall_classes FROM rated"""
)
def evaluation(spark, sf):
    """The one-pass evaluation that training and testing use."""
    scored = scored_log(spark, sf).select(F.col("label2").alias("label"), "prob", "prediction")
    return rounded(metrics.evaluation(scored), ["loss", "accuracy", "precision", "recall", "f1"])


POINTS = (
    LABELLED
    + """, per_score AS (
  SELECT value / (1 + value) AS threshold, CAST(sum(label1) AS BIGINT) AS pos, CAST(sum(1 - label1) AS BIGINT) AS neg
  FROM labelled GROUP BY 1),
points AS (
  SELECT *, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
    CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
    CAST(sum(pos) OVER () AS BIGINT) AS all_pos, CAST(sum(neg) OVER () AS BIGINT) AS all_neg FROM per_score)"""
)


@query(
    POINTS
    + """ SELECT round(threshold, 9) AS threshold, pos, neg, tp, fp, all_pos, all_neg,
  round(tp / all_pos, 6) AS tpr, round(fp / all_neg, 6) AS fpr FROM points"""
)
def roc_points(spark, sf):
    points = rounded(metrics.roc_points(scored_log(spark, sf), "score", "label1"), ["tpr", "fpr"])
    return rounded(points, ["threshold"], 9)


@query(
    LABELLED
    + """, ranked AS (
  SELECT label1, rank() OVER (ORDER BY value / (1 + value))
    + (count(*) OVER (PARTITION BY value / (1 + value)) - 1) / 2 AS mid_rank FROM labelled)
SELECT round((sum(mid_rank) FILTER (label1 = 1) - sum(label1) * (sum(label1) + 1) / 2)
  / (CAST(sum(label1) AS DOUBLE) * sum(1 - label1)), 6) AS auc FROM ranked"""
)
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(metrics.roc_points(scored_log(spark, sf), "score", "label1")), ["auc"])


@query(
    LABELLED
    + """ SELECT label2 AS label, CAST(least(floor(k / 34), 2) AS BIGINT) AS prediction, count(*) AS n
FROM labelled GROUP BY ALL"""
)
def masked_timestep_eval(spark, sf):
    width = len(FEATURES)
    k_of_step = X.bind(
        F.col("x"), lambda x: F.transform("mask", lambda _, t: F.get(x, (t * width + 1).cast("int")))
    )
    guess = F.transform(k_of_step, lambda k: F.least(F.floor(k / 34), F.lit(2)))
    actual = F.transform("y", X.arg_max)
    padded = padded_log(spark, sf).select("mask", actual.alias("label"), guess.alias("prediction"))
    return metrics.confusion_matrix(sequences.unmasked_steps(padded, "label", "prediction"))


# ---------------------------------------------------------------- parameters


@query(
    """SELECT CAST(label AS BIGINT) AS layer, pos, round(sum(v * w) / sum(w), 6) AS value, CAST(sum(w) AS BIGINT) AS n
FROM (SELECT label, vec_id + 1 AS w, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos FROM embeddings)
GROUP BY label, pos"""
)
def weighted_param_average(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("label").cast("long").alias("layer"),
        (F.col("vec_id") + 1).alias("n"),
        F.col("embedding").cast("array<double>").alias("values"),
    )
    return rounded(parameters.weighted_average(vectors, by=["layer"]), ["value"])


@query("SELECT CAST(label AS BIGINT) AS layer, CAST(sum(len(embedding)) AS BIGINT) AS n_params FROM embeddings GROUP BY label")
def param_counts(spark, sf):
    model = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("label").cast("long").alias("layer"), F.col("embedding").alias("values")
    )
    return parameters.parameter_counts(model)


# ---------------------------------------------------------------- training and scoring


@query(
    SAMPLES
    + """, wanted AS (
  SELECT CAST(s.sample_idx // 16 AS BIGINT) AS batch_id, l.id, l.cycle AS pos, l.value, l.k, l.label1,
    bool_or(l.cycle = s.cycle) AS is_label
  FROM samples s JOIN labelled l ON l.id = s.id AND l.cycle BETWEEN s.cycle - 50 AND s.cycle GROUP BY ALL)
SELECT batch_id, id, pos, CAST(round(value * 100) AS BIGINT) || ',' || CAST(k * 100 AS BIGINT) || ',' || pos * 100 AS x,
  CAST(label1 AS FLOAT) AS y, is_label FROM wanted"""
)
def window_batch_rows(spark, sf):
    """What the trainer reads: the rows of every minibatch of windows."""
    log, extent = labelled_log(spark, sf)
    offsets = splits.sample_offsets(lengths(spark, sf), extent=extent.as_one_group)
    rows = splits.window_batch_rows(log, offsets, FEATURES, "label1", entities=extent.groups)
    return rows.withColumn("x", as_text("x", 100)).drop("t")


@query(
    BATCHED
    + """ SELECT batch_id, l.id, l.cycle AS pos, l.cycle + batch_steps - steps AS t, CAST(label2 AS FLOAT) AS y
FROM labelled l JOIN widths USING (id)"""
)
def life_batch_rows(spark, sf):
    """What the trainer reads: the rows of every minibatch of whole lives."""
    log, extent = labelled_log(spark, sf)
    batches = sequences.life_batches(lengths(spark, sf), extent=extent.as_one_group)
    return splits.life_batch_rows(log, batches, FEATURES, "label2").select("batch_id", "id", "pos", "t", "y")


def scaled_phases(spark, sf):
    """Labelled log, split by entity and standardised with the training entities' statistics."""
    log, extent = labelled_log(spark, sf)
    phases = splits.entity_phases(raw_events(spark, sf), extent=extent.as_one_group)
    phased = splits.split_entities(log, phases, entities=extent.groups)
    train_log = phased.where("phase = 'train'")
    return scaling.apply_scaler(phased, scaling.fit_scaler(train_log, FEATURES)), phases, extent


def window_rows(spark, sf, phase, label, batch_size):
    scaled, phases, extent = scaled_phases(spark, sf)
    mine = F.col("phase") == phase
    known = lengths(spark, sf).join(phases.where(mine), "id", "left_semi")
    offsets = splits.sample_offsets(known, extent=extent.as_one_group)
    return splits.window_batch_rows(
        scaled.where(mine), offsets, FEATURES, label, batch_size=batch_size, entities=extent.groups
    )


WORKERS = 8


def training_stats(spark, rows, net, settings, validation=None):
    """Statistics of a training run, one row per worker and round; the tables it needed are deleted."""
    path = shared_folder(spark, "stats")
    rounds = export_rounds(rows, settings)
    try:
        train(spark, rounds, net, settings, validation=validation, stats_path=path)
        # workers times rounds, which the driver has run one by one
        stats = spark.createDataFrame(read_stats(spark, path).toArrow())
    finally:
        rounds.delete()
        delete_table(spark, path)
    return stats.select("run", "epoch", "round", "worker", "n", F.round("loss", 6).alias("loss"))


@query()
def averaged_training(spark, sf):
    """One epoch of window training on the first entities, validated on the rest."""
    net = Network(features=len(FEATURES), outputs=1, units=(8,))
    settings = Settings(epochs=1, workers=WORKERS, evaluations_per_epoch=3)
    rows = window_rows(spark, sf, "train", "label1", 16)
    return training_stats(spark, rows, net, settings, window_rows(spark, sf, "val", "label1", 512))


@query()
def averaged_training_per_step(spark, sf):
    """One epoch on whole lives of the first entities, one class per cycle, validated on the rest."""
    net = Network(features=len(FEATURES), outputs=3, units=(8,), many_to_one=False)
    scaled, phases, extent = scaled_phases(spark, sf)

    def rows(phase):
        known = lengths(spark, sf).join(phases.where(F.col("phase") == phase), "id", "left_semi")
        batches = sequences.life_batches(known, extent=extent.as_one_group)
        return splits.life_batch_rows(scaled, batches, FEATURES, "label2")

    return training_stats(spark, rows("train"), net, Settings(epochs=1, workers=WORKERS), rows("val"))


@query()
def batch_scoring(spark, sf):
    """Every window through a network with its initial weights."""
    net = Network(features=len(FEATURES), outputs=1, units=(8,))
    log, extent = labelled_log(spark, sf)
    offsets = splits.sample_offsets(lengths(spark, sf), extent=extent.as_one_group)
    rows = splits.window_batch_rows(log, offsets, FEATURES, "label1", batch_size=512, entities=extent.groups)
    scored = score(rows, net, net.initial())
    return scored.select("id", F.col("pos").alias("cycle"), "label", F.round(F.col("prob")[1], 6).alias("prob"), "prediction")


LINEAR = Network(features=len(FEATURES), outputs=1, units=(), precision="float64")
LINEAR_SUM = " + ".join(
    f"CAST({float(w)!r} AS DOUBLE) * CAST(CAST({c} / 64 AS FLOAT) AS DOUBLE)" for w, c in zip(LINEAR.initial(), ["value", "k", "CAST(cycle AS DOUBLE)"])
)


@query(
    LOG
    + f""", linear AS (SELECT id, cycle + 1 AS cycle, 1 / (1 + exp(-({LINEAR_SUM}))) AS p FROM log WHERE cycle < n)
SELECT id, cycle, round(p, 5) AS prob, CAST(p > 0.5 AS BIGINT) AS prediction FROM linear WHERE cycle > 50"""
)
def batch_scoring_linear(spark, sf):
    """Bulk scoring with a network without hidden layers: it sees the window's last row."""
    log, extent = labelled_log(spark, sf)
    # a power of two keeps the features equal in both engines' single precision
    log = log.withColumns({c: F.col(c) / 64 for c in FEATURES})
    offsets = splits.sample_offsets(lengths(spark, sf), extent=extent.as_one_group)
    rows = splits.window_batch_rows(
        log, offsets, FEATURES, "label1", batch_size=512, entities=extent.groups
    )
    scored = score(rows, LINEAR, LINEAR.initial())
    return scored.select(
        "id", F.col("pos").alias("cycle"), F.round(F.col("prob")[1], 5).alias("prob"), "prediction"
    )


PEEP = Network(features=len(FEATURES), outputs=1, units=(1,), precision="float64", peepholes=True)
PEEP_VALUES = PEEP.initial()
# its three peepholes: input and forget gate, then output gate
PEEP.layer_blocks(PEEP.blocks(PEEP_VALUES), 0)[3][:, 0] = 0.5, -0.25, 0.75


def peephole_sql() -> str:
    """One unit over two steps: gate sums of every row, the step from nothing, and the step after it."""
    (wx, wh, b, peep), (w, bias) = PEEP.layer_blocks(PEEP.blocks(PEEP_VALUES), 0), PEEP.blocks(PEEP_VALUES)[-2:]

    def number(v):
        return f"CAST({float(v)!r} AS DOUBLE)"

    def sigmoid(z):
        return f"1 / (1 + exp(-({z})))"

    cells = ["value", "k", "CAST(cycle AS DOUBLE)"]
    x = [f"CAST(CAST({c} / 64 AS FLOAT) AS DOUBLE)" for c in cells]
    sums = ", ".join(
        " + ".join(f"{number(wx[j, g])} * {x[j]}" for j in range(3)) + f" + {number(b[g])} AS z{g}" for g in range(4))
    again = ", ".join(f"z{g} + {number(wh[0, g])} * lag(h) OVER w AS y{g}" for g in range(4))
    p = [number(v) for v in peep[:, 0]]
    return f"""{LOG}, driven AS (SELECT id, cycle, n, {sums} FROM log),
cell AS (SELECT *, {sigmoid("z0")} * tanh(z3) AS c FROM driven),
one AS (SELECT *, {sigmoid(f"z2 + c * {p[2]}")} * tanh(c) AS h FROM cell),
two AS (SELECT id, cycle, n, {again}, lag(c) OVER w AS c1 FROM one WINDOW w AS (PARTITION BY id ORDER BY cycle)),
after AS (SELECT *, {sigmoid(f"y1 + c1 * {p[1]}")} * c1 + {sigmoid(f"y0 + c1 * {p[0]}")} * tanh(y3) AS c2 FROM two),
last AS (SELECT *, {sigmoid(f"y2 + c2 * {p[2]}")} * tanh(c2) AS h2 FROM after)
SELECT id, cycle + 1 AS cycle, round({sigmoid(f"{number(w[0, 0])} * h2 + {number(bias[0])}")}, 6) AS prob
FROM last WHERE cycle > 1 AND cycle < n"""


@query(peephole_sql())
def peephole_scoring(spark, sf):
    """Windows of two rows through a cell with peepholes."""
    log, extent = labelled_log(spark, sf)
    log = log.withColumns({c: F.col(c) / 64 for c in FEATURES})
    offsets = splits.sample_offsets(lengths(spark, sf), 2, extent=extent.as_one_group)
    rows = splits.window_batch_rows(log, offsets, FEATURES, "label1", 2, 512, entities=extent.groups)
    scored = score(rows, PEEP, PEEP_VALUES, 2)
    return scored.select("id", F.col("pos").alias("cycle"), F.round(F.col("prob")[1], 6).alias("prob"))


@query(
    LABELLED
    + """ SELECT id, cycle AS pos, CAST(label1 AS DOUBLE) AS label, 150 AS n_numbers, round(CAST(lag(value, 50) OVER w AS FLOAT)::DOUBLE, 4) AS oldest,
  round(CAST(lag(k, 1) OVER w AS FLOAT)::DOUBLE, 4) AS newest
FROM labelled WINDOW w AS (PARTITION BY id ORDER BY cycle) QUALIFY cycle > 50"""
)
def comparison_samples(spark, sf):
    """What the comparison model reads: every window as one flat vector."""
    series = experiment.Series.of(labelled_log(spark, sf)[0])
    rows = comparison.window_vectors(series, FEATURES, "label1", 50).withColumn("x", vector_to_array("x"))
    return rows.select(
        "id", "pos", "label", F.size("x").alias("n_numbers"), F.round(F.col("x")[0], 4).alias("oldest"),
        F.round(F.element_at("x", -2), 4).alias("newest"))


@query()
def mlp_baseline(spark, sf):
    """The comparison model, trained on the first entities, on the windows of all."""
    log = phased_log(spark, sf).drop("phase")
    labelled = labels.horizon_labels(log.withColumn("RUL", F.col("n_cycles") - F.col("cycle")))
    labelled = kept(labelled.select("id", "cycle", *FEATURES, "label1"), "labelled")
    model = comparison.fit_comparison(labelled, FEATURES, settings=comparison.Perceptron(hidden=(8,), iterations=10))
    scored, _ = comparison.evaluate_comparison(labelled, model, FEATURES)
    return scored.select("id", F.col("pos").alias("cycle"), "label", F.round(F.col("prob")[1], 6).alias("prob"), "prediction")


# ---------------------------------------------------------------- odd logs, and tables written and read again


@query(
    LABELLED
    + """ SELECT 'train' AS phase, id, cycle, value + 1 AS value, label2 FROM labelled WHERE label2 > 0
UNION ALL SELECT 'test', id, cycle, value, label2 FROM labelled"""
)
def published_series(spark, sf):
    """Two phases published, then one of them again; of a third version only the rows were written."""
    folder = shared_folder(spark, "versions")
    log = labelled_log(spark, sf)[0].select("id", "cycle", "value", *columns.TARGET_COLUMNS)
    log = kept(log, "labelled")
    publish_series(log, folder, "train")
    publish_series(log, folder, "test")
    publish_series(log.where("label2 > 0").withColumn("value", F.col("value") + 1), folder, "train")
    write_series(log.where("id < 0"), Versions(spark, folder).fresh(), "test")
    features, targets = columns.split_features_labels(log)
    parts = []
    for phase in ("train", "test"):
        place = published(spark, folder, phase)
        a, b = (read_series(spark, place, phase, kind, t.schema) for kind, t in (("features", features), ("labels", targets)))
        rows = columns.pair_features_labels(a, b).select("id", "cycle", "value", "label2")
        parts.append(rows.withColumn("phase", F.lit(phase)))
    return reduce(DataFrame.unionByName, parts)


ODD = LOG + """, odd AS (SELECT *, cycle * 3 + id * 1000 + cycle // 7 AS late FROM log)"""


def odd_log(spark, sf):
    """The log with cycles that begin late and have gaps."""
    log, _ = labelled_log(spark, sf)
    late = F.col("cycle") * 3 + F.col("id") * 1000 + F.floor(F.col("cycle") / 7)
    return log.select("id", late.alias("cycle"), "value", "k", *columns.TARGET_COLUMNS)


@query(
    ODD
    + """, labels AS (
  SELECT id, cycle AS pos, row_number() OVER (ORDER BY id, cycle) - 1 AS i, lag(value, 1) OVER w AS v1, lag(value, 50) OVER w AS v50,
    n - cycle AS rul FROM odd WINDOW w AS (PARTITION BY id ORDER BY late) QUALIFY cycle > 50)
SELECT CAST((row_number() OVER (ORDER BY id, pos) - 1) // 16 AS BIGINT) AS batch_id, id, pos,
  round(CAST(v1 AS FLOAT)::DOUBLE, 4) AS newest, round(CAST(v50 AS FLOAT)::DOUBLE, 4) AS oldest, CAST(rul AS FLOAT) AS y FROM labels"""
)
def windows_of_odd_cycles(spark, sf):
    """The windows that training reads from a log with gaps: made of rows, not of cycle numbers."""
    rows = experiment.window_rows(experiment.Series.of(odd_log(spark, sf)), ["value"], "RUL", 50, 16)
    cells = rows.groupBy("batch_id", "id").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.get("x", F.lit(0)).alias("v"), "y", "is_label"))).alias("cells")
    )
    labelled = cells.select("batch_id", "id", "cells", F.posexplode("cells").alias("at", "cell")).where("cell.is_label")

    def back(n):
        return F.round(F.get("cells.v", F.col("at") - n).cast("double"), 4)

    return labelled.select(
        "batch_id", "id", F.col("cell.pos").alias("pos"), back(1).alias("newest"), back(50).alias("oldest"), F.col("cell.y").alias("y")
    )


@query(
    BATCHED
    + """, phased AS (
  SELECT *, CASE WHEN rank <= floor(CAST(0.8 AS DOUBLE) * n_ids) THEN 'train' ELSE 'val' END AS phase FROM (
    SELECT id, row_number() OVER (ORDER BY id) AS rank, count(*) OVER () AS n_ids, count(*) AS steps FROM labelled GROUP BY id)),
kept AS (SELECT phase, id, steps FROM phased UNION ALL SELECT 'test', id, steps FROM phased),
placed AS (SELECT *, CAST((row_number() OVER (PARTITION BY phase ORDER BY id) - 1) // 16 AS BIGINT) AS batch_id FROM kept),
timed AS (SELECT *, max(steps) OVER (PARTITION BY phase, batch_id) AS batch_steps FROM placed)
SELECT phase, batch_id, t.id, cycle AS pos, cycle + batch_steps - steps AS t, CAST(rul AS FLOAT) AS y,
  CAST(round(value * 100) AS BIGINT) AS v FROM timed t JOIN labelled l ON l.id = t.id"""
)
def stored_minibatches(spark, sf):
    """Minibatches ingested twice, the second time over the first, and read back row by row."""
    path = shared_folder(spark, "ingest")
    log = odd_log(spark, sf)
    for _ in range(2):
        experiment.ingest(log, log, path, ["value"], "RUL", rescale=False)
    phases = [
        experiment.stored_rows(spark, path, phase, 1).withColumn("phase", F.lit(phase)) for phase in ("train", "val", "test")
    ]
    rows = reduce(DataFrame.unionByName, phases)
    v = F.round(F.get("x", F.lit(0)).cast("double") * 100).cast("long")
    return rows.select("phase", "batch_id", "id", "pos", "t", "y", v.alias("v"))


UNITS_OF = """, unit_log AS (
  SELECT CASE WHEN id % 2 = 0 THEN '001' ELSE '002' END AS unit, CAST(id // 2 AS BIGINT) AS engine, id, cycle, value, k, n FROM log)"""


@query(
    LOG
    + UNITS_OF
    + """ SELECT unit, engine, cycle, value AS setting1, k AS s1, 0.0::DOUBLE AS s21, n - cycle AS "RUL",
  CAST(CASE WHEN n - cycle <= 30 THEN 1 ELSE 0 END AS BIGINT) AS label1 FROM unit_log"""
)
def text_log_round_trip(spark, sf):
    """The log as text files of two units that share engine numbers, read again and labelled."""
    folder = shared_folder(spark, "logs")
    log = cycle_log(spark, sf)
    zero = F.lit("0.0")
    line = F.concat_ws(
        " ", F.floor(F.col("id") / 2), "cycle", "value", zero, zero, "k", *[zero] * 20, F.lit(""), F.lit("")
    )
    for remainder, unit in enumerate(("001", "002")):
        # a unit's engines stand in order of their number, as in the published files
        lines = log.where(F.col("id") % 2 == remainder).select(line.alias("value"))
        lines.write.text(f"{folder}/{logs.FILE_NAME.format(kind='train', unit=unit)}")
    read = label_complete(logs.read_units(spark, folder, "train", ("001", "002")))
    return read.select(
        "unit", F.col("engine").cast("long").alias("engine"), F.col("cycle").cast("long").alias("cycle"), "setting1", "s1", "s21",
        F.col("RUL").cast("long").alias("RUL"), F.col("label1").cast("long").alias("label1"),
    )


@query(
    LABELLED
    + """ SELECT 'features' AS kind, id, cycle, value, k, CAST(NULL AS BIGINT) AS "RUL", CAST(NULL AS BIGINT) AS label2 FROM labelled
UNION ALL SELECT 'labels', id, cycle, NULL, NULL, rul, label2 FROM labelled"""
)
def series_round_trip(spark, sf):
    """Feature and label series written in buckets of entities and read again."""
    folder = shared_folder(spark, "series")
    log = labelled_log(spark, sf)[0].select("id", "cycle", "value", "k", *columns.TARGET_COLUMNS)
    write_series(log, folder, "train")
    features, targets = columns.split_features_labels(log)
    a = read_series(spark, folder, "train", "features", features.schema).withColumn("kind", F.lit("features"))
    b = read_series(spark, folder, "train", "labels", targets.schema).withColumn("kind", F.lit("labels")).drop("label1")
    return a.unionByName(b, allowMissingColumns=True)


LINEAR_CELLS = ["value", "k", "CAST(cycle AS DOUBLE)"]


@query(
    SAMPLES
    + f""", seen AS (
  SELECT s.sample_idx // 512 AS worker, s.label1 AS y, {", ".join(f"CAST(CAST(l.{c.replace('CAST(cycle', 'cycle').replace(' AS DOUBLE)', '')} / 64 AS FLOAT) AS DOUBLE) AS x{i}" for i, c in enumerate(LINEAR_CELLS))}
  FROM samples s JOIN labelled l ON l.id = s.id AND l.cycle = s.cycle - 1),
gone AS (SELECT *, 1 / (1 + exp(-({" + ".join(f"CAST({float(w)!r} AS DOUBLE) * x{i}" for i, w in enumerate(LINEAR.initial()[:3]))}))) - y AS d FROM seen),
slopes AS (
  SELECT worker, count(*) AS n, unnest([avg(d * x0), avg(d * x1), avg(d * x2), avg(d)]) AS g,
    unnest([{", ".join(f"CAST({float(w)!r} AS DOUBLE)" for w in LINEAR.initial())}]) AS w, unnest([0, 1, 2, 3]) AS pos FROM gone GROUP BY worker),
clipped AS (SELECT *, greatest(least(g, 0.5), -0.5) AS c FROM slopes)
SELECT CAST(pos AS BIGINT) AS pos, round(sum(n * (w - 0.001 * c / (abs(c) + 1e-8))) / sum(n), 8) AS value, CAST(sum(n) AS BIGINT) AS n
FROM clipped GROUP BY pos"""
)
def averaged_round_linear(spark, sf):
    """One averaging round over all samples: a worker for every 512, each taking one optimiser step."""
    log, extent = labelled_log(spark, sf)
    log = log.withColumns({c: F.col(c) / 64 for c in FEATURES})
    offsets = splits.sample_offsets(lengths(spark, sf), extent=extent.as_one_group)
    rows = splits.window_batch_rows(log, offsets, FEATURES, "label1", batch_size=512, entities=extent.groups)
    workers = (rows.agg(F.max("batch_id")).first()[0] or 0) + 1
    settings = Settings(workers=workers, averaging_frequency=1)
    rounds = export_rounds(rows, settings)
    try:
        weights, stats = average_round(rounds.read(0), LINEAR, Weights(LINEAR.initial()), Adam(), settings, 0)
    finally:
        rounds.delete()
    n = sum(int(s[1]) for s in stats)
    made = [(i, round(float(v), 8), n) for i, v in enumerate(weights.values)]
    return spark.createDataFrame(made, "pos long, value double, n long")



# ------------------------------------------------ steps, cadence, resuming, balance


def linear_rows(spark, sf, batch_size):
    """Batch rows whose windows a network without layers classifies by their last row, and the number of batches."""
    log, extent = labelled_log(spark, sf)
    log = log.withColumns({c: F.col(c) / 64 for c in FEATURES})
    offsets = splits.sample_offsets(lengths(spark, sf), extent=extent.as_one_group)
    rows = splits.window_batch_rows(log, offsets, FEATURES, "label1", batch_size=batch_size, entities=extent.groups)
    rows = kept(rows, "linear")
    return rows, (rows.agg(F.max("batch_id")).first()[0] or 0) + 1


def number(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def linear_seen(batch_size: int) -> str:
    """The samples as a linear network sees them: worker (one for every batch), label, and the last row's features."""
    cells = [f"CAST(CAST(l.{c} / 64 AS FLOAT) AS DOUBLE) AS x{i}" for i, c in enumerate(("value", "k", "cycle"))]
    return SAMPLES + f""", seen AS (
  SELECT CAST(s.sample_idx // {batch_size} AS BIGINT) AS batch_id, s.label1 AS y, {", ".join(cells)}
  FROM samples s JOIN labelled l ON l.id = s.id AND l.cycle = s.cycle - 1)"""


START = [float(w) for w in LINEAR.initial()]
CHANCE = "1 / (1 + exp(-({} * x0 + {} * x1 + {} * x2 + {})))"
LOSS = "-ln(greatest(least(CASE WHEN y = 1 THEN p ELSE 1 - p END, CAST(1 AS DOUBLE)), CAST(1e-7 AS DOUBLE)))"
SLOPES = "avg((p - y) * x0) AS g0, avg((p - y) * x1) AS g1, avg((p - y) * x2) AS g2, avg(p - y) AS g3, count(*) AS n"


def clipped(g: str) -> str:
    return f"greatest(least({g}, 0.5), -0.5)"


def first_steps(batch_size: int) -> str:
    """Every batch's weights after one step of its own worker."""
    moved = [f"{number(w)} - 0.001 * {clipped(f'g{i}')} / (abs({clipped(f'g{i}')}) + 1e-8) AS w{i}" for i, w in enumerate(START)]
    return linear_seen(batch_size) + f""", chance AS (SELECT *, {CHANCE.format(*map(number, START))} AS p FROM seen),
slopes AS (SELECT batch_id, {SLOPES}, sum({LOSS}) AS loss FROM chance GROUP BY batch_id),
moved AS (SELECT *, {", ".join(moved)} FROM slopes)"""


@query(
    first_steps(64)
    + """ SELECT batch_id, CAST(0 AS BIGINT) AS iteration, n, round(loss, 6) AS loss,
  round(sqrt(g0 * g0 + g1 * g1 + g2 * g2 + g3 * g3), 8) AS norm FROM moved"""
)
def step_statistics(spark, sf):
    """One row per optimiser step of an averaging round, which its workers write: terms, loss and gradient norm."""
    rows, workers = linear_rows(spark, sf, 64)
    path = shared_folder(spark, "steps")
    settings = Settings(epochs=1, workers=workers, averaging_frequency=1)
    rounds = export_rounds(rows, settings)
    try:
        train(spark, rounds, LINEAR, settings, steps_path=path)
    finally:
        rounds.delete()
    steps = read_steps(spark, path)
    return steps.select(
        "batch_id", "iteration", F.col("n").cast("long").alias("n"), F.round("loss", 6).alias("loss"), F.round("norm", 8).alias("norm"))


@query(
    first_steps(64)
    + f""", again AS (
  SELECT y, {CHANCE.format("w0", "w1", "w2", "w3")} AS p FROM seen JOIN moved USING (batch_id)),
cells AS (SELECT y, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS guess, count(*) AS n, sum({LOSS}) AS loss FROM again GROUP BY ALL)
SELECT CAST(0 AS BIGINT) AS iteration, round(sum(loss) / sum(n), 6) AS loss,
  round(sum(CASE WHEN y = guess THEN n ELSE 0 END) / sum(n), 6) AS accuracy, CAST(sum(n) AS BIGINT) AS n FROM cells"""
)
def iteration_evaluation(spark, sf):
    """The minibatches of the workers' first iteration, evaluated within the round with the weights after it."""
    rows, workers = linear_rows(spark, sf, 64)
    settings = Settings(workers=workers, averaging_frequency=1, evaluate_every=10)
    rounds, cells = export_rounds(rows, settings), []
    try:
        average_round(rounds.read(0), LINEAR, Weights(LINEAR.initial()), Adam(), settings, 0, cells=cells)
    finally:
        rounds.delete()
    made = []
    for iteration in sorted({c[0] for c in cells}):
        own = [c[1:] for c in cells if c[0] == iteration]
        row = metrics.evaluation_of_cells(own)
        made.append((iteration, round(row["loss"], 6), round(row["accuracy"], 6), sum(c[2] for c in own)))
    return spark.createDataFrame(made, "iteration long, loss double, accuracy double, n long")


def average_of(names: list[str], table: str) -> str:
    return ", ".join(f"sum(n * {name}) / sum(n) AS {name}" for name in names) + f" FROM {table}"


def resumed_sql() -> str:
    """Two rounds of one step each: moments and weights are averaged in between, by the samples of each worker."""
    names = [f"{kind}{i}" for kind in "wms" for i in range(4)]
    first = [f"0.1 * {clipped(f'g{i}')} AS m{i}, 0.001 * {clipped(f'g{i}')} * {clipped(f'g{i}')} AS s{i}" for i in range(4)]
    later = [
        f"0.9 * m{i} + 0.1 * {clipped(f'g{i}')} AS m{i}, 0.999 * s{i} + 0.001 * {clipped(f'g{i}')} * {clipped(f'g{i}')} AS s{i}, w{i}"
        for i in range(4)]
    step = [f"w{i} - 0.001 * (m{i} / 0.19) / (sqrt(s{i} / (1 - 0.999 * 0.999)) + 1e-8) AS w{i}" for i in range(4)]
    return first_steps(64) + f""", parts AS (SELECT (max(batch_id) + 2) // 2 AS workers FROM seen),
one AS (SELECT *, {", ".join(first)} FROM moved WHERE batch_id < (SELECT workers FROM parts)),
mean AS (SELECT {average_of(names, "one")}),
other AS (
  SELECT seen.*, {CHANCE.format("w0", "w1", "w2", "w3")} AS p, mean.* FROM seen, mean WHERE batch_id >= (SELECT workers FROM parts)),
slopes2 AS (SELECT batch_id, {SLOPES}, {", ".join(f"any_value({name}) AS {name}" for name in names)} FROM other GROUP BY batch_id),
moments2 AS (SELECT n, {", ".join(later)} FROM slopes2),
two AS (SELECT n, {", ".join(step)} FROM moments2),
last AS (SELECT {average_of(["w0", "w1", "w2", "w3"], "two")})
SELECT unnest([0, 1, 2, 3])::BIGINT AS pos, round(unnest([w0, w1, w2, w3]), 8) AS value FROM last"""


@query(resumed_sql())
def resumed_training(spark, sf):
    """The weights of a training that is cut short after its first round, and gone on with from its journal."""
    rows, batches = linear_rows(spark, sf, 64)
    settings = Settings(epochs=1, workers=(batches + 1) // 2, averaging_frequency=1)
    path = shared_folder(spark, "resumed")
    journal, rounds = Journal(spark, path), export_rounds(rows, settings)

    def cut_short(number, weights):
        raise InterruptedError(number)

    try:
        try:
            train(spark, rounds, LINEAR, settings, journal=journal, on_round=cut_short)
        except InterruptedError:
            pass
        weights = train(spark, open_rounds(spark, rounds.path), LINEAR, settings, journal=journal).weights
    finally:
        rounds.delete()
        delete_table(spark, path)
    made = [(i, round(float(v), 8)) for i, v in enumerate(weights.values)]
    return spark.createDataFrame(made, "pos long, value double")


@query(
    LOG
    + """, sizes AS (SELECT id, count(*) AS steps FROM log GROUP BY id),
ranked AS (SELECT *, row_number() OVER (ORDER BY steps * steps % 97, id) - 1 AS i FROM sizes),
costs AS (SELECT CAST(i // 3 AS BIGINT) AS batch_id, CAST(sum(steps * steps) AS BIGINT) AS cost FROM ranked GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (ORDER BY cost DESC, batch_id) - 1 AS place FROM costs),
dealt AS (
  SELECT *, place // 8 AS sorted_round, CASE WHEN place // 4 % 2 = 0 THEN place % 4 ELSE 3 - place % 4 END AS worker FROM placed),
rounds AS (
  SELECT sorted_round, row_number() OVER (ORDER BY (sorted_round + 1) * 2654435761 % 4294967291, sorted_round) - 1 AS round
  FROM (SELECT DISTINCT sorted_round FROM dealt))
SELECT batch_id, cost, round, CAST(worker AS INT) AS worker FROM dealt JOIN rounds USING (sorted_round)"""
)
def balanced_deal(spark, sf):
    """Minibatches of three lives dealt to four workers, two each in a round, by a cost that grows with the square of a life."""
    known = lengths(spark, sf).withColumn("cost", F.col("n_cycles") * F.col("n_cycles"))
    ranked = number_rows(known.withColumn("_mixed", F.col("cost") % 97), [], ["_mixed", "id"], "_i")
    costs = ranked.groupBy(F.expr("(_i - 1) div 3").alias("batch_id")).agg(F.sum("cost").alias("cost"))
    return balance.balanced_workers(costs, 4, 2)


# ------------------------------------------------ states that merge


@query(LOG + STATS.format(t="log"))
def merged_scaler(spark, sf):
    """Statistics of the whole log from states of its parts, one of which was delivered twice."""
    log = kept(scaling.with_cycle_feature(cycle_log(spark, sf)), "log")
    path = shared_folder(spark, "states")
    for part in (0, 1, 2, 1):
        put_part(scaling.scaler_state(log.where(F.pmod("id", F.lit(3)) == part), FEATURES), path, f"p{part}")
    merged = scaling.merge_scaler_states(read_parts(spark, path, scaling.STATE))
    table = scaling.scaler_table(scaling.scaler_of_state(merged, FEATURES))
    return rounded(table, ["mean", "std"])


@query(
    CLASSES
    + """ SELECT (SELECT round(avg(-ln(greatest(least(p[label2 + 1], 1 - 1e-7), 1e-7))), 6) FROM soft) AS loss,
  round(sum(tp) / sum(actual), 6) AS accuracy, round(avg(precision), 6) AS precision,
  round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, count(precision) AS precision_classes,
  count(recall) AS recall_classes FROM rated"""
)
def merged_evaluation(spark, sf):
    """The evaluation of all predictions from stored states of their parts, one of which came twice."""
    scored = kept(scored_log(spark, sf).select("id", F.col("label2").alias("label"), "prob", "prediction"), "scored")
    path = shared_folder(spark, "states")
    for part in (0, 1, 2, 0):
        put_part(metrics.evaluation_state(scored.where(F.pmod("id", F.lit(3)) == part)), path, f"day{part}")
    merged = metrics.merged_evaluation(read_parts(spark, path, metrics.EVALUATION_STATE))
    return rounded(merged.drop("auc", "auc_error"), ["loss", "accuracy", "precision", "recall", "f1"])


@query(
    LABELLED
    + """, bins AS (
  SELECT CAST(least(floor(value / (1 + value) * 4096), 4095) AS BIGINT) AS bin, sum(label1) AS pos, sum(1 - label1) AS neg
  FROM labelled GROUP BY 1),
placed AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM bins)
SELECT round((sum(CAST(pos AS DOUBLE) * below) + sum(CAST(pos AS DOUBLE) * neg) / 2) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc,
  round(sum(CAST(pos AS DOUBLE) * neg) / 2 / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc_error FROM placed"""
)
def roc_binned(spark, sf):
    """Area under the curve from a histogram of fixed size, and how far it may be off."""
    return rounded(metrics.binned_auc(metrics.roc_histogram(scored_log(spark, sf), 12, "score", "label1")), ["auc", "auc_error"])


for registry in (QUERIES, ORACLES):
    registry["sequences"] = registry.pop("sequences_")
