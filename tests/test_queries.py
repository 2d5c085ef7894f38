"""Every query against its SQL in DuckDB: with the default bounds, and with bounds so
small that each entity counts as oversized and no table may be broadcast."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from cyclemill.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TIGHT = {"rowsPerTask": 20, "segmentRows": 50, "broadcastRows": 3, "driverBytes": 0}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got, want, _ = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert got == want and want[1]


SKEW_SENSITIVE = [
    "cycle_numbering", "rul_labels", "rul_left_join", "rul_ground_truth_positional", "label_pipeline",
    "entity_split", "tail_split", "minibatches", "sequences", "sequence_labels", "pad_align_end",
    "window_batch_rows", "life_batch_rows", "sequence_layout", "batch_scoring_linear",
    "roc_points", "roc_auc", "head_of_entity", "masked_timestep_eval", "windows_of_odd_cycles", "stored_minibatches",
    "averaged_round_linear", "text_log_round_trip", "resumed_training", "step_statistics", "balanced_deal",
    "peephole_scoring", "comparison_samples", "published_series",
]


@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_equals_sql_in_the_plans_for_large_data(spark, con, name):
    for key, value in TIGHT.items():
        spark.conf.set(f"spark.cyclemill.{key}", value)
    try:
        got, want, _ = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    finally:
        for key in TIGHT:
            spark.conf.unset(f"spark.cyclemill.{key}")
    assert got == want


def test_every_query_has_a_check_or_a_reason():
    without_sql = set(QUERIES) - set(ORACLES)
    assert without_sql == {"averaged_training", "averaged_training_per_step", "batch_scoring", "mlp_baseline"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "cycle", "RUL", "label1", "label2", "cycle_norm"]
    assert df.count() == 1000
