"""Driver contract and plan shape checks."""
import __spark_entry__ as E
from voxspark.functions import text as X
from voxspark.operators import index as I
from voxspark.plans import views as V
from conftest import SF


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and set(df.columns) == {"lang", "edits", "words", "rows", "wer"}


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60


def test_clean_text_stays_in_jvm(spark):
    p = _plan(V.v_manifest(spark, SF).select(X.clean_text("text")))
    assert "Python" not in p and "ArrowEval" not in p


def test_index_has_no_single_partition_window(spark):
    p = _plan(I.with_index(spark.range(100), ["id"]))
    assert "SinglePartition" not in p
    assert "BroadcastHashJoin" in p                        # offsets broadcast


def test_scan_prunes_columns(spark):
    df = V.v_manifest(spark, SF).select("utt_id", "duration")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_key_plans_have_no_cartesian_or_row_udf(spark):
    from voxspark.plans.registry import REGISTRY
    for name in ["agg1_wer", "join2_attach_custom", "win5_number_repeats", "agg15_confidence_metrics",
                 "join4_missing_audio", "src6_mix"]:
        plan = _plan(REGISTRY[name].fn(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, (name, bad)
