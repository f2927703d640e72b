from telemetra.registry import q_clean_telemetry, q_clean_telemetry_dedup, q_clean_telemetry_keyed, q_impute_mean, q_parse_body

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _only_partials_gathered(plan: str) -> bool:
    """Every single-partition exchange carries partial aggregates, never rows."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            nxt = lines[i + 1] if i + 1 < len(lines) else ""
            if "HashAggregate(keys=[]" not in nxt or "partial_" not in nxt:
                return False
    return True


def test_flagship_has_no_python_and_no_single_partition_window(spark):
    plan = _plan(q_clean_telemetry(spark, SF))
    assert "EvalPython" not in plan and "ArrowEvalPython" not in plan
    assert _only_partials_gathered(plan)
    assert "Join" not in plan and "Subquery" in plan  # means are one merged scalar subquery
    assert "WindowGroupLimit" in plan  # one row per key comes first


def test_keyed_source_needs_no_row_shuffle(spark):
    plan = _plan(q_clean_telemetry_keyed(spark, SF))
    assert _only_partials_gathered(plan) and "Join" not in plan and "hashpartitioning" not in plan


def test_dedup_variant_pre_limits_before_its_shuffle(spark):
    df = q_clean_telemetry_dedup(spark, SF)
    df.collect()
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and _only_partials_gathered(plan)
    assert "ReusedExchange" in plan  # one key shuffle, shared by the rows and the means subquery


def test_flagship_scan_prunes_columns(spark):
    plan = _plan(q_clean_telemetry(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_imputation_does_not_gather_rows(spark):
    plan = _plan(q_impute_mean(spark, SF))
    assert _only_partials_gathered(plan) and "Window" not in plan


def test_body_parse_happens_once_per_row(spark):
    plan = q_parse_body(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
