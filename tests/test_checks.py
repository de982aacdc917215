"""The table of checks on a small summary with every outcome."""

import __spark_entry__ as entry
from terrapop.operators import checks

SUMMARY = "run_id string, hazard string, threshold string, admin_id int, pop_total double, pop_affected double, pct_affected double"
ROWS = [
    ("r1", "drought", "-1.0", 1, 100.0, 60.0, 60.0), ("r1", "drought", "-1.0", 2, 50.0, 10.0, 20.0),
    ("r1", "drought", "-1.5", 1, 100.0, 40.0, 40.0), ("r1", "drought", "-1.5", 2, 50.0, 10.0, 20.0),
    ("r1", "drought", "-2.0", 1, 100.0, 41.0, 41.0), ("r1", "drought", "-2.0", 2, 50.0, 0.0, 0.0),
    ("r2", "flood", "0", 1, 1000.0, -5.0, -0.5), ("r2", "flood", "0", 2, 0.0, 0.0, None), ("r2", "flood", "0", 3, 10.0, 11.0, 110.0),
    ("r3", "heat", "32", 1, 1000.0, 996.0, 99.6),
]
RECORDS = [("r1", "drought", "-1.0", 150.0, 70.0), ("r1", "drought", "-1.5", 150.0, 50.2), ("r1", "drought", "-2.0", 150.0, 45.0), ("r2", "flood", "0", 1010.9, 6.2)]
LOOSER = {"drought": ("-1.0", "-1.5", "-2.0")}


def tables(spark):
    return spark.createDataFrame(ROWS, SUMMARY), spark.createDataFrame(RECORDS, "run_id string, hazard string, threshold string, recorded_total double, recorded_affected double")


def test_every_outcome(spark):
    got = {(r.run_id, r.threshold, r.name): (r.status, r.value) for r in checks.check_table(*tables(spark), LOOSER).collect()}
    assert len(got) == 5 * 8
    assert got["r1", "-1.0", "table_vs_recorded_sum"] == ("PASS", 70.0) and got["r1", "-1.5", "table_vs_recorded_sum"][0] == "WARN" and got["r1", "-2.0", "table_vs_recorded_sum"][0] == "FAIL"
    assert got["r1", "-1.0", "monotonic"] == ("PASS", 0.0) and got["r1", "-1.5", "monotonic"] == ("FAIL", 1.0) and got["r1", "-2.0", "monotonic"] == ("PASS", 0.0)
    assert got["r2", "0", "non_negative"] == ("FAIL", 1.0) and got["r2", "0", "pct_bounds"] == ("FAIL", 3.0) and got["r2", "0", "exposed_within_total"] == ("FAIL", 1.0)
    assert got["r2", "0", "zero_population"] == ("WARN", 1.0) and got["r2", "0", "table_vs_recorded_sum"] == ("PASS", 6.0) and got["r2", "0", "table_vs_recorded_total"][0] == "PASS"
    assert got["r3", "32", "table_vs_recorded_sum"] == ("WARN", 996.0) and got["r3", "32", "non_negative"][0] == "PASS"


def test_roll_up_flags_and_rows(spark):
    summary, recorded = tables(spark)
    rolled = {r.run_id: (r.checks, r.failures, r.warnings, r.status) for r in checks.rolled_up(checks.check_table(summary, recorded, LOOSER)).collect()}
    assert rolled == {"r1": (24, 2, 3, "FAIL"), "r2": (8, 3, 1, "FAIL"), "r3": (8, 0, 3, "PASS")}
    flags = {(r.run_id, r.threshold, r.admin_id): [k for k in ("negative", "zero", "missing", "below", "above", "exceeds", "any_flag") if r[k]] for r in checks.row_flags(summary).collect()}
    assert flags["r2", "0", 1] == ["negative", "below", "any_flag"] and flags["r2", "0", 2] == ["zero", "missing", "any_flag"] and flags["r2", "0", 3] == ["above", "exceeds", "any_flag"] and flags["r3", "32", 1] == []
    rows = {(r.run_id, r.threshold): (r.units, r.diff, r.diff_pct, r.max_pct) for r in checks.quality_rows(summary, recorded).collect()}
    assert rows["r1", "-1.5"] == (2, -0.2, -0.398406, 40.0) and rows["r3", "32"] == (1, None, None, 99.6)


def test_empty(spark):
    summary, recorded = tables(spark)
    assert checks.check_table(summary.limit(0), recorded, LOOSER).count() == 0


def test_union_takes_in_every_hazard(spark):
    rows = entry.queries()["union_hazard_summaries"](spark, "/root/testdata/sf0.001").select("hazard", "threshold").distinct().collect()
    bands = {}
    for r in rows:
        bands.setdefault(r.hazard, set()).add(r.threshold)
    assert bands == {"flood": {None, "0"}, "cyclone": {None, "63", "93", "119"}, "drought": {"-1.5", "-1.0", "-2.0"}, "heat": {"32", "38", "46", "p95"}, "earthquake": {"6", "5", "7"}, "violence": {"1"}}
