"""Master lists as tables: both readings of null, repeated codes, a million codes, the checks that use them."""

import pytest
from conftest import SMALL, records
from pyspark.sql import functions as F

from sparkrecon.fixtures import FIXTURE_RULES, view
from sparkrecon.operators import checks, dq, masters
from sparkrecon.params import VALID_CURRENCIES, VALID_GL_ACCOUNTS, VALID_GL_ACCOUNTS_DQ, VALID_LEDGER_STATUSES


def _table(spark, codes):
    return spark.createDataFrame([(c,) for c in codes], "code STRING")


@pytest.mark.parametrize("codes, not_in, not_listed", [
    (["a", "b", "a"], ["c", "c"], ["c", "c", None]),
    (["a", None], [], ["b", "c", "c", None]),
    ([], ["a", "b", "c", "c"], ["a", "b", "c", "c", None]),
    ([None], [], ["a", "b", "c", "c", None]),
])
def test_both_readings_of_null(spark, codes, not_in, not_listed):
    df = spark.createDataFrame([(c,) for c in ("a", "b", "c", "c", None)], "x STRING")
    master = _table(spark, codes)
    order = lambda v: (v is None, v or "")
    assert sorted([r["x"] for r in masters.rows_not_in(df, "x", master).collect()], key=order) == not_in
    assert sorted([r["x"] for r in masters.rows_not_listed(df, "x", master).collect()], key=order) == not_listed
    (row,) = records(masters.master_report(df, "x", {"m": master}))
    assert row == {"list": "m", "not_in": len(not_in), "not_listed": len(not_listed), "total_rows": 5}
    marked = masters.with_masters(df, {"x": master, "absent": master})
    assert marked.count() == 5


def test_a_million_codes(spark):
    """No list in the plan, and the size of the list decides how it is joined."""
    master = spark.range(1_000_000).select(F.concat(F.lit("C"), "id").alias("code"))
    df = spark.range(0, 2_000_000, 7).select(F.concat(F.lit("C"), "id").alias("vendor"))
    want = len(range(0, 2_000_000, 7)) - len(range(0, 1_000_000, 7))
    for build in (masters.rows_not_in, masters.rows_not_listed):
        found = build(df, "vendor", master)
        assert found.count() == want
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "INSET" not in plan and " IN (" not in plan and "NestedLoop" not in plan and len(plan) < 20_000


def test_checks_and_catalogue_by_master_tables(spark):
    """The lists of the rules as tables give what the literals give, and other lists other results."""
    source, target = view(spark, SMALL, "dq_source"), view(spark, SMALL, "dq_target")
    lists = {"currency": _table(spark, VALID_CURRENCIES), "gl_account": _table(spark, VALID_GL_ACCOUNTS * 2)}
    s = masters.with_masters(source, lists)
    t = masters.with_masters(target, {"ledger_status": _table(spark, VALID_LEDGER_STATUSES)})
    assert records(checks.quality_report(s, t, FIXTURE_RULES)) == records(checks.quality_report(source, target, FIXTURE_RULES))
    s = masters.with_masters(source, {"gl_account": _table(spark, VALID_GL_ACCOUNTS_DQ)})
    assert records(dq.count_report(s, target, FIXTURE_RULES)) == records(dq.count_report(source, target, FIXTURE_RULES))
    s = masters.with_masters(source, {"gl_account": _table(spark, [*VALID_GL_ACCOUNTS_DQ, None])})
    (row,) = records(dq.count_rule(s, "dq5a_gl", FIXTURE_RULES))
    assert row["failing_rows"] == 0
    (row,) = records(checks.check_source(masters.with_masters(source, {"gl_account": _table(spark, [])}), FIXTURE_RULES, "s09"))
    assert row["rows_failed"] == source.count()
