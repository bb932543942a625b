"""The running report against the full one, day by day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import licenses as license_rows
from rows import values

from seatwise.operators import reports, running_report
from seatwise.plans.jobs import plan_pipeline
from seatwise.plans.report_state import ReportState
from seatwise.session import table_store
from seatwise.sources import generated

DAY = dt.date(2025, 3, 1)


def plan_text(frame):
    return frame._jdf.queryExecution().toString()


def test_equal_to_the_full_report_over_ten_days(spark, tmp_path):
    tables = generated.generate_tables(generated.user_ids(spark, 400, 3), DAY, 3)
    # One user holds a third of the licenses.
    hot = tables.licenses.withColumn("userid", F.when(
        F.crc32(F.col("license_id").cast("binary")) % 3 == 0, "1").otherwise(F.col("userid")))
    licenses = table_store(spark)(plan_pipeline(
        type(tables)(tables.users, hot, tables.requests.limit(0)), DAY, f"{DAY} 07:00:00"
    ).licenses_after, "day0")
    state = ReportState(spark, str(tmp_path), parts=16)
    state.start(licenses, DAY)
    for n in range(1, 11):
        day = DAY + dt.timedelta(days=9 * n)
        asked = tables.requests.filter(F.col("id") % 10 == n % 10)
        keep = table_store(spark)
        run = plan_pipeline(type(tables)(tables.users, licenses, asked), day, f"{day} 07:00:00", keep)
        issued = keep(run.requests_run.new_licenses, "issued")
        due = keep(licenses.filter((F.col("status") == "ACTIVE") & (F.col("expiry_date") < F.lit(day))), "due")
        after = keep(run.licenses_after, "after")
        found = state.advance(issued, due, day)
        assert values(found, *sorted(found.columns)) == values(
            reports.full_report(after, day), *sorted(found.columns))
        assert values(state.advance(issued, due, day)) == values(found)
        licenses = after
        if n == 5:
            state.compact()
            assert len(state.days()) == 1
    wanted = running_report.held_counts(licenses)
    assert values(running_report.merged(state.counts())) == values(wanted, *running_report.HELD, "licenses")
    with pytest.raises(ValueError):
        state.advance(issued, due, DAY)


def test_the_license_table_is_not_read(spark, tmp_path):
    rows = license_rows(spark, *((f"l{i}", f"u{i % 50}", "Type 1", "P", "ACTIVE", dt.date(2030, 1, 1))
                                 for i in range(200)))
    rows.write.parquet(str(tmp_path / "licenses"))
    table = spark.read.parquet(str(tmp_path / "licenses"))
    state = ReportState(spark, str(tmp_path / "state"), parts=32)
    state.start(table, DAY)
    new = license_rows(spark, ("n1", "u7", "Type 2", "P", "ACTIVE", dt.date(2030, 1, 1)))
    changes = running_report.day_changes(new, new.limit(0))
    plan = plan_text(running_report.advance_report(state.report(), state.counts(), changes))
    assert "/licenses" not in plan
    found = state.advance(new, new.limit(0), DAY + dt.timedelta(days=1))
    by_type = {r.license_type: (r.unique_users, r.total_licenses)
               for r in found.filter("report = 'active_type'").collect()}
    assert by_type == {"Type 1": (50, 200), "Type 2": (1, 1)}
    total = found.filter("report = 'active_total'").first()
    assert (total.unique_users, total.total_licenses) == (50, 201)


def test_last_licenses_of_a_group(spark, tmp_path):
    """Groups without licenses go, the total stays; an empty table can be started from."""
    state = ReportState(spark, str(tmp_path), parts=4)
    one = license_rows(spark, ("a", "u", "Type 1", "P", "ACTIVE", dt.date(2025, 3, 5)))
    state.start(one.limit(0), DAY)
    assert values(state.report(), "report", "unique_users", "total_licenses") == [("active_total", 0, 0)]
    state.advance(one, one.limit(0), DAY + dt.timedelta(days=1))
    found = state.advance(one.limit(0), one, DAY + dt.timedelta(days=6))
    assert values(found, "report", "license_status", "unique_users", "total_licenses") == [
        ("active_total", None, 0, 0), ("all_status", "EXPIRED", 1, 1), ("all_type_status", "EXPIRED", 1, 1)]
