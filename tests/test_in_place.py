"""Runs over tables in parts: same rows as full rewrites, few parts rewritten, safe to repeat."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from rows import values
from seed import AS_OF, NOW, seed_tables

from seatwise.operators import expiry
from seatwise.plans.in_place import expired_rows, run_in_place
from seatwise.plans.jobs import plan_pipeline
from seatwise.sinks import laid_out
from seatwise.sinks.laid_out import LaidOut, Staged
from seatwise.sources import generated
from seatwise.sources.star import AS_OF as STAR_DAY
from seatwise.sources.star import NOW as STAR_NOW
from seatwise.sources.star import StarTables

STAR = "/root/testdata/sf0.01"


def files(folder):
    return {os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
            for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet")}


def same_tables(kept, wanted):
    for name, rows in wanted.items():
        assert values(kept.read(name), *rows.columns) == values(rows), name


def test_a_run_gives_the_rows_of_a_full_rewrite(spark, tmp_path):
    seed = seed_tables(spark)
    kept = LaidOut(spark, str(tmp_path))
    kept.create_all(seed)
    same_tables(kept, seed)
    wanted = plan_pipeline(seed, AS_OF, NOW).tables
    before = values(wanted.licenses)
    run = run_in_place(spark, str(tmp_path), AS_OF, NOW)
    same_tables(kept, wanted)
    assert run.licenses.changed + run.licenses.added > 0 and run.users.changed > 0
    again = run_in_place(spark, str(tmp_path), AS_OF, NOW)
    assert (again.licenses.changed, again.licenses.added, again.users.changed) == (0, 0, 0)
    assert values(kept.read("licenses"), *wanted.licenses.columns) == before


def test_a_day_rewrites_few_files(spark, tmp_path):
    """After a month's run, the expiries of one more day: under 1% of the licenses."""
    star = StarTables(spark, STAR)
    kept = LaidOut(spark, str(tmp_path))
    kept.create("licenses", star.licenses)
    for day in (STAR_DAY - dt.timedelta(days=1), STAR_DAY):
        due = kept.due(day)
        rows = due.count()
        before = files(tmp_path / "licenses")
        staged = kept.stage("licenses", expired_rows(due, STAR_NOW))
        kept.commit()
        after = files(tmp_path / "licenses")
    assert staged.changed == rows and 0 < rows < 0.01 * kept.read("licenses").count()
    assert staged.parts <= 2 and staged.of > 50
    rewritten = [f for f in before if after.get(f) != before[f]]
    assert len(rewritten) <= 0.05 * len(before)
    wanted = expiry.expire_licenses(star.licenses, STAR_DAY, STAR_NOW)
    assert values(kept.read("licenses"), *wanted.columns) == values(wanted)


def test_due_licenses_are_found_without_reading_the_others(spark, tmp_path):
    star = StarTables(spark, STAR)
    kept = LaidOut(spark, str(tmp_path))
    kept.create("licenses", expiry.expire_licenses(star.licenses, dt.date(2000, 12, 1), STAR_NOW))
    due = kept.due(STAR_DAY)
    found = due.collect()
    assert len(found) == star.licenses.filter(
        "status = 'ACTIVE' AND expiry_date >= '2000-12-01' AND expiry_date < '2001-01-01'").count()
    plan = due._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().apply(0)
    read = plan.metrics().apply("numOutputRows").value()
    assert len(found) <= read <= 0.1 * kept.read("licenses").count()


@pytest.mark.parametrize("step", ["users", "licenses", None])
def test_an_interrupted_commit_is_finished(spark, tmp_path, monkeypatch, step):
    """Ended while staging (None), or after the marker with some tables not yet in place."""
    seed = seed_tables(spark)
    kept = LaidOut(spark, str(tmp_path))
    kept.create_all(seed)
    wanted = plan_pipeline(seed, AS_OF, NOW).tables

    class Ended(Exception):
        pass

    def broken_commit(self):
        if step is not None:
            whole = self.layouts
            self.layouts = {name: whole[name] for name in list(whole)[:list(whole).index(step) + 1]}
            files_of = laid_out.file_system

            class Kept:
                def __init__(self, files):
                    self.files = files

                def __getattr__(self, name):
                    if name == "delete":
                        raise Ended
                    return getattr(self.files, name)

            monkeypatch.setattr(laid_out, "file_system", lambda s, p: (
                Kept(files_of(s, p)[0]), files_of(s, p)[1]))
            whole_commit(self)
        raise Ended

    whole_commit = LaidOut.commit
    with monkeypatch.context() as patch:
        patch.setattr(LaidOut, "commit", broken_commit)
        with pytest.raises(Ended):
            run_in_place(spark, str(tmp_path), AS_OF, NOW)
    monkeypatch.undo()
    assert LaidOut(spark, str(tmp_path)).recover() == (step is not None)
    same_tables(kept, wanted if step is not None else seed)
    run_in_place(spark, str(tmp_path), AS_OF, NOW)
    same_tables(kept, wanted)


def test_nulls_and_empty_tables(spark, tmp_path):
    seed = seed_tables(spark)
    kept = LaidOut(spark, str(tmp_path))
    kept.create("licenses", seed.licenses.withColumn(
        "expiry_date", F.when(F.col("status") == "ACTIVE", F.col("expiry_date"))))
    assert kept.read("licenses").count() == seed.licenses.count()
    staged = kept.stage("licenses", expired_rows(kept.read("licenses").limit(0), NOW))
    assert (staged.parts, staged.changed, staged.added) == (0, 0, 0)
    kept.commit()
    assert kept.read("licenses").count() == seed.licenses.count()
    kept.create_all(type(seed)(*(rows.limit(0) for _, rows in seed.items())))
    run = run_in_place(spark, str(tmp_path), AS_OF, NOW)
    assert run.licenses == run.users == run.requests == Staged(0, 0, 0, 0)
    assert kept.read("licenses").isEmpty()


def test_generated_days(spark, tmp_path):
    day = dt.date(2025, 3, 1)
    tables = generated.generate_tables(generated.user_ids(spark, 300, 3), day, 5)
    kept = LaidOut(spark, str(tmp_path / "kept"))
    kept.create_all(tables)
    for n in range(3):
        at = day + dt.timedelta(days=17 * n)
        now = dt.datetime.combine(at, dt.time(7))
        planned = plan_pipeline(kept.tables(), at, now).tables
        wanted = {name: values(rows) for name, rows in planned.items()}
        run_in_place(spark, str(tmp_path / "kept"), at, now)
        for name, rows in planned.items():
            assert values(kept.read(name), *rows.columns) == wanted[name]
