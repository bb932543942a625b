import datetime as dt
import os
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from rows import values
import seed as known
from seed import AS_OF, NOW, seed_tables

from seatwise.__main__ import main
from seatwise.operators import expiry, reports, requests
from seatwise.plans import pipeline
from seatwise.plans.pipeline import run_on_folder, run_pipeline
from seatwise.plans.validation import validate
from seatwise.plans.jobs import process_requests
from seatwise.session import shared_folder, table_store, temporary_store
from seatwise.sinks.parquet import write_tables
from seatwise.sinks.whole import Output, whole_output
from seatwise.sources.tables import Tables, preflight, read_parquet, register


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("seed"))
    write_tables(seed_tables(spark), path)
    return path


@pytest.fixture(autouse=True)
def own_partition_number(spark):
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_run_writes_change_sets_and_tables(spark, folder, tmp_path):
    out = str(tmp_path / "run")
    results = run_on_folder(spark, folder, out, AS_OF, NOW)
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("decisions").count() == known.ISSUED
    assert read("new_licenses").count() == known.ISSUED
    assert read("license_changes").count() == known.DUE
    # users left without a license, and those who got one
    assert read("flag_changes").count() == known.FLAGS_CHANGED
    assert read("quarantined").isEmpty()
    after = read_parquet(spark, f"{out}/after")
    assert preflight(after) == {"users": True, "licenses": True, "requests": True}
    assert after.licenses.count() == known.LICENSES_AFTER
    assert values(read("report")) == values(reports.full_report(after.licenses, AS_OF))
    assert values(results["by_status"]) == known.STATUS_AFTER
    assert values(results["decision_counts"]) == [("APPROVED", known.ISSUED)]
    assert values(results["run_counts"]) == [(known.DUE, known.FLAGS_CHANGED)]
    issued = process_requests(seed_tables(spark), AS_OF, NOW)
    assert values(results["distribution"]) == values(issued.distribution())


def test_repeated_run_gives_the_same_tables(spark, folder, tmp_path):
    out = str(tmp_path / "run")
    run_on_folder(spark, folder, out, AS_OF, NOW)
    first = values(spark.read.parquet(f"{out}/after/licenses"))
    run_on_folder(spark, folder, out, AS_OF, NOW)
    assert values(spark.read.parquet(f"{out}/after/licenses")) == first


def test_failed_run_leaves_the_output_as_it_was(spark, folder, tmp_path, monkeypatch):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    run_on_folder(spark, folder, whole, AS_OF, NOW)

    def fail(*args):
        raise OSError("disk gone")

    with monkeypatch.context() as patch:
        # the change sets and the full tables are written by then
        patch.setattr(pipeline.reports, "full_report", fail)
        for out in (whole, broken):
            with pytest.raises(OSError, match="disk gone"):
                run_on_folder(spark, folder, out, AS_OF, NOW + dt.timedelta(days=1))
    assert sorted(os.listdir(tmp_path)) == ["whole"]
    run_on_folder(spark, folder, broken, AS_OF, NOW)
    assert sorted(os.listdir(tmp_path)) == ["broken", "whole"]
    for name in ("decisions", "after/licenses", "after/requests", "after/users", "report"):
        assert values(spark.read.parquet(f"{broken}/{name}")) == values(
            spark.read.parquet(f"{whole}/{name}"))


def test_a_run_replaces_all_results_of_the_one_before(spark, folder, tmp_path):
    out = str(tmp_path / "run")
    run_on_folder(spark, folder, out, AS_OF, NOW)
    results = run_on_folder(spark, folder, out, AS_OF, NOW, snapshots=False)
    assert not os.path.exists(f"{out}/after")
    assert values(results["run_counts"]) == [(known.DUE, known.FLAGS_CHANGED)]


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_switch_that_ends_half_way_is_undone_or_finished(spark, tmp_path, monkeypatch, step):
    class Ended(Exception):
        pass

    def put(number):
        with whole_output(spark, str(tmp_path / "out"), []) as output:
            output.store(spark.range(number), "a")
        return output

    put(1)
    moves = []

    def ending(self, *paths):
        if len(moves) == step:
            raise Ended
        moves.append(paths)
        whole_move(self, *paths)

    whole_move, whole_delete = Output._move, Output._delete
    with monkeypatch.context() as patch:
        patch.setattr(Output, "_move", ending)
        patch.setattr(Output, "_delete", lambda self, path: (
            ending(self) if path == self.replaced else whole_delete(self, path)))
        with pytest.raises(Ended):
            put(2)
    Output(spark, str(tmp_path / "out")).recover()
    found = spark.read.parquet(str(tmp_path / "out" / "a")).count()
    assert found == (2 if step == 2 else 1)
    assert os.listdir(tmp_path) == ["out"]
    assert put(3).table("a").count() == 3


def test_run_on_its_own_output_changes_nothing(spark, folder, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    run_on_folder(spark, folder, one, AS_OF, NOW)
    run_on_folder(spark, f"{one}/after", two, AS_OF, NOW)
    for name in ("users", "licenses", "requests"):
        assert values(spark.read.parquet(f"{one}/after/{name}")) == values(
            spark.read.parquet(f"{two}/after/{name}"))
    assert spark.read.parquet(f"{two}/license_changes").isEmpty()
    assert spark.read.parquet(f"{two}/flag_changes").isEmpty()


def test_change_sets_alone(spark, folder, tmp_path):
    out = str(tmp_path / "run")
    results = run_pipeline(spark, read_parquet(spark, folder), out, AS_OF, NOW, snapshots=False)
    assert not (tmp_path / "run" / "after").exists()
    assert values(results["by_status"]) == known.STATUS_AFTER


def test_repeated_keys_stop_the_run(spark, tmp_path):
    tables = seed_tables(spark)
    twice = replace(tables, users=tables.users.unionByName(tables.users.limit(1)))
    with pytest.raises(ValueError, match="users.userid 'member-00' occurs 2 times"):
        run_pipeline(spark, twice, str(tmp_path / "run"), AS_OF, NOW)
    twice = replace(tables, requests=tables.requests.unionByName(tables.requests.limit(1)))
    with pytest.raises(ValueError, match="requests.id 100 occurs 2 times"):
        run_pipeline(spark, twice, str(tmp_path / "run"), AS_OF, NOW)


def test_validation_covers_rules_keys_and_references(spark):
    tables = seed_tables(spark)
    dropped = replace(tables, users=tables.users.filter("userid <> 'member-02'"))
    found = validate(dropped)
    assert found["rules"].filter("violations > 0").isEmpty()
    assert values(found["keys"]) == [("licenses", 0, 0), ("requests", 0, 0), ("users", 0, 0)]
    assert found["repeated_emails"].isEmpty()
    assert values(found["orphan_licenses"]) == [(2,)]


def test_results_need_their_own_folder(spark, folder):
    with pytest.raises(ValueError):
        run_on_folder(spark, folder, folder + "/", AS_OF, NOW)


def test_preflight_names_what_is_wrong(spark):
    tables = seed_tables(spark)
    broken = Tables(tables.users.drop("email"), tables.licenses, tables.requests.selectExpr(
        "CAST(id AS INT) AS id", "* EXCEPT (id)"))
    with pytest.raises(ValueError, match="users.email: missing; requests.id: int, expected bigint"):
        preflight(broken)


def test_registered_views_serve_sql(spark):
    register(spark, seed_tables(spark))
    held = spark.sql("""
        SELECT count(*) FROM users u WHERE EXISTS (
            SELECT 1 FROM licenses l WHERE l.userid = u.userid AND l.status = 'ACTIVE'
            AND l.expiry_date > DATE '2025-09-10')""").first()[0]
    late = {r[1] for r in known.license_rows() if known.active(r) and r[4] > AS_OF}
    assert held == len(late)


def test_store_lives_in_the_shared_folder(spark):
    rows = table_store(spark)(spark.range(5), "numbers")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_folder(spark) in path for path in rows.inputFiles())
    assert rows.count() == 5


def session_with(**settings):
    conf = SimpleNamespace(
        get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf)


def test_stages_go_to_the_named_folder_or_the_warehouse():
    warehouse = {"spark_sql_warehouse_dir": "s3://house/"}
    named = session_with(spark_checkpoint_dir="s3://shared/", **warehouse)
    assert shared_folder(named) == "s3://shared"
    assert shared_folder(session_with(**warehouse)) == "s3://house/.stages"


def test_stages_are_deleted_after_use(spark):
    with temporary_store(spark) as store:
        kept = store(spark.range(5), "numbers")
        files = kept.inputFiles()
        assert files and kept.count() == 5
    with pytest.raises(RuntimeError), temporary_store(spark) as store:
        again = store(spark.range(5), "numbers").inputFiles()
        raise RuntimeError
    from urllib.parse import urlparse
    assert not any(os.path.exists(urlparse(f).path) for f in files + again)


def test_overlapping_folders_are_refused(spark, folder, tmp_path):
    day_one = str(tmp_path / "one")
    run_on_folder(spark, folder, day_one, AS_OF, NOW)
    before = values(spark.read.parquet(f"{day_one}/after/users"))
    os.symlink(day_one, tmp_path / "alias")
    for out in (day_one, f"{day_one}/after", f"{day_one}/after/", f"{day_one}/after/users/deeper",
                f"{day_one}/x/../after", f"file:{day_one}/after", str(tmp_path / "alias"),
                str(tmp_path)):
        with pytest.raises(ValueError, match="folder"):
            run_on_folder(spark, f"{day_one}/after", out, AS_OF, NOW)
        with pytest.raises(ValueError, match="folder"):
            run_pipeline(spark, read_parquet(spark, f"{day_one}/after"), out, AS_OF, NOW)
    assert values(spark.read.parquet(f"{day_one}/after/users")) == before
    second = run_on_folder(spark, f"{day_one}/after", str(tmp_path / "two"), "2025-09-11", NOW)
    assert values(second["decision_counts"]) == []


def test_empty_status_is_refused_by_status_folders(spark, tmp_path):
    tables = seed_tables(spark)
    odd = replace(tables, licenses=tables.licenses.withColumn(
        "status", F.when(F.col("status") == "SUSPENDED", "").otherwise(F.col("status"))))
    with pytest.raises(ValueError, match="status"):
        run_pipeline(spark, odd, str(tmp_path / "a"), AS_OF, NOW, by_status=True)
    run_pipeline(spark, odd, str(tmp_path / "b"), AS_OF, NOW)
    assert read_parquet(spark, str(tmp_path / "b/after")).licenses.filter("status = ''").count() > 0


def test_a_reopened_request_gets_another_license(spark, folder, tmp_path):
    one, two, three = (str(tmp_path / n) for n in ("one", "two", "three"))
    run_on_folder(spark, folder, one, AS_OF, NOW)
    tables = read_parquet(spark, f"{one}/after")
    reopened = replace(tables, requests=tables.requests.withColumn(
        "request_status", F.when(F.col("id") == 100, "PENDING").otherwise(F.col("request_status"))))
    later = "2027-01-01"
    run_pipeline(spark, reopened, two, later, NOW)
    licenses = read_parquet(spark, f"{two}/after").licenses
    assert licenses.select("license_id").distinct().count() == licenses.count()
    assert licenses.count() == known.LICENSES_AFTER + 1
    run_on_folder(spark, f"{two}/after", three, later, NOW)
    assert read_parquet(spark, f"{three}/after").licenses.count() == licenses.count()


def test_issued_ids_that_are_taken_stop_the_run(spark, folder, tmp_path):
    tables = seed_tables(spark)
    first = process_requests(tables, AS_OF, NOW)
    revoked = first.licenses_after.withColumn("status", F.lit("REVOKED"))
    with pytest.raises(ValueError, match="issued already"):
        run_pipeline(spark, replace(tables, licenses=revoked), str(tmp_path / "x"), AS_OF, NOW)


def test_reports_beyond_a_hundred_groups_are_whole(spark, tmp_path):
    tables = seed_tables(spark)
    many = spark.range(250).select(
        F.concat(F.lit("l"), "id").alias("license_id"), F.lit("member-01").alias("userid"),
        F.lit("Type 1").alias("license_type"), F.lit(AS_OF).alias("start_date"),
        F.lit(AS_OF).alias("expiry_date"), F.concat(F.lit("p"), "id").alias("product_name"),
        F.lit("ACTIVE").alias("status"), F.lit(NOW).cast("timestamp_ntz").alias("created_at"),
        F.lit(NOW).cast("timestamp_ntz").alias("updated_at"))
    mails = tables.users.unionByName(tables.users.withColumn(
        "userid", F.concat(F.lit("twin-"), "userid")))
    doubled = mails.crossJoin(spark.range(4).toDF("n")).select(
        F.concat("userid", F.lit("-"), "n").alias("userid"), "name",
        F.concat("n", "email").alias("email"), "lastlogin", "islicenseactive", "created_at",
        "updated_at")
    source = str(tmp_path / "in")
    write_tables(Tables(doubled, many, tables.requests), source)
    assert main(["report", source, str(tmp_path / "report"), "--as-of", "2025-09-10"]) == 0
    assert spark.read.parquet(str(tmp_path / "report/by_type_and_product")).count() == 250
    assert main(["validate", source, str(tmp_path / "validate")]) == 0
    assert spark.read.parquet(str(tmp_path / "validate/repeated_emails")).count() == (
        4 * known.USERS_IN_ALL)


def test_filters_and_columns_reach_the_scan(spark, folder, capsys):
    licenses = read_parquet(spark, folder).licenses
    reports.counts_by_type(licenses, AS_OF).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(status,ACTIVE)" in plan
    assert "GreaterThanOrEqual(expiry_date,2025-09-10)" in plan
    assert "ReadSchema: struct<userid:string,license_type:string,expiry_date:date,status:string>" in plan
    expiry.licenses_to_expire(licenses, AS_OF).explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThan(expiry_date,2025-09-10)" in plan and "Exchange" not in plan
    expiry.expire_licenses(licenses, AS_OF, NOW).explain("formatted")
    assert "Exchange" not in capsys.readouterr().out


def test_licenses_by_status_are_pruned(spark, folder, tmp_path):
    plain, one, two = (str(tmp_path / name) for name in ("plain", "one", "two"))
    run_on_folder(spark, folder, plain, AS_OF, NOW)
    run_on_folder(spark, folder, one, AS_OF, NOW, by_status=True)
    run_on_folder(spark, f"{one}/after", two, AS_OF, NOW, by_status=True)
    wanted = spark.read.parquet(f"{plain}/after/licenses")
    for out in (one, two):
        found = read_parquet(spark, f"{out}/after").licenses
        assert values(found, *wanted.columns) == values(wanted)
    active = requests.active_seats(read_parquet(spark, f"{one}/after").licenses, AS_OF)
    assert "PartitionFilters: [isnotnull(status" in active._jdf.queryExecution().toString()
    assert all("status=ACTIVE" in path for path in (
        active.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]))


def test_command_line(spark, folder, tmp_path, capsys):
    assert main(["generate", str(tmp_path / "gen"), "--users", "50", "--as-of", "2025-09-10"]) == 0
    assert main(["validate", str(tmp_path / "gen"), str(tmp_path / "found")]) == 0
    assert main(["report", folder, str(tmp_path / "brief"), "--as-of", "2025-09-10", "--brief"]) == 0
    out = capsys.readouterr().out
    active = [r for r in known.license_rows() if known.active(r)]
    assert f"|{len(known.HOLDERS)} " in out and f"|{len(active)} " in out
    assert sorted(os.listdir(tmp_path / "brief")) == ["by_type", "totals"]
    assert main(["--conf", "spark.sql.shuffle.partitions=5", "run", folder, str(tmp_path / "out"),
                 "--as-of", "2025-09-10", "--by-status", "--include-expired", "--brief"]) == 0
    out = capsys.readouterr().out
    assert "by_type_and_product" not in out and "run_counts" in out
    assert spark.conf.get("spark.sql.shuffle.partitions") == "5"
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_local_warehouse_serves_local_mode_only(spark, tmp_path, monkeypatch):
    def session(**conf):
        names = {name.replace("__", "."): value for name, value in conf.items()}
        return SimpleNamespace(
            conf=names, sparkContext=SimpleNamespace(master="spark://host:7077"),
            _jvm=spark._jvm, _jsc=spark._jsc)

    local = session(spark__sql__warehouse__dir=f"file:{tmp_path}/w")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(local)
    local.sparkContext.master = "local[4]"
    assert shared_folder(local) == f"file:{tmp_path}/w/.stages"
    named = session(spark__sql__warehouse__dir=f"file:{tmp_path}/w", spark__checkpoint__dir="/share/x/")
    assert shared_folder(named) == "/share/x"
