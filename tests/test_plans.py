"""The physical plans are the ones intended."""

import contextlib
import datetime as dt
import io
import pathlib
import re

from conftest import AS_OF, SF_DIR, payload_text, three_rows
from pyspark.sql import functions as F

from skytally import registry
from skytally.operators import landing, ledger, parse
from skytally.plans import marts, reads, staging
from skytally.sources import driver_tables as src
from skytally.sources.payloads import open_payloads


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def codegen(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]


def test_published_hour_needs_only_its_columns(spark):
    observed = src.to_observations(src.events(spark, SF_DIR))
    text = plan(marts.hourly_activity(staging.grid_observations(staging.stage_observations(observed))))
    assert "SortAggregate" not in text and "Window" not in text
    assert "props" not in text and "event_type" not in text
    assert "partial_count" in text or "partial_first" in text


def test_no_query_forms_pairs_or_ranks_in_one_task(spark):
    skip = ("stream", "late", "full", "reconcile", "built")
    for name, query in registry.QUERIES.items():
        if name.startswith(skip):
            continue
        text = plan(query(spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        for line in text.splitlines():
            assert not ("Window " in line and line.rstrip().endswith(", []")), name
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_validation_is_compiled(payloads):
    judged = landing.judge(payloads(payload_text(three_rows())), "a", AS_OF)
    sizes = codegen(judged)
    # The JVM leaves larger methods interpreted.
    assert sizes and max(sizes) < 8000


def test_payloads_are_parsed_once(payloads):
    opened = open_payloads(payloads(payload_text(three_rows())))
    text = plan(parse.accepted(parse.validate(parse.explode_states(opened), AS_OF)))
    # Once as it is, and once repaired where that failed.
    assert text.count("parseJson") == 2


def test_landing_keys_are_read_by_day_and_range(spark, lake, payloads):
    landing.land_snapshots(payloads(payload_text(three_rows())), lake, "a", AS_OF)
    rows = lake.landing([AS_OF.date()], without="b").where(F.col("observed_at") >= F.lit(AS_OF))
    text = plan(rows.select("icao24", "observed_at"))
    # A day, and a load that is repeated, are left out before anything is listed.
    assert lake.landing([AS_OF.date()], without="a").inputFiles() == lake.landing([dt.date(2020, 1, 1)]).inputFiles() == []
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(observed_at", text)
    assert re.search(r"ReadSchema: struct<icao24:string,observed_at:timestamp>", text)


def test_reads_prune_days(spark, lake, marts):
    lake.append(src.to_observations(src.events(spark, SF_DIR)), "a")
    from skytally.plans.marts import refresh_hourly

    refresh_hourly(lake, marts)
    text = plan(reads.hourly_totals(marts.hourly(), registry.NOW, 24))
    assert re.search(r"PartitionFilters: \[[^\]]*activity_date", text)
    assert re.search(r"PushedFilters: \[[^\]]*activity_hour", text)


def test_rebuild_reads_only_recent_days(spark, lake):
    lake.append(src.to_observations(src.events(spark, SF_DIR)), "a")
    from skytally.plans.marts import since_bound

    text = plan(since_bound(lake.landing(), registry.LANDED_UNTIL))
    assert re.search(r"PartitionFilters: \[[^\]]*observed_date", text)


def test_snapshots_are_sorted_natively(spark):
    assert "lambdafunction" not in plan(src.to_payloads(src.events(spark, SF_DIR)))


def test_loads_read_their_payloads_from_an_archive(spark, monkeypatch):
    given = []

    def land(payloads, lake, *args):
        given.append(plan(payloads))
        raise InterruptedError

    monkeypatch.setattr(landing, "land_snapshots", land)
    for name in ("run_reject_reasons", "landed_provenance"):
        with contextlib.suppress(InterruptedError):
            registry.QUERIES[name](spark, SF_DIR)
    assert len(given) == 2 and not any("Aggregate" in text for text in given)


def test_accounting_parses_its_payloads_once(spark):
    assert "Generate" not in plan(registry.QUERIES["load_accounting"](spark, SF_DIR))


def test_run_states_sort_only_what_was_dealt_by_run(spark):
    lines = plan(ledger.run_states(src.to_ledger_events(src.orders(spark, SF_DIR)))).splitlines()
    exchange = next(n for n, line in enumerate(lines) if "Exchange" in line)
    assert not any("Sort" in line for line in lines[exchange:])


def test_a_streamed_batch_is_several_files(spark, monkeypatch):
    files = []

    def append(stream, *args):
        files.append(len(list(pathlib.Path(args[1]).parent.glob("in/*.parquet"))))
        raise InterruptedError

    monkeypatch.setattr(registry.windows, "append_partials", append)
    with contextlib.suppress(InterruptedError):
        registry.QUERIES["stream_hourly"](spark, SF_DIR)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert files[0] == 5 * -(-tasks // 5)
