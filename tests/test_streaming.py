import datetime as dt

from conftest import AS_OF, EPOCH, SF_DIR, normal, payload_text, three_rows
from pyspark.sql import functions as F

from skytally.operators import ledger, quality
from skytally.operators.landing import first_wins
from skytally.plans import marts as plans
from skytally.plans import staging
from skytally.schemas import HOURLY_ACTIVITY, conform
from skytally.sources import driver_tables as src
from skytally.sources.payloads import read_payload_files
from skytally.sources.versions import VersionedTable
from skytally.streaming import landing, windows


def drop(folder, name, *args):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(payload_text(*args))


def test_landing_stream_with_late_rows(spark, tmp_path, lake, marts):
    inbox, as_of = tmp_path / "inbox", AS_OF + dt.timedelta(hours=1)

    def run(checkpoint="checkpoint", files=1):
        stream = landing.stream_payload_files(spark, str(inbox), files_per_batch=files)
        landing.land_stream(stream, lake, str(tmp_path / checkpoint), as_of=as_of, marts=marts).awaitTermination()

    drop(inbox, "a.json", three_rows())
    run()
    drop(inbox, "b.json", three_rows() + three_rows(EPOCH + 3000), EPOCH + 3000)
    run()
    states = ledger.run_states(lake.ledger())
    assert sorted((r.rows_received, r.rows_inserted, r.rows_duplicate) for r in states.collect()) == [(3, 3, 0), (6, 3, 3)]
    assert lake.landing().count() == 6
    full = plans.publishable_hourly(lake.landing())
    assert normal(conform(marts.hourly(), HOURLY_ACTIVITY).collect()) == normal(full.collect())
    assert marts.health().agg(F.sum("run_count")).first()[0] == 2

    # Nothing new: nothing happens.
    run()
    assert lake.landing().count() == 6 and ledger.run_states(lake.ledger()).count() == 2

    # The checkpoint is lost: both files are read again, in other batches, as duplicates.
    before = normal(lake.landing().collect())
    run("another-checkpoint", None)
    assert normal(lake.landing().collect()) == before
    states = ledger.run_states(lake.ledger())
    assert states.count() == 4 and states.agg(F.sum("rows_inserted")).first()[0] == 6
    assert quality.repeated_keys(lake.landing(), "icao24", "observed_at").count() == 0
    assert quality.ledger_balance(states).count() == 0


def test_two_feeds_share_a_lake(spark, tmp_path, lake):
    for n, feed in enumerate(("north", "south")):
        drop(tmp_path / feed, "a.json", three_rows(EPOCH + 600 * n), EPOCH + 600 * n)
        stream = landing.stream_payload_files(spark, str(tmp_path / feed))
        checkpoint = str(tmp_path / f"{feed}-checkpoint")
        landing.land_stream(stream, lake, checkpoint, as_of=AS_OF + dt.timedelta(hours=1)).awaitTermination()
    assert lake.landing().count() == 6 and ledger.run_states(lake.ledger()).count() == 2


def test_files_are_read_whole(spark, tmp_path):
    drop(tmp_path / "in", "a.json", three_rows())
    (tmp_path / "in" / "b.json").write_text('{\n"time": 1,\n"states": null\n}')
    rows = read_payload_files(spark, str(tmp_path / "in")).collect()
    assert len(rows) == 2 and all("/in/" in r.source_file for r in rows)


def merged(spark, tmp_path, table, partial, merge, files=1, parts=5):
    table.repartition(parts).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
    windows.append_partials(stream, partial, str(tmp_path / "out"), str(tmp_path / "cp"), merge).awaitTermination()
    return windows.read_partials(spark, str(tmp_path / "out"))


def test_streamed_hours_agree_with_the_batch(spark, tmp_path):
    observed = src.to_observations(src.events(spark, SF_DIR))
    streamed = windows.merged_hours(merged(spark, tmp_path, observed, windows.hourly_partials, windows.merge_hours))
    batch = plans.hourly_activity(staging.grid_observations(staging.stage_observations(observed)))
    assert normal(streamed.collect()) == normal(batch.collect()) and streamed.count() > 0


def test_the_first_report_is_kept_whatever_batch_it_is_in(spark, tmp_path):
    reports = src.to_reports(src.events(spark, SF_DIR))

    def first(rows):
        return windows.deduplicated(rows, ("api_snapshot_time", "pos"))

    kept = first(merged(spark, tmp_path, reports, first, first, files=2))
    assert normal(kept.collect()) == normal(first_wins(reports, ("api_snapshot_time", "pos")).collect())


def test_many_batches_leave_few_folders_and_replays_change_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(3).selectExpr("id % 2 AS k", "id AS n")

    def merge(parts):
        return parts.groupBy("k").agg(F.sum("n").alias("n"))

    most = 0
    for batch in range(64):
        for _ in range(2 if batch % 7 == 0 else 1):  # some are replayed, also right after a merge
            windows.add_partial(spark, rows, path, "query", batch, merge)
        table = VersionedTable(spark, path, rows.schema)
        most = max(most, len(table.current().parts))
    assert most <= 12 and len(table.current().parts) == 1
    windows.add_partial(spark, rows, path, "query", 17, merge)  # counted long ago
    windows.add_partial(spark, rows, path, "another", 17, merge)
    totals = {r.k: r.n for r in merge(windows.read_partials(spark, path)).collect()}
    assert totals == {0: 65 * 2, 1: 65 * 1}
    assert len(table._names("data")) < 30  # folders of old versions are gone
