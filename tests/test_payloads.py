"""Payloads of any size: those beyond a variant are read row by row, with the same outcome."""

from conftest import AS_OF, EPOCH, SF_DIR, normal
from pyspark.sql import functions as F

from skytally.operators import landing, ledger, parse
from skytally.sources import driver_tables as src
from skytally.sources.payloads import open_payloads

ODD = [
    None, "", "null", "1", '"x"', "[1]", "{}", '{"time":1}', '{"time":1,"states":null}', '{"time":1,"states":false}',
    '{"time":1,"states":true}', '{"time":1,"states":0}', '{"time":1,"states":1}', '{"time":1,"states":""}',
    '{"time":1,"states":"a"}', '{"time":1,"states":{}}', '{"time":1,"states":{"a":1}}', '{"time":1,"states":[]}',
    '{"time":1,"states":[null,1,[1,NaN],{"a":1}]}', '{"time":NaN,"states":[]}', '{"time":1,"states":[1],"states":[2]}',
    '{"time":1,"time":2,"states":[2]}', '{"time":true,"states":[1]}', '{"time":1e30,"states":[1]}', "1,2", "1] [2",
    ' {"time":1,"states":[[1,"a]",-Infinity]]} ', '{"time":1,"states":[1', '{"time":"1","states":[]}',
    '{"Time":1,"states":[]}', '{"time":1,"states":[1]} x', '{"time":1,"states":[1]} {}', '{"time":1,"States":[1]}', '{"time":{"a":1},"states":[]}', '{"time":null,"states":[1]}',
]


def opened(payloads, by_rows):
    found = open_payloads(payloads, by_rows)
    return normal(found.withColumn("states", F.to_json("states")).collect())


def test_rows_read_by_themselves_are_the_same(spark):
    odd = spark.createDataFrame([(text, f"odd-{i}") for i, text in enumerate(ODD)], "payload string, source_file string")
    for payloads in (odd, src.to_payloads(src.events(spark, SF_DIR)).persist()):
        whole = opened(payloads, False)
        assert opened(payloads, True) == whole and len(whole) > 5


def big(spark, rows):
    """One payload of so many states, 207 bytes each."""
    state = F.concat(
        F.lit('["'), F.format_string("%06x", F.col("i")), F.lit('", "'), F.repeat(F.lit("x"), 90), F.lit('", "Ruritania", '),
        F.lit(f"{EPOCH}, {EPOCH}, 1.5, 50.5, 9000.0, false, 200.0, 64.0, 1.5, null, 9100.0, "), F.lit('"3311", false, 0, 1]'),
    )
    listed = spark.range(1, rows + 1, numPartitions=4).withColumnRenamed("id", "i").select(state.alias("s"))
    text = F.concat(F.lit(f'{{"time": {EPOCH}, "states": ['), F.array_join(F.collect_list("s"), ", "), F.lit("]}"))
    return listed.agg(text.alias("payload")).withColumn("source_file", F.lit("big"))


def test_a_payload_of_20_mib_lands_whole(spark, lake):
    payloads = big(spark, 110_000).persist()
    assert payloads.select(F.octet_length("payload")).first()[0] > 20 << 20
    landing.land_snapshots(payloads, lake, "a", AS_OF)
    run = ledger.run_states(lake.ledger()).first()
    assert (run.status, run.rows_received, run.rows_inserted) == ("succeeded", 110_000, 110_000)
    assert lake.landing().agg(F.countDistinct("icao24")).first()[0] == 110_000
    payloads.unpersist()


def test_a_payload_of_130_mib_is_read_whole(spark, tmp_path):
    rows = 700_000
    big(spark, rows).write.parquet(str(tmp_path / "in"))
    payloads = spark.read.parquet(str(tmp_path / "in"))
    assert payloads.select(F.octet_length("payload")).first()[0] > 130 << 20
    states = parse.explode_states(open_payloads(payloads))
    last = F.max_by(F.to_json("state"), "pos").alias("last")
    found = states.agg(F.count("*").alias("n"), F.max("pos").alias("pos"), last).first()
    assert (found.n, found.pos) == (rows, rows - 1) and found.last.endswith('"3311",false,0,1]')
