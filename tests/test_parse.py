import datetime as dt
import json

import pytest
from conftest import AS_OF, EPOCH, payload_text, three_rows
from pyspark.sql import functions as F

from skytally.operators import parse
from skytally.sources.payloads import open_payloads

UTC = dt.timezone.utc


def judged(payloads, *texts):
    return parse.validate(parse.explode_states(open_payloads(payloads(*texts))), AS_OF)


def changed(**at):
    row = three_rows()[0]
    for place, value in at.items():
        row[int(place[1:])] = value
    return row


# One case per row of a single payload; the text is spliced in as JSON.
CASES = [
    (changed(_0=None), "icao24_missing"),
    (changed(_0="  \t "), "icao24_missing"),
    (changed(_0="\x1c　"), "icao24_missing"),
    (changed(_0=12), "icao24_missing"),
    (changed(_0="0123456789abc"), "icao24_invalid"),
    (changed(_4=None), "last_contact_not_numeric"),
    (changed(_4=True), "last_contact_not_numeric"),
    (changed(_4="1757500000"), "last_contact_not_numeric"),
    (changed(_4=100), "last_contact_implausible"),
    (changed(_4=EPOCH + 48 * 3600), "last_contact_implausible"),
    (changed(_4=EPOCH + 23 * 3600), None),
    (changed(_4=10**15), "last_contact_out_of_range"),
    (changed(_4=-(10**15)), "last_contact_out_of_range"),
    (changed(_4=10**60), "last_contact_out_of_range"),
    (changed(_3="soon"), "time_position_not_numeric"),
    (changed(_3=1), "time_position_implausible"),
    (changed(_3=1e300), "time_position_out_of_range"),
    (changed(_8="no"), "on_ground_not_boolean"),
    (changed(_8=None), "on_ground_not_boolean"),
    (changed(_8=1), "on_ground_not_boolean"),
    (changed(_5=-181.0), "longitude_out_of_range"),
    (changed(_5=180), None),
    (changed(_5="1.5"), "longitude_not_numeric"),
    (changed(_6=91.0), "latitude_out_of_range"),
    (changed(_6=-90), None),
    (changed(_6=False), "latitude_not_numeric"),
    (changed(_6=float("nan")), "latitude_not_finite"),
    (changed(_10=361.0), "true_track_out_of_range"),
    (changed(_10=360), "true_track_out_of_range"),
    (changed(_10=-0.1), "true_track_out_of_range"),
    (changed(_10=0), None),
    (changed(_9=float("nan")), "velocity_not_finite"),
    (changed(_9=float("inf")), "velocity_not_finite"),
    (changed(_9=float("-inf")), "velocity_not_finite"),
    (changed(_7="high"), "baro_altitude_not_numeric"),
    (changed(_13=[]), "geo_altitude_not_numeric"),
    (changed(_11={}), "vertical_rate_not_numeric"),
    (changed(_1=7), "text_field_not_string"),
    (changed(_2=[]), "text_field_not_string"),
    (changed(_14=2000), "text_field_not_string"),
    (changed(_16="radar"), "position_source_not_numeric"),
    (changed(_16=float("inf")), "position_source_not_finite"),
    (changed(_17=40000), "category_out_of_range"),
    (changed(_12="ignored"), None),
    # Two faults: the earlier test names the reason.
    (changed(_6=91.0, _5="x"), "longitude_not_numeric"),
    (changed(_6=91.0, _8="no"), "on_ground_not_boolean"),
    (changed(_1=7, _10=400), "true_track_out_of_range"),
    (changed(_17="x", _16=99999), "position_source_out_of_range"),
    (None, "row_not_array"),
    ("state", "row_not_array"),
    (5, "row_not_array"),
    ({"0": "x"}, "row_not_array"),
    ([], "row_too_short"),
    (three_rows()[0][:16], "row_too_short"),
    (three_rows()[0][:17], None),
    (three_rows()[0] + ["more"], None),
]


def test_first_broken_rule_names_the_reason(payloads):
    rows = judged(payloads, payload_text([row for row, _ in CASES])).select("pos", "reason").collect()
    found = {r.pos: r.reason for r in rows}
    wrong = [(CASES[i], found[i]) for i in range(len(CASES)) if found[i] != CASES[i][1]]
    assert not wrong


def test_accepted_values(payloads):
    rows = parse.accepted(judged(payloads, payload_text(three_rows()))).orderBy("pos").collect()
    first, _, third = rows
    assert len(rows) == 3
    assert (first.icao24, first.callsign, first.origin_country) == ("e5a001", "KITE7", "Ruritania")
    assert first.observed_at.timestamp() == EPOCH - 7
    assert (first.baro_altitude_m, first.geo_altitude_m, first.position_source, first.category) == (
        9300.0, 9410.0, 0, 1,
    )
    # Without a position time the last contact addresses the row.
    assert third.time_position is None and third.observed_at.timestamp() == EPOCH - 40
    assert third.on_ground is True and third.latitude is None and third.callsign is None


def test_text_is_stripped_and_lowered(payloads):
    rows = [changed(_0="  AB12CD\x1f", _1="   ", _14=" 1200 ")]
    row = judged(payloads, payload_text(rows)).first()
    assert (row.icao24, row.callsign, row.squawk) == ("ab12cd", None, "1200")


def test_floats_become_integers_toward_zero(payloads):
    rows = judged(payloads, payload_text([changed(_16=1.9, _17=-1.9)])).collect()
    assert (rows[0].position_source, rows[0].category) == (1, -1)


SPI = [(None, False), (0, False), (0.0, False), ("", False), ([], False), ({}, False), (False, False),
       ("false", True), (1, True), (0.5, True), ([0], True), ([None], True), ({"a": 0}, True),
       (float("nan"), True), (True, True)]


def test_spi_follows_truthiness(payloads):
    rows = judged(payloads, payload_text([changed(_15=v) for v, _ in SPI])).select("pos", "reason", "spi").collect()
    assert {r.pos: (r.reason, r.spi) for r in rows} == {i: (None, e) for i, (_, e) in enumerate(SPI)}


@pytest.mark.parametrize("seconds", [EPOCH + 0.5, 1757500000.123456, 1757499999.9999995, 946684800])
def test_epoch_to_microsecond(payloads, seconds):
    row = judged(payloads, payload_text([changed(_3=seconds)])).select(F.unix_micros("time_position").alias("t")).first()
    expected = dt.datetime.fromtimestamp(float(seconds), tz=UTC) - dt.datetime(1970, 1, 1, tzinfo=UTC)
    assert row.t == expected // dt.timedelta(microseconds=1)


PAYLOADS = [
    ("nope", "not_json"),
    ("", "not_json"),
    ('{"time": 1', "not_json"),
    ("[]", "not_object"),
    ('"text"', "not_object"),
    ("null", "not_object"),
    ('{"states": []}', "time_unusable"),
    ('{"time": null, "states": []}', "time_unusable"),
    ('{"time": "1757500000", "states": []}', "time_unusable"),
    ('{"time": true, "states": []}', "time_unusable"),
    ('{"time": 1e30, "states": []}', "time_out_of_range"),
    ('{"time": 1757500000, "states": "none"}', "states_not_list"),
    ('{"time": 1757500000, "states": {"a": 1}}', "states_not_list"),
    ('{"time": 1757500000, "states": 3}', "states_not_list"),
    ('{"time": 1757500000, "states": true}', "states_not_list"),
    ('{"time": 1757500000, "states": null}', "ok"),
    ('{"time": 1757500000, "states": []}', "ok"),
    ('{"time": 1757500000, "states": {}}', "ok"),
    ('{"time": 1757500000, "states": ""}', "ok"),
    ('{"time": 1757500000, "states": 0}', "ok"),
    ('{"time": 1757500000, "states": false}', "ok"),
    ('{"time": 1757500000}', "ok"),
    (' \n{"time": 1757500000.5, "states": null, "time": 1757500001}', "ok"),
]


def test_payload_status(payloads):
    opened = open_payloads(payloads(*[text for text, _ in PAYLOADS]))
    found = {int(r.source_file.split("-")[1]): r.payload_status for r in opened.collect()}
    assert found == {i: status for i, (_, status) in enumerate(PAYLOADS)}
    assert parse.explode_states(opened).count() == 0
    assert parse.explode_states(opened, keep_empty=True).count() == len(PAYLOADS)


def test_rejected_rows_keep_their_text(payloads):
    rows = parse.rejected(judged(payloads, payload_text([None, changed(_8="no"), *three_rows()]))).collect()
    assert {r.reason for r in rows} == {"row_not_array", "on_ground_not_boolean"}
    raw = next(r.raw for r in rows if r.reason == "on_ground_not_boolean")
    assert json.loads(raw)[8] == "no"


def test_dry_run(payloads):
    rows = three_rows()
    text = payload_text([*rows, rows[0], rows[0], None, changed(_0=None)])
    row = parse.dry_run_summary(judged(payloads, text)).first()
    assert (row.rows_received, row.rows_valid, row.rows_rejected) == (7, 5, 2)
    assert (row.rows_unique, row.rows_duplicate_in_batch) == (3, 2)
    assert row.reject_reasons == {"icao24_missing": 1, "row_not_array": 1}


def test_long_payload_is_read_whole(payloads):
    rows = [changed(_0=f"{i:06x}") for i in range(20000)]
    assert parse.accepted(judged(payloads, payload_text(rows))).select("icao24").distinct().count() == 20000
