"""Literal cases for the column functions."""

import random
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_EVEN, Context, Decimal
from zoneinfo import ZoneInfo

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesync.functions import payload, text, times, values

UTC = timezone.utc


def evaluate(spark, expression, inputs, kind="string"):
    """The expression over one input column, results in input order."""
    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r[0] for r in rows.select(expression(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def instants(spark, expression, inputs):
    micros = evaluate(spark, lambda c: F.unix_micros(expression(c)), inputs)
    return [None if m is None else datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=m) for m in micros]


def test_amounts_of_every_spelling(spark):
    """One number spelled in many ways, and the nearest texts that are no number."""
    for sign in ("", "-", "+"):
        digits = "70350125"
        forms = [f" {sign}{digits[:k]}.{digits[k:]}{mark}{k0:+d}" for k in range(1, 8) for mark in "eE" for k0 in (5 - k, 12 - k)]
        forms += [f"{sign}70350.125", f"{sign}70_350.125000\t".strip(), f"{sign}.70350125e5", f"{sign}0000070350.1250", f"{sign}70350125e-3", f"{sign}7035012500000.e-8"]
        want = [Decimal(f.strip().replace("_", "")).quantize(Decimal("0.000001")) for f in forms]
        assert evaluate(spark, values.to_amount, forms) == want
    tie = {"4.0000005e-0": "4.000000", "40000015e-7": "4.000002", "4.00000050000000000000000000000001e0": "4.000001",
           "2.5000000000000000000001e-6": "0.000003", "1234567890123456789012.0000005e0": "1234567890123456789012.000000",
           "5e-7": "0.000000", "15e-7": "0.000002", "1e-400": "0.000000", "0e999999999999": "0.000000", "8" * 32: "8" * 32 + ".000000",
           "8" * 31 + "e1": "8" * 31 + "0.000000"}
    assert evaluate(spark, values.to_amount, list(tie)) == [Decimal(v) for v in tie.values()]
    bad = ["e5", "1e", "1e+", "1e5.0", "--1", "1 2", "0x1", "inf", "nan", "", " ", ".", "+", None, "1e33", "8" * 33, "1e999999999999", "9" * 32 + ".9999995"]
    assert evaluate(spark, values.to_amount, bad) == [None] * len(bad)


@settings(max_examples=10, deadline=None, database=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.decimals(allow_nan=False, allow_infinity=False, places=None,
                            min_value=-(10 ** 30), max_value=10 ** 30), min_size=20, max_size=40))
def test_amounts_match_decimal_rounding(spark, numbers):
    plain = [format(n, "f") if i % 2 else format(n, "E") for i, n in enumerate(numbers)]
    exact = Context(prec=400, rounding=ROUND_HALF_EVEN)
    expected = [exact.quantize(Decimal(t), Decimal("0.000001")) for t in plain]
    wrong = [c for c in zip(plain, evaluate(spark, values.to_amount, plain), expected) if c[1] != c[2]]
    assert not wrong


def some_instants(seed, count=40):
    """Instants of four millennia, to the microsecond."""
    rng = random.Random(seed)
    return [datetime(1, 1, 1, tzinfo=UTC) + timedelta(days=rng.randrange(360_000, 1_460_000), microseconds=rng.randrange(86_400_000_000)) for _ in range(count)]


def test_times_of_every_spelling(spark):
    """The same instants as ISO text with any offset and precision, and as digits of milliseconds."""
    rng, spelled = random.Random(1), {}
    for at in some_instants(1):
        zone = timezone(timedelta(minutes=rng.randrange(-14 * 60, 14 * 60, 15)))
        digits = rng.randrange(0, 7)
        cut = at.replace(microsecond=at.microsecond // 10 ** (6 - digits) * 10 ** (6 - digits))
        fraction = f".{cut.microsecond:06}"[:digits + 1] if digits else ""
        local = cut.astimezone(zone)
        spelled[local.strftime("%Y-%m-%dT%H:%M:%S").zfill(19) + fraction + local.strftime("%z")[:3] + ":" + local.strftime("%z")[3:]] = cut
        spelled[cut.strftime("%Y-%m-%dT%H:%M:%S").zfill(19) + fraction + rng.choice("Zz")] = cut
        day = cut.replace(hour=0, minute=0, second=0, microsecond=0)
        spelled[day.strftime("%Y-%m-%d").zfill(10)] = day
        millis = (at - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(milliseconds=1)
        spelled[rng.choice(["", " ", "  "]) + str(millis) + rng.choice(["", " "])] = datetime(1970, 1, 1, tzinfo=UTC) + timedelta(milliseconds=millis)
    assert instants(spark, times.to_time, list(spelled)) == list(spelled.values())
    first = next(iter(spelled))
    unreadable = [None, "\t ", first + "x", "x" + first, first[:7], first.replace("T", "T25", 1), "2031-02-29", "2031-00-10", "1e12", "12.5", "--5", "false", "[1]", "7" * 25]
    assert instants(spark, times.to_time, unreadable) == [None] * len(unreadable)


def test_parse_iso(spark):
    good = {
        "2026-01-02T03:04:05.000Z": datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC),
        "2026-01-02T03:04": datetime(2026, 1, 2, 3, 4, tzinfo=UTC),
        "2026-01-02T03": datetime(2026, 1, 2, 3, tzinfo=UTC),
        "2026-01-02": datetime(2026, 1, 2, tzinfo=UTC),
        "2026-01-02 03:04:05+0530": datetime(2026, 1, 1, 21, 34, 5, tzinfo=UTC),
        "20260102": datetime(2026, 1, 2, tzinfo=UTC),
        "20260102T030405Z": datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC),
        "20260102T0304": datetime(2026, 1, 2, 3, 4, tzinfo=UTC),
        "20260102T03+05": datetime(2026, 1, 1, 22, tzinfo=UTC),
        "20260102T030405,5-0100": datetime(2026, 1, 2, 4, 4, 5, 500000, tzinfo=UTC),
        "2026-01-02T03:04Z": datetime(2026, 1, 2, 3, 4, tzinfo=UTC),
        "2026-01-02t03:04+02:00": datetime(2026, 1, 2, 1, 4, tzinfo=UTC),
        "2026-01-02T03:04:05,25+02": datetime(2026, 1, 2, 1, 4, 5, 250000, tzinfo=UTC),
        "": None,
        None: None,
    }
    assert instants(spark, times.parse_iso, list(good)) == list(good.values())
    for bad in ["not a date", "2026", "2026-02-30", "   "]:
        with pytest.raises(Exception, match="not an ISO 8601 time"):
            instants(spark, times.parse_iso, [bad])


def test_issue_times_of_any_offset(spark):
    def parse(c):
        return times.parse_issue_time(c, "updated")

    rng, spelled = random.Random(2), {None: None}
    for at in some_instants(2):
        at = at.replace(microsecond=at.microsecond // 1000 * 1000)
        local = at.astimezone(timezone(timedelta(minutes=rng.randrange(-12 * 60, 14 * 60, 30))))
        spelled[local.strftime("%Y-%m-%dT%H:%M:%S").zfill(19) + f".{at.microsecond // 1000:03}" + local.strftime("%z")] = at
    assert instants(spark, parse, list(spelled)) == list(spelled.values())
    whole = next(text for text in spelled if text)
    for bad in (whole[:10], whole[:19] + whole[23:], whole[:23], " ", whole[:5] + "19" + whole[7:]):
        with pytest.raises(Exception, match="field updated"):
            instants(spark, parse, [bad])


def test_instants_as_text_in_zones(spark):
    """Minutes are cut, not rounded, and so are milliseconds."""
    held = [at for at in some_instants(3) if 1975 < at.year < 2035] + [datetime(2011, 12, 31, 23, 59, 59, 999_999, tzinfo=UTC)]
    micros = [(at - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1) for at in held]
    for zone in ("America/St_Johns", "Australia/Lord_Howe", "UTC"):
        found = evaluate(spark, lambda c, zone=zone: times.minute_in_zone(F.timestamp_micros(c), zone), micros, "bigint")
        assert found == [at.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M") for at in held]
    assert evaluate(spark, lambda c: times.utc_millis_text(F.timestamp_micros(c)), micros, "bigint") == [
        at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{at.microsecond // 1000:03}Z" for at in held]


def test_type_ids(spark):
    cases = {"3": 3, "3.5": 3, "-3.5": -3, '"3"': 3, '" 3 "': 3, '"3.5"': None, '"x"': None, "null": None, "true": 1,
             "1e30": None, "[]": None}
    assert evaluate(spark, lambda c: values.type_id(F.parse_json(c)), list(cases)) == list(cases.values())


def test_id_lists_keep_first_places(spark):
    rng = random.Random(4)
    lists = [[rng.choice(["", " ", "a7", "b-8", " 55", "55 ", "a7 "]) for _ in range(rng.randrange(1, 9))] for _ in range(30)]
    want = [list(dict.fromkeys(item.strip() for item in items if item.strip())) for items in lists]
    assert evaluate(spark, values.id_list, [";".join(items) for items in lists] + [None]) == [*want, None]


def test_canonical_json(spark):
    raw = '{"b": 1, "a": {"z": "Zoë", "y": [1, null, true]}}'
    assert evaluate(spark, lambda c: payload.canonical(payload.parsed(c)), [raw]) == [
        '{"a":{"y":[1,null,true],"z":"Zoë"},"b":1}']


def test_strict_and_loose_truth(spark):
    spelled = ['{"f":true}', '{"f":"true"}', '{"f":1}', '{"f":false}', '{"f":null}', "{}", '{"f":""}', '{"f":[]}']
    assert evaluate(spark, lambda c: payload.is_true(F.parse_json(c), "f"), spelled) == [
        True, False, False, False, False, False, False, False]
    assert evaluate(spark, lambda c: payload.truthy(payload.node_at(F.parse_json(c), "f")), spelled) == [
        True, True, True, False, False, False, False, False]


def test_other_fields(spark):
    cases = {'{"fields":{"summary":"s","z":1,"a":{"k":null}}}': '{"a":{"k":null},"z":1}',
             '{"fields":{"summary":"s"}}': None, '{"fields":null}': None, "{}": None}
    assert evaluate(spark, lambda c: payload.other_fields(F.parse_json(c), "fields", ["summary"]),
                    list(cases)) == list(cases.values())


def test_first_title(spark):
    cases = {
        '{"properties":{"N":{"type":"number","number":1},"T":{"type":"title","title":[{"plain_text":"a"},{"plain_text":"b"}]}}}': "ab",
        '{"properties":{"T":{"type":"title","title":[]}}}': "",
        '{"properties":{"T":{"type":"title"}}}': "",
        '{"properties":{"Z":{"type":"title","title":[{"plain_text":"z"}]},"A":{"type":"title","title":[{"plain_text":"a"}]}}}': "z",
        '{"properties":{"T":{"type":"title","title":[{"href":null},{"plain_text":"b"}]}}}': "b",
        '{"properties":{"N":"text"}}': None, '{"properties":{}}': None, "{}": None,
    }
    assert evaluate(spark, payload.first_title, list(cases)) == list(cases.values())


def test_masking(spark):
    uri = "mongodb+srv://app:p%40ss@cluster0.abc.mongodb.net,10.0.0.7:27017/db?x=1"
    message = ["user app password p@ss or p%40ss at cluster0.abc.mongodb.net via shard-1.abc.mongodb.net "
               "10.0.0.7 10.1.2.3 file oci://bucket@ns/x.parquet'"]
    assert evaluate(spark, lambda c: text.mask_uri(c, uri), message) == [
        "user *** password *** or *** at *** via <host> *** <ip> file <oci-path>'"]
    assert evaluate(spark, lambda c: text.mask(c, ["tok", ""]), ["a tok b tok"]) == ["a *** b ***"]


def test_masking_takes_the_longest_secret_first():
    assert text.uri_secrets("x://ab:abc@h/db") == ["abc", "ab", "h"]
    assert text.uri_secrets("x://us%2Fer:p%3Aw@One.example:27017,two.example/db?a=b@c") == [
        "One.example", "two.example", "us%2Fer", "p%3Aw", "us/er", "p:w"]
    assert text.uri_secrets("x://h.example") == ["h.example"] and text.uri_secrets("x:///path") == []


def test_classify_first_rule_wins(spark):
    messages = ["x bad auth MongoTimeoutException", "MongoTimeoutException", "something else"]
    found = evaluate(spark, lambda c: text.classify(c, text.DOCUMENT_ERROR_RULES, "MongoError"), messages)
    assert found == ["MongoAuthError", "MongoError", "MongoError"]


def test_hosts(spark):
    allowed = r"^[a-z0-9][a-z0-9-]*\.example\.net$"
    cases = {"https://Team.example.net/": "team.example.net", "team.example.net": "team.example.net",
             "http://evil.org/team.example.net": None, "": None, None: None}
    assert evaluate(spark, lambda c: text.normalize_host(c, allowed), list(cases)) == list(cases.values())
