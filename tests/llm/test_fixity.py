import pytest
from pyspark.sql import functions as F

from skybasin.llm import fixity

SCHEMA = "number bigint, record binary, node string, digest int, parts int, file string"


def _frame(spark, rows):
    return spark.createDataFrame([(n, None if b is None else bytearray(b), "x", 1, 2, "y") for n, b in rows], SCHEMA)


def _audit(spark, expected, found):
    rows = fixity.audit_records(_frame(spark, expected), _frame(spark, found)).collect()
    return {r.node: (r.state, r.start, r.end, r.found_start, r.found_end) for r in rows}


def test_damage_is_located(spark, monkeypatch):
    monkeypatch.setattr(fixity, "FANOUT", 4)
    monkeypatch.setattr(fixity, "FILE_RECORDS", 50)
    good = [(i, b"r%d" % i) for i in range(300) if i != 77]
    bad = [(i, b"R" if i == 20 else b) for i, b in good if i not in (0, 299)] + [(77, b"new"), (-5, b"twin")]
    found = _audit(spark, good, bad)
    assert {n: s[0] for n, s in found.items()} == {0: "missing", 299: "missing", 20: "changed", 77: "extra", -5: "extra"}
    before = sum(len(b) for n, b in good if n < 20)
    assert found[20][1:] == (before, before + 3, before - 2, before - 1)
    assert found[77][1:3] == (None, None)


def test_equal_and_empty_replicas(spark):
    rows = [(i, b"x" * i) for i in range(200)]
    assert _audit(spark, rows, rows[::-1]) == {}
    assert _audit(spark, [], []) == {}
    assert {s[0] for s in _audit(spark, rows[:5], []).values()} == {"missing"}


def test_nulls_and_repeated_numbers(spark):
    rows = [(1, b"a"), (1, b"b"), (1, b"b"), (2, None), (3, b""), (None, b"loose"), (None, None)]
    assert _audit(spark, rows, rows[::-1]) == {}
    assert _audit(spark, rows, rows[1:]).keys() == {1}
    assert _audit(spark, rows, rows[:2] + rows[3:]).keys() == {1}
    assert [s[0] for s in _audit(spark, rows, rows[:5] + rows[6:]).values()] == ["missing"]
    # A null record is an empty one.
    assert _audit(spark, [(2, None)], [(2, b"")]) == {}


def test_a_long_record(spark):
    body = b"z" * 3_000_000
    assert _audit(spark, [(1, body)], [(1, body[:-1] + b"y")])[1] == ("changed", 0, len(body), 0, len(body))


def test_only_branches_that_differ_are_opened(spark, monkeypatch):
    monkeypatch.setattr(fixity, "FANOUT", 4)
    opened = []
    plain = fixity._differences
    monkeypatch.setattr(fixity, "_differences", lambda a, b: (opened.append(a.count()), plain(a, b))[1])
    good = [(i, b"r%d" % i) for i in range(256)]
    _audit(spark, good, [(i, b"!" if i == 100 else b) for i, b in good])
    assert len(opened) == 5 and opened[0] == 1 and max(opened) <= 4


def test_heights_must_agree(spark):
    small, large = _frame(spark, [(1, b"a")]), _frame(spark, [(10**6, b"a")])
    with pytest.raises(ValueError, match="heights"):
        fixity.audit(fixity.build_tree(small), fixity.build_tree(large))


def test_record_bytes(spark):
    row = spark.createDataFrame([(7, None, None), (8, "http://a/é", "<p>é")], "n bigint, u string, h string")
    found = [bytes(r[0]) for r in row.select(fixity.warc_record(F.col("n"), F.col("u"), F.col("h"))).collect()]
    assert found[0].endswith(b"WARC-Target-URI: \r\nContent-Type: text/html\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    assert b"Content-Length: 5\r\n\r\n<p>\xc3\xa9\r\n\r\n" in found[1]


def _placed(spark, rows):
    return spark.createDataFrame([(n, bytearray(r), f, o) for n, r, f, o in rows], "number bigint, record binary, file bigint, at bigint")


def _moves(expected, found):
    rows = fixity.audit_records(expected, found, file_col="file", offset_col="at").collect()
    return sorted((r.node, r.state, r.found_start) for r in rows)


def test_places_of_records_are_part_of_the_audit(spark):
    good = [(i, b"record %d" % i, 0, 8 * i) for i in range(10)]
    whole = _placed(spark, good)
    assert _moves(whole, _placed(spark, good)) == []
    # An archive without gaps is where records are expected without columns of places.
    assert _moves(whole.select("number", "record"), _placed(spark, good)) == []
    # Foreign bytes before record 4 push it and all after it; only its own distance changes.
    pushed = [(n, r, f, o + (5 if n >= 4 else 0)) for n, r, f, o in good]
    assert _moves(whole, _placed(spark, pushed)) == [(4, "moved", 37)]
    # Two records that changed places: they and the one behind them have others before them.
    swapped = [(n, r, f, {2: 24, 3: 16}.get(n, o)) for n, r, f, o in good]
    assert [x[:2] for x in _moves(whole, _placed(spark, swapped))] == [(2, "moved"), (3, "moved"), (4, "moved")]
    # A lost record whose place was closed changes no neighbour; one that left a hole moves the next.
    closed = [(n, r, f, o - (8 if n > 6 else 0)) for n, r, f, o in good if n != 6]
    assert _moves(whole, _placed(spark, closed)) == [(6, "missing", None)]
    assert [x[:2] for x in _moves(whole, _placed(spark, [x for x in good if x[0] != 6]))] == [(6, "missing"), (7, "moved")]
    # A record in another file.
    other = [(n, r, 1 if n == 9 else f, 0 if n == 9 else o) for n, r, f, o in good]
    assert _moves(whole, _placed(spark, other)) == [(9, "moved", 0)]
