"""Quoted files read by byte ranges, against the reader that takes a file in one task."""

import csv
import io
import random
from collections import Counter

import pytest

from tidewater.operators.alerts import KeySpikeRule, SpikeRule
from tidewater.sources.files import LOG_COLUMNS, read_log
from tidewater.sources.records import TOLD, inside_after, parse_records, ranges_inside, read_log_ranges, records, text_lines
from tidewater.streaming.logs import AlertStream, log_line_stream, log_stream


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that records lie across them."""
    small = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "9", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def field(rng, end):
    kind = rng.random()
    if kind < 0.5:
        return "".join(rng.choices("abc é1", k=rng.randint(0, 6)))
    if kind < 0.6:
        return 'a"b'  # a quote that opens nothing
    inner = "".join(rng.choices(["x", ",", end, '""', "z z"], k=rng.choice([2, 6, 12, 60])))
    return f'"{inner}"'


def log_text(rng, n, end):
    out = []
    for _ in range(n):
        width = rng.choice([24] * 8 + [3, 25, 1])
        out.append(",".join(field(rng, end) if rng.random() < 0.3 else f"v{i}" for i in range(width)))
        if rng.random() < 0.03:
            out.append("")
    return end.join(out) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("line, outside, inside", [
    ("", False, True), ("a,b", False, True), ('a,"b', True, False), ('"a","b"', False, False), ('"a""', True, False),
    ('""', False, True), ('"",""', False, True), ('a"b,c', False, False), ('a"b,"', True, True), ('x","y', True, True), ('x"y"z,w', False, False),
])
def test_states(line, outside, inside):
    assert (inside_after(line.encode(), False), inside_after(line.encode(), True)) == (outside, inside)


@pytest.mark.parametrize("told", [TOLD, 0], ids=["told", "joined"])
@pytest.mark.parametrize("seed, end", [(1, "\n"), (3, "\r\n")])
def test_rows_of_the_one_task_reader(spark, tmp_path, small_ranges, seed, end, told):
    rng = random.Random(seed)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes(log_text(rng, 120, end).encode())
    lines = text_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20 and ranges_inside(lines).count() > 5
    got = parse_records(records(lines, told))
    assert got.columns == list(LOG_COLUMNS)
    want = Counter(map(tuple, read_log(spark, str(tmp_path)).collect()))
    assert Counter(map(tuple, got.collect())) == want and want.total() > 200


def test_a_break_across_many_ranges(spark, tmp_path, small_ranges):
    """One field is longer than several ranges; another file ends inside quotes."""
    long = "line, of text\n" * 400
    rows = [["first"] + ["v"] * 23, ["second", long, 'say "so"'] + ["v"] * 21, ["third"] + ["v"] * 23]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    (tmp_path / "a.csv").write_text(text.getvalue())
    got = sorted(tuple(r) for r in read_log_ranges(spark, str(tmp_path)).collect())
    assert got == sorted(map(tuple, rows))
    (tmp_path / "b.csv").write_text('x,y\nopen,"never\nclosed')
    values = {r.value for r in records(text_lines(spark, str(tmp_path / "b.csv"))).collect()}
    assert values == {"x,y", 'open,"never\nclosed'}


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("\n\n")
    assert read_log_ranges(spark, str(tmp_path)).count() == 0


def test_stream_of_ranges(spark, tmp_path, small_ranges):
    """The stream by ranges raises the alerts and counts of the stream by files."""
    found = []
    for kind, reader in (("files", log_stream), ("ranges", log_line_stream)):
        folder, base = tmp_path / "in", str(tmp_path / kind)
        folder.mkdir(exist_ok=True)
        for k in range(3):
            rows = []
            for i in range(9):
                values = dict.fromkeys(LOG_COLUMNS, "v") | {"severity": "Fatal", "bundle_id": "b", "error_message": "two\nlines " * 20, "date": str(1_700_000_000 + i)}
                rows.append([values[c] for c in LOG_COLUMNS])
            rows.append(["v"] * 23 + ["no date"])
            with open(folder / f"{k}.csv", "w", newline="") as file:
                csv.writer(file, lineterminator="\n").writerows(rows)
        stream = AlertStream(base, [SpikeRule(), KeySpikeRule()])
        rows = reader(spark, str(folder), files_per_batch=2)
        query = (stream.start if kind == "files" else stream.start_lines)(rows, f"{base}-checkpoint")
        query.awaitTermination()
        found.append((sorted(map(tuple, stream.alerts(spark).collect()), key=str), stream.counters(spark)))
    assert found[0] == found[1] and found[0][0] and found[0][1]["rows_dropped_invalid_date"] == 3
