import json
import os
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tidewater.functions.dates import month_label
from tidewater.sinks import files as out
from tidewater.sinks.routing import routed_items, target_table, write_routed
from tidewater.sources import files as src
from tidewater.sources import jdbc
from tidewater.sources.notifications import created_objects
from tidewater.sources.tables import register_views


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
    return str(path)


def lines(folder, suffix):
    return [line for f in sorted(folder.glob(f"**/part-*{suffix}")) for line in f.read_text("utf-8").splitlines()]


def test_json_sources(spark, tmp_path):
    array = put(tmp_path / "rooms.json", json.dumps([{"id": 1, "name": "Room #1"}, {"id": 2, "name": "é"}], indent=2))
    assert sorted(r.name for r in src.read_json_array(spark, array, "id int, name string").collect()) == ["Room #1", "é"]
    put(tmp_path / "raw/a.json", json.dumps([{"event_id": "e1"}, {"event_id": "e2"}]))
    put(tmp_path / "raw/b.json", json.dumps([{"event_id": "e3"}]))
    events = src.read_json_lines(spark, str(tmp_path / "raw/*.json"), "event_id string")
    assert sorted(r.event_id for r in events.collect()) == ["e1", "e2", "e3"]


def test_csv_sources(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id,when,note\n1,2020-01-02 03:04,"x, ""y"""\n2,2021-01-01 00:00,\n')
    typed = src.read_typed_csv(spark, path, timestamp_format="yyyy-MM-dd HH:mm")
    assert dict(typed.dtypes) == {"id": "int", "when": "timestamp", "note": "string"}
    assert src.read_typed_csv(spark, path, "id bigint, when string, note string").first().note == 'x, "y"'
    staged = src.read_text_csv(spark, path, ["row_id", "order_date", "memo"])
    assert staged.columns == ["row_id", "order_date", "memo"] and staged.count() == 2
    assert {t for _, t in src.read_text_csv(spark, path).dtypes} == {"string"}


def test_encoding_fallback(spark, tmp_path):
    latin = put(tmp_path / "w.csv", "name€\nJosé “€”\n".encode("windows-1252"))
    utf = put(tmp_path / "u.csv", "name\nJosé\n")
    assert src.read_csv_any_encoding(spark, latin).collect()[0].asDict() == {"name€": "José “€”"}
    assert src.read_csv_any_encoding(spark, utf).first().name == "José"


def test_vector(spark, tmp_path):
    path = put(tmp_path / "v.csv", "70, 120, 110 ,-1.5\n")
    assert [r.value for r in src.read_vector(spark, path).orderBy("pos").collect()] == [70, 120, 110, -1.5]


def log_line(fields=24, date="1700000000", severity="Fatal"):
    cells = [f"c{i}" for i in range(fields)]
    cells[2] = severity
    if fields >= 24:
        cells[23] = date
    return ",".join(cells)


def test_log_keeps_short_lines_and_drops_long_ones(spark, tmp_path):
    content = [log_line(), log_line(5), log_line(26), log_line() + ",", log_line() + ",,", log_line().replace("c5", '"a,b"').replace("c6", "")]
    path = put(tmp_path / "log.csv", "\n".join(content) + "\n")
    rows = src.read_log(spark, path).collect()
    assert len(rows) == 3
    assert src.read_log(spark, path).select("severity").count() == 3
    assert len(src.read_log(spark, path).select("severity").collect()) == 3
    assert [r.date for r in rows] == ["1700000000", None, "1700000000"]
    assert rows[2].graphics is None and rows[2].model == "a,b"
    assert src.overlong_log_lines(spark.read.text(path)).count() == 3


def test_empty_probe(spark, tmp_path):
    assert src.is_empty(spark, put(tmp_path / "e.csv", "a,b\n"))
    assert src.is_empty(spark, str(tmp_path / "absent.csv"))
    assert not src.is_empty(spark, put(tmp_path / "f.csv", "a,b\n1,2\n"))


def test_from_objects(spark, tmp_path):
    for name in ("metrics/daily/p.csv", "metrics/_temporary0/q.csv", "other/r.csv"):
        put(tmp_path / name, "a\n1\n")
    read = spark.read.schema("a string").options(**src.DELIMITED).option("recursiveFileLookup", True).csv(str(tmp_path))
    assert [r.source_path.rsplit("/", 1)[1] for r in src.from_objects(read, "metrics/", ".csv").collect()] == ["p.csv"]


def test_jdbc_options():
    split = jdbc.Split("rental_id", "1", "1000000", 64)
    options = jdbc.read_options("jdbc:x:y", "rental", {"user": "u"}, split)
    assert options == {
        "url": "jdbc:x:y", "dbtable": "rental", "user": "u", "partitionColumn": "rental_id", "lowerBound": "1",
        "upperBound": "1000000", "numPartitions": "64",
    }
    assert "numPartitions" not in jdbc.read_options("jdbc:x:y", "actor", {}, None)


def test_views(spark):
    register_views({"numbers": spark.range(4)})
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 4


def s3_event(*keys):
    return {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in keys]}


def test_notifications(spark):
    wrapped = json.dumps({"Message": json.dumps(s3_event("metrics/daily/part+1%3D.csv"))})
    direct = json.dumps(s3_event("metrics/returns/x.csv", "metrics/_temporary/0/y.csv", "metrics/_SUCCESS"))
    messages = spark.createDataFrame([(wrapped,), (direct,), (json.dumps({"Event": "s3:TestEvent"}),)], "body string")
    assert sorted(tuple(r) for r in created_objects(messages).collect()) == [
        ("b", "metrics/daily/part 1=.csv"), ("b", "metrics/returns/x.csv"),
    ]
    with pytest.raises(Exception):
        created_objects(spark.createDataFrame([("not json",)], "body string")).collect()


PATHS = [("a/metrics/daily/x.csv", "DailyMetrics"), ("metrics/departures/x", "DeparturesData"), ("metrics/returns/x", "ReturnsData"), ("raw/x", None)]


def test_routing(spark, tmp_path):
    df = spark.createDataFrame([(p,) for p, _ in PATHS], "p string")
    assert {r.p: r.t for r in df.select("p", target_table(F.col("p")).alias("t")).collect()} == dict(PATHS)
    rows = spark.createDataFrame(
        [("metrics/departures/a.csv", "A", "5", ""), ("metrics/departures/a.csv", None, "6", None), ("metrics/returns/b.csv", "Z", "7", None), ("x", "A", "1", "1")],
        "source_path string, station_dep string, DepCount string, empty string",
    )
    got = sorted(((r.target, r.item) for r in routed_items(rows).collect()), key=str)
    assert got == sorted(
        [
            ("DeparturesData", {"DepCount": "5", "StationName": "A"}),
            ("DeparturesData", {"DepCount": "6", "StationName": "Unknown"}),
            ("ReturnsData", {"station_dep": "Z", "DepCount": "7"}),
        ],
        key=str,
    )
    write_routed(rows, str(tmp_path / "routed"))
    assert len(lines(tmp_path / "routed" / "target=DeparturesData", ".json")) == 2


def test_exports(spark, tmp_path):
    report = spark.createDataFrame([(1, "Room #1", 33.3333), (2, "é", None)], "id int, name string, avg_age double").orderBy("id")
    money = spark.sql("SELECT cast(1.5 AS decimal(5,2)) AS amount")
    out.export_reports({"ages": report, "money": money}, str(tmp_path / "json"), "json")
    assert json.loads(lines(tmp_path / "json/money", ".json")[0]) == {"amount": 1.5}
    out.export_reports({"ages": report.coalesce(1)}, str(tmp_path / "xml"), "xml")
    file = next((tmp_path / "xml/ages").glob("part-*"))
    root = ET.fromstring(file.read_text("utf-8"))
    assert root.tag == "ages" and [i.find("name").text for i in root.findall("item")] == ["Room #1", "é"]
    with pytest.raises(ValueError, match="yaml"):
        out.exporter("yaml")


def test_combined_document(spark, tmp_path):
    report = spark.createDataFrame([(1, None)], "id int, age double")
    out.combined_json({"a": report, "b": report.limit(0)}, str(tmp_path / "doc"))
    assert json.loads("".join(lines(tmp_path / "doc", ".txt"))) == {"a": [{"id": 1, "age": None}], "b": []}
    ordered = spark.range(3000).repartition(7).orderBy(F.desc("id"))
    out.combined_json({"a": ordered}, str(tmp_path / "ordered"))
    document = json.loads("".join(lines(tmp_path / "ordered", ".txt")))
    assert [r["id"] for r in document["a"]] == list(range(2999, -1, -1))
    many = spark.range(0, 150_000, 1, 5)
    out.combined_json({"none": many.limit(0), "all": many, "again": report}, str(tmp_path / "many"))
    document = json.loads("".join(lines(tmp_path / "many", ".txt")))
    assert [r["id"] for r in document["all"]] == list(range(150_000)) and document["none"] == [] and len(document["again"]) == 1


def test_parts_are_the_document_until_they_are_joined(spark, tmp_path, monkeypatch):
    """Rows pass this process in the call that joins parts only; the joined file is the document."""
    monkeypatch.setattr(out, "_parts", lambda *_: pytest.fail("rows went through the driver"))
    report = spark.range(0, 5000, 1, 6).select("id", F.lit(None).cast("string").alias("nothing"))
    out.combined_json({"a": report, "b": report.limit(1)}, str(tmp_path / "doc"))
    monkeypatch.undo()
    parts = sorted(f for f in os.listdir(tmp_path / "doc") if f.startswith("part-"))
    text = "".join((tmp_path / "doc" / f).read_text() for f in parts)
    assert [r["id"] for r in json.loads(text)["a"]] == list(range(5000)) and json.loads(text)["b"] == [{"id": 0, "nothing": None}]
    out.join_parts(spark, str(tmp_path / "doc"), str(tmp_path / "one.json"))
    assert (tmp_path / "one.json").read_text() == text


def test_combined_xml_has_the_report_shape(spark, tmp_path):
    gaps = spark.createDataFrame([(213, "Room #213", 115), (83, "Room <83>", 115)], "id int, name string, age_diff int")
    out.combined_xml({"rooms_max_age_diff": gaps, "rooms_mixed_gender": gaps.select("id")}, str(tmp_path / "x"))
    root = ET.fromstring("\n".join(lines(tmp_path / "x", ".txt")))
    assert root.tag == "student_analysis" and [e.tag for e in root] == ["rooms_max_age_diff", "rooms_mixed_gender"]
    items = root.find("rooms_max_age_diff").findall("item")
    assert [{c.tag: c.text for c in i} for i in items] == [
        {"id": "213", "name": "Room #213", "age_diff": "115"}, {"id": "83", "name": "Room <83>", "age_diff": "115"},
    ]
    out.combined_xml({"a": spark.range(0, 120_000, 1, 3)}, str(tmp_path / "many"))
    assert len(ET.fromstring("\n".join(lines(tmp_path / "many", ".txt"))).find("a")) == 120_000


def test_shared_folder_is_the_sessions(spark, monkeypatch):
    from types import SimpleNamespace

    from tidewater.session import shared_folder

    def session(master, folder):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        conf = SimpleNamespace(get=lambda *_: folder, set=lambda *_: None)
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert shared_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        shared_folder(session("yarn", None))
    assert "tidewater-" in shared_folder(session("local[2]", None))


def test_csv_and_monthly_split(spark, tmp_path):
    rows = spark.createDataFrame([("2020-05-01 10:00", 1), ("2020-05-31 23:59", 2), ("2020-06-01 00:00", 3)], "`Departure time` string, data int")
    out.split_by_month(rows, F.to_timestamp("Departure time"), str(tmp_path / "months"))
    folders = sorted(p.name for p in (tmp_path / "months").glob("month=*"))
    assert folders == ["month=2020-05", "month=2020-06"]
    may = src.read_text_csv(spark, str(tmp_path / "months/month=2020-05"))
    assert may.columns == ["Departure time", "data"] and may.count() == 2
    out.write_csv(rows, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    assert rows.select(month_label(F.to_timestamp("Departure time"))).distinct().count() == 2


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    out.write_documents(df, str(tmp_path / "docs"))
    assert sorted(lines(tmp_path / "docs", ".txt")) == ['{"id":1,"t":"a"}', '{"id":2}']
    folder = tmp_path / "sent"
    folder.mkdir()

    def insert_many(batch):
        import os
        import uuid

        with open(os.path.join(str(folder), uuid.uuid4().hex), "w") as f:
            f.write("\n".join(batch))

    out.insert_documents(spark.range(25).coalesce(1), insert_many, batch=10)
    assert sorted(len(f.read_text().splitlines()) for f in folder.iterdir()) == [5, 10, 10]


def test_log_records(spark, tmp_path):
    """Long quoted fields, line breaks and commas in quotes, long and short records, blank lines."""
    width = len(src.LOG_COLUMNS)
    long = "x" * 100_000 + '""' + "y,\n" * 1000
    records = [
        ["1", f'"{long}"', "Fatal", *[""] * (width - 4), "10"], ["2", '"a\nb, ""c"""', "Error", *[""] * (width - 4), "20"],
        ["3", "short"], ["4", *["z"] * width], ["5", *[""] * width], [" "], [""],
    ]
    (tmp_path / "log.csv").write_text("".join(",".join(r) + "\n" for r in records))
    rows = src.read_log(spark, str(tmp_path / "log.csv")).collect()
    assert [r.error_code for r in rows] == ["1", "2", "3"]
    assert rows[0].error_message == long.replace('""', '"') and rows[0].date == "10"
    assert rows[1].error_message == 'a\nb, "c"' and rows[2].severity is None
    line = spark.createDataFrame([(f'1,"{"x" * 100_000}","a ""b"", c",' + "," * (width - 4) + "9",)], "value string")
    assert src.parse_log(line).first().date == "9" and src.overlong_log_lines(line).count() == 0
