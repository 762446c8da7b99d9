"""Room reports over rooms(id, name) and students(id, name, birthday, sex, room_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import whole_years
from tidewater.operators.joins import children_counted, rollup_to
from tidewater.operators.ranking import top_rows
from tidewater.operators.statistics import more_than_one
from tidewater.operators.warehouse import Load, fk_load, insert_ignore

ROOM_SCHEMA = "id int, name string"
STUDENT_SCHEMA = "id int, name string, birthday date, sex string, room int"


def load_rooms(rooms: DataFrame, batch: DataFrame) -> Load:
    return insert_ignore(rooms, batch, ["id"], ["name"])


def load_students(students: DataFrame, batch: DataFrame, rooms: DataFrame) -> Load:
    """Students of known rooms or of none; a bad sex is turned away."""
    named = batch.withColumnRenamed("room", "room_id")
    valid = F.col("sex").isin("M", "F") & F.col("name").isNotNull() & F.col("birthday").isNotNull()
    load = fk_load(students, named.filter(valid), ["id"], rooms, "room_id", "id", ["name", "birthday", "room_id", "sex"])
    return Load(load.inserted, load.rejected.unionByName(named.filter(~F.coalesce(valid, F.lit(False)))))


def student_counts(rooms: DataFrame, students: DataFrame) -> DataFrame:
    counted = children_counted(rooms, "id", students, "room_id", "students_count")
    return counted.select("id", "name", "students_count").orderBy("id")


def student_counts_by_name(rooms: DataFrame, students: DataFrame) -> DataFrame:
    """The same with rooms of one name taken together."""
    return student_counts(rooms, students).groupBy("name").agg(F.sum("students_count").alias("students_count"))


def _ages(rooms: DataFrame, students: DataFrame, name: str, measure: Column) -> DataFrame:
    return rollup_to(students, "room_id", {name: measure}, rooms, "id").select("id", "name", name)


def youngest_rooms(rooms: DataFrame, students: DataFrame, as_of: Column, limit: int = 5) -> DataFrame:
    """Rooms with the lowest average age in whole years, to four decimals."""
    aged = _ages(rooms, students, "avg_age", F.round(F.avg(whole_years(F.col("birthday"), as_of)), 4))
    return top_rows(aged, limit, F.col("avg_age"), F.col("id"))


def widest_age_gaps(rooms: DataFrame, students: DataFrame, as_of: Column, limit: int = 5) -> DataFrame:
    age = whole_years(F.col("birthday"), as_of)
    aged = _ages(rooms, students, "age_diff", F.max(age) - F.min(age))
    return top_rows(aged, limit, F.desc("age_diff"), F.col("id"))


def mixed_rooms(rooms: DataFrame, students: DataFrame) -> DataFrame:
    mixed = rollup_to(students, "room_id", {"_mixed": more_than_one("sex")}, rooms, "id")
    return mixed.filter("_mixed").select("id", "name").orderBy("id")


def all_reports(rooms: DataFrame, students: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Every report by name, ready for an exporter."""
    return {
        "rooms_student_count": student_counts(rooms, students),
        "rooms_min_avg_age": youngest_rooms(rooms, students, as_of),
        "rooms_max_age_diff": widest_age_gaps(rooms, students, as_of),
        "rooms_mixed_gender": mixed_rooms(rooms, students),
    }
