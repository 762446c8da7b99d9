"""Census questions over age, sex, race, education, marital-status, occupation, hours-per-week, native-country, salary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import percent_text
from tidewater.operators import statistics as st

# Salary classes, age bins, degrees
RICH, POOR = ">50K", "<=50K"
AGE_EDGES, AGE_LABELS = (16, 35, 70, 100), ("young", "adult", "retiree")
HIGHER = ("Bachelors", "Prof-school", "Assoc-acdm", "Assoc-voc", "Masters", "Doctorate")


def by_sex(people: DataFrame) -> DataFrame:
    return st.value_counts(people, "sex")


def mean_age(people: DataFrame, sex: str = "Male") -> DataFrame:
    return people.filter(F.col("sex") == sex).agg(F.avg("age").alias("mean_age"))


def share_of_country(people: DataFrame, country: str = "United-States") -> DataFrame:
    share = F.count_if(F.col("native-country") == country) / F.count("*") * 100
    return people.agg(share.alias("share"), percent_text(share).alias("share_text"))


def age_by_salary(people: DataFrame) -> DataFrame:
    return people.filter(F.col("salary").isin(RICH, POOR)).groupBy("salary").agg(
        F.avg("age").alias("mean_age"), F.stddev_samp("age").alias("std_age")
    )


def rich_without_degree(people: DataFrame) -> DataFrame:
    """Education of those who earn much without higher education; no row means all have it."""
    rich = people.filter(F.col("salary") == RICH)
    return st.value_counts(rich.filter(st.not_in_values("education", HIGHER)), "education")


def age_statistics(people: DataFrame) -> DataFrame:
    return st.describe(people, "age", ["race", "sex"])


def rich_share_by_marriage(people: DataFrame, sex: str = "Male") -> DataFrame:
    """Share of high earners among the married (any 'Married...') and the single."""
    status = F.when(F.col("marital-status").startswith("Married"), "married").otherwise("single")
    shares = st.share_in_group(people.filter(F.col("sex") == sex).withColumn("status", status), "status", "salary", [RICH])
    return shares.select("status", "share")


def hardest_working(people: DataFrame) -> DataFrame:
    return st.at_maximum(people, "hours-per-week", F.col("salary") == RICH)


def hours_by_country(people: DataFrame) -> DataFrame:
    keyed = people.filter(F.col("native-country").isNotNull() & F.col("salary").isNotNull())
    return keyed.groupBy("native-country", "salary").agg(F.avg("hours-per-week").alias("mean_hours"))


def with_age_group(people: DataFrame) -> DataFrame:
    return people.withColumn("AgeGroup", st.right_closed_bin(F.col("age"), AGE_EDGES, AGE_LABELS))


def rich_by_age_group(people: DataFrame) -> DataFrame:
    return st.bin_counts(people.filter(F.col("salary") == RICH), "age", AGE_EDGES, AGE_LABELS)


def richest_age_group(people: DataFrame) -> DataFrame:
    return st.best_bin(people.filter(F.col("salary") == RICH), "age", AGE_EDGES, AGE_LABELS)


def occupation_sizes(people: DataFrame) -> DataFrame:
    return st.value_counts(people, "occupation")


def young_busy_occupations(people: DataFrame) -> DataFrame:
    """Occupations of mean age up to 40 where everyone works more than 5 hours."""
    return st.groups_where(people, ["occupation"], (F.avg("age") <= 40) & (F.min("hours-per-week") > 5))
