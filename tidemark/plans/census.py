"""Questions on the census income table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import above_up_to, holds_for_all, in_list, is_true, share
from tidemark.operators.ranking import largest_group, value_counts
from tidemark.operators.stats import describe, group_mean, groups_where

# Column types of the input, and the values the questions name.
SCHEMA = (
    "`age` int, `workclass` string, `fnlwgt` long, `education` string, `education-num` int, "
    "`marital-status` string, `occupation` string, `relationship` string, `race` string, `sex` string, "
    "`capital-gain` int, `capital-loss` int, `hours-per-week` int, `native-country` string, `salary` string"
)
HIGHER_DEGREES = ["Bachelors", "Prof-school", "Assoc-acdm", "Assoc-voc", "Masters", "Doctorate"]
MARRIED = ["Married-civ-spouse", "Married-spouse-absent", "Married-AF-spouse"]
RICH = ">50K"
POOR = "<=50K"


def per_sex(df: DataFrame) -> DataFrame:
    return value_counts(df, "sex")


def mean_age_of(df: DataFrame, sex: str = "Male") -> DataFrame:
    return df.filter(F.col("sex") == sex).agg(F.avg("age").alias("mean_age"))


def share_of_country(df: DataFrame, country: str = "United-States") -> DataFrame:
    return df.agg(share(F.col("native-country") == country).alias("share"))


def age_by_salary(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the age in the two salary classes."""
    return (
        df.filter(in_list(F.col("salary"), [POOR, RICH])).groupBy("salary")
        .agg(F.avg("age").alias("mean_age"), F.stddev_samp("age").alias("std_age"))
        .orderBy("salary")
    )


def rich_all_hold(df: DataFrame, degrees: list[str] = HIGHER_DEGREES) -> DataFrame:
    """Whether everyone in the upper class holds one of the degrees."""
    return df.filter(F.col("salary") == RICH).agg(
        holds_for_all(in_list(F.col("education"), degrees)).alias("all_hold")
    )


def age_by_race_and_sex(df: DataFrame, ages_from: DataFrame | None = None) -> DataFrame:
    return describe(df, "age", ["race", "sex"], values_from=ages_from)


def max_age_of(df: DataFrame, race: str = "Asian-Pac-Islander", sex: str = "Male") -> DataFrame:
    return df.filter((F.col("race") == race) & (F.col("sex") == sex)).agg(F.max("age").alias("max_age"))


def rich_share_by_marriage(df: DataFrame, sex: str = "Male", married: list[str] = MARRIED) -> DataFrame:
    """Share of the upper class among married and other men, in one pass; unknown counts as other."""
    wed = in_list(F.col("marital-status"), married)
    rich = is_true(F.col("salary") == RICH).cast("double")
    return (
        df.filter(F.col("sex") == sex)
        .agg(F.avg(F.when(wed, rich)).alias("married_share"), F.avg(F.when(~wed, rich)).alias("other_share"))
        .withColumn("married_earn_more", is_true(F.col("married_share") > F.col("other_share")))
    )


def longest_week(df: DataFrame) -> DataFrame:
    """The longest working week, how many work it, and the share of the upper class among them.

    One aggregate per value of the hours; the largest value is the answer.
    """
    return (
        df.filter(F.col("hours-per-week").isNotNull())
        .groupBy(F.col("hours-per-week").alias("max_hours"))
        .agg(F.count(F.lit(1)).alias("workers"), share(F.col("salary") == RICH).alias("rich_share"))
        .orderBy(F.desc("max_hours"))
        .limit(1)
    )


def hours_by_country(df: DataFrame) -> DataFrame:
    return group_mean(df, ["native-country", "salary"], "hours-per-week", "mean_hours").orderBy(
        "native-country", "salary"
    )


def with_age_group(df: DataFrame, age: str = "age") -> DataFrame:
    a = F.col(age)
    band = (
        F.when(a.between(16, 35), "young")
        .when(above_up_to(a, 35, 70), "adult")
        .when(above_up_to(a, 70, 100), "retiree")
        .otherwise("unknown")
    )
    return df.withColumn("AgeGroup", band)


def rich_per_age_group(df: DataFrame) -> DataFrame:
    return (
        with_age_group(df).filter(F.col("salary") == RICH)
        .groupBy("AgeGroup").agg(F.count(F.lit(1)).alias("size")).orderBy("AgeGroup")
    )


def richest_age_group(df: DataFrame) -> DataFrame:
    return largest_group(rich_per_age_group(df), "AgeGroup", "size").select("AgeGroup")


def occupations(df: DataFrame, oldest=40, least_hours=5) -> DataFrame:
    """Group sizes, and whether the mean age is at most ``oldest`` and everyone works more than ``least_hours``."""
    return groups_where(df, "occupation", "age", oldest, "hours-per-week", least_hours).orderBy("occupation")


def accepted_occupations(df: DataFrame) -> DataFrame:
    return occupations(df).filter("passes").select("occupation")
