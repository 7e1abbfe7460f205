"""Census questions: people are line items, jobs come from the parts they name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import census as c
from tidemark.plans import numbers as n
from tidemark.registry import Tables, query


def _person() -> list:
    return [
        F.when(F.col("l_linestatus") == "F", "Female").otherwise("Male").alias("sex"),
        F.when(F.col("l_returnflag") == "R", c.RICH).otherwise(c.POOR).alias("salary"),
        F.col("l_quantity").alias("age"),
    ]


def people(t: Tables) -> DataFrame:
    return t.lineitem.select(*_person())


def people_with_jobs(t: Tables) -> DataFrame:
    jobs = t.part.select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("race"), F.col("p_type").alias("education"),
        F.col("p_type").alias("marital-status"), F.col("p_brand").alias("native-country"),
        F.col("p_brand").alias("occupation"), F.col("p_size").alias("hours-per-week"),
    )
    return t.lineitem.select("l_partkey", *_person()).join(jobs, "l_partkey")


PEOPLE = """
WITH people AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 'Female' ELSE 'Male' END AS sex,
         CASE WHEN l_returnflag = 'R' THEN '>50K' ELSE '<=50K' END AS salary, l_quantity AS age,
         p_type AS race, p_brand AS country, p_size AS hours
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


def six(name: str):
    """A mean or deviation to six digits, so that the order of addition does not show."""
    return F.round(name, 6).alias(name)


@query("Q23_rows_per_sex", PEOPLE + "SELECT sex, count(*) AS \"count\" FROM people GROUP BY sex ORDER BY 2 DESC, 1")
def q23(t):
    return c.per_sex(people(t))


@query("Q24_mean_age_of_men", PEOPLE + "SELECT round(avg(age), 6) AS mean_age FROM people WHERE sex = 'Male'")
def q24(t):
    return c.mean_age_of(people(t)).select(six("mean_age"))


@query("Q25_share_of_country", PEOPLE + """
SELECT round(avg(CASE WHEN country = 'Brand#1' THEN 1.0::DOUBLE ELSE 0 END), 6) AS share FROM people""")
def q25(t):
    return c.share_of_country(people_with_jobs(t), "Brand#1").select(six("share"))


@query("Q26_age_by_salary", PEOPLE + """
SELECT salary, round(avg(age), 6) AS mean_age, round(stddev_samp(age), 6) AS std_age FROM people GROUP BY salary""")
def q26(t):
    return c.age_by_salary(people(t)).select("salary", six("mean_age"), six("std_age"))


@query("Q27_rich_all_hold", PEOPLE + """
SELECT coalesce(bool_and(coalesce(race IN ('SMALL', 'MEDIUM', 'LARGE', 'ECONOMY', 'PROMO'), false)), true) AS all_hold
FROM people WHERE salary = '>50K'""")
def q27(t):
    return c.rich_all_hold(people_with_jobs(t), ["SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO"])


@query("Q28_describe_age", PEOPLE + """
SELECT race, sex, count(age) AS "count", round(avg(age), 6) AS mean, round(stddev_samp(age), 6) AS std,
       min(age) AS min, quantile_cont(age, 0.25) AS p25, quantile_cont(age, 0.5) AS p50,
       quantile_cont(age, 0.75) AS p75, max(age) AS max
FROM people WHERE race IS NOT NULL AND sex IS NOT NULL GROUP BY race, sex ORDER BY race, sex""")
def q28(t):
    return c.age_by_race_and_sex(people_with_jobs(t), people(t)).withColumns(
        {"mean": F.round("mean", 6), "std": F.round("std", 6)}
    )


@query("Q28_max_age_of_group", PEOPLE + """
SELECT max(age) AS max_age FROM people WHERE race = 'SMALL' AND sex = 'Male'""")
def q28_max(t):
    return c.max_age_of(people_with_jobs(t), "SMALL", "Male")


@query("Q29_rich_share_by_marriage", PEOPLE + """
, shares AS (
  SELECT avg(CASE WHEN salary = '>50K' THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE race IN ('SMALL', 'MEDIUM', 'LARGE')) AS m,
         avg(CASE WHEN salary = '>50K' THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE race NOT IN ('SMALL', 'MEDIUM', 'LARGE')) AS o
  FROM people WHERE sex = 'Male')
SELECT round(m, 6) AS married_share, round(o, 6) AS other_share, m > o AS married_earn_more FROM shares""")
def q29(t):
    return c.rich_share_by_marriage(people_with_jobs(t), married=["SMALL", "MEDIUM", "LARGE"]).select(
        six("married_share"), six("other_share"), "married_earn_more"
    )


@query("Q30_longest_week", PEOPLE + """
SELECT max(hours) AS max_hours, count(*) AS workers,
       round(avg(CASE WHEN salary = '>50K' THEN 1.0::DOUBLE ELSE 0 END), 6) AS rich_share
FROM people WHERE hours = (SELECT max(hours) FROM people)""")
def q30(t):
    return c.longest_week(people_with_jobs(t)).select("max_hours", "workers", six("rich_share"))


@query("Q31_hours_by_country", PEOPLE + """
SELECT country AS "native-country", salary, round(avg(hours), 6) AS mean_hours FROM people GROUP BY country, salary""")
def q31(t):
    return c.hours_by_country(people_with_jobs(t)).select("native-country", "salary", six("mean_hours"))


BANDS = PEOPLE + """
, banded AS (SELECT *, CASE WHEN age BETWEEN 16 AND 35 THEN 'young' WHEN age > 35 AND age <= 70 THEN 'adult'
  WHEN age > 70 AND age <= 100 THEN 'retiree' ELSE 'unknown' END AS "AgeGroup" FROM people)
"""


@query("Q32_age_groups", BANDS + """SELECT age, "AgeGroup", count(*) AS n FROM banded GROUP BY age, "AgeGroup" """)
def q32(t):
    return c.with_age_group(people(t)).groupBy("age", "AgeGroup").agg(F.count(F.lit(1)).alias("n"))


@query("Q33_rich_per_age_group", BANDS + """
SELECT "AgeGroup", count(*) AS size FROM banded WHERE salary = '>50K' GROUP BY "AgeGroup" ORDER BY 1""")
def q33(t):
    return c.rich_per_age_group(people(t))


@query("Q33_richest_age_group", BANDS + """
SELECT "AgeGroup" FROM banded WHERE salary = '>50K' GROUP BY "AgeGroup" ORDER BY count(*) DESC, 1 LIMIT 1""")
def q33_largest(t):
    return c.richest_age_group(people(t))


@query("Q34_group_filter", PEOPLE + """
SELECT country AS occupation, count(*) AS group_size,
       avg(age) <= 25.5 AND bool_and(coalesce(hours > 1, false)) AS passes
FROM people GROUP BY country ORDER BY occupation""")
def q34(t):
    return c.occupations(people_with_jobs(t), 25.5, 1)


# One vector of numbers: the retail prices of the parts.


@query("Q35_mean_minus", "SELECT round(avg(p_retailprice) - 60, 6) AS mean_minus FROM part")
def q35(t):
    return n.mean_minus(t.part, "p_retailprice", 60).select(six("mean_minus"))


@query("Q36_sorted_values", "SELECT p_retailprice FROM part ORDER BY p_retailprice")
def q36(t):
    return n.ascending(t.part, "p_retailprice")


@query("Q37_median_and_percentile", """
SELECT round(median(p_retailprice), 6) AS median, round(quantile_cont(p_retailprice, 0.04), 6) AS percentile FROM part
""")
def q37(t):
    return n.median_and_percentile(t.part, "p_retailprice").select(six("median"), six("percentile"))


@query("Q38_share_above", """
SELECT round(avg(CASE WHEN p_retailprice > 950 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share FROM part""")
def q38(t):
    return n.share_above(t.part, "p_retailprice", 950).select(six("share"))


@query("Q38_deviation", "SELECT round(stddev_pop(p_retailprice), 6) AS std FROM part")
def q38_std(t):
    return n.deviation(t.part, "p_retailprice").select(six("std"))
