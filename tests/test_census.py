import pandas as pd
import pytest

from tests.conftest import rows
from tidemark.plans import census as c
from tidemark.plans import numbers as n
from tidemark.sources.files import read_csv, read_vector

COLUMNS = "age double, education string, `marital-status` string, race string, sex string, `hours-per-week` int, `native-country` string, salary string"


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            (20.0, "Bachelors", "Married-civ-spouse", "A", "Male", 40, "United-States", ">50K"),
            (40.0, None, None, "A", "Male", 60, None, ">50K"),
            (36.0, "Masters", "Divorced", "B", "Female", 60, "France", "<=50K"),
            (71.0, "HS-grad", "Divorced", None, "Male", 20, "France", "<=50K"),
        ],
        COLUMNS,
    )


def test_questions(people):
    assert rows(c.per_sex(people)) == [("Male", 3), ("Female", 1)]
    assert rows(c.mean_age_of(people))[0][0] == pytest.approx(131 / 3)
    assert rows(c.share_of_country(people)) == [(0.25,)]
    assert rows(c.rich_all_hold(people)) == [(False,)]
    assert rows(c.rich_all_hold(people.filter("salary = 'none'"))) == [(True,)]
    assert rows(c.max_age_of(people, "A")) == [(40.0,)]
    assert rows(c.longest_week(people)) == [(60, 2, 0.5)]
    assert rows(c.hours_by_country(people)) == [("France", "<=50K", 40.0), ("United-States", ">50K", 40.0)]
    married, other, more = rows(c.rich_share_by_marriage(people))[0]
    assert (married, other, more) == (1.0, 0.5, True)
    assert rows(c.rich_per_age_group(people)) == [("adult", 1), ("young", 1)]
    assert rows(c.richest_age_group(people)) == [("adult",)]


def test_describe_matches_pandas(spark):
    data = pd.DataFrame({"race": ["A"] * 7 + ["B"], "sex": ["M"] * 8, "age": [1.0, 2, 2, 5, 8, 13, 40, 9]})
    want = data.groupby(["race", "sex"])["age"].describe()
    for buffered in (200_000, 0):
        got = c.describe(spark.createDataFrame(data), "age", ["race", "sex"], buffered_values=buffered).toPandas()
        first = want.iloc[0]
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert got.iloc[0][ours] == pytest.approx(first[theirs])
        assert pd.isna(got.iloc[1]["std"])


def test_age_bands(spark):
    ages = spark.createDataFrame([(a,) for a in (15, 16, 35, 36, 70, 71, 100, 101, None)], "age int")
    assert [r[1] for r in rows(c.with_age_group(ages))] == [
        "unknown", "young", "young", "adult", "adult", "retiree", "retiree", "unknown", "unknown"]


def test_group_filter(spark):
    data = spark.createDataFrame(
        [("Programmer", 25, 40), ("Programmer", 35, 40), ("Teacher", 45, 40), ("Teacher", 50, 40), ("Artist", 22, 4),
         ("Artist", 23, 10)],
        "occupation string, age int, `hours-per-week` int")
    assert rows(c.accepted_occupations(data)) == [("Programmer",)]
    assert [r[1] for r in rows(c.occupations(data))] == [2, 2, 2]


CALORIES = (
    [50.0] * 3 + [70.0] * 2 + [80.0] + [90.0] * 7 + [100.0] * 17 + [110.0] * 29 + [120.0] * 10 + [130.0] * 2
    + [140.0] * 3 + [150.0] * 2 + [160.0]
)


def test_numbers(spark):
    values = spark.createDataFrame([(v,) for v in CALORIES], "val double")
    assert values.count() == 77 and sum(CALORIES) == 8230
    assert rows(n.mean_minus(values, "val", 60))[0][0] == pytest.approx(46.883116883116884)
    assert rows(n.median_and_percentile(values, "val")) == [(110.0, 70.0)]
    assert rows(n.share_above(values, "val", 60))[0][0] == pytest.approx(0.961038961038961)
    assert rows(n.deviation(values, "val"))[0][0] == pytest.approx(19.35718533390827)
    assert [r[0] for r in rows(n.ascending(values, "val"))] == sorted(CALORIES)


def test_vector_file(spark, tmp_path):
    (tmp_path / "v.csv").write_text("70, 120,70 ,50\n")
    assert rows(read_vector(spark, str(tmp_path))) == [(0, 70.0), (1, 120.0), (2, 70.0), (3, 50.0)]


def test_census_file(spark, tmp_path):
    names = "age, workclass, fnlwgt, education, education-num, marital-status, occupation, relationship, race, sex, " \
            "capital-gain, capital-loss, hours-per-week, native-country, salary".replace(" ", "")
    (tmp_path / "a.csv").write_text(
        names + "\n39, State-gov, 77516, Bachelors, 13, Never-married, Adm, Not, White, Male, 2174, 0, 40, NA, <=50K\n")
    got = rows(read_csv(spark, str(tmp_path), c.SCHEMA), "age", "workclass", "native-country", "salary")
    assert got == [(39, "State-gov", None, "<=50K")]
