import math

import pytest
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.functions import dist
from panelspark.sources import literal_table, read_delimited, schemas


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, minutes",
    [("12:30", 12.5), ("0:06", 0.1), ("63:00", 63.0), ("", None), (None, None), ("7", None), ("a:b", None), ("1:2:3", None)],
)
def test_duration(spark, text, minutes):
    got = one(spark, text, "string", C.duration_minutes("x"))
    assert got == (None if minutes is None else pytest.approx(minutes))


def test_null_rules(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", None), ("b", None), ("c", 2.0), ("c", 3.0)], "g string, x double"
    )
    got = {
        r["g"]: (r["strict"], r["loose"], r["mean"])
        for r in df.groupBy("g")
        .agg(C.strict_sum("x").alias("strict"), C.sum_or_zero("x").alias("loose"), C.strict_mean("x").alias("mean"))
        .collect()
    }
    assert got == {"a": (None, 1.0, None), "b": (None, 0.0, None), "c": (5.0, 5.0, 2.5)}


def test_conditional_keeps_null(spark):
    for value, expected in ((1, "yes"), (0, "no"), (None, None)):
        assert one(spark, value, "int", C.conditional(F.col("x") == 1, F.lit("yes"), F.lit("no"))) == expected


def test_ratios(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 0.0), (3.0, 4.0), (None, 4.0)], "a double, b double")
    rows = df.select(C.safe_pct("a", "b").alias("p"), C.per_unit("a", "b").alias("u")).collect()
    assert [r["p"] for r in rows] == [0.0, 0.0, 75.0, 0.0]
    assert [r["u"] for r in rows] == [None, None, 7.5, None]


def test_strings(spark):
    assert one(spark, "A//B/*", "string", C.strip_slashes("x")) == "AB*"
    assert one(spark, "Name**", "string", C.strip_suffix("x")) == "Name"
    assert one(spark, "a*b", "string", C.strip_suffix("x")) == "a*b"
    assert one(spark, "q", "string", C.recode("x", {"p": "r"})) == "q"
    assert one(spark, "p", "string", C.recode("x", {"p": "r"})) == "r"
    assert one(spark, None, "string", C.recode("x", {"p": "r"})) is None


def test_row_sums(spark):
    assert one(spark, [1, 0, 1], "array<int>", C.row_sum(array="x")) == 2


def test_columns_between(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert C.cols_between(df, "b", "d") == ["b", "c", "d"]
    with pytest.raises(ValueError):
        C.cols_between(df, "c", "a")


def test_delimited_dimension(spark, tmp_path):
    header = ",".join(schemas.TEAMS.names)
    rows = [
        "00,1,1949,2019,ATL,Hawks,1949,Atlanta,State Farm Arena,18729,O'Brien (Jr),G,C,D",
        "00,2,1946,2019,NOP,Pelicans,2002,New Orleans,Center,,Owner,G,C,No Affiliate",
        '00,3,1946,2019,BKN,Nets,1976,"Brooklyn, NY",Barclays,0,Owner,G,C,Long Island',
    ]
    path = tmp_path / "teams.csv"
    path.write_text("\n".join([header, *rows]) + "\n")
    got = read_delimited(spark, str(path), schemas.TEAMS).orderBy("TEAM_ID").collect()
    assert [r["ARENACAPACITY"] for r in got] == [18729, None, 0]
    assert got[0]["LEAGUE_ID"] == "00" and got[0]["OWNER"] == "O'Brien (Jr)" and got[2]["CITY"] == "Brooklyn, NY"
    assert read_delimited(spark, str(path), schemas.TEAMS, F.col("ARENACAPACITY") > 0).count() == 1


def test_columns_are_found_by_header_name(spark, tmp_path):
    path = tmp_path / "teams.csv"
    header = ["", "extra", *reversed(schemas.TEAMS.names), "extra"]
    row = ["1", "x", "Long Island", "C", "G", "", "18729", "Arena", "City", "1949", "Nets", "BKN", "2019", "1946", "7", "00", "y"]
    path.write_text(",".join(header) + "\n" + ",".join(row) + "\n")
    got = read_delimited(spark, str(path), schemas.TEAMS).collect()
    assert len(got) == 1 and got[0].asDict() == {
        "LEAGUE_ID": "00", "TEAM_ID": 7, "MIN_YEAR": 1946, "MAX_YEAR": 2019, "ABBREVIATION": "BKN", "NICKNAME": "Nets",
        "YEARFOUNDED": 1949, "CITY": "City", "ARENA": "Arena", "ARENACAPACITY": 18729, "OWNER": None, "GENERALMANAGER": "G",
        "HEADCOACH": "C", "DLEAGUEAFFILIATION": "Long Island",
    }
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="LEAGUE_ID"):
        read_delimited(spark, str(path), schemas.TEAMS)


def test_literal_table(spark):
    assert literal_table(spark, {"a": [1, 2], "b": ["x", "y"]}, "a int, b string").count() == 2
    with pytest.raises(ValueError):
        literal_table(spark, {"a": [1], "b": ["x", "y"]}, "a int, b string")


def test_distributions():
    assert dist.t_ppf(0.975, 10) == pytest.approx(2.2281388519649385, rel=1e-10)
    assert dist.t_sf(2.0, 5) == pytest.approx(0.05096973941492917, rel=1e-10)
    assert dist.t_ppf(0.975, 1e7) == pytest.approx(dist.normal_ppf(0.975), rel=1e-6)
    assert dist.f_sf(4.0, 1, 10) == pytest.approx(2 * dist.t_sf(2.0, 10), rel=1e-10)
    assert dist.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert dist.chi2_sf(10.0, 2) == pytest.approx(math.exp(-5), rel=1e-10)
    assert dist.chi2_sf(30.0, 4) == pytest.approx(math.exp(-15) * 16, rel=1e-9)
    # far tails keep their digits in logs
    assert dist.log_normal_sf(40.0) == pytest.approx(-804.608442, abs=1e-5)
    assert dist.log_normal_sf(29.999999) == pytest.approx(dist.log_normal_sf(30.000001), rel=1e-6)
    assert dist.log_normal_between(38.0, 39.0) == pytest.approx(dist.log_normal_sf(38.0), abs=1e-9)
    assert dist.log_normal_between(-1.0, 1.0) == pytest.approx(math.log(0.6826894921370859), rel=1e-12)
    assert dist.log_choose(10, 3) == pytest.approx(math.log(120))
