"""The test tables read as arrests, jurisdictions, populations and fixed-width records.

One order is one arrest; its customer gives the person and the place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tabledef import TableDef

ARREST_RECORD = TableDef.of(
    "arrest",
    [
        ("ncic_jurisdiction", 1, 4, "character(4)"),
        ("arrest_year", 6, 4, "smallint"),
        ("arrest_month", 10, 2, "smallint"),
        ("arrest_day", 12, 2, "smallint"),
        ("offense_level", 14, 1, "'F' = felony; 'O' = other; 'P' = petty"),
        ("bcs_offense_code", 15, 3, "smallint"),
        ("race", 18, 10, "character(10)"),
        ("age", 28, 3, "smallint"),
    ],
    32,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arrests(spark: SparkSession, d: str) -> DataFrame:
    people = read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    rows = read(spark, d, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("o_orderkey").alias("db_id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("ncic_jurisdiction"),
        F.col("o_orderstatus").alias("offense_level"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("offense_code"),
        F.col("o_orderpriority").alias("summary_code"),
        F.when(F.col("o_orderkey") % 5 < 3, "booked").otherwise("cited").alias("status_type"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("race"),
        F.when(F.col("c_custkey") % 3 == 0, "female").when(F.col("c_custkey") % 17 != 0, "male").alias("gender"),
        F.nullif(F.floor((F.col("c_acctbal") + 1000) / 130).cast("int"), F.lit(40)).alias("age"),
        F.col("o_totalprice").alias("amount"),
        F.col("c_custkey").alias("person"),
    )


ARRESTS = """arrests AS (
    SELECT o_orderkey AS db_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
           lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS ncic_jurisdiction, o_orderstatus AS offense_level,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS offense_code, o_orderpriority AS summary_code,
           CASE WHEN o_orderkey % 5 < 3 THEN 'booked' ELSE 'cited' END AS status_type, nullif(c_mktsegment, 'MACHINERY') AS race,
           CASE WHEN c_custkey % 3 = 0 THEN 'female' WHEN c_custkey % 17 <> 0 THEN 'male' END AS gender,
           nullif(CAST(floor((c_acctbal + 1000) / 130) AS INTEGER), 40) AS age, o_totalprice AS amount, c_custkey AS person
    FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def jurisdictions(spark: SparkSession, d: str) -> DataFrame:
    """Without nation 7, so that some arrests have no county."""
    nation, region = read(spark, d, "nation"), read(spark, d, "region")
    rows = nation.filter("n_nationkey <> 7").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("ncic_jurisdiction"), F.col("r_name").alias("county"))


JURISDICTIONS = """jurisdictions AS (
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS ncic_jurisdiction, r_name AS county
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7
)"""


def people(spark: SparkSession, d: str) -> DataFrame:
    """Population by year, county, race, gender and age group, Juvenile and Adult among the bands."""
    from ..functions.recode import age_class, population_band
    from ..operators.aggregates import overlapping

    nation, region = read(spark, d, "nation"), read(spark, d, "region")
    rows = read(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    age = F.floor((F.col("c_acctbal") + 1000) / 130).cast("int")
    rows = rows.select(F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"), F.col("r_name").alias("county"), F.col("c_mktsegment").alias("race"), F.when(F.col("c_custkey") % 3 == 0, "female").otherwise("male").alias("gender"), age.alias("age"), (F.col("c_custkey") % 90 + 10).alias("population"))
    banded = overlapping(rows, [population_band(F.col("age")), age_class(F.col("age"))], "age_group")
    return banded.groupBy("year", "county", "race", "gender", "age_group").agg(F.sum("population").alias("population"))


BAND = "CASE " + " ".join(f"WHEN age <= {last} THEN '{name}'" for last, name in [(9, "0-9"), (14, "10-14"), (17, "15-17"), (24, "18-24"), (29, "25-29"), (39, "30-39"), (49, "40-49"), (59, "50-59")]) + " ELSE '60+' END"
PEOPLE = f"""persons AS (
    SELECT CAST(y AS INTEGER) AS year, r_name AS county, c_mktsegment AS race, CASE WHEN c_custkey % 3 = 0 THEN 'female' ELSE 'male' END AS gender,
           CAST(floor((c_acctbal + 1000) / 130) AS INTEGER) AS age, c_custkey % 90 + 10 AS population
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, generate_series(1995, 2001) t(y)
), people AS (
    SELECT year, county, race, gender, age_group, CAST(sum(population) AS BIGINT) AS population FROM (
        SELECT year, county, race, gender, {BAND} AS age_group, population FROM persons
        UNION ALL SELECT year, county, race, gender, CASE WHEN age < 18 THEN 'Juvenile' ELSE 'Adult' END, population FROM persons)
    GROUP BY ALL
)"""


def demographics(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.aggregates import halved_total
    from .summaries import population_cube

    return halved_total(population_cube(people(spark, d)), "age_group", "population")


DEMOGRAPHICS = PEOPLE + """, demographics AS (
    SELECT year, coalesce(county, 'All Combined') AS county, coalesce(race, 'All Combined') AS race, coalesce(gender, 'All Combined') AS gender,
           coalesce(age_group, 'All Combined') AS age_group,
           CAST(CASE WHEN age_group IS NULL THEN floor(sum(population) / 2) ELSE sum(population) END AS BIGINT) AS population
    FROM people GROUP BY year, CUBE(county, race, gender, age_group)
)"""


def records(spark: SparkSession, d: str) -> DataFrame:
    """The arrests as fixed-width records of one file, some of whose fields are odd."""
    rows = arrests(spark, d).select(
        "ncic_jurisdiction",
        F.col("year").alias("arrest_year"),
        F.when(F.col("db_id") % 101 == 0, 2).otherwise(F.col("month")).alias("arrest_month"),
        F.when(F.col("db_id") % 101 == 0, 30).otherwise(F.col("day")).alias("arrest_day"),
        "offense_level",
        F.when(F.col("db_id") % 13 == 0, F.lit(None).cast("int")).otherwise(F.col("offense_code")).alias("bcs_offense_code"),
        "race",
        "age",
        "db_id",
    )
    made = rows.select("db_id", ARREST_RECORD.format(rows).alias("record"))
    odd = F.when(F.col("db_id") % 97 == 0, F.overlay("record", F.lit("1A "), 15, 3)).when(F.col("db_id") % 89 == 0, F.overlay("record", F.lit("A  "), 15, 3)).otherwise(F.col("record"))
    return made.select(F.lit("orders").alias("file"), F.col("db_id").alias("recno"), odd.alias("record"))


RECORDS = ARRESTS + """, records AS (
    SELECT db_id AS recno, ncic_jurisdiction, year AS arrest_year, CASE WHEN db_id % 101 = 0 THEN 2 ELSE month END AS arrest_month,
           CASE WHEN db_id % 101 = 0 THEN 30 ELSE day END AS arrest_day, offense_level, race, age,
           CASE WHEN db_id % 97 = 0 THEN '1A ' WHEN db_id % 89 = 0 THEN 'A  ' WHEN db_id % 13 = 0 THEN '   ' ELSE lpad(CAST(offense_code AS VARCHAR), 3, '0') END AS code_text
    FROM arrests
)"""


def line_years(spark: SparkSession, d: str) -> DataFrame:
    """Lines by brand, type and year."""
    part = read(spark, d, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").alias("size"))
    lines = read(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.select("l_partkey", "brand", "type", "size", F.year("l_shipdate").alias("year"), "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")


LINE_YEARS = """line_years AS (
    SELECT l_partkey, p_brand AS brand, p_type AS type, p_size AS size, CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, l_linestatus, l_quantity, l_extendedprice
    FROM lineitem JOIN part ON l_partkey = p_partkey
)"""
