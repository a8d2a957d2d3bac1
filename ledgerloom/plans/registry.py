"""The library's queries on the test tables, and the SQL that each must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import checkpoint_dir, cut
from ..functions import dates, parsing, predicates, recode
from ..operators import aggregates, joins, local_fit, profile, reshape, risk, sequences, stats, suppress
from ..sources import fixed_width, manifest, record_files
from . import cleaning, release, standins, summaries
from .standins import ARRESTS, DEMOGRAPHICS, JURISDICTIONS, LINE_YEARS, RECORDS, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
ALL = aggregates.ALL


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


# --- summaries -------------------------------------------------------------------------

OFFENSE = ["offense_level", "offense_code", "summary_code", "status_type"]
SUMMARY = f"""{ARRESTS}, {JURISDICTIONS}, summary AS (
    SELECT year, a.ncic_jurisdiction, county, offense_level, offense_code, summary_code, status_type, race, gender, age_group, arrests FROM (
        SELECT year, ncic_jurisdiction, offense_level, offense_code, summary_code, status_type, race, gender,
               CASE WHEN age < 18 THEN 'Juvenile' ELSE 'Adult' END AS age_group, count(*) AS arrests
        FROM arrests GROUP BY ALL) a
    LEFT JOIN jurisdictions j ON a.ncic_jurisdiction = j.ncic_jurisdiction
)"""
OFFENSES = f"""{ARRESTS}, {JURISDICTIONS}, offenses AS (
    SELECT a.*, county FROM (SELECT year, ncic_jurisdiction, offense_level, offense_code, summary_code, status_type, race, count(*) AS total FROM arrests GROUP BY ALL) a
    LEFT JOIN jurisdictions j ON a.ncic_jurisdiction = j.ncic_jurisdiction
)"""
SHARES = f"""{DEMOGRAPHICS}, shares AS (
    SELECT t.year, t.county, d.race, d.population, 100.0 * CAST(d.population AS DOUBLE) / t.top AS percentage
    FROM (SELECT year, county, max(population) AS top FROM demographics WHERE gender = 'All Combined' AND age_group = 'All Combined' GROUP BY ALL) t
    LEFT JOIN (SELECT year, county, race, population FROM demographics WHERE gender = 'All Combined' AND age_group = 'All Combined') d
    ON t.year = d.year AND t.county = d.county
)"""


def _cube_sql() -> str:
    """Every total as a query of its own, joined by UNION."""
    parts = []
    for place in (True, False):
        for n in range(4):
            for kept in combinations(["race", "gender", "age_group"], n):
                group = ["year", *OFFENSE, *(["ncic_jurisdiction", "county"] if place else []), *kept]
                show = [c if c in group else f"'{ALL}' AS {c}" for c in ["year", *OFFENSE, "race", "gender", "age_group", "ncic_jurisdiction", "county"]]
                parts.append(f"SELECT {', '.join(show)}, CAST(sum(arrests) AS BIGINT) AS arrests FROM summary GROUP BY {', '.join(group)}")
    return f"WITH {SUMMARY} " + " UNION ".join(parts)


def _summary(spark: SparkSession, d: str) -> DataFrame:
    return summaries.arrest_summary(standins.arrests(spark, d), standins.jurisdictions(spark, d))


def _offenses(spark: SparkSession, d: str) -> DataFrame:
    return summaries.year_jurisdiction_offense(standins.arrests(spark, d), standins.jurisdictions(spark, d))


def _shares(spark: SparkSession, d: str) -> DataFrame:
    return summaries.year_county_race(cut(standins.demographics(spark, d)))  # read twice


@query("int_summary", f"WITH {SUMMARY} SELECT * FROM summary")
def int_summary(spark, d):
    return _summary(spark, d)


@query("arrest_cube", _cube_sql())
def arrest_cube(spark, d):
    return summaries.arrest_cube(_summary(spark, d))


@query("year_jurisdiction", f"WITH {OFFENSES} SELECT * FROM offenses")
def year_jurisdiction(spark, d):
    return _offenses(spark, d)


@query("census_cube_halved", f"WITH {DEMOGRAPHICS} SELECT * FROM demographics")
def census_cube_halved(spark, d):
    return standins.demographics(spark, d)


@query("year_county_share", f"WITH {SHARES} SELECT year, county, race, population, round(percentage, 6) AS percentage FROM shares")
def year_county_share(spark, d):
    return _shares(spark, d).withColumn("percentage", F.round("percentage", 6))


@query(
    "demographic_share",
    f"""WITH {DEMOGRAPHICS} SELECT t.year, t.county, d.race, d.gender, d.age_group, d.population, round(100.0 * CAST(d.population AS DOUBLE) / t.top, 6) AS percentage
    FROM (SELECT year, county, max(population) AS top FROM demographics WHERE gender = 'All Combined' AND age_group = 'All Combined' GROUP BY ALL) t
    LEFT JOIN (SELECT * FROM demographics WHERE age_group IN ('All Combined', 'Juvenile', 'Adult')) d ON t.year = d.year AND t.county = d.county""",
)
def demographic_share(spark, d):
    return summaries.demographic_summary(standins.demographics(spark, d)).withColumn("percentage", F.round("percentage", 6))


RATES = f"""{OFFENSES}, {SHARES}, rates AS (
    SELECT s.year, s.race, 100000.0 * CAST(o.n AS DOUBLE) / s.population AS arrest_rate
    FROM (SELECT * FROM shares WHERE county = 'All Combined' AND race <> 'All Combined') s
    JOIN (SELECT year, race, sum(total) AS n FROM offenses WHERE year > 1995 AND year < 2001 GROUP BY ALL) o ON s.year = o.year AND s.race = o.race
)"""


@query("rate_per_100k_wide", f"WITH {RATES} SELECT race, " + ", ".join(f'round(max(arrest_rate) FILTER (year = {y}), 6) AS "y{y}"' for y in range(1996, 2001)) + " FROM rates GROUP BY race")
def rate_per_100k_wide(spark, d):
    rates = summaries.arrest_rates(_offenses(spark, d), _shares(spark, d), 1995, 2001)
    wide = summaries.rates_wide(rates, range(1996, 2001))
    return wide.select("race", *(F.round(F.col(f"`{y}`"), 6).alias(f"y{y}") for y in range(1996, 2001)))


def _disparity_sql(by: tuple[str, ...], where: str = "") -> str:
    extra = "".join(f", o.{c}" for c in by)
    keys = ", ".join(["year", *by])
    return f"""WITH {OFFENSES}, {SHARES}, chosen AS (SELECT * FROM offenses {where}),
    part AS (SELECT {keys}, race, sum(total) AS n FROM chosen GROUP BY {keys}, race), whole AS (SELECT {keys}, sum(total) AS n FROM chosen GROUP BY {keys})
    SELECT s.year, s.race{extra}, round(100.0 * CAST(o.n AS DOUBLE) / w.n / s.percentage, 6) AS disparity_index
    FROM shares s JOIN part o ON s.year = o.year AND s.race = o.race JOIN whole w ON {" AND ".join(f"o.{c} = w.{c}" for c in ("year", *by))}
    WHERE s.county = 'All Combined' AND s.race <> 'All Combined'"""


@query("disparity_statewide", _disparity_sql((), "WHERE status_type = 'booked'"))
def disparity_statewide(spark, d):
    return summaries.disparity(_offenses(spark, d), _shares(spark, d), status="booked").withColumn("disparity_index", F.round("disparity_index", 6))


@query("disparity_by_level", _disparity_sql(("offense_level",)))
def disparity_by_level(spark, d):
    return summaries.disparity(_offenses(spark, d), _shares(spark, d), by=["offense_level"]).withColumn("disparity_index", F.round("disparity_index", 6))


@query(
    "disparity_by_county",
    f"""WITH {OFFENSES}, {SHARES}, chosen AS (SELECT * FROM offenses WHERE status_type = 'booked'),
    part AS (SELECT year, county, race, CAST(sum(total) AS BIGINT) AS n FROM chosen GROUP BY ALL), whole AS (SELECT year, county, CAST(sum(total) AS BIGINT) AS n FROM chosen GROUP BY ALL)
    SELECT s.year, s.county, s.race, s.population, round(s.percentage, 6) AS percent_population, round(100.0 * CAST(o.n AS DOUBLE) / w.n / (0.0001 + s.percentage), 6) AS disparity_index, o.n AS n_race, w.n AS n_all
    FROM shares s JOIN part o ON s.year = o.year AND s.county = o.county AND s.race = o.race JOIN whole w ON o.year = w.year AND o.county = w.county
    WHERE s.county <> 'All Combined' AND s.race <> 'All Combined'""",
)
def disparity_by_county(spark, d):
    found = summaries.disparity_by_county(_offenses(spark, d), _shares(spark, d), "booked")
    return found.withColumns({c: F.round(c, 6) for c in ("percent_population", "disparity_index")})


@query(
    "disparity_two_codebooks",
    f"""WITH {OFFENSES}, {SHARES}, codes AS (SELECT DISTINCT summary_code, kind AS offense_type, before_new FROM (
        SELECT summary_code, 'old ' || substr(summary_code, 3) AS kind, true AS before_new FROM offenses UNION ALL SELECT summary_code, 'new ' || substr(summary_code, 3), false FROM offenses WHERE summary_code <> '5-LOW')),
    part AS (SELECT year, summary_code, race, sum(total) AS n FROM offenses GROUP BY ALL), whole AS (SELECT year, summary_code, sum(total) AS n FROM offenses GROUP BY ALL)
    SELECT DISTINCT s.year, s.race, o.summary_code, c.offense_type, round(100.0 * CAST(o.n AS DOUBLE) / w.n / s.percentage, 6) AS disparity_index
    FROM shares s JOIN part o ON s.year = o.year AND s.race = o.race JOIN whole w ON o.year = w.year AND o.summary_code = w.summary_code
    JOIN codes c ON c.summary_code = o.summary_code AND c.before_new = (o.year < 1998) WHERE s.county = 'All Combined' AND s.race <> 'All Combined'""",
)
def disparity_two_codebooks(spark, d):
    offenses = _offenses(spark, d)
    code = F.col("summary_code")
    old = offenses.select(code, F.concat(F.lit("old "), F.expr("substring(summary_code, 3)")).alias("offense_type"), F.lit(True).alias("before_new"))
    new = offenses.filter(code != "5-LOW").select(code, F.concat(F.lit("new "), F.expr("substring(summary_code, 3)")).alias("offense_type"), F.lit(False).alias("before_new"))
    return summaries.disparity_by_code(offenses, _shares(spark, d), old.union(new), 1998).withColumn("disparity_index", F.round("disparity_index", 6))


# --- fixed-width records ---------------------------------------------------------------


@query(
    "fixed_width_roundtrip",
    f"""WITH {RECORDS} SELECT recno, rpad(ncic_jurisdiction, 4, ' ') AS ncic_jurisdiction, arrest_year, arrest_month, arrest_day,
    CASE offense_level WHEN 'F' THEN 'felony' WHEN 'O' THEN 'other' WHEN 'P' THEN 'petty' END AS offense_level,
    try_cast(CASE WHEN regexp_matches(trim(code_text), '^[0-9]+$') THEN trim(code_text) END AS INTEGER) AS bcs_offense_code, rpad(coalesce(race, ''), 10, ' ') AS race, age FROM records""",
)
def fixed_width_roundtrip(spark, d):
    t = standins.ARREST_RECORD
    typed = t.typed(t.split(standins.records(spark, d)))
    return typed.select("recno", *(F.col(f.name).cast("int").alias(f.name) if f.is_whole else F.col(f.name) for f in t.fields))


@query(
    "record_files_roundtrip",
    f"""WITH {RECORDS} SELECT rpad(ncic_jurisdiction, 4, ' ') AS ncic_jurisdiction, arrest_year, arrest_month, offense_level AS level,
    CASE WHEN regexp_matches(trim(code_text), '^[0-9]+$') THEN try_cast(trim(code_text) AS INTEGER) END AS bcs_offense_code, rpad(coalesce(race, ''), 10, ' ') AS race, age, count(*) AS n
    FROM (SELECT * REPLACE (CASE offense_level WHEN 'F' THEN 'felony' WHEN 'O' THEN 'other' WHEN 'P' THEN 'petty' END AS offense_level) FROM records) GROUP BY ALL""",
)
def record_files_roundtrip(spark, d):
    """Written as fixed-width files by every task, read again by byte ranges."""
    t = standins.ARREST_RECORD
    path = f"{checkpoint_dir(spark)}/records-{uuid.uuid4()}"
    record_files.write_fixed(standins.records(spark, d), path, t.length)
    typed = t.typed(t.split(record_files.read_fixed(spark, path, t.length, splitRecords="20000")))
    return typed.groupBy("ncic_jurisdiction", F.col("arrest_year").cast("int").alias("arrest_year"), F.col("arrest_month").cast("int").alias("arrest_month"), F.col("offense_level").alias("level"), F.col("bcs_offense_code").cast("int").alias("bcs_offense_code"), "race", F.col("age").cast("int").alias("age")).agg(F.count("*").alias("n"))


@query(
    "parse_modes",
    f"""WITH {RECORDS} SELECT recno, try_cast(CASE WHEN regexp_matches(trim(code_text), '^[0-9]+$') THEN trim(code_text) END AS INTEGER) AS lenient,
    CASE WHEN code_text LIKE ' %' THEN NULL WHEN regexp_matches(code_text, '^[0-9]') THEN CAST(regexp_extract(code_text, '^[0-9]+') AS INTEGER) ELSE 0 END AS prefixed,
    CASE WHEN trim(code_text) IN ('1A', 'A') THEN NULL ELSE try_cast(trim(code_text) AS INTEGER) END AS strict FROM records""",
)
def parse_modes(spark, d):
    text = F.substring("record", 15, 3)
    sound = F.when(~F.trim(text).isin("1A", "A"), text)
    return standins.records(spark, d).select("recno", parsing.lenient_int(text).alias("lenient"), parsing.prefix_int(text).alias("prefixed"), parsing.strict_number(sound).alias("strict"))


@query(
    "stage_reconcile",
    f"""WITH {RECORDS} SELECT value, CAST(sum(r) AS BIGINT) AS n_raw, CAST(sum(t) AS BIGINT) AS n_typed, CAST(sum(r) - sum(t) AS BIGINT) AS difference FROM (
        SELECT trim(code_text) AS value, 1 AS r, 0 AS t FROM records
        UNION ALL SELECT CASE WHEN regexp_matches(trim(code_text), '^[0-9]+$') THEN lpad(CAST(CAST(trim(code_text) AS INTEGER) AS VARCHAR), 3, '0') END, 0, 1 FROM records) GROUP BY value HAVING sum(r) <> sum(t)""",
)
def stage_reconcile(spark, d):
    t = standins.ARREST_RECORD
    raw = t.split(standins.records(spark, d))
    return profile.reconcile_stages(raw, t.typed(raw), F.trim("bcs_offense_code"), F.lpad(F.col("bcs_offense_code").cast("string"), 3, "0"))


@query("failed_parses", f"WITH {RECORDS} SELECT recno, 'bcs_offense_code' AS \"column\", code_text AS text FROM records WHERE trim(code_text) IN ('1A', 'A')")
def failed_parses(spark, d):
    t = standins.ARREST_RECORD
    raw = t.split(standins.records(spark, d))
    return joins.failed_parses(raw, t.typed(raw), "recno", ["bcs_offense_code", "age"])


@query("impossible_dates", f"WITH {RECORDS} SELECT recno, arrest_year, arrest_month, arrest_day FROM records WHERE try_cast(arrest_year || '-' || arrest_month || '-' || arrest_day AS DATE) IS NULL")
def impossible_dates(spark, d):
    t = standins.ARREST_RECORD
    typed = t.typed(t.split(standins.records(spark, d)))
    return profile.impossible_dates(typed, "arrest_year", "arrest_month", "arrest_day").select("recno", *(F.col(c).cast("int").alias(c) for c in ("arrest_year", "arrest_month", "arrest_day")))


@query("record_keys", f"WITH {ARRESTS} SELECT 'orders:' || db_id AS uid, 1000 + row_number() OVER (ORDER BY db_id) - 1 AS key FROM arrests")
def record_keys(spark, d):
    rows = standins.records(spark, d).withColumn("recno", F.col("recno") + 1)
    keyed = fixed_width.surrogate_keys(rows, 1000).withColumn("recno", F.col("recno") - 1)
    return keyed.select(fixed_width.uid().alias("uid"), F.col("db_id").alias("key"))


@query("dedupe_append", "SELECT event_type, count(*) AS n, min(event_id) AS first_id FROM events WHERE event_id % 3 <> 0 GROUP BY event_type")
def dedupe_append(spark, d):
    events = read(spark, d, "events").withColumn("internal_uid", F.concat_ws(":", F.lit("events"), "event_id"))
    again = events.union(events.filter("event_id % 2 = 0"))
    added = manifest.new_rows(again, events.filter("event_id % 3 = 0"))
    return added.groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(
    "manifest_changes",
    """WITH f AS (SELECT 'part' || n_nationkey AS file, n_nationkey AS size, n_regionkey AS hash, 1 AS modified FROM nation WHERE n_nationkey % 5 <> 0),
    m AS (SELECT 'part' || n_nationkey AS file, CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE n_nationkey END AS size, n_regionkey AS hash, CASE WHEN n_nationkey % 4 = 0 THEN 2 ELSE 1 END AS modified FROM nation WHERE n_nationkey % 6 <> 1)
    SELECT coalesce(f.file, m.file) AS file, CASE WHEN m.file IS NULL THEN 'new' WHEN f.file IS NULL THEN 'deleted' WHEN f.size <> m.size OR f.hash <> m.hash THEN 'changed' WHEN f.modified <> m.modified THEN 'touched' ELSE 'same' END AS state
    FROM f FULL JOIN m ON f.file = m.file""",
)
def manifest_changes(spark, d):
    nation, n = read(spark, d, "nation"), F.col("n_nationkey")
    name = F.concat(F.lit("part"), n.cast("string")).alias("file")
    found = nation.filter(n % 5 != 0).select(name, n.alias("size"), F.col("n_regionkey").alias("hash"), F.lit(1).alias("modified"))
    known = nation.filter(n % 6 != 1).select(name, F.when(n % 7 == 0, 0).otherwise(n).alias("size"), F.col("n_regionkey").alias("hash"), F.when(n % 4 == 0, 2).otherwise(1).alias("modified"))
    return manifest.changes(found, known)


# --- scalar functions and recoding -----------------------------------------------------


@query(
    "centuries",
    f"""WITH {ARRESTS} SELECT db_id, CASE WHEN yy > 79 THEN 1900 + yy ELSE 2000 + yy END AS file_year, CASE WHEN year - 1900 < 100 THEN year ELSE year - 1900 END AS full_year,
    CASE WHEN yy - (year - 1900) > 3 THEN 1800 + yy ELSE 1900 + yy END AS birth_year FROM (SELECT db_id, year, CAST((year * 7 + db_id) % 100 AS INTEGER) AS yy FROM arrests)""",
)
def centuries(spark, d):
    yy = ((F.col("year") * 7 + F.col("db_id")) % 100).cast("int")
    rows = standins.arrests(spark, d).select("db_id", "year", yy.alias("yy"))
    return rows.select("db_id", dates.century(F.col("yy")).alias("file_year"), dates.full_year(F.col("year") - 1900).alias("full_year"), dates.birth_year(F.col("yy"), F.col("year")).alias("birth_year"))


@query(
    "dates_and_ages",
    f"""WITH {ARRESTS}, b AS (SELECT db_id, make_date(year, month, day) AS arrested, make_date(year - 20 - CAST(db_id % 40 AS INTEGER), CAST(db_id % 12 + 1 AS INTEGER), CAST(db_id % 28 + 1 AS INTEGER)) AS birth FROM arrests)
    SELECT db_id, CAST(date_sub('year', birth, arrested) AS INTEGER) AS age, CAST(arrested - birth AS INTEGER) AS days, make_date(CAST(year(arrested) AS INTEGER), 12, 31) AS year_end, CAST(year(arrested) AS INTEGER) AS number_year FROM b""",
)
def dates_and_ages(spark, d):
    k = F.col("db_id")
    rows = standins.arrests(spark, d).select(k, dates.date_of(F.col("year"), F.col("month"), F.col("day")).alias("at"), dates.date_of(F.col("year") - 20 - (k % 40), k % 12 + 1, k % 28 + 1).alias("birth"))
    number = F.year("at") * 10000 + F.month("at") * 100 + F.dayofmonth("at")
    return rows.select(k, dates.age_at(F.col("birth"), F.col("at")).alias("age"), dates.days_between(F.col("at"), F.col("birth")).alias("days"), dates.year_end(F.year("at")).alias("year_end"), dates.year_of_number(number).alias("number_year"))


@query(
    "recode_levels",
    f"""WITH {ARRESTS} SELECT CASE WHEN race IN ('BUILDING', 'FURNITURE') THEN 'goods' WHEN race = 'AUTOMOBILE' THEN 'cars' ELSE race END AS race,
    CASE WHEN age > 17 AND age <= 24 THEN '18-24' WHEN age > 24 AND age <= 32 THEN '25-32' WHEN age > 32 AND age <= 44 THEN '33-44' WHEN age > 44 AND age <= 150 THEN '45+' END AS band,
    nullif(offense_level, 'P') AS level, lower(regexp_replace(summary_code, '[^A-Za-z0-9]+', '_', 'g')) AS tidy, CASE WHEN length(summary_code) > 8 THEN substr(summary_code, 1, 5) || '...' ELSE summary_code END AS short,
    coalesce(race IN ('BUILDING', 'HOUSEHOLD'), false) AS within, NOT coalesce(race IN ('BUILDING', 'HOUSEHOLD'), false) AS outside, count(*) AS n, round(floor(10 * sum(amount) / 1000000.0) / 10, 1) AS tenths FROM arrests GROUP BY ALL""",
)
def recode_levels(spark, d):
    race, code = F.col("race"), F.col("summary_code")
    rows = standins.arrests(spark, d)
    keys = {
        "race": recode.remap(race, [["BUILDING", "FURNITURE"], "AUTOMOBILE"], ["goods", "cars"]),
        "band": recode.right_closed(F.col("age"), recode.RELEASE_BANDS),
        "level": recode.without(F.col("offense_level"), ["P"]),
        "tidy": recode.tidy_name(code),
        "short": recode.shortened(code, 8),
        "within": predicates.is_in(race, ["BUILDING", "HOUSEHOLD"]),
        "outside": predicates.not_in(race, ["BUILDING", "HOUSEHOLD"]),
    }
    return rows.groupBy(*(c.alias(n) for n, c in keys.items())).agg(F.count("*").alias("n"), F.round(recode.floor_tenth(F.sum("amount") / 1000000.0), 1).alias("tenths"))


# --- lookups and joins -----------------------------------------------------------------


@query(
    "code_lookup_first",
    "WITH t AS (SELECT p_brand, min(p_partkey) AS k FROM part GROUP BY p_brand) SELECT s_suppkey, b AS p_brand, p.p_type FROM (SELECT s_suppkey, 'Brand#' || (s_suppkey % 31) AS b FROM supplier) LEFT JOIN t ON b = t.p_brand LEFT JOIN part p ON p.p_partkey = t.k",
)
def code_lookup_first(spark, d):
    rows = read(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 31).cast("string")).alias("p_brand"))
    return joins.first_match(rows, read(spark, d, "part").select("p_brand", "p_partkey", "p_type"), "p_brand", "p_partkey").select("s_suppkey", "p_brand", "p_type")


@query(
    "code_lookup_versioned",
    f"""WITH {ARRESTS}, t AS (SELECT p_size AS offense_code, max(p_type) FILTER (p_partkey % 2 = 0) AS old, max(p_type) FILTER (p_partkey % 2 = 1) AS new, count(*) AS k FROM part WHERE p_size > 1 GROUP BY p_size)
    SELECT year, a.offense_code, coalesce(CASE WHEN k = 1 THEN coalesce(new, old) WHEN year >= 1998 THEN new ELSE old END, 'NA') AS p_type, count(*) AS n FROM arrests a LEFT JOIN t ON a.offense_code = t.offense_code GROUP BY ALL""",
)
def code_lookup_versioned(spark, d):
    table = read(spark, d, "part").filter("p_size > 1").select(F.col("p_size").alias("offense_code"), (F.col("p_partkey") % 2).alias("flag"), "p_type")
    found = joins.versioned_match(standins.arrests(spark, d), table, "offense_code", "flag", F.col("year") >= 1998, "p_type")
    return aggregates.counts(found, ["year", "offense_code", "p_type"])


@query("join_failures", f"WITH {ARRESTS}, {JURISDICTIONS} SELECT ncic_jurisdiction, count(*) AS n_rows FROM arrests WHERE ncic_jurisdiction NOT IN (SELECT ncic_jurisdiction FROM jurisdictions) GROUP BY ALL")
def join_failures(spark, d):
    return joins.unmatched(standins.arrests(spark, d), standins.jurisdictions(spark, d), "ncic_jurisdiction")


@query(
    "code_count_merge",
    f"WITH {ARRESTS} SELECT race, count(*) FILTER (year < 1998) AS n_left, count(*) FILTER (year >= 2000 AND race <> 'BUILDING') AS n_right FROM arrests GROUP BY race HAVING count(*) FILTER (year < 1998) + count(*) FILTER (year >= 2000 AND race <> 'BUILDING') > 0",
)
def code_count_merge(spark, d):
    rows = standins.arrests(spark, d)
    return joins.merged_counts(rows.filter("year < 1998"), rows.filter("year >= 2000 AND race <> 'BUILDING'"), "race")


@query("match_flag", f"WITH {ARRESTS} SELECT year, count(*) FILTER (person IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)) AS matched, count(*) AS n FROM arrests GROUP BY year")
def match_flag(spark, d):
    keys = read(spark, d, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("person"))
    found = joins.flagged(standins.arrests(spark, d), keys, "person", "hit")
    return found.groupBy("year").agg(aggregates.count_if(F.col("hit")).alias("matched"), F.count("*").alias("n"))


@query("lookup_consistent", "SELECT count(*) AS n_rows, bool_and(c_nationkey % 5 = n_regionkey) AS agree FROM customer JOIN nation ON c_nationkey = n_nationkey")
def lookup_consistent(spark, d):
    rows = read(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), (F.col("c_nationkey") % 5).alias("said"))
    return joins.consistent(rows, read(spark, d, "nation"), "n_nationkey", "said", "n_regionkey")


@query(
    "key_remap",
    """WITH m AS (SELECT n_nationkey AS old, n_nationkey * 10 + 1 AS new FROM nation WHERE n_nationkey <> 3) SELECT a.new AS home, b.new AS work, count(*) AS n
    FROM (SELECT c_nationkey AS h, (c_custkey % 25) AS w FROM customer) LEFT JOIN m a ON h = a.old LEFT JOIN m b ON w = b.old GROUP BY ALL""",
)
def key_remap(spark, d):
    mapping = read(spark, d, "nation").filter("n_nationkey <> 3").select(F.col("n_nationkey").alias("old"), (F.col("n_nationkey") * 10 + 1).alias("new"))
    rows = read(spark, d, "customer").select(F.col("c_nationkey").alias("home"), (F.col("c_custkey") % 25).cast("int").alias("work"))
    return aggregates.counts(joins.remap_keys(rows, mapping, ["home", "work"]), ["home", "work"])


# --- contingency tables, shares, modes --------------------------------------------------

TABLE = f"WITH {ARRESTS}, l AS (SELECT * FROM (SELECT DISTINCT race FROM arrests WHERE {{keep}}) , (SELECT DISTINCT gender FROM arrests WHERE {{keep}}), (SELECT DISTINCT year FROM arrests WHERE {{keep}})) SELECT l.race, l.gender, l.year, count(a.db_id) AS n FROM l LEFT JOIN arrests a ON a.race IS NOT DISTINCT FROM l.race AND a.gender IS NOT DISTINCT FROM l.gender AND a.year = l.year GROUP BY ALL"


@query("crosstab_dense", TABLE.replace("{keep}", "race IS NOT NULL AND gender IS NOT NULL"))
def crosstab_dense(spark, d):
    return aggregates.dense_counts(standins.arrests(spark, d), ["race", "gender", "year"])


@query("crosstab_with_null", TABLE.replace("{keep}", "true"))
def crosstab_with_null(spark, d):
    return aggregates.dense_counts(standins.arrests(spark, d), ["race", "gender", "year"], keep_null=True)


@query("booking_rate_by_year", f"WITH {ARRESTS} SELECT ncic_jurisdiction, year, round(CAST(count(*) FILTER (status_type = 'booked' AND race IS NOT NULL) AS DOUBLE) / nullif(count(*) FILTER (race IS NOT NULL), 0), 9) AS share FROM arrests GROUP BY ALL")
def booking_rate_by_year(spark, d):
    share = aggregates.share_if(F.col("status_type") == "booked", F.col("race").isNotNull())
    return standins.arrests(spark, d).groupBy("ncic_jurisdiction", "year").agg(F.round(share, 9).alias("share"))


@query(
    "high_rate_screen",
    f"""WITH {ARRESTS}, s AS (SELECT ncic_jurisdiction, year, CASE WHEN count(*) >= 30 THEN CAST(count(*) FILTER (status_type = 'booked') AS DOUBLE) / count(*) END AS share FROM arrests GROUP BY ALL)
    SELECT ncic_jurisdiction, count(*) AS n_periods, count(*) FILTER (share IS NULL) AS n_missing, count(*) FILTER (share > 0.62) AS n_high, count(*) FILTER (share < 0.55) AS n_low FROM s GROUP BY ALL""",
)
def high_rate_screen(spark, d):
    share = F.when(F.count("*") >= 30, aggregates.share_if(F.col("status_type") == "booked")).alias("share")
    by_year = standins.arrests(spark, d).groupBy("ncic_jurisdiction", "year").agg(share)
    return sequences.threshold_counts(by_year, ["ncic_jurisdiction"], "share", 0.62, 0.55)


@query(
    "mode_per_group",
    f"WITH {ARRESTS}, n AS (SELECT person, summary_code, count(*) AS n FROM arrests WHERE summary_code <> '1-URGENT' GROUP BY ALL) SELECT person, summary_code AS mode FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY n DESC, summary_code) AS k FROM n) WHERE k = 1",
)
def mode_per_group(spark, d):
    rows = standins.arrests(spark, d).withColumn("code", F.nullif(F.col("summary_code"), F.lit("1-URGENT")))
    return aggregates.mode_by(rows.filter("code IS NOT NULL"), ["person"], "code")


@query("single_row_flag", f"WITH {ARRESTS} SELECT person, CASE WHEN count(*) = 1 THEN max(offense_code) ELSE 0 END AS offense_code FROM arrests GROUP BY person")
def single_row_flag(spark, d):
    return aggregates.single_row_flag(standins.arrests(spark, d), ["person"], "offense_code")


@query("value_summaries", f"WITH {ARRESTS} SELECT offense_level, min(amount) AS minimum, round(quantile_cont(amount, 0.25), 6) AS lower_quartile, round(quantile_cont(amount, 0.5), 6) AS median, round(avg(amount), 6) AS mean, round(quantile_cont(amount, 0.75), 6) AS upper_quartile, max(amount) AS maximum FROM arrests GROUP BY ALL")
def value_summaries(spark, d):
    out = aggregates.summaries(standins.arrests(spark, d), ["offense_level"], "amount")
    return out.withColumns({c: F.round(c, 6) for c in ("lower_quartile", "median", "mean", "upper_quartile")})


@query("value_spread", f"WITH {ARRESTS} SELECT race, min(age) AS minimum, max(age) AS maximum, max(age) - min(age) AS width, round(avg(age), 9) AS mean, round(stddev_samp(age), 9) AS sd, round(quantile_cont(age, 0.5), 6) AS median FROM arrests GROUP BY ALL")
def value_spread(spark, d):
    out = aggregates.spreads(standins.arrests(spark, d), ["race"], "age")
    return out.withColumns({"mean": F.round("mean", 9), "sd": F.round("sd", 9), "median": F.round("median", 6)})


@query(
    "aggregate_reconcile",
    f"WITH {ARRESTS}, a AS (SELECT year, count(*) AS n FROM arrests GROUP BY ALL), b AS (SELECT year, count(*) AS n FROM arrests WHERE NOT (year = 1997 AND race IS NULL) AND year <> 2000 GROUP BY ALL) SELECT a.year, CAST(a.n AS DOUBLE) AS \"left\", CAST(b.n AS DOUBLE) AS \"right\", CAST(a.n - coalesce(b.n, 0) AS DOUBLE) AS difference FROM a LEFT JOIN b ON a.year = b.year WHERE a.n <> b.n OR b.n IS NULL",
)
def aggregate_reconcile(spark, d):
    rows = standins.arrests(spark, d)
    fewer = rows.filter(~((F.col("year") == 1997) & F.col("race").isNull()) & (F.col("year") != 2000))
    return aggregates.reconcile(aggregates.counts(rows, ["year"]), aggregates.counts(fewer, ["year"]), ["year"], "n")


# --- sequences -------------------------------------------------------------------------

UNITS = f"{ARRESTS}, u AS (SELECT person, count(*) AS n FROM arrests GROUP BY ALL), c AS (SELECT person, n, CAST(sum(n) OVER (ORDER BY n, person ROWS UNBOUNDED PRECEDING) AS DOUBLE) / sum(n) OVER () AS share_below FROM u)"


def _units(spark, d):
    return aggregates.running_share(aggregates.counts(standins.arrests(spark, d), ["person"]), "n")


@query("cumulative_share_95", f"WITH {UNITS} SELECT person, n, round(share_below, 9) AS share_below FROM c WHERE share_below > 1 - 0.95")
def cumulative_share_95(spark, d):
    return sequences.top_share(_units(spark, d), 0.95).withColumn("share_below", F.round("share_below", 9))


@query("cumulative_share_next", f"WITH {UNITS} SELECT person, n, round(share_below, 9) AS share_below FROM c WHERE share_below >= 1 - 0.95 OR share_below = (SELECT max(share_below) FROM c WHERE share_below < 1 - 0.95)")
def cumulative_share_next(spark, d):
    return sequences.top_share(_units(spark, d), 0.95, "with_next").withColumn("share_below", F.round("share_below", 9))


@query("cumulative_share_strict", f"WITH {UNITS} SELECT person, n, round(share_below, 9) AS share_below FROM c WHERE n > coalesce((SELECT max(n) FROM c WHERE share_below < 1 - 0.98), -1)")
def cumulative_share_strict(spark, d):
    return sequences.top_share(_units(spark, d), 0.98, "strict").withColumn("share_below", F.round("share_below", 9))


SERIES = f"""{LINE_YEARS}, series AS (SELECT k.l_partkey, y.year, count(l.year) AS n FROM (SELECT DISTINCT l_partkey FROM line_years) k CROSS JOIN (SELECT DISTINCT year FROM line_years) y
    LEFT JOIN line_years l ON l.l_partkey = k.l_partkey AND l.year = y.year GROUP BY ALL),
    islands AS (SELECT l_partkey, n > 0 AS present, min(year) AS run_start, max(year) AS run_end, count(*) AS run_length FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY year) - row_number() OVER (PARTITION BY l_partkey, n > 0 ORDER BY year) AS g FROM series) GROUP BY l_partkey, n > 0, g)"""
LONGEST = "SELECT l_partkey, run_start, run_end, run_length FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY run_length DESC, run_start) AS k FROM islands WHERE {on}) WHERE k = 1"


def _series(spark, d):
    return aggregates.dense_series(standins.line_years(spark, d), ["l_partkey"], "year")


def _islands(spark, d):
    return sequences.runs(_series(spark, d), ["l_partkey"], "year", F.col("n") > 0)


@query("longest_run", f"WITH {SERIES} {LONGEST.format(on='present')}")
def longest_run(spark, d):
    return sequences.longest_run(_islands(spark, d), ["l_partkey"])


@query("longest_gap", f"WITH {SERIES} {LONGEST.format(on='NOT present')}")
def longest_gap(spark, d):
    return sequences.longest_run(_islands(spark, d), ["l_partkey"], on=False)


@query("run_count", f"WITH {SERIES} SELECT l_partkey, count(*) AS n_runs FROM islands WHERE present GROUP BY ALL")
def run_count(spark, d):
    return sequences.run_count(_islands(spark, d), ["l_partkey"])


@query(
    "yoy_ratio_extremes",
    f"""WITH {SERIES}, a AS (SELECT l_partkey, CAST(n AS DOUBLE) / lag(n) OVER (PARTITION BY l_partkey ORDER BY year) AS r FROM series WHERE n > 0),
    b AS (SELECT l_partkey, CASE WHEN n > 0 AND p > 0 THEN CAST(n AS DOUBLE) / p END AS r FROM (SELECT *, lag(n) OVER (PARTITION BY l_partkey ORDER BY year) AS p FROM series))
    SELECT x.l_partkey, round(x.lo, 9) AS least_ratio, round(x.hi, 9) AS most_ratio, round(y.lo, 9) AS least_adjacent, round(y.hi, 9) AS most_adjacent
    FROM (SELECT l_partkey, min(r) AS lo, max(r) AS hi FROM a GROUP BY ALL) x JOIN (SELECT l_partkey, coalesce(min(r), 0.0) AS lo, coalesce(max(r), 1.0) AS hi FROM b GROUP BY ALL) y ON x.l_partkey = y.l_partkey""",
)
def yoy_ratio_extremes(spark, d):
    series = _series(spark, d)
    a = sequences.ratio_extremes(series, ["l_partkey"], "year", "n")
    b = sequences.finite_ratio_extremes(series, ["l_partkey"], "year", "n").withColumnsRenamed({"least_ratio": "least_adjacent", "most_ratio": "most_adjacent"})
    both = a.join(b, "l_partkey")
    return both.withColumns({c: F.round(c, 9) for c in both.columns if c != "l_partkey"})


@query(
    "logit_change",
    f"""WITH {ARRESTS}, s AS (SELECT ncic_jurisdiction, year, CAST(count(*) FILTER (offense_level = 'F') AS DOUBLE) / count(*) AS p FROM arrests GROUP BY ALL),
    l AS (SELECT *, CASE WHEN p > 0 AND p < 1 THEN ln(p / (1 - p)) END AS q FROM s)
    SELECT ncic_jurisdiction, year, round(c, 6) AS logit_change FROM (SELECT *, q - lag(q) OVER (PARTITION BY ncic_jurisdiction ORDER BY year) AS c FROM l) WHERE c IS NOT NULL""",
)
def logit_change(spark, d):
    by_year = standins.arrests(spark, d).groupBy("ncic_jurisdiction", "year").agg(aggregates.share_if(F.col("offense_level") == "F").alias("share"))
    return sequences.logit_changes(by_year, ["ncic_jurisdiction"], "year", "share").select("ncic_jurisdiction", "year", F.round("logit_change", 6).alias("logit_change"))


@query(
    "neighbour_flags",
    f"""WITH {ARRESTS}, n AS (SELECT db_id, year, month, day, ncic_jurisdiction AS unit, lag(db_id) OVER w AS pk, lead(db_id) OVER w AS nk, lag(month) OVER w AS pm, lead(month) OVER w AS nm, lag(day) OVER w AS pd, lead(day) OVER w AS nd,
        lag(ncic_jurisdiction) OVER w AS pu, lead(ncic_jurisdiction) OVER w AS nu FROM arrests WINDOW w AS (PARTITION BY year ORDER BY db_id))
    SELECT db_id, coalesce(pk IS NOT NULL AND pm < month AND pd <= day AND pu = unit, false) AS month_slipped,
        (pk IS NULL OR coalesce(pm = month AND day > pd AND pu = unit, false)) AND (nk IS NULL OR coalesce(nm = month AND day > nd AND nu = unit, false)) AS day_transposed,
        coalesce(pk IS NOT NULL AND nk IS NOT NULL AND pm = month AND nm = month AND day = pd + 1 AND coalesce(nd = pd + 1, true), false) AS day_added FROM n""",
)
def neighbour_flags(spark, d):
    found = sequences.neighbour_flags(standins.arrests(spark, d).withColumnRenamed("ncic_jurisdiction", "unit"), "db_id", ["year"])
    return found.select("db_id", "month_slipped", "day_transposed", "day_added")


@query("dense_codes", f"WITH {ARRESTS} SELECT race, code, count(*) AS n FROM (SELECT race, CASE WHEN race IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY race) AS INTEGER) END AS code FROM arrests) GROUP BY ALL")
def dense_codes(spark, d):
    return aggregates.counts(sequences.dense_codes(standins.arrests(spark, d), "race", "code"), ["race", "code"])


@query("standardized", f"WITH {ARRESTS} SELECT db_id, round((amount - avg(amount) OVER w) / stddev_samp(amount) OVER w, 6) AS z FROM arrests WINDOW w AS (PARTITION BY offense_level)")
def standardized(spark, d):
    return sequences.standardized(standins.arrests(spark, d), "amount", ["offense_level"], "z").select("db_id", F.round("z", 6).alias("z"))


# --- reshaping -------------------------------------------------------------------------


@query("unpivot_measures", f"WITH {LINE_YEARS}, t AS (SELECT brand, year, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price FROM line_years GROUP BY ALL) SELECT brand, year, 'quantity' AS measure, quantity AS amount FROM t UNION ALL SELECT brand, year, 'price', price FROM t")
def unpivot_measures(spark, d):
    sums = standins.line_years(spark, d).groupBy("brand", "year").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return reshape.long(sums, ["brand", "year"], ["quantity", "price"], "measure", "amount")


@query("pivot_summary", f"WITH {LINE_YEARS} SELECT brand, type, " + ", ".join(f"count(*) FILTER (year = {y}) AS n_{y}" for y in range(1995, 2002)) + " FROM line_years GROUP BY ALL")
def pivot_summary(spark, d):
    return reshape.crosstab(standins.line_years(spark, d), ["brand", "type"], "year", range(1995, 2002))


PACKED = "packed AS (SELECT o_orderkey, year(o_orderdate) AS year, string_agg(rpad(CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE l_returnflag || l_linestatus END, 2, ' '), '' ORDER BY l_linenumber, l_partkey) AS codes FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <= 7 GROUP BY ALL)"


def _packed(spark, d):
    code = F.rpad(F.when(F.col("l_linenumber") % 4 == 0, "").otherwise(F.concat("l_returnflag", "l_linestatus")), 2, " ")
    lines = read(spark, d, "lineitem").filter("l_linenumber <= 7").join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", code.alias("code"))))
    return lines.groupBy("o_orderkey", F.year("o_orderdate").alias("year")).agg(F.array_join(F.transform(ordered, lambda x: x["code"]), "").alias("codes"))


@query("qualifier_explode", f"WITH {PACKED} SELECT o_orderkey, trim(substr(codes, CAST(i * 2 + 1 AS INTEGER), 2)) AS code FROM packed, generate_series(0, 6) t(i) WHERE trim(substr(codes, CAST(i * 2 + 1 AS INTEGER), 2)) <> ''")
def qualifier_explode(spark, d):
    return reshape.explode_codes(_packed(spark, d), ["o_orderkey"], "codes")


@query("qualifier_usage", f"WITH {PACKED} SELECT CAST(year AS INTEGER) AS year, trim(substr(codes, CAST(i * 2 + 1 AS INTEGER), 2)) AS code, count(*) AS n FROM packed, generate_series(0, 6) t(i) WHERE trim(substr(codes, CAST(i * 2 + 1 AS INTEGER), 2)) <> '' GROUP BY ALL")
def qualifier_usage(spark, d):
    return reshape.code_usage(_packed(spark, d), "codes", ["year"])


@query("largest_and_smallest", f"(WITH {ARRESTS} SELECT db_id, amount, 'largest' AS \"end\" FROM arrests ORDER BY amount DESC, db_id LIMIT 8) UNION ALL (WITH {ARRESTS} SELECT db_id, amount, 'smallest' FROM arrests ORDER BY amount, db_id LIMIT 8)")
def largest_and_smallest(spark, d):
    return reshape.ends(standins.arrests(spark, d).select("db_id", "amount"), "amount", 8, ["db_id"])


@query("union_distinct", f"WITH {ARRESTS} SELECT race, gender FROM arrests WHERE year < 1997 UNION SELECT race, gender FROM arrests WHERE year > 1999")
def union_distinct(spark, d):
    rows = standins.arrests(spark, d)
    return rows.filter("year < 1997").select("race", "gender").union(rows.filter("year > 1999").select("race", "gender")).distinct()


# --- profiles --------------------------------------------------------------------------


def _profile_sql() -> str:
    parts = []
    for c, kind in (("c_custkey", "number"), ("c_name", "text"), ("c_nationkey", "number"), ("c_mktsegment", "text")):
        shown = "NULL" if c == "c_name" else "CAST({f}(%s) AS VARCHAR)" % c
        parts.append(f"SELECT '{c}' AS \"column\", '{kind}' AS kind, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, {shown.format(f='min')} AS least, {shown.format(f='max')} AS most FROM customer")
    return " UNION ALL ".join(parts)


@query("column_profile", _profile_sql())
def column_profile(spark, d):
    return profile.column_profile(read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), masked=["c_name"])


@query("freq_desc", f"WITH {ARRESTS} SELECT race, count(*) AS n FROM arrests GROUP BY race")
def freq_desc(spark, d):
    return profile.frequencies(standins.arrests(spark, d), "race").orderBy(F.desc("n"), "race")


@query("implausible_ages", f"WITH {ARRESTS} SELECT year, count(*) FILTER (age <= 5) AS n_low, count(*) FILTER (age >= 80) AS n_high FROM arrests GROUP BY year HAVING count(*) FILTER (age <= 5) > 0 OR count(*) FILTER (age >= 80) > 0")
def implausible_ages(spark, d):
    return profile.implausible(standins.arrests(spark, d), "age", 5, 80, ["year"])


@query("contradictions", f"WITH {ARRESTS} SELECT 'juvenile felony' AS rule, count(*) FILTER (age < 18 AND offense_level = 'F') AS n_rows FROM arrests UNION ALL SELECT 'cited petty', count(*) FILTER (status_type = 'cited' AND offense_level = 'P') FROM arrests")
def contradictions(spark, d):
    level, status = F.col("offense_level"), F.col("status_type")
    return profile.contradictions(standins.arrests(spark, d), {"juvenile felony": (F.col("age") < 18) & (level == "F"), "cited petty": (status == "cited") & (level == "P")})


@query("unmatched_audit", f"WITH {ARRESTS}, {JURISDICTIONS} SELECT 'ncic_jurisdiction' AS \"column\", ncic_jurisdiction AS code, count(*) AS n_rows FROM arrests WHERE ncic_jurisdiction NOT IN (SELECT ncic_jurisdiction FROM jurisdictions) GROUP BY ALL UNION ALL SELECT 'offense_code', CAST(offense_code AS VARCHAR), count(*) FROM arrests WHERE offense_code NOT IN (SELECT p_size FROM part WHERE p_size > 2) GROUP BY ALL")
def unmatched_audit(spark, d):
    sizes = read(spark, d, "part").filter("p_size > 2")
    return profile.unmatched_audit(standins.arrests(spark, d), {"ncic_jurisdiction": (standins.jurisdictions(spark, d), "ncic_jurisdiction"), "offense_code": (sizes, "p_size")})


# --- disclosure risk -------------------------------------------------------------------

KEYS = ["race", "gender", "band"]
PERSONS = f"""{ARRESTS}, persons AS (SELECT DISTINCT person, ncic_jurisdiction AS stratum, race, gender,
    CASE WHEN age > 17 AND age <= 24 THEN '18-24' WHEN age > 24 AND age <= 32 THEN '25-32' WHEN age > 32 AND age <= 44 THEN '33-44' WHEN age > 44 AND age <= 150 THEN '45+' END AS band,
    CASE person % 4 WHEN 0 THEN 'felony' WHEN 1 THEN 'petty' WHEN 2 THEN 'other' END AS level FROM arrests)"""
FITS = " AND ".join(f"(a.{k} = b.{k} OR a.{k} IS NULL OR b.{k} IS NULL)" for k in KEYS)


def _persons(spark, d):
    level = F.when(F.col("person") % 4 == 0, "felony").when(F.col("person") % 4 == 1, "petty").when(F.col("person") % 4 == 2, "other")
    return standins.arrests(spark, d).select("person", F.col("ncic_jurisdiction").alias("stratum"), "race", "gender", recode.right_closed(F.col("age"), recode.RELEASE_BANDS).alias("band"), level.alias("level")).distinct()


@query("k_risk", f"WITH {PERSONS}, p AS (SELECT * FROM persons WHERE race IS NOT NULL AND gender IS NOT NULL AND band IS NOT NULL) SELECT person, CAST(count(*) OVER (PARTITION BY stratum, race, gender, band) AS DOUBLE) AS risk FROM p")
def k_risk(spark, d):
    return risk.calc_risk(_persons(spark, d).na.drop(subset=KEYS), KEYS, ["stratum"]).select("person", "risk")


@query("k_risk_with_nulls", f"WITH {PERSONS} SELECT a.person, CAST(count(*) AS DOUBLE) AS risk FROM persons a JOIN persons b ON a.stratum = b.stratum AND {FITS} GROUP BY a.person")
def k_risk_with_nulls(spark, d):
    return risk.calc_risk(_persons(spark, d), KEYS, ["stratum"]).select("person", "risk")


@query("l_diversity_risk", f"WITH {PERSONS} SELECT a.person, CAST(count(DISTINCT coalesce(b.level, 'NA')) AS DOUBLE) AS risk FROM persons a JOIN persons b ON a.stratum = b.stratum AND {FITS} GROUP BY a.person")
def l_diversity_risk(spark, d):
    return risk.calc_risk(_persons(spark, d), KEYS, ["stratum"], "level", risk.diversity).select("person", "risk")


@query("share_risk", f"WITH {PERSONS} SELECT a.person, round(CAST(count(*) FILTER (b.level IN ('felony', 'petty')) AS DOUBLE) / count(*), 9) AS risk FROM persons a JOIN persons b ON a.stratum = b.stratum AND {FITS} GROUP BY a.person")
def share_risk(spark, d):
    return risk.calc_risk(_persons(spark, d), KEYS, ["stratum"], "level", risk.share_of("felony", "petty")).select("person", F.round("risk", 9).alias("risk"))


RISKED = f"{PERSONS}, r AS (SELECT a.person, a.stratum, a.race, a.gender, a.band, count(*) AS orig FROM persons a JOIN persons b ON a.stratum = b.stratum AND {FITS} GROUP BY ALL)"


@query(
    "at_risk_subset",
    f"WITH {RISKED} SELECT person, CAST(orig AS DOUBLE) AS orig_risk FROM r x WHERE EXISTS (SELECT 1 FROM r y WHERE y.orig < 3 AND y.stratum = x.stratum AND (" + " OR ".join(f"x.{k} IS NOT DISTINCT FROM y.{k}" for k in KEYS) + "))",
)
def at_risk_subset(spark, d):
    return risk.at_risk_subset(_persons(spark, d), KEYS, 3, ["stratum"]).select("person", "orig_risk")


CELL = "PARTITION BY stratum, race, gender, band"


@query("cell_suppress_k", f"WITH {PERSONS} SELECT person, CASE WHEN count(*) OVER ({CELL}) >= 3 THEN band END AS band FROM persons")
def cell_suppress_k(spark, d):
    return risk.suppress_small(_persons(spark, d), ["stratum"], ["race", "gender"], "band", 3).select("person", "band")


@query("cell_suppress_l", f"WITH {PERSONS}, c AS (SELECT stratum, race, gender, band, count(DISTINCT coalesce(level, '-')) AS k FROM persons GROUP BY ALL) SELECT person, CASE WHEN k >= 2 THEN p.band END AS band FROM persons p JOIN c ON p.stratum = c.stratum AND p.race IS NOT DISTINCT FROM c.race AND p.gender IS NOT DISTINCT FROM c.gender AND p.band IS NOT DISTINCT FROM c.band")
def cell_suppress_l(spark, d):
    return risk.suppress_uniform(_persons(spark, d), ["stratum"], ["race", "gender"], "band", ["level"], 2).select("person", "band")


@query("cell_suppress_ordered", f"WITH {PERSONS} SELECT person, CASE WHEN count(*) FILTER (level = 'felony') OVER ({CELL}) > 0 AND count(*) FILTER (level = 'petty') OVER ({CELL}) = 0 THEN NULL ELSE band END AS band FROM persons")
def cell_suppress_ordered(spark, d):
    return risk.suppress_ordered(_persons(spark, d), ["stratum"], ["race", "gender"], "band", "level", "felony", "petty").select("person", "band")


@query("suppression_counts", f"WITH {PERSONS}, s AS (SELECT *, count(*) OVER ({CELL}) AS k FROM persons) SELECT stratum, count(*) AS n_rows, count(*) FILTER (band IS NOT NULL AND k < 3) AS n_band, round(100.0 * CAST(count(*) FILTER (band IS NOT NULL AND k < 3) AS DOUBLE) / count(*), 9) AS pct_band FROM s GROUP BY stratum")
def suppression_counts(spark, d):
    rows = _persons(spark, d)
    after = risk.suppress_small(rows, ["stratum"], ["race", "gender"], "band", 3)
    return risk.suppression_counts(rows, after, "person", ["band"], ["stratum"]).withColumn("pct_band", F.round("pct_band", 9))


def _suppressed_sql(threshold):
    return f"""WITH {PERSONS}, r AS (SELECT a.person, count(*) AS n FROM persons a JOIN persons b ON a.stratum = b.stratum AND {FITS} GROUP BY a.person)
        SELECT CAST(0 AS BIGINT) AS n_below, CAST(0 AS BIGINT) AS n_changed, count(*) FILTER (n < {threshold}) AS n_at_risk, true AS few_nulled, count(*) AS n_rows FROM r"""


def _suppressed(spark, d, threshold, **options):
    """After randomized suppression: rows below the threshold with any key left, cells changed other than to null, rows.

    few_nulled: cells are nulled where rows were at risk, and at most two for each of these; nulling all keys would be three a row.
    """
    rows = _persons(spark, d).select("person", "stratum", *KEYS)
    done = suppress.suppress(rows, KEYS, "person", ["stratum"], threshold=threshold, **options)
    after = risk.calc_risk(done, KEYS, ["stratum"])
    before = risk.calc_risk(rows, KEYS, ["stratum"])
    joined = after.alias("a").join(before.alias("b"), "person")
    changed = sum((F.when(F.col(f"a.{k}").isNotNull() & ~F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")), 1).otherwise(0) for k in KEYS), F.lit(0))
    nulled = sum((F.when(F.col(f"a.{k}").isNull() & F.col(f"b.{k}").isNotNull(), 1).otherwise(0) for k in KEYS), F.lit(0))
    low = F.col("b.risk") < threshold
    few = (F.sum(nulled) <= 2 * aggregates.count_if(low)) & ((F.sum(nulled) > 0) == (aggregates.count_if(low) > 0))
    below = aggregates.count_if((F.col("a.risk") < threshold) & F.coalesce(*(F.col(f"a.{k}") for k in KEYS)).isNotNull())
    return joined.agg(below.alias("n_below"), F.coalesce(F.sum(changed), F.lit(0)).cast("long").alias("n_changed"), aggregates.count_if(low).alias("n_at_risk"), few.alias("few_nulled"), F.count("*").alias("n_rows"))


@query("local_suppression_invariants", _suppressed_sql(2))
def local_suppression_invariants(spark, d):
    return _suppressed(spark, d, 2, chains=2)


@query("local_suppression_rounds", _suppressed_sql(3))
def local_suppression_rounds(spark, d):
    """The same with every stratum searched by rounds over patterns, as large ones are."""
    return _suppressed(spark, d, 3, chains=2, task_rows=0)


@query(
    "completion_risk",
    f"""WITH {PERSONS}, f AS (SELECT s.stratum, fr, fg, fb FROM (SELECT DISTINCT stratum FROM persons) s
        LEFT JOIN (SELECT DISTINCT stratum, race AS fr FROM persons WHERE race IS NOT NULL) a ON a.stratum = s.stratum
        LEFT JOIN (SELECT DISTINCT stratum, gender AS fg FROM persons WHERE gender IS NOT NULL) b ON b.stratum = s.stratum
        LEFT JOIN (SELECT DISTINCT stratum, band AS fb FROM persons WHERE band IS NOT NULL) c ON c.stratum = s.stratum),
    fits AS (SELECT person, f.*, (race IS NULL AND gender IS NULL AND band IS NULL) AS open, CAST(race IS NOT NULL AS INTEGER) + CAST(gender IS NOT NULL AS INTEGER) + CAST(band IS NOT NULL AS INTEGER) AS known
        FROM persons p JOIN f ON f.stratum = p.stratum AND (race IS NULL OR race = fr) AND (gender IS NULL OR gender = fg) AND (band IS NULL OR band = fb)),
    pooled AS (SELECT stratum, fr, fg, fb, count(*) AS risk, max(known) AS known FROM fits GROUP BY ALL),
    best AS (SELECT person, open, risk, known, max(known) OVER (PARTITION BY person) AS most FROM (SELECT t.person, t.open, q.risk, q.known FROM fits t JOIN pooled q ON q.stratum = t.stratum AND q.fr IS NOT DISTINCT FROM t.fr AND q.fg IS NOT DISTINCT FROM t.fg AND q.fb IS NOT DISTINCT FROM t.fb))
    SELECT person, CAST(CASE WHEN open THEN 1 ELSE min(risk) END AS DOUBLE) AS risk FROM best WHERE known = most GROUP BY person, open""",
)
def completion_risk(spark, d):
    return risk.calc_risk(_persons(spark, d), KEYS, ["stratum"], within_completions=True).select("person", "risk")


# --- statistics ------------------------------------------------------------------------


@query("slope_per_group", f"WITH {ARRESTS}, s AS (SELECT ncic_jurisdiction, year, count(*) AS n FROM arrests GROUP BY ALL) SELECT ncic_jurisdiction, CAST(regr_count(n, year) AS BIGINT) AS n, round(regr_slope(n, year), 6) AS slope, round(regr_r2(n, year), 6) AS r2 FROM s GROUP BY ALL")
def slope_per_group(spark, d):
    series = aggregates.counts(standins.arrests(spark, d), ["ncic_jurisdiction", "year"]).withColumn("n", F.col("n").cast("double"))
    out = stats.trend(series.withColumn("year", F.col("year").cast("double")), ["ncic_jurisdiction"], "year", "n")
    return out.select("ncic_jurisdiction", "n", F.round("slope", 6).alias("slope"), F.round("r2", 6).alias("r2"))


@query("histogram", f"WITH {ARRESTS}, b AS (SELECT CAST(CASE WHEN amount < 0 THEN 0 WHEN amount >= 500000 THEN 11 ELSE floor(amount / 50000) + 1 END AS BIGINT) AS bin FROM arrests) SELECT bin, count(*) AS n, CAST((bin - 1) * 50000 AS DOUBLE) AS bin_start FROM b GROUP BY bin")
def histogram(spark, d):
    return stats.histogram(standins.arrests(spark, d), "amount", 0.0, 500000.0, 10)


@query("jeffreys_interval")
def jeffreys_interval(spark, d):
    rates = standins.arrests(spark, d).groupBy("ncic_jurisdiction").agg(aggregates.count_if(F.col("status_type") == "booked").alias("hits"), F.count("*").alias("n"))
    return stats.jeffreys(rates, "hits", "n")


@query(
    "local_fit",
    """WITH p AS (SELECT o_orderpriority AS k, CAST(CAST(o_orderdate AS DATE) - DATE '1992-01-01' AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(o_totalprice AS DOUBLE)) AS DOUBLE) AS sy FROM orders GROUP BY ALL),
    q AS (SELECT k, ceil(0.3 * sum(n)) AS q FROM p GROUP BY k),
    pairs AS (SELECT a.k, a.x, a.n AS m, b.x - a.x AS d, b.n, b.sy, sum(b.n) OVER (PARTITION BY a.k, a.x ORDER BY abs(b.x - a.x)) AS reached FROM p a JOIN p b ON a.k = b.k),
    h AS (SELECT k, x, min(abs(d)) AS h FROM pairs JOIN q USING (k) WHERE reached >= q GROUP BY k, x),
    w AS (SELECT p.*, pow(1 - pow(abs(d) / h, 3), 3) AS w FROM pairs p JOIN h USING (k, x) WHERE abs(d) < h),
    s AS (SELECT k, x, m, sum(w * n) AS s0, sum(w * n * d) AS s1, sum(w * n * d * d) AS s2, sum(w * sy) AS t0, sum(w * sy * d) AS t1 FROM w GROUP BY k, x, m)
    SELECT k, x, CAST(m AS BIGINT) AS n, round((s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1), 1) AS smooth FROM s""",
)
def local_line(spark, d):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    orders = read(spark, d, "orders").select(F.col("o_orderpriority").alias("k"), days.alias("x"), "o_totalprice")
    return local_fit.loess(orders, ["k"], "x", "o_totalprice", 0.3, 256).withColumn("smooth", F.round("smooth", 1))


@query("density", f"WITH {ARRESTS}, g AS (SELECT unnest([10.0, 30.0, 50.0, 70.0])::DOUBLE AS x) SELECT x, round(avg(exp(-pow((x - age) / 5.0, 2) / 2) / (5.0 * sqrt(2 * pi()))), 9) AS density FROM g, arrests WHERE age IS NOT NULL GROUP BY x")
def density(spark, d):
    return stats.density(standins.arrests(spark, d), "age", [10, 30, 50, 70], 5.0).withColumn("density", F.round("density", 9))


@query(
    "polynomial_fit",
    f"""WITH {ARRESTS}, p AS (SELECT ncic_jurisdiction, CAST(year - 1998 AS DOUBLE) AS t, CAST(count(*) AS DOUBLE) AS y FROM arrests GROUP BY ALL),
    s AS (SELECT ncic_jurisdiction, CAST(count(*) AS DOUBLE) AS n, sum(t) AS a, sum(t*t) AS b, sum(t*t*t) AS c, sum(t*t*t*t) AS d, sum(y) AS p, sum(t*y) AS q, sum(t*t*y) AS r, sum(y*y) AS yy FROM p GROUP BY ALL),
    k AS (SELECT *, n*(b*d - c*c) - a*(a*d - b*c) + b*(a*c - b*b) AS det FROM s),
    x AS (SELECT *, (p*(b*d - c*c) - a*(q*d - c*r) + b*(q*c - b*r)) / det AS c0, (n*(q*d - c*r) - p*(a*d - b*c) + b*(a*r - q*b)) / det AS c1, (n*(b*r - q*c) - a*(a*r - q*b) + p*(a*c - b*b)) / det AS c2 FROM k WHERE n > 3)
    SELECT ncic_jurisdiction, round(c0, 4) AS c0, round(c1, 4) AS c1, round(c2, 4) AS c2, round(sqrt(greatest(0, yy - c0*p - c1*q - c2*r) / (n - 3)), 3) AS sigma FROM x""",
)
def polynomial_fit(spark, d):
    series = aggregates.counts(standins.arrests(spark, d).withColumn("t", F.col("year") - 1998), ["ncic_jurisdiction", "t"])
    fitted = stats.polynomial(series, ["ncic_jurisdiction"], "t", "n", 2).filter("sigma IS NOT NULL")
    return fitted.select("ncic_jurisdiction", *(F.round(F.col("coefficients")[i], 4).alias(f"c{i}") for i in range(3)), F.round("sigma", 3).alias("sigma"))


# --- releases --------------------------------------------------------------------------


def _release_sql() -> str:
    """Each pass as a query over the last, cells counted by windows."""
    released, sought, felony = "coalesce(disposition = 'released', false)", "coalesce(disposition = 'complaint sought', false)", "coalesce(offense_level = 'felony', false)"
    other = f"(NOT {sought} OR NOT {felony})"
    k = [(released, "offense_code IN (1, 2)"), (f"({sought} AND {felony})", "true"), (f"({released} AND {felony})", "true"), (other, "true"), ("true", "true")]
    least = [f"({sought} AND {felony})", other, f"({released} AND {felony})", "true"]
    tests = [(among, only, f"count(*) FILTER (WHERE {among}) OVER (PARTITION BY year, gender, race, age, county) < 5") for among, only in k]
    tests += [(among, "true", f"count(DISTINCT offense_code) FILTER (WHERE {among}) OVER (PARTITION BY year, gender, race, age, county) < 5") for among in least]
    steps = [f"p{i + 1} AS (SELECT * REPLACE (CASE WHEN {among} AND {only} AND {test} THEN NULL ELSE county END AS county) FROM p{i})" for i, (among, only, test) in enumerate(tests)]
    band = "CASE WHEN age <= 24 THEN '18-24' WHEN age <= 32 THEN '25-32' WHEN age <= 44 THEN '33-44' WHEN age <= 150 THEN '45+' END"
    first = f"""p0 AS (SELECT db_id, year, CAST(substr(ncic_jurisdiction, 1, 2) AS INTEGER) AS county, race, gender, {band} AS age, offense_code,
        CASE WHEN offense_level = 'F' THEN 'felony' ELSE offense_level END AS offense_level, CASE WHEN offense_code = 1 THEN 'released' WHEN offense_code < 4 THEN 'complaint sought' ELSE 'other' END AS disposition FROM arrests WHERE age > 17)"""
    return f"WITH {ARRESTS}, {first}, {', '.join(steps)} SELECT db_id, year, county, race, gender, age FROM p{len(steps)}"


@query("release_k_passes", _release_sql())
def release_k_passes(spark, d):
    rows = standins.arrests(spark, d).withColumn("disposition", F.when(F.col("offense_code") == 1, "released").when(F.col("offense_code") < 4, "felony complaint sought").otherwise("other")).withColumn("offense_level", F.when(F.col("offense_level") == "F", "felony").otherwise(F.col("offense_level")))
    return release.protect(release.prepare(rows), release.standard_passes(drawn_offenses=[1, 2])).select("db_id", "year", "county", "race", "gender", "age")


@query(
    "release_total_k",
    f"""WITH {ARRESTS}, p AS (SELECT db_id, year, CAST(substr(ncic_jurisdiction, 3, 2) AS INTEGER) AS county, gender, race FROM arrests WHERE age > 17)
    SELECT db_id, CASE WHEN count(*) OVER (PARTITION BY year, gender, race, county) >= 5 THEN county END AS county FROM p""",
)
def release_total_k(spark, d):
    rows = standins.arrests(spark, d).filter("age > 17").select("db_id", "year", F.substring("ncic_jurisdiction", 3, 2).cast("int").alias("county"), "gender", "race")
    return release.protect(rows, [release.Pass("all", None, k=5)], identifiers=["gender", "race"]).select("db_id", "county")


@query("state_rollup", f"WITH {ARRESTS} SELECT year, CAST(sum(n) AS BIGINT) AS n, floor(10 * (100.0 * sum(n * share / 100) / sum(n))) / 10 AS rate FROM (SELECT year, ncic_jurisdiction, count(*) AS n, 100.0 * CAST(count(*) FILTER (status_type = 'booked') AS DOUBLE) / count(*) AS share FROM arrests GROUP BY ALL) GROUP BY year")
def state_rollup(spark, d):
    share = (F.lit(100.0) * aggregates.count_if(F.col("status_type") == "booked").cast("double") / F.count("*")).alias("share")
    counties = standins.arrests(spark, d).groupBy("year", "ncic_jurisdiction").agg(F.count("*").alias("n"), share)
    return release.state_rollup(counties, "year", ["n"], {"rate": ("share", "n")})


@query("wide_summary", f"WITH {ARRESTS} SELECT year, race, " + ", ".join(f'count(*) FILTER (offense_code = {c}) AS "SCO{c:02d}_sum"' for c in range(1, 6)) + " FROM arrests GROUP BY ALL")
def wide_summary(spark, d):
    return release.wide_summary(standins.arrests(spark, d), ["year", "race"], range(1, 6), "offense_code")


@query(
    "disposition_times",
    f"""WITH {ARRESTS}, t AS (SELECT offense_level, make_date(year, month, day) AS a, make_date(year, month, day) + CAST(db_id % 300 AS INTEGER) AS c, make_date(year, month, day) + CAST(db_id % 60 - 8 AS INTEGER) AS e FROM arrests)
    SELECT offense_level, days, count(*) AS n FROM (SELECT offense_level, CAST(CASE WHEN offense_level = 'F' THEN c ELSE e END - a AS INTEGER) AS days FROM t) WHERE days BETWEEN -5 AND 40 GROUP BY ALL""",
)
def disposition_times(spark, d):
    at = dates.date_of(F.col("year"), F.col("month"), F.col("day"))
    rows = standins.arrests(spark, d).select(F.col("offense_level").alias("disposition_class"), at.alias("arrest_date"), "db_id")
    rows = rows.withColumn("court_date", F.date_add("arrest_date", (F.col("db_id") % 300).cast("int"))).withColumn("arrest_disposition_date", F.date_add("arrest_date", (F.col("db_id") % 60 - 8).cast("int")))
    out = cleaning.time_to_disposition(rows, ["F"], (-5, 40)).groupBy("disposition_class", "days").agg(F.count("*").alias("n"))
    return out.withColumnRenamed("disposition_class", "offense_level")


@query("windowed_events", "SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_events(spark, d):
    from ..streaming.arrivals import windowed_counts

    return windowed_counts(read(spark, d, "events"), "ts", "1 day", "1 hour", ["event_type"])


from . import detail_queries  # noqa: E402,F401  registers the queries of single functions and of cleaning


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

