"""Queries of single functions, of cleaning and of the disposition reports, with the SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, parsing, predicates, recode
from ..operators import aggregates, joins, ordering, profile, reshape
from ..sources import text_tables
from . import cleaning, release, reports, standins, summaries
from .registry import OFFENSE, query
from .standins import ARRESTS, LINE_YEARS, read


# Fixed values, written out apart from the tables that the library uses, so that a change there shows.
RACES_SQL = """CASE code
    WHEN '1' THEN 'White' WHEN '2' THEN 'Hispanic' WHEN '3' THEN 'Black' WHEN '4' THEN 'American Indian'
    WHEN '5' THEN 'Chinese' WHEN '6' THEN 'Japanese' WHEN '7' THEN 'Filipino' WHEN '8' THEN 'Other'
    WHEN '9' THEN 'Pacific Islander' WHEN 'A' THEN 'Other Asian' WHEN 'B' THEN 'Black' WHEN 'C' THEN 'Chinese'
    WHEN 'D' THEN 'Cambodian' WHEN 'F' THEN 'Filipino' WHEN 'G' THEN 'Guamanian' WHEN 'H' THEN 'Hispanic'
    WHEN 'I' THEN 'American Indian' WHEN 'J' THEN 'Japanese' WHEN 'K' THEN 'Korean' WHEN 'L' THEN 'Laotian'
    WHEN 'O' THEN 'Other' WHEN 'P' THEN 'Pacific Islander' WHEN 'S' THEN 'Samoan' WHEN 'U' THEN 'Hawaiian'
    WHEN 'V' THEN 'Vietnamese' WHEN 'W' THEN 'White' WHEN 'Z' THEN 'Asian Indian' END"""
GROUPS_SQL = """CASE county
    WHEN 'Alpine' THEN 'Alpine/Tuolumne/Calaveras/Amador' WHEN 'Tuolumne' THEN 'Alpine/Tuolumne/Calaveras/Amador' WHEN 'Calaveras' THEN 'Alpine/Tuolumne/Calaveras/Amador' WHEN 'Amador' THEN 'Alpine/Tuolumne/Calaveras/Amador'
    WHEN 'Colusa' THEN 'Colusa/Glenn/Yuba/Sutter/Lake' WHEN 'Glenn' THEN 'Colusa/Glenn/Yuba/Sutter/Lake' WHEN 'Yuba' THEN 'Colusa/Glenn/Yuba/Sutter/Lake' WHEN 'Sutter' THEN 'Colusa/Glenn/Yuba/Sutter/Lake'
    WHEN 'Lake' THEN 'Colusa/Glenn/Yuba/Sutter/Lake' WHEN 'Sierra' THEN 'Sierra/Plumas/Lassen/Modoc/Nevada' WHEN 'Plumas' THEN 'Sierra/Plumas/Lassen/Modoc/Nevada' WHEN 'Lassen' THEN 'Sierra/Plumas/Lassen/Modoc/Nevada'
    WHEN 'Modoc' THEN 'Sierra/Plumas/Lassen/Modoc/Nevada' WHEN 'Nevada' THEN 'Sierra/Plumas/Lassen/Modoc/Nevada' WHEN 'Inyo' THEN 'Inyo/Mono/Mariposa/Madera/San Benito' WHEN 'Mono' THEN 'Inyo/Mono/Mariposa/Madera/San Benito'
    WHEN 'Mariposa' THEN 'Inyo/Mono/Mariposa/Madera/San Benito' WHEN 'Madera' THEN 'Inyo/Mono/Mariposa/Madera/San Benito' WHEN 'San Benito' THEN 'Inyo/Mono/Mariposa/Madera/San Benito' WHEN 'Trinity' THEN 'Trinity/Del Norte/Siskiyou/Tehama'
    WHEN 'Del Norte' THEN 'Trinity/Del Norte/Siskiyou/Tehama' WHEN 'Siskiyou' THEN 'Trinity/Del Norte/Siskiyou/Tehama' WHEN 'Tehama' THEN 'Trinity/Del Norte/Siskiyou/Tehama' WHEN 'Kern' THEN 'Kern'
    WHEN 'Napa' THEN 'Napa' END"""
DISPOSITIONS_SQL = """CASE code
    WHEN '10' THEN 'Dismissed' WHEN '12' THEN 'Transferred' WHEN '13' THEN 'Remanded to Adult Court' WHEN '14' THEN 'Deported'
    WHEN '15' THEN 'Traffic Court' WHEN '16' THEN 'Direct File - Adult Court' WHEN '20' THEN 'Informal Probation (654 WI)' WHEN '21' THEN 'Informal Probation (654.2 WI)'
    WHEN '30' THEN 'Non-Ward Probation (725(a) WI)' WHEN '40' THEN 'Wardship (Own/Relative''s Home)' WHEN '41' THEN 'Wardship (Non-secure County Facility)' WHEN '42' THEN 'Wardship (Secure County Facility - Includes Electronic Monitoring)'
    WHEN '43' THEN 'Wardship (Other Public Facility)' WHEN '44' THEN 'Wardship (Private Facility)' WHEN '49' THEN 'Wardship (Other)' WHEN '50' THEN 'Wardship (CYA)'
    WHEN '60' THEN 'Diversion' WHEN '61' THEN 'Deferred Entry of Judgment' END"""


# --- text, numbers and dates -----------------------------------------------------------


@query(
    "text_fields",
    """SELECT o_orderkey, split_part(o_orderpriority || '''' || o_orderstatus || '''x', '''', 2) AS quoted, nullif(trim(CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE ' ' || o_orderstatus || '  ' END), '') AS trimmed,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS DOUBLE) / 2 END AS number, CASE WHEN o_orderkey % 2 = 0 THEN 'a b' ELSE 'ab' END AS shown FROM orders""",
)
def text_fields(spark, d):
    key = F.col("o_orderkey")
    text = F.when(key % 3 == 0, F.concat(F.lit(" "), (key.cast("double") / 2).cast("string"))).otherwise(F.concat(key.cast("string"), F.lit("?")))
    return read(spark, d, "orders").select(
        "o_orderkey",
        parsing.between_quotes(F.concat("o_orderpriority", F.lit("'"), "o_orderstatus", F.lit("'x"))).alias("quoted"),
        parsing.trimmed(F.when(key % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit(" \t")))).alias("trimmed"),
        parsing.quiet_number(text).alias("number"),
        parsing.printable(F.when(key % 2 == 0, F.concat(F.lit("a"), F.lit("\u0000"), F.lit("b"))).otherwise("ab")).alias("shown"),
    )


@query(
    "checked_dates",
    """SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderkey % 7 = 0 THEN '02/30/1996' ELSE strftime(o_orderdate, '%m/%d/%Y') END, '%m/%d/%Y') AS DATE) AS slashed,
    CAST(try_strptime(CASE WHEN o_orderkey % 11 = 0 THEN '19961301' ELSE strftime(o_orderdate, '%Y%m%d') END, '%Y%m%d') AS DATE) AS compact FROM orders""",
)
def checked_dates(spark, d):
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    return read(spark, d, "orders").select(
        "o_orderkey",
        dates.date_from(F.when(key % 7 == 0, "02/30/1996").otherwise(F.date_format(date, "MM/dd/yyyy")), "MM/dd/yyyy").alias("slashed"),
        dates.compact_date(F.when(key % 11 == 0, "19961301").otherwise(F.date_format(date, "yyyyMMdd"))).alias("compact"),
    )


@query("race_codes", f"SELECT code, {RACES_SQL} AS label, count(*) AS n FROM (SELECT substr('12345678 9ABCDFGHIJKLOPSUVWXZ', CAST(c_custkey % 29 + 1 AS INTEGER), 1) AS code FROM customer) GROUP BY ALL")
def race_codes(spark, d):
    code = F.expr("substring('12345678 9ABCDFGHIJKLOPSUVWXZ', CAST(c_custkey % 29 + 1 AS INT), 1)")
    coded = read(spark, d, "customer").select(code.alias("code"))
    return aggregates.counts(coded.withColumn("label", recode.race_label(F.col("code"))), ["code", "label"])


_COUNTIES = [*(c for g in recode.COUNTY_GROUPS for c in g), "Kern", "Napa"]


@query("county_groups", f"SELECT county, {GROUPS_SQL} AS grouped, count(*) AS n FROM (SELECT [{', '.join(repr(c) for c in _COUNTIES)}][CAST(s_suppkey % {len(_COUNTIES)} + 1 AS INTEGER)] AS county FROM supplier) GROUP BY ALL")
def county_groups(spark, d):
    names = F.array(*(F.lit(c) for c in _COUNTIES))
    county = F.element_at(names, (F.col("s_suppkey") % len(_COUNTIES) + 1).cast("int"))
    named = read(spark, d, "supplier").select(county.alias("county"))
    return aggregates.counts(named.withColumn("grouped", recode.county_group(F.concat("county", F.lit(" County")))), ["county", "grouped"])


@query("flags_with_null", f"WITH {ARRESTS}, f AS (SELECT year, CASE WHEN race IS NOT NULL THEN status_type = 'booked' END AS flag FROM arrests) SELECT year, count(*) FILTER (flag IS TRUE) AS n_true, count(*) FILTER (flag IS FALSE) AS n_false, count(*) FILTER (flag IS NULL) AS n_unknown FROM f GROUP BY year")
def flags_with_null(spark, d):
    rows = standins.arrests(spark, d).withColumn("flag", F.when(F.col("race").isNotNull(), F.col("status_type") == "booked"))
    count = aggregates.count_if
    return rows.groupBy("year").agg(count(predicates.is_true(F.col("flag"))).alias("n_true"), count(predicates.is_false(F.col("flag"))).alias("n_false"), count(F.col("flag").isNull()).alias("n_unknown"))


@query("half_even", "SELECT l_orderkey, l_linenumber, l_partkey, round_even(CAST(l_quantity AS DOUBLE) / 4, 0) AS whole, round_even(CAST(l_partkey AS DOUBLE) / 8, 1) AS tenth FROM lineitem")
def half_even(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.bround(F.col("l_quantity").cast("double") / 4, 0).alias("whole"), F.bround(F.col("l_partkey").cast("double") / 8, 1).alias("tenth"))


@query("magnitudes", "SELECT CAST(CASE WHEN n >= 100000 THEN 100000 WHEN n >= 10000 THEN 10000 WHEN n >= 1000 THEN 1000 WHEN n >= 100 THEN 100 WHEN n >= 10 THEN 10 WHEN n >= 1 THEN 1 ELSE 0 END AS INTEGER) AS magnitude, count(*) AS n_parts FROM (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY ALL) GROUP BY 1")
def magnitudes(spark, d):
    used = read(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").cast("long").alias("n"))
    return used.groupBy(recode.magnitude(F.col("n")).alias("magnitude")).agg(F.count("*").alias("n_parts"))


# --- rows, columns and names -----------------------------------------------------------


@query("without_positions", "SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS nth FROM events) WHERE nth NOT IN (1, 2, 500)")
def without_positions(spark, d):
    return ordering.without_positions(read(spark, d, "events"), ["ts", "event_id"], [1, 2, 500]).select("event_id", "user_id", "event_type")


@query("name_sets", "(SELECT p_brand AS name, 'left only' AS side FROM part WHERE p_size < 10 EXCEPT SELECT p_brand, 'left only' FROM part WHERE p_size > 45) UNION ALL (SELECT p_brand, 'either' FROM part WHERE p_size < 10 UNION SELECT p_brand, 'either' FROM part WHERE p_size > 45)")
def name_sets(spark, d):
    small, large = (read(spark, d, "part").filter(c).select(F.col("p_brand").alias("name")) for c in ("p_size < 10", "p_size > 45"))
    return reshape.only_left(small, large).withColumn("side", F.lit("left only")).union(reshape.either(small, large).withColumn("side", F.lit("either")))


@query("transposed_counts", f"WITH {ARRESTS} SELECT CAST(year AS VARCHAR) AS period, " + ", ".join(f"count(*) FILTER (offense_level = '{v}') AS {v}" for v in "FOP") + " FROM arrests GROUP BY year")
def transposed_counts(spark, d):
    by_level = reshape.crosstab(standins.arrests(spark, d), ["offense_level"], "year", range(1990, 2003), "")
    years = [c for c in by_level.columns if c != "offense_level"]
    return reshape.transposed(by_level, "offense_level", list("FOP"), years, "period").filter("F + O + P > 0")


@query("composite_sums", f"WITH {ARRESTS} SELECT year, count(*) FILTER (offense_code IN (1, 2)) AS grave, count(*) FILTER (offense_code IN (3, 4, 5)) AS other FROM arrests GROUP BY year")
def composite_sums(spark, d):
    wide = release.wide_summary(standins.arrests(spark, d), ["year"], range(1, 6), "offense_code")
    return wide.select("year", aggregates.composite(["SCO01_sum", "SCO02_sum"]).alias("grave"), aggregates.composite(["SCO03_sum", "SCO04_sum", "SCO05_sum"]).alias("other"))


@query("blocks_side_by_side", f"WITH {ARRESTS} SELECT year, " + ", ".join([*(f"count(*) FILTER (gender = '{g}') AS gender_{g}" for g in ("female", "male")), *(f"count(*) FILTER (status_type = '{s}') AS status_{s}" for s in ("booked", "cited"))]) + " FROM arrests GROUP BY year")
def blocks_side_by_side(spark, d):
    return aggregates.side_by_side(standins.arrests(spark, d), ["year"], {"gender": ("gender", ["female", "male"]), "status": ("status_type", ["booked", "cited"])})


@query("group_maximum", f"WITH {ARRESTS} SELECT db_id, max(amount) OVER (PARTITION BY ncic_jurisdiction) AS largest FROM arrests")
def group_maximum(spark, d):
    return joins.with_group_max(standins.arrests(spark, d), ["ncic_jurisdiction"], "amount", "largest").select("db_id", "largest")


@query("permuted_keys", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS n_old, count(DISTINCT o_custkey) AS n_new, CAST(1 AS BIGINT) AS least, count(DISTINCT o_custkey) AS most FROM (SELECT DISTINCT o_custkey FROM orders)")
def permuted_keys(spark, d):
    """The permutation differs by seed; what it must hold is that it is one."""
    map_ = joins.permuted_keys(read(spark, d, "orders"), "o_custkey", 7)
    return map_.agg(F.count("*").alias("n"), F.countDistinct("old").alias("n_old"), F.countDistinct("new").alias("n_new"), F.min("new").alias("least"), F.max("new").alias("most"))


@query("top_codes", f"WITH {LINE_YEARS}, a AS (SELECT brand AS code, count(*) AS n FROM line_years WHERE l_returnflag = 'R' GROUP BY ALL), b AS (SELECT brand AS code, count(*) AS n FROM line_years WHERE l_returnflag = 'A' GROUP BY ALL) SELECT coalesce(a.code, b.code) AS code, coalesce(a.n, 0) AS n_first, coalesce(b.n, 0) AS n_second, 'brand ' || substr(coalesce(a.code, b.code), 7) AS meaning FROM a FULL JOIN b ON a.code = b.code WHERE a.n > 60 OR b.n > 60")
def top_codes(spark, d):
    lines = standins.line_years(spark, d).withColumnRenamed("brand", "code")
    first, second = (aggregates.counts(lines.filter(F.col("l_returnflag") == f), ["code"]) for f in "RA")
    names = read(spark, d, "part").select(F.col("p_brand").alias("code"), F.concat(F.lit("brand "), F.expr("substring(p_brand, 7)")).alias("meaning")).distinct()
    return joins.decode(reshape.frequent_codes(first, second, 60), names, "code")


@query("named_frequencies", "SELECT o_orderstatus AS code, count(*) AS n, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS name FROM orders GROUP BY o_orderstatus")
def named_frequencies(spark, d):
    names = spark.createDataFrame([("F", "finished"), ("O", "open")], "code string, name string")
    return profile.frequencies(read(spark, d, "orders").withColumnRenamed("o_orderstatus", "code"), "code", names)


@query("variable_summary", f"WITH {ARRESTS} SELECT CAST(min(age) AS DOUBLE) AS minimum, quantile_cont(age, 0.25) AS lower_quartile, quantile_cont(age, 0.5) AS median, round(avg(age), 9) AS mean, quantile_cont(age, 0.75) AS upper_quartile, CAST(max(age) AS DOUBLE) AS maximum FROM arrests")
def variable_summary(spark, d):
    return profile.variable_summary(standins.arrests(spark, d), "age").withColumn("mean", F.round("mean", 9))


# --- cleaning --------------------------------------------------------------------------

RAW_ARRESTS = f"""{ARRESTS}, raw AS (SELECT db_id, year AS arrest_year, month AS arrest_month, CASE WHEN db_id % 29 = 0 THEN 31 ELSE day END AS arrest_day,
    CASE WHEN db_id % 4 = 0 THEN age END AS age, CASE WHEN db_id % 3 = 0 THEN race || CASE WHEN db_id % 2 = 0 THEN '_a' ELSE '_x_y' END END AS race, CASE WHEN db_id % 2 = 0 THEN gender END AS gender,
    CASE WHEN db_id % 7 = 0 THEN '     ' ELSE '0' || ncic_jurisdiction END AS bcs_jurisdiction, CASE WHEN db_id % 5 = 0 THEN '    ' WHEN db_id % 11 = 0 THEN '  ' || chr(127) || chr(127) ELSE ncic_jurisdiction END AS ncic_jurisdiction,
    CASE WHEN db_id % 6 = 0 THEN '    ' ELSE ' ' || offense_level || ' ' END AS fbi_offense_code, 'level_' || offense_level AS offense_level, status_type || '_so_far' AS disposition FROM arrests)"""


@query(
    "clean_arrests",
    f"""WITH {RAW_ARRESTS} SELECT db_id, replace(regexp_replace(race, '_[a-z]$', ''), '_', ' ') AS race, gender, nullif(bcs_jurisdiction, '     ') AS bcs_jurisdiction,
    CASE WHEN ncic_jurisdiction NOT IN ('    ', '  ' || chr(127) || chr(127)) THEN ncic_jurisdiction END AS ncic_jurisdiction, trim(nullif(fbi_offense_code, '    ')) AS fbi_offense_code,
    replace(offense_level, '_', ' ') AS offense_level, replace(disposition, '_', ' ') AS disposition, CAST(try_strptime(printf('%04d-%02d-%02d', arrest_year, arrest_month, arrest_day), '%Y-%m-%d') AS DATE) AS arrest_date
    FROM raw WHERE age IS NOT NULL OR race IS NOT NULL OR gender IS NOT NULL""",
)
def clean_arrests(spark, d):
    id_ = F.col("db_id")
    rows = standins.arrests(spark, d)
    raw = rows.select(
        "db_id",
        F.col("year").alias("arrest_year"),
        F.col("month").alias("arrest_month"),
        F.when(id_ % 29 == 0, 31).otherwise(F.col("day")).alias("arrest_day"),
        F.when(id_ % 4 == 0, F.col("age")).alias("age"),
        F.when(id_ % 3 == 0, F.concat("race", F.when(id_ % 2 == 0, "_a").otherwise("_x_y"))).alias("race"),
        F.when(id_ % 2 == 0, F.col("gender")).alias("gender"),
        F.when(id_ % 7 == 0, "     ").otherwise(F.concat(F.lit("0"), "ncic_jurisdiction")).alias("bcs_jurisdiction"),
        F.when(id_ % 5 == 0, "    ").when(id_ % 11 == 0, "  \x7f\x7f").otherwise(F.col("ncic_jurisdiction")).alias("ncic_jurisdiction"),
        F.when(id_ % 6 == 0, "    ").otherwise(F.concat(F.lit(" "), "offense_level", F.lit(" "))).alias("fbi_offense_code"),
        F.concat(F.lit("level_"), "offense_level").alias("offense_level"),
        F.concat("status_type", F.lit("_so_far")).alias("disposition"),
    )
    return cleaning.clean_arrests(raw).select("db_id", "race", "gender", "bcs_jurisdiction", "ncic_jurisdiction", "fbi_offense_code", "offense_level", "disposition", "arrest_date")


RAW_DISPOSITIONS = f"""{ARRESTS}, raw AS (SELECT db_id, CASE WHEN db_id % 2 = 0 THEN year - 1900 ELSE year END AS court_year, CASE WHEN db_id % 9 = 0 THEN 0 ELSE month END AS court_month, day AS court_day,
    CASE WHEN db_id % 3 = 0 AND year < 2000 THEN year - 1900 ELSE year END AS arrest_year, month AS arrest_month, CASE WHEN db_id % 10 = 0 THEN 0 ELSE 1 END AS arrest_day,
    CASE WHEN db_id % 13 = 0 THEN 99 ELSE db_id % 80 END AS birth_year, CASE WHEN db_id % 13 = 0 THEN 99 ELSE db_id % 13 END AS birth_month, CASE WHEN db_id % 13 = 0 THEN 99 ELSE db_id % 28 END AS birth_day FROM arrests)"""


@query(
    "clean_dispositions",
    f"""WITH {RAW_DISPOSITIONS}, a AS (SELECT * REPLACE (CASE WHEN court_year < 100 THEN court_year + 1900 ELSE court_year END AS court_year, CASE WHEN arrest_year < 101 THEN arrest_year + 1900 ELSE arrest_year END AS arrest_year) FROM raw),
    b AS (SELECT * REPLACE (CASE WHEN birth_year >= 100 THEN birth_year WHEN birth_year - (court_year - 1900) > 3 THEN birth_year + 1800 ELSE birth_year + 1900 END AS birth_year) FROM a),
    c AS (SELECT *, (birth_year = 1899 AND birth_month = 99 AND birth_day = 99) AS gone FROM b),
    e AS (SELECT db_id, court_year, nullif(court_month, 0) AS court_month, nullif(court_day, 0) AS court_day, arrest_year, nullif(arrest_month, 0) AS arrest_month, nullif(arrest_day, 0) AS arrest_day,
        CASE WHEN NOT gone AND birth_year <> 0 THEN birth_year END AS birth_year, CASE WHEN NOT gone AND birth_month <> 0 THEN birth_month END AS birth_month, CASE WHEN NOT gone AND birth_day <> 0 THEN birth_day END AS birth_day FROM c)
    SELECT db_id, court_year, birth_year, birth_month, birth_day, arrest_year - birth_year - CASE WHEN arrest_month < birth_month THEN 1 ELSE 0 END AS age,
        CAST(try_strptime(printf('%04d-%02d-%02d', court_year, court_month, court_day), '%Y-%m-%d') AS DATE) - CAST(try_strptime(printf('%04d-%02d-%02d', arrest_year, arrest_month, arrest_day), '%Y-%m-%d') AS DATE) AS days_to_disposition FROM e""",
)
def clean_dispositions(spark, d):
    id_, rows = F.col("db_id"), standins.arrests(spark, d)
    lost = id_ % 13 == 0
    raw = rows.select(
        "db_id",
        F.when(id_ % 2 == 0, F.col("year") - 1900).otherwise(F.col("year")).alias("court_year"),
        F.when(id_ % 9 == 0, 0).otherwise(F.col("month")).alias("court_month"),
        F.col("day").alias("court_day"),
        F.when((id_ % 3 == 0) & (F.col("year") < 2000), F.col("year") - 1900).otherwise(F.col("year")).alias("arrest_year"),
        F.col("month").alias("arrest_month"),
        F.when(id_ % 10 == 0, 0).otherwise(1).alias("arrest_day"),
        F.when(lost, 99).otherwise((id_ % 80).cast("int")).alias("birth_year"),
        F.when(lost, 99).otherwise((id_ % 13).cast("int")).alias("birth_month"),
        F.when(lost, 99).otherwise((id_ % 28).cast("int")).alias("birth_day"),
    )
    return cleaning.clean_dispositions(raw).select("db_id", "court_year", "birth_year", "birth_month", "birth_day", "age", "days_to_disposition")


_CODES = [*recode.JUVENILE_DISPOSITIONS, "11"]


@query("juvenile_referrals", f"SELECT referral_source, detention, {DISPOSITIONS_SQL} AS disposition, referral_county_name, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 3 = 2 THEN 'School' ELSE 'Law Enforcement Agency' END AS referral_source, CASE WHEN c_custkey % 5 < 2 THEN 'Detained - Secure Facility' ELSE 'Not Detained' END AS detention, [{', '.join(repr(c) for c in _CODES)}][CAST(c_custkey % {len(_CODES)} + 1 AS INTEGER)] AS code, c_mktsegment AS referral_county_name FROM customer) GROUP BY ALL")
def juvenile_referrals(spark, d):
    id_ = F.col("c_custkey")
    raw = read(spark, d, "customer").select(
        F.when(id_ % 3 == 0, "Lae Enforcement Agency").when(id_ % 3 == 1, "Law Enforcement Agency").otherwise("School").alias("referral_source"),
        F.when(id_ % 5 == 0, "Detained-Secure Facility").when(id_ % 5 == 1, "Detained - Secure Facility").otherwise("Not Detained").alias("detention"),
        F.element_at(F.array(*map(F.lit, _CODES)), (id_ % len(_CODES) + 1).cast("int")).alias("code"),
        F.col("c_mktsegment").alias("county_desc"),
        F.lit("x").alias("fitness_hearing_out_desc"),
    )
    merged = cleaning.merge_spellings(raw).withColumn("disposition", recode.juvenile_disposition(F.col("code")))
    return aggregates.counts(merged, ["referral_source", "detention", "disposition", "referral_county_name"])


@query("usage_rules", f"WITH {ARRESTS} SELECT CASE WHEN offense_code < 3 THEN 'complaint sought' ELSE summary_code END AS disposition, count(*) AS n FROM arrests WHERE age > 5 AND age < 60 GROUP BY ALL")
def usage_rules(spark, d):
    rows = summaries.age_at_risk(standins.arrests(spark, d), 5, 60)
    said = F.when(F.col("offense_code") == 1, "felony complaint sought").when(F.col("offense_code") == 2, "misdemeanor complaint sought").otherwise(F.col("summary_code"))
    return aggregates.counts(rows.select(summaries.complaint_sought(said).alias("disposition")), ["disposition"])


# --- reports on dispositions and bookings ----------------------------------------------

DISPOSED = f"""{ARRESTS}, disposed AS (SELECT ncic_jurisdiction AS agency, year, coalesce(CASE WHEN offense_code > 2 THEN 'crt' END, CASE WHEN offense_code = 1 THEN 'lea' WHEN person % 7 > 0 THEN 'da' END) AS class FROM arrests)"""
SHARES = f"""{DISPOSED}, shares AS (SELECT agency, year, count(*) AS n, """ + ", ".join(f"100.0 * CAST(count(*) FILTER (class = '{c}') AS DOUBLE) / count(*) AS {c}" for c in reports.CLASSES) + " FROM disposed WHERE class IS NOT NULL GROUP BY ALL)"


def _disposed(spark, d):
    court = F.when(F.col("offense_code") > 2, "crt")
    arrest = F.when(F.col("offense_code") == 1, "lea").when(F.col("person") % 7 > 0, "da")
    return standins.arrests(spark, d).select(F.col("ncic_jurisdiction").alias("agency"), "year", reports.disposition_class(court, arrest).alias("class"))


@query("disposition_shares", f"WITH {SHARES} SELECT agency, year, n, " + ", ".join(f"round({c}, 9) AS {c}" for c in reports.CLASSES) + " FROM shares")
def disposition_shares(spark, d):
    shares = reports.disposition_shares(_disposed(spark, d), ["agency", "year"])
    return shares.select("agency", "year", "n", *(F.round(c, 9).alias(c) for c in reports.CLASSES))


_DISPOSITIONS = [*reports.COURT, *reports.RELEASED, *reports.DECLINED, "pending"]


@query(
    "disposition_classes",
    f"""WITH {ARRESTS}, named AS (SELECT ncic_jurisdiction AS agency, CASE WHEN db_id % 3 > 0 THEN [{', '.join(map(repr, _DISPOSITIONS))}][CAST(db_id % 26 + 1 AS INTEGER)] END AS court, CASE WHEN db_id % 5 > 0 THEN [{', '.join(map(repr, _DISPOSITIONS))}][CAST(db_id % 7 + 8 AS INTEGER)] END AS arrest FROM arrests)
    SELECT agency, CASE WHEN d IN ('acquitted', 'certified_to_juvenile_court', 'convicted', 'defendant_deceased', 'dismissed', 'diversion_dismissed', 'not_guilty_insane') THEN 'crt' WHEN d LIKE 'lea\\_rel\\_%' ESCAPE '\\' THEN 'lea' WHEN d LIKE 'da\\_dec\\_%' ESCAPE '\\' THEN 'da' ELSE d END AS class, count(*) AS n
    FROM (SELECT agency, coalesce(court, arrest) AS d FROM named) GROUP BY ALL""",
)
def disposition_classes(spark, d):
    id_, named = F.col("db_id"), F.array(*map(F.lit, _DISPOSITIONS))
    court = F.when(id_ % 3 > 0, F.element_at(named, (id_ % len(_DISPOSITIONS) + 1).cast("int")))
    arrest = F.when(id_ % 5 > 0, F.element_at(named, (id_ % 7 + 8).cast("int")))
    classes = reports.classified(reports.disposition_class(court, arrest))
    return aggregates.counts(standins.arrests(spark, d).select(F.col("ncic_jurisdiction").alias("agency"), classes.alias("class")), ["agency", "class"])


@query("median_shares_ranked", f"WITH {SHARES}, m AS (SELECT agency, round(median(crt), 9) AS median FROM shares GROUP BY agency) SELECT agency, median, row_number() OVER (ORDER BY median, agency) AS from_least, row_number() OVER (ORDER BY median DESC, agency) AS from_most FROM m")
def median_shares_ranked(spark, d):
    shares = reports.disposition_shares(_disposed(spark, d), ["agency", "year"])
    return reports.median_ranked(shares, "agency", "crt")


BOOKED = f"{ARRESTS}, matched AS (SELECT a.*, person IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%') AS matched FROM arrests a)"


def _matched(spark, d):
    booked = read(spark, d, "orders").filter("o_orderpriority LIKE '1%'").select(F.col("o_custkey").alias("person"))
    return joins.flagged(standins.arrests(spark, d), booked, "person", "matched")


@query("match_rate_by_offense", f"WITH {BOOKED} SELECT summary_code, count(*) AS n, count(*) FILTER (matched) AS n_matched, round(100.0 * CAST(count(*) FILTER (matched) AS DOUBLE) / count(*), 9) AS rate FROM matched GROUP BY ALL")
def match_rate_by_offense(spark, d):
    return reports.match_rates(_matched(spark, d), ["summary_code"], "matched").withColumn("rate", F.round("rate", 9))


@query("match_rate_by_department", f"WITH {BOOKED} SELECT ncic_jurisdiction, count(*) AS n, count(*) FILTER (matched) AS n_matched, round(100.0 * CAST(count(*) FILTER (matched) AS DOUBLE) / count(*), 9) AS rate FROM matched WHERE offense_level = 'F' GROUP BY ALL HAVING count(*) >= 95")
def match_rate_by_department(spark, d):
    felonies = _matched(spark, d).filter(F.col("offense_level") == "F")
    return reports.match_rates(felonies, ["ncic_jurisdiction"], "matched", least=95).withColumn("rate", F.round("rate", 9))


@query("smoothed_offense_counts", f"WITH {ARRESTS} SELECT {', '.join(OFFENSE)}, count(*) AS n, round(CAST(count(*) FILTER (gender = 'female') AS DOUBLE) / (0.0001 + count(*) FILTER (gender = 'male')), 6) AS ratio FROM arrests GROUP BY ALL")
def smoothed_offense_counts(spark, d):
    n = aggregates.count_if
    rows = standins.arrests(spark, d).groupBy(*OFFENSE).agg(F.count("*").alias("n"), n(F.col("gender") == "female").alias("f"), n(F.col("gender") == "male").alias("m"))
    return rows.select(*OFFENSE, "n", F.round(recode.smoothed_ratio(F.col("f").cast("double"), F.col("m")), 6).alias("ratio"))


@query(
    "manual_lines",
    """WITH p AS (SELECT p_partkey, p_size, p_type, p_partkey % 9 AS pos FROM part)
    SELECT p_partkey AS lineno, lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS code, 'S' || p_size AS statute,
           CASE WHEN pos % 3 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'PC' ELSE 'VC' END END AS code_type, p_type AS literal,
           substr('FMNIS', CAST(p_partkey % 5 + 1 AS INTEGER), 1) AS offense_class, CAST(p_size % 100 AS INTEGER) AS summary_code, CAST(p_partkey % 900 AS INTEGER) AS hierarchy FROM p""",
)
def manual_lines(spark, d):
    """Lines as a manual prints them, cut apart again: two of three lack the statute type, and the widths change every nine lines."""
    parts = read(spark, d, "part").withColumn("pos", F.col("p_partkey") % 9)
    width = (F.lit(12) + F.floor(F.col("p_partkey") / 9) % 5).cast("int")
    statute = F.rpad(F.concat(F.lit("S"), F.col("p_size")), width, F.lit(" "))
    kind = F.when(F.col("pos") % 3 == 0, F.when(F.col("p_partkey") % 2 == 0, "PC").otherwise("VC")).otherwise("  ")
    letter = F.substring(F.lit("FMNIS"), (F.col("p_partkey") % 5 + 1).cast("int"), F.lit(1))
    line = F.concat(F.lpad((F.col("p_partkey") % 100000).cast("string"), 5, "0"), statute, F.lit(" "), kind, F.lit(" "), "p_type", F.lit(" "), letter, F.lit(" "), F.lpad((F.col("p_size") % 100).cast("string"), 2, "0"), F.lit("  "), (F.col("p_partkey") % 900).cast("string"))
    return text_tables.split_manual(parts.select(F.col("p_partkey").alias("lineno"), line.alias("line")))


@query("carried_forward", f"WITH {ARRESTS} SELECT db_id, last_value(age IGNORE NULLS) OVER (PARTITION BY ncic_jurisdiction ORDER BY db_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_age FROM arrests")
def carried_forward(spark, d):
    rows = standins.arrests(spark, d).select("db_id", "ncic_jurisdiction", "age")
    return ordering.carried(rows, ["ncic_jurisdiction"], "db_id", "age", "last_age").select("db_id", "last_age")
