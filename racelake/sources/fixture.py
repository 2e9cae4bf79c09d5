"""Race-results input derived from the supplied TPC-H-like tables.

The studied pipeline reads one CSV of race results and one country lookup CSV.
No such files ship with the test data, so both are derived deterministically
from the supplied tables (rules in FIXTURES.md section 3).  One raw row is one
``lineitem`` row joined to its order, customer, nation and part; integer
arithmetic on the keys picks the text form of every field so that each parser
branch, data-quality rule and duplicate case is exercised.

Scale: the derivation is three equi-joins on the big tables (orders-customer,
then lineitem on the order key, then part) that Spark plans as shuffle joins;
``nation`` has 25 rows by the TPC-H definition.
Only the seven source columns that feed the rules are read from parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Raw CSV header of the race-results file, in file order.
RAW_COLUMNS = [
    "Year of event",
    "Event dates",
    "Event name",
    "Event distance/length",
    "Event number of finishers",
    "Athlete performance",
    "Athlete club",
    "Athlete country",
    "Athlete year of birth",
    "Athlete gender",
    "Athlete age category",
    "Athlete average speed",
    "Athlete ID",
]

# Header of the country lookup file.
LOOKUP_COLUMNS = ["athlete_country_code", "country_code_iso3", "country_name"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _txt(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _country_letters(n: Column) -> Column:
    """Two letters from a nation key, then ``x`` (``0`` -> ``aax``)."""
    return F.concat(F.chr(F.lit(97) + F.floor(n / 5)), F.chr(F.lit(97) + n % 5), F.lit("x"))


def race_results_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw race results with the original CSV header names and inferred types."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")

    # Join order (Spark keeps the written order without CBO statistics): orders
    # meet customer and nation first, an orders-sized shuffle; lineitem is then
    # shuffled only twice - by order key, then by part key - the minimum, as
    # part grows with the data and cannot be broadcast.
    order_side = (
        orders.join(cust, orders.o_custkey == cust.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
    )
    joined = (
        li.join(order_side, li.l_orderkey == order_side.o_orderkey)
        .join(part, F.col("l_partkey") == part.p_partkey)
    )

    h = F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_linenumber")
    g = F.col("l_orderkey") * 37 + F.col("l_partkey") * 11
    p = F.col("l_partkey")
    c = F.col("c_custkey")
    n = F.col("n_nationkey")
    size = F.col("p_size")
    seg = F.col("c_mktsegment")
    d0 = F.to_date("o_orderdate")

    dates = (
        F.when(h % 10 == 5, F.concat(F.lit("03.-05."), F.date_format(d0, "MM.yyyy")))
        .when(h % 10 == 6, F.concat(F.date_format(d0, "dd.MM."), F.lit("-02."),
                                    F.date_format(F.date_add(F.last_day(d0), 2), "MM.yyyy")))
        .when(h % 10 == 7, F.concat(F.date_format(d0, "dd.MM.yyyy"), F.lit("-"),
                                    F.date_format(F.date_add(d0, 30), "dd.MM.yyyy")))
        .when(h % 10 == 8, F.concat(F.lit("00."), F.date_format(d0, "MM.yyyy")))
        .when(h % 10 == 9, F.date_format(d0, "yyyy-MM-dd"))
        .otherwise(F.date_format(d0, "dd.MM.yyyy"))
    )

    r = p % 12
    distance = (
        F.when(r <= 3, F.concat(_txt(size + 40), F.lit("km")))
        .when(r == 4, F.concat(F.lit(" "), _txt(size + 40), F.lit("Km")))
        .when(r == 5, F.concat(_txt(size + 40), F.lit(".5km")))
        .when(r == 6, F.concat(_txt(size + 30), F.lit("mi")))
        .when(r == 7, F.concat(_txt((size % 8 + 1) * 6), F.lit("h")))
        .when(r == 8, F.concat(_txt(size + 50), F.lit("K")))
        .when(r == 9, F.concat(_txt(size % 10 + 1), F.lit("d")))
        .when(r == 10, F.concat(_txt(size + 60), F.lit("km/2Etappen")))
        .when(p % 48 == 35, F.lit("None"))
        .when(p % 24 == 11, F.lit(None).cast("string"))
        .otherwise(F.lit("07:35"))
    )

    distance_perf = F.concat(
        _txt(g % 200 + 30), F.lit("."), _pad(g % 1000, 3),
        F.when(g % 5 == 0, F.lit(" mi")).otherwise(F.lit(" km")),
    )
    clock = F.concat(_pad(g % 60, 2), F.lit(":"), _pad(g % 59, 2), F.lit(" h"))
    performance = (
        F.when(h % 17 == 0, F.lit(None).cast("string"))
        .when(h % 97 == 0, F.lit("4:5 h"))
        .when((r == 7) != (h % 19 == 0), distance_perf)
        .when(h % 13 == 0, F.concat(_txt(g % 3 + 1), F.lit("d "), _pad(g % 24, 2), F.lit(":"), clock))
        .otherwise(F.concat(_txt(g % 30 + 4), F.lit(":"), clock))
    )

    club = (
        F.when(c % 7 == 0, F.lit(None).cast("string"))
        .when(c % 7 == 1, F.concat(F.lit("*"), seg))
        .when(c % 7 == 2, F.lit("***"))
        .when(c % 7 == 3, F.lit("  "))
        .when(c % 7 == 4, F.concat(F.lit("Łódź "), seg))
        .otherwise(seg)
    )

    country = F.when(h % 29 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(" "), _country_letters(n)))

    birth = (
        F.when(c % 41 == 0, F.lit(1193.0))
        .when(c % 37 == 0, F.lit(None).cast("double"))
        .when(c % 43 == 0, F.lit(1890.0))
        .otherwise((c % 70 + 1930).cast("double"))
    )

    gender = (
        F.when(c % 101 == 0, F.lit(None).cast("string"))
        .when(c % 11 == 0, F.lit("X"))
        .when(c % 2 == 0, F.lit("m"))
        .otherwise(F.lit("F"))
    )

    category = (
        F.when((c + F.col("l_linenumber")) % 13 == 0, F.lit(None).cast("string"))
        .when(c % 10 == 0, F.lit("U23"))
        .when(c % 10 == 1, F.lit("MU23"))
        .when(c % 10 == 2, F.lit("WU20"))
        .when(c % 10 == 3, F.lit("M"))
        .otherwise(F.concat(F.when(c % 2 == 0, F.lit("m")).otherwise(F.lit("W")),
                            _txt(c % 6 * 5 + 35)))
    )

    speed = (
        F.when(h % 23 == 0, F.lit(None).cast("string"))
        .when(h % 31 == 0, F.lit("09:29:17"))
        .when(h % 7 == 0, F.lit("0.0"))
        .when(h % 2 == 0, F.concat(_txt(g % 9000 + 5000), F.lit(".0")))
        .otherwise(F.concat(_txt(g % 9 + 5), F.lit(".5")))
    )

    values = [
        F.year(d0).cast("int"),
        dates,
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" ")),
        distance,
        (p % 50).cast("int"),
        performance,
        club,
        country,
        birth,
        gender,
        category,
        speed,
        c.cast("int"),
    ]
    return joined.select(*[v.alias(name) for v, name in zip(values, RAW_COLUMNS)])


def country_lookup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country lookup: padded lower-case-derived code, ISO3-like code, name.

    Nation 22 is left out (its athletes find no match) and nations 23 and 24
    share one ISO3 code (several athlete codes per country).
    """
    n = F.col("n_nationkey")
    return (
        _table(spark, sf_dir, "nation")
        .filter(n != 22)
        .select(
            F.concat(F.lit(" "), F.upper(_country_letters(n)), F.lit(" ")).alias("athlete_country_code"),
            F.concat(F.lit("N"), _pad(F.when(n == 24, F.lit(23)).otherwise(n), 2)).alias("country_code_iso3"),
            F.col("n_name").alias("country_name"),
        )
    )
