"""Map the driver's TPC-H-like tables onto the reference's input shapes.

``visits_raw`` stands in for the visit_occurrence CSV (17 text columns, with
bad dates and missing values injected by key rules); ``person_raw`` stands in
for person.csv (padded and unparsable ids). Both are plain Spark plans over
the given Parquet tables, so their size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.functions.dates import microsecond_of
from vistra.schema import PERSON_COLUMNS, VISIT_COLUMNS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c) -> F.Column:
    return c.cast("string")


def with_time_of_day(date: Column, key: Column) -> Column:
    """Midnight of a date → a second and microsecond of that day that follow from a key."""
    seconds = F.timestamp_add("SECOND", F.pmod(key * 7919, F.lit(86400)), date)
    return F.timestamp_add("MICROSECOND", F.pmod(key * 104729, F.lit(1_000_000)), seconds)


# The text forms that the parser takes: year, month, day, hour, minute, second, microsecond.
TIME_FORMS = [
    "%1$04d-%2$02d-%3$02d %4$02d:%5$02d:%6$02d.%7$06d",
    "%1$04d-%2$02d-%3$02dT%4$02d:%5$02d:%6$02d.%7$06d",
    "  %1$04d-%2$02d-%3$02d %4$02d:%5$02d:%6$02d ",
    "%1$04d-%2$02d-%3$02d %4$02d:%5$02d",
    "%1$04d-%2$d-%3$d %4$d:%5$02d:%6$02d",
    "%1$04d%2$02d%3$02d %4$02d:%5$02d:%6$02d",
    "%2$d/%3$d/%1$04d %4$02d:%5$02d:%6$02d",
    "%1$04d-%2$02d-%3$02dT%4$02d:%5$02d:%6$02d.%7$06d789Z",
    "%1$04d-%2$02d-%3$02d %4$02d:%5$02d:%6$02d+02:00",
]


def _formatted_times(ts: str, key: str) -> Column:
    t = F.col(ts)
    form = F.element_at(F.array(*[F.lit(f) for f in TIME_FORMS]), (F.pmod(F.col(key), F.lit(len(TIME_FORMS))) + 1).cast("int"))
    parts = [F.year(t), F.month(t), F.day(t), F.hour(t), F.minute(t), F.second(t), microsecond_of(t)]
    return F.call_function("format_string", form, *parts)


def written_times(ts: str, key: str, plain: str) -> Column:
    """A timestamp column as text, in one of the forms above by ``key``.

    ``plain``: the column with that timestamp's usual text, from whose parts the
    forms of four-digit years are put together; other values are formatted.
    """
    t, text = F.col(ts), F.col(plain)
    date, clock, micros = F.substring(text, 1, 10), F.substring(text, 12, 8), F.rpad(F.substring(text, 21, 6), 6, "0")
    year, month, day = F.substring(text, 1, 4), F.month(t).cast("string"), F.day(t).cast("string")
    hour, minutes = F.hour(t).cast("string"), F.substring(text, 14, 6)
    forms = [
        [date, " ", clock, ".", micros],
        [date, "T", clock, ".", micros],
        ["  ", date, " ", clock, " "],
        [date, " ", F.substring(text, 12, 5)],
        [year, "-", month, "-", day, " ", hour, minutes],
        [year, F.substring(text, 6, 2), F.substring(text, 9, 2), " ", clock],
        [month, "/", day, "/", year, " ", clock],
        [date, "T", clock, ".", micros, "789Z"],
        [date, " ", clock, "+02:00"],
    ]
    kind, made = F.pmod(F.col(key), F.lit(len(TIME_FORMS))), F.lit(None).cast("string")
    for i, parts in reversed(list(enumerate(forms))):
        made = F.when(kind == i, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise(made)
    first, last = (F.lit(x).cast("timestamp_ntz") for x in ("1000-01-01 00:00:00", "9999-12-31 23:59:59.999999"))
    return F.when(F.col(key).isNotNull() & t.between(first, last), made).otherwise(_formatted_times(ts, key))


def _spread(rows: DataFrame) -> DataFrame:
    """A table of few files dealt over the cores, so that text is not written and parsed by one task; a larger one as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def visits_raw(spark: SparkSession, sf_dir: str, missing_end: bool = False) -> DataFrame:
    """One text row per lineitem, shaped like the 17-column visit CSV.

    Times of day, down to the microsecond, and the text form of a time follow
    from keys. Injected defects (by key rule): missing person (orderkey % 97 = 0), bad
    start text (orderkey % 89 = 0), missing provider (suppkey % 10 = 0),
    missing care site (suppkey % 7 = 0), missing source value (N/O lines).
    ``missing_end`` also blanks the end time of line number 7.
    """
    # an order's time is written before the join, once for its lines; a line's time after it, so that no text of lines is moved
    li = _spread(load_table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None)).otherwise(F.col("l_returnflag")).alias("source_value"),
    )
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", with_time_of_day(F.col("o_orderdate"), F.col("o_orderkey")).alias("start")
    ).withColumn("start_plain", _text(F.col("start"))).withColumn("start_text", written_times("start", "o_orderkey", "start_plain")).drop("start", "start_plain")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    joined = joined.withColumn("end", with_time_of_day(F.col("l_shipdate"), F.col("l_partkey"))).withColumn("end_plain", _text(F.col("end")))
    joined = joined.withColumn("end_text", written_times("end", "l_partkey", "end_plain"))

    end_text = F.col("end_text")
    if missing_end:
        end_text = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(end_text)

    derived = {
        "visit_occurrence_id": _text(F.col("o_orderkey")),
        "person_id": F.when(F.col("o_orderkey") % 97 == 0, F.lit(None)).otherwise(
            _text(F.col("o_custkey"))
        ),
        "visit_concept_id": _text(F.col("l_partkey")),
        "visit_start_datetime": F.when(F.col("o_orderkey") % 89 == 0, F.lit("not-a-date")).otherwise(
            F.col("start_text")
        ),
        "visit_end_datetime": end_text,
        "visit_type_concept_id": _text(F.col("l_linenumber")),
        "provider_id": F.when(F.col("l_suppkey") % 10 == 0, F.lit(None)).otherwise(
            _text(F.col("l_suppkey"))
        ),
        "care_site_id": F.when(F.col("l_suppkey") % 7 == 0, F.lit(None)).otherwise(
            _text(F.col("l_suppkey"))
        ),
        "visit_source_value": F.col("source_value"),
    }
    return joined.select(
        *[
            (derived[c] if c in derived else F.lit(None)).cast("string").alias(c)
            for c in VISIT_COLUMNS
        ]
    )


def person_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per customer, shaped like person.csv's three used columns."""
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    key = F.col("c_custkey")
    person_id = (
        F.when(key % 17 == 0, F.concat(F.lit("id-"), _text(key)))
        .when(key % 5 == 0, F.concat(F.lit("  "), _text(key), F.lit(" ")))
        .otherwise(_text(key))
    )
    out = {
        "person_id": person_id,
        "gender_source_value": F.col("c_mktsegment"),
        "race_source_value": F.col("n_name"),
    }
    return joined.select(*[out[c].cast("string").alias(c) for c in PERSON_COLUMNS])
