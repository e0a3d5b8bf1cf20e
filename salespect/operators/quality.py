"""Data-quality checks whose results are rows of a table.

Measurements are one-row frames (or a few rows) computed by partial
aggregation; the checks are expressions over them. Everything that one scan can
measure is measured by one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespect.config import Settings
from salespect.functions.order_stats import quantiles
from salespect.functions.staging import staged
from salespect.operators.clean import CRITICAL_COLUMNS
from salespect.schema import STANDARD_COLUMNS, UNKNOWN

BASIC, INTEGRITY, BUSINESS = "Basic Checks", "Data Integrity", "Business Rules"
TIME, STATISTICAL = "Time Series", "Statistical Checks"

NUMBER_TYPES = {
    "quantity": (T.IntegerType, T.LongType),
    "unit_price": (T.DoubleType, T.FloatType),
    "total_price": (T.DoubleType, T.FloatType),
}
DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# How the checks read each column: the type they need, and the types that are it already.
READ_AS: dict[str, tuple[str, tuple[type[T.DataType], ...]]] = {
    **{c: ("double", types) for c, types in NUMBER_TYPES.items()},
    "hour": ("int", WHOLE_TYPES),
    "invoice_date": ("date", DATE_TYPES),
    "invoice_datetime": ("timestamp", DATE_TYPES),
    **{
        c: ("string", (T.StringType,))
        for c in ("invoice_no", "product_id", "product_description", "customer_id", "country")
    },
}
OUTLIER_COLUMNS = ("quantity", "unit_price", "total_price")

CHECK_TYPE = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


# --- shared building blocks -------------------------------------------------


def _result(
    group: str,
    check: str,
    message: Column | str,
    failed: Column | None = None,
    warning: Column | None = None,
    metrics: Iterable[str] = (),
) -> Column:
    """A check struct; `metrics` names measurement columns to report."""
    never = F.lit(False)
    status = (
        F.when(failed if failed is not None else never, "failed")
        .when(warning if warning is not None else never, "warning")
        .otherwise("passed")
    )
    severity = F.when(status == "failed", "error").when(status == "warning", "warning")
    pairs = [part for m in metrics for part in (F.lit(m), F.col(m).cast("double"))]
    return F.struct(
        F.lit(group).alias("group"),
        F.lit(check).alias("check"),
        status.alias("status"),
        severity.otherwise("info").alias("severity"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        (F.create_map(*pairs) if pairs else F.create_map())
        .cast(T.MapType(T.StringType(), T.DoubleType()))
        .alias("metrics"),
    ).cast(CHECK_TYPE)


def _rows(measured: DataFrame, *results: Column) -> DataFrame:
    return measured.select(F.inline(F.array(*results)))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def _percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def _as_of(cfg: Settings) -> Column:
    return F.lit(cfg.as_of) if cfg.as_of else F.current_date()


# --- measurements -----------------------------------------------------------


def _read(column: str, found: T.DataType) -> Column:
    """The column in the type the checks need; what cannot be read, NaN too, is NULL."""
    wanted, same = READ_AS[column]
    value = F.col(column)
    if not isinstance(found, same):
        from_text = (T.StringType, T.VarcharType, T.CharType, T.NullType)
        sources = {
            "double": (*from_text, T.NumericType, T.BooleanType),
            "int": (*from_text, T.NumericType, T.BooleanType),
            "date": (*from_text, *DATE_TYPES),
            "timestamp": (*from_text, *DATE_TYPES),
            "string": (T.DataType,),
        }
        value = value.try_cast(wanted) if isinstance(found, sources[wanted]) else F.lit(None).cast(wanted)
        found = T.DoubleType() if wanted == "double" else found
    if isinstance(found, (T.DoubleType, T.FloatType)):
        value = F.nullif(value, F.lit(float("nan")).cast(found))
    return value


def comparable(df: DataFrame) -> DataFrame:
    """The frame with values that Spark cannot group by or write, maps and the like, as text."""
    without = ("map<", "variant", "interval", "void")
    odd = [f.name for f in df.schema if any(word in f.dataType.simpleString() for word in without)]
    return df.withColumns({c: F.col(c).cast("string") for c in odd}) if odd else df


def readable(df: DataFrame) -> DataFrame:
    """The frame as the checks read it: in the type they need where that is possible, else NULL."""
    wrong = {f.name: _read(f.name, f.dataType) for f in df.schema if f.name in READ_AS and (not isinstance(f.dataType, READ_AS[f.name][1]) or isinstance(f.dataType, (T.DoubleType, T.FloatType)))}
    return df.withColumns(wrong) if wrong else df


def unreadable_stats(df: DataFrame, columns: Iterable[str] = tuple(READ_AS)) -> DataFrame:
    """One row: per column that the checks read, how many values are given but cannot be read."""
    counts = [
        F.count_if(F.col(f.name).isNotNull() & _read(f.name, f.dataType).isNull()).alias(f"unreadable_{f.name}")
        for f in df.schema
        if f.name in columns and f.name in READ_AS
    ]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts)


def line_stats(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Everything a single pass over the lines can measure, as one row.

    Measurements whose columns are absent are left out.
    """
    have = set(df.columns)
    df = readable(df)
    quantity, price, hour = F.col("quantity"), F.col("unit_price"), F.col("hour")
    off = F.abs(F.col("total_price") - quantity * price) > cfg.price_tolerance
    measures = [F.count(F.lit(1)).alias("row_count")]
    measures += [
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS if c in have
    ]
    if "customer_id" in have:
        measures.append(F.count_if(F.col("customer_id") != UNKNOWN).alias("known_customers"))
    for name, label, cap in (
        ("quantity", "quantity", cfg.quantity_cap),
        ("unit_price", "price", cfg.price_cap),
    ):
        if name in have:
            value = F.col(name)
            measures += [
                F.min(value).alias(f"min_{label}"),
                F.max(value).alias(f"max_{label}"),
                F.avg(value).alias(f"avg_{label}"),
                F.stddev_samp(value).alias(f"std_{label}"),
                F.count_if(value <= 0).alias(f"nonpositive_{label}"),
                F.count_if(value > cap).alias(f"extreme_{label}"),
            ]
    if {"quantity", "unit_price", "total_price"} <= have:
        measures.append(F.count_if(off).alias("price_mismatches"))
    if "hour" in have:
        outside = (hour < cfg.opening_hour) | (hour > cfg.closing_hour)
        measures.append(F.count_if(outside).alias("unusual_hours"))
    if "invoice_date" in have:
        measures += [
            F.min("invoice_date").alias("min_date"),
            F.max("invoice_date").alias("max_date"),
        ]
    return df.agg(*measures)


def line_keys(df: DataFrame) -> list[str]:
    """Columns that identify a line: invoice, product and the time as precise as available."""
    time = "invoice_datetime" if "invoice_datetime" in df.columns else "invoice_date"
    keys = [c for c in ("invoice_no", "product_id", time) if c in df.columns]
    return keys or df.columns


def duplicate_stats(df: DataFrame) -> DataFrame:
    """Complete and key duplicates.

    Only the key columns are shuffled for all lines. Equal lines share a key, so
    whole lines are compared only where a key repeats. Calling this writes the
    keys that repeat: a few are broadcast, and whole lines stay where they are.
    """
    df = comparable(df)
    keys = line_keys(df)
    sizes = staged(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "repeated_keys")
    repeated = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    zero = F.lit(0).cast("long")
    beyond_first = F.coalesce(F.sum(F.col("_n") - 1), zero)
    return (
        df.join(repeated, same_key, "left_semi")
        .groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(beyond_first.alias("complete_duplicates"))
        .select(
            df.agg(F.count(F.lit(1))).scalar().alias("total_records"),
            sizes.agg(beyond_first).scalar().alias("key_duplicates"),
            "complete_duplicates",
        )
        .withColumns(
            {
                "complete_dup_rate": _share("complete_duplicates", "total_records"),
                "key_dup_rate": _share("key_duplicates", "total_records"),
            }
        )
    )


def suspicious_customers(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Known customers with implausibly many lines or implausible spending."""
    return (
        readable(df)
        .filter(F.col("customer_id") != UNKNOWN)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("total_price").alias("total_spent"),
        )
        .filter(
            (F.col("transaction_count") > cfg.max_customer_rows)
            | (F.col("total_spent") > cfg.max_customer_spend)
        )
    )


def inconsistent_products(df: DataFrame) -> DataFrame:
    """Products that appear with more than one description."""
    return (
        readable(df)
        .groupBy("product_id")
        .agg(F.count_distinct("product_description").alias("description_count"))
        .filter("description_count > 1")
    )


def date_stats(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Range, density, future lines and gaps, from the line count of each day.

    Timestamps count as their day, so one task orders calendar days at most.
    """
    day, gap = F.col("invoice_date"), F.col("gap")
    days = readable(df).select(F.to_date(day).alias("invoice_date")).filter(day.isNotNull()).groupBy("invoice_date").agg(F.count(F.lit(1)).alias("n"))
    gaps = days.withColumn("gap", F.datediff(day, F.lag(day).over(Window.orderBy(day))))
    wide = gap > cfg.max_gap_days
    return gaps.agg(
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count(day).alias("unique_dates"),
        F.coalesce(F.datediff(F.max(day), F.min(day)), F.lit(0)).alias("date_range_days"),
        F.coalesce(F.sum(F.when(day > _as_of(cfg), F.col("n"))), F.lit(0)).alias("future_rows"),
        F.count_if(wide).alias("gap_count"),
        F.coalesce(F.max(F.when(wide, gap)), F.lit(0)).alias("max_gap_days"),
    ).withColumn("date_density", _share("unique_dates", "date_range_days"))


def outlier_stats(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Bounds by interquartile range and the share outside, one row per numeric column."""
    df = readable(df)
    names = [c for c in OUTLIER_COLUMNS if c in df.columns]
    quartiles = quantiles(df, {name: (0.25, 0.75) for name in names}, cfg)
    bounds, counts = {}, [F.count(F.lit(1)).alias("row_count")]
    for name, (low, high) in quartiles.items():
        reach = (high - low) * cfg.iqr_factor
        bounds[name] = (low - reach, high + reach)
        outside = (F.col(name) < bounds[name][0]) | (F.col(name) > bounds[name][1])
        counts.append(F.count_if(outside).alias(name))
    per_column = [
        F.struct(
            F.lit(name).alias("column_name"),
            bounds[name][0].alias("lower_bound"),
            bounds[name][1].alias("upper_bound"),
            F.col(name).alias("outlier_count"),
            _share(name, "row_count").alias("outlier_rate"),
        )
        for name in names
    ]
    return df.agg(*counts).select(F.inline(F.array(*per_column)))


def country_counts(df: DataFrame, k: int = 5) -> DataFrame:
    """The k countries with the most lines."""
    return (
        readable(df)
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("line_count"))
        .orderBy(F.desc("line_count"), F.asc("country"))
        .limit(k)
    )


def concentration_stats(df: DataFrame) -> DataFrame:
    """Number of countries, and the largest one with its share of the lines."""
    counts = readable(df).groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("country_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.min_by("country", F.struct(-F.col("n"), F.col("country"))).alias("top_country"),
        F.coalesce(F.max("n"), F.lit(0)).alias("top_count"),
    ).withColumn("top_share", _share("top_count", "row_count"))


# --- checks over measurements -----------------------------------------------


def _row_count(cfg: Settings) -> Column:
    rows = F.col("row_count")
    return _result(
        BASIC,
        "row_count",
        F.format_string(f"%d rows (expected {cfg.min_rows} to {cfg.max_rows})", rows),
        failed=rows < cfg.min_rows,
        warning=rows > cfg.max_rows,
        metrics=["row_count"],
    )


def _schema(df: DataFrame) -> Column:
    missing = sorted(set(STANDARD_COLUMNS) - set(df.columns))
    text = "missing columns: " + ", ".join(missing) if missing else "all columns present"
    return _result(BASIC, "schema", text, failed=F.lit(bool(missing)))


def _nulls(column: str) -> Column:
    nulls = F.col(f"null_{column}")
    return _result(
        INTEGRITY,
        f"nulls:{column}",
        F.format_string(f"%d nulls in {column}", nulls),
        failed=nulls > 0,
        metrics=[f"null_{column}"],
    )


def _type(df: DataFrame, column: str) -> Column:
    found = df.schema[column].dataType
    return _result(
        INTEGRITY,
        f"type:{column}",
        f"{column} is {found.simpleString()}",
        warning=F.lit(not isinstance(found, NUMBER_TYPES[column])),
    )


def _coverage(cfg: Settings) -> Column:
    share = _share("known_customers", "row_count")
    return _result(
        INTEGRITY,
        "customer_coverage",
        F.concat(_percent(share), F.lit(" of lines name their customer")),
        warning=share < cfg.min_customer_coverage,
        metrics=["known_customers", "row_count"],
    )


def _ranges() -> Column:
    counts = [
        "nonpositive_quantity",
        "extreme_quantity",
        "nonpositive_price",
        "extreme_price",
    ]
    bad = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in counts])
    listed = [
        F.when(F.col(c) > 0, F.format_string(f"%d lines with {c.replace('_', ' ')}", F.col(c)))
        for c in counts
    ]
    empty = F.col("row_count") == 0
    return _result(
        BUSINESS,
        "ranges",
        F.when(empty, "no rows").otherwise(
            F.when(bad, F.concat_ws("; ", *listed)).otherwise("values within range")
        ),
        failed=empty | bad,
        metrics=[
            *("min_quantity", "max_quantity", "avg_quantity", "std_quantity"),
            *("min_price", "max_price", "avg_price", "std_price"),
            *counts,
        ],
    )


def _business_rules(df: DataFrame, cfg: Settings) -> Column:
    mismatched, suspicious = F.col("price_mismatches"), F.col("suspicious_customers")
    findings = [
        F.when(mismatched > 0, F.format_string("%d lines whose total is not quantity times price", mismatched)),
        F.when(suspicious > 0, F.format_string("%d suspicious customers", suspicious)),
    ]
    broken = (mismatched > 0) | (suspicious > 0)
    if "hour" in df.columns:
        share = _share("unusual_hours", "row_count")
        unusual = share > cfg.max_unusual_hour_rate
        findings.append(F.when(unusual, F.concat(_percent(share), F.lit(" outside usual hours"))))
        broken = broken | unusual
    return _result(
        BUSINESS,
        "business_rules",
        F.when(broken, F.concat_ws("; ", *findings)).otherwise("all rules hold"),
        warning=broken,
        metrics=["price_mismatches", "suspicious_customers"],
    )


def _duplicates(cfg: Settings) -> Column:
    share = F.col("key_dup_rate")
    return _result(
        BASIC,
        "duplicates",
        F.concat(F.format_string("%d duplicate lines, ", F.col("key_duplicates")), _percent(share)),
        failed=share > cfg.max_duplicate_rate,
        warning=share > 0,
        metrics=[
            *("total_records", "complete_duplicates", "key_duplicates"),
            *("complete_dup_rate", "key_dup_rate"),
        ],
    )


def _consistency() -> Column:
    products = F.col("inconsistent_products")
    return _result(
        BUSINESS,
        "consistency",
        F.format_string("%d products with several descriptions", products),
        warning=products > 0,
        metrics=["inconsistent_products"],
    )


def _dates(cfg: Settings) -> Column:
    unreadable = F.col("unreadable_dates") > 0
    future = F.col("future_rows") > 0
    sparse = (F.col("date_range_days") > 0) & (F.col("date_density") < cfg.min_date_density)
    early = F.coalesce(F.year("min_date") < cfg.first_year, F.lit(False))
    late = F.coalesce(F.year("max_date") > cfg.last_year, F.lit(False))
    critical = F.concat_ws(
        "; ",
        F.when(unreadable, F.format_string("%d unreadable dates", F.col("unreadable_dates"))),
        F.when(future, F.format_string("%d lines with future dates", F.col("future_rows"))),
        F.when(sparse, F.concat(F.lit("date density only "), _percent(F.col("date_density")))),
    )
    minor = F.concat_ws(
        "; ",
        F.when(early, F.concat(F.lit("earliest date "), F.col("min_date").cast("string"))),
        F.when(late, F.concat(F.lit("latest date "), F.col("max_date").cast("string"))),
    )
    return _result(
        TIME,
        "dates",
        F.when(unreadable | future | sparse, critical)
        .when(early | late, minor)
        .otherwise(F.format_string("%d distinct dates", F.col("unique_dates"))),
        failed=unreadable | future | sparse,
        warning=early | late,
        metrics=["unique_dates", "date_range_days", "date_density", "future_rows"],
    )


def _gaps() -> Column:
    count = F.col("gap_count")
    return _result(
        TIME,
        "time_gaps",
        F.format_string("%d gaps, longest %d days", count, F.col("max_gap_days")),
        warning=count > 0,
        metrics=["gap_count", "max_gap_days"],
    )


def _concentration(cfg: Settings) -> Column:
    none, share = F.col("country_count") == 0, F.col("top_share")
    return _result(
        STATISTICAL,
        "distribution",
        F.when(none, "no countries").otherwise(
            F.concat(_percent(share), F.lit(" of lines from "), F.col("top_country"))
        ),
        warning=none | (share > cfg.max_country_share),
        metrics=["country_count", "top_share"],
    )


def _outlier_rows(stats: DataFrame, cfg: Settings) -> DataFrame:
    """A warning for each column with too many outliers, or one passed row."""
    entry = F.struct("column_name", "outlier_count", "outlier_rate")
    high = stats.filter(F.col("outlier_rate") > cfg.max_outlier_rate)
    listed = high.agg(F.array_sort(F.collect_list(entry)).alias("high"))
    warnings = F.transform(
        "high",
        lambda e: F.struct(
            F.lit(STATISTICAL).alias("group"),
            F.concat(F.lit("outliers:"), e["column_name"]).alias("check"),
            F.lit("warning").alias("status"),
            F.lit("warning").alias("severity"),
            F.concat(
                F.format_string("%d outliers, ", e["outlier_count"]), _percent(e["outlier_rate"])
            ).alias("message"),
            F.create_map(
                F.lit("outlier_count"),
                e["outlier_count"].cast("double"),
                F.lit("outlier_rate"),
                e["outlier_rate"],
            ).alias("metrics"),
        ).cast(CHECK_TYPE),
    )
    fine = _result(STATISTICAL, "outliers", "outlier rates within range")
    return listed.select(F.inline(F.when(F.size("high") > 0, warnings).otherwise(F.array(fine))))


# --- the suite --------------------------------------------------------------


def _unless_missing(df: DataFrame, group: str, check: str, needs: Iterable[str]) -> Column | None:
    """A failed result if the check cannot run on this frame's columns."""
    missing = [c for c in needs if c not in df.columns]
    if missing:
        text = "cannot run without " + ", ".join(missing)
        return _result(group, check, text, failed=F.lit(True))
    return None


def basic_checks(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """All checks that need nothing but one pass, and those on the schema."""
    have = set(df.columns)

    def guarded(group: str, check: str, needs: Iterable[str], build: Callable[[], Column]) -> Column:
        problem = _unless_missing(df, group, check, needs)
        return build() if problem is None else problem

    priced = ("quantity", "unit_price")
    stats = line_stats(df, cfg)
    if {"customer_id", "total_price"} <= have:
        count = suspicious_customers(df, cfg).agg(F.count(F.lit(1))).scalar()
        stats = stats.withColumn("suspicious_customers", count)
    return _rows(
        stats,
        _row_count(cfg),
        _schema(df),
        *[_nulls(c) for c in CRITICAL_COLUMNS if c in have],
        *[_type(df, c) for c in NUMBER_TYPES if c in have],
        guarded(INTEGRITY, "customer_coverage", ["customer_id"], lambda: _coverage(cfg)),
        guarded(BUSINESS, "ranges", priced, _ranges),
        guarded(
            BUSINESS,
            "business_rules",
            (*priced, "total_price", "customer_id"),
            lambda: _business_rules(df, cfg),
        ),
    )


def duplicate_checks(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return _rows(duplicate_stats(df), _duplicates(cfg))


def _or_problem(
    df: DataFrame, group: str, check: str, needs: Iterable[str], build: Callable[[], DataFrame]
) -> DataFrame:
    problem = _unless_missing(df, group, check, needs)
    return build() if problem is None else _rows(df.sparkSession.range(1), problem)


def consistency_checks(df: DataFrame) -> DataFrame:
    def build() -> DataFrame:
        count = inconsistent_products(df).agg(F.count(F.lit(1)).alias("inconsistent_products"))
        return _rows(count, _consistency())

    return _or_problem(df, BUSINESS, "consistency", ("product_id", "product_description"), build)


def date_checks(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    def build() -> DataFrame:
        unreadable = F.lit(0)
        if not isinstance(df.schema["invoice_date"].dataType, DATE_TYPES):
            unreadable = unreadable_stats(df, ["invoice_date"]).select("unreadable_invoice_date").scalar()
        return _rows(date_stats(df, cfg).withColumn("unreadable_dates", unreadable), _dates(cfg), _gaps())

    return _or_problem(df, TIME, "dates", ["invoice_date"], build)


def outlier_checks(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    if not set(OUTLIER_COLUMNS) & set(df.columns):
        return _rows(df.sparkSession.range(1), _result(STATISTICAL, "outliers", "no columns"))
    return _outlier_rows(outlier_stats(df, cfg), cfg)


def distribution_checks(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return _or_problem(
        df,
        STATISTICAL,
        "distribution",
        ["country"],
        lambda: _rows(concentration_stats(df), _concentration(cfg)),
    )


@dataclass(frozen=True)
class Part:
    """Checks that share their measurements, and how each one runs alone if need be."""

    group: str
    checks: tuple[str, ...]
    build: Callable[[], DataFrame]
    alone: Callable[[str], DataFrame] | None = None


def check_parts(df: DataFrame, cfg: Settings = Settings()) -> list[Part]:
    """The suite as parts, none of which depends on another."""
    have = set(df.columns)
    reads = {
        "row_count": (),
        **{f"nulls:{c}": (c,) for c in CRITICAL_COLUMNS if c in have},
        "customer_coverage": ("customer_id",),
        "ranges": ("quantity", "unit_price"),
        "business_rules": ("quantity", "unit_price", "total_price", "customer_id", "hour"),
    }

    def alone(check: str) -> DataFrame:
        """A basic check on the only columns that it reads."""
        if check not in reads:  # schema and types are known without a scan
            return _rows(df.sparkSession.range(1), _schema(df) if check == "schema" else _type(df, check.split(":")[1]))
        columns = [F.col(c) for c in reads[check] if c in have]
        return basic_checks(df.select(F.lit(1).alias("_line"), *columns), cfg).filter(F.col("check") == check)

    types = [f"type:{c}" for c in NUMBER_TYPES if c in have]
    return [
        Part(BASIC, ("schema", *types, *reads), lambda: basic_checks(df, cfg), alone),
        Part(BASIC, ("duplicates",), lambda: duplicate_checks(df, cfg)),
        Part(BUSINESS, ("consistency",), lambda: consistency_checks(df)),
        Part(TIME, ("dates", "time_gaps"), lambda: date_checks(df, cfg)),
        Part(STATISTICAL, ("outliers",), lambda: outlier_checks(df, cfg)),
        Part(STATISTICAL, ("distribution",), lambda: distribution_checks(df, cfg)),
    ]


_BASIC_GROUPS = {"nulls": INTEGRITY, "type": INTEGRITY, "customer_coverage": INTEGRITY, "ranges": BUSINESS, "business_rules": BUSINESS}


def _reason(error: Exception) -> str:
    """The first line of an error; of a Java error that came untranslated, as from a failed subquery, that of its innermost cause."""
    cause = getattr(error, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    said = str(error if cause is None else cause.getMessage() or cause.toString()).strip()
    return said.splitlines()[0] if said else ""


def _outcome(part: Part) -> list[Row]:
    """The part's check rows; where its jobs fail, those of each check alone, and a failed row where that fails too."""

    def failed(check: str, error: Exception) -> Row:
        reason = _reason(error)
        group = _BASIC_GROUPS.get(check.split(":")[0], part.group)
        return Row(group, check, "failed", "error", f"could not run: {type(error).__name__}: {reason}"[:500], {})

    def one(check: str) -> list[Row]:
        try:
            return part.alone(check).collect()
        except (PySparkException, Py4JError) as error:
            return [failed(check, error)]

    try:
        return part.build().collect()
    except (PySparkException, Py4JError) as error:
        if part.alone is None:
            return [failed(check, error) for check in part.checks]
        return [row for check in part.checks for row in one(check)]


def run_all_checks(df: DataFrame, cfg: Settings = Settings(), jobs: int = 6) -> DataFrame:
    """Every check result as one row, about twenty in all.

    This runs the checks, up to `jobs` parts at a time, each as jobs of its own:
    a part that fails, since a column cannot be computed or a file be read,
    gives failed rows and leaves the others alone. The frame is read several
    times, so pass a stored one.
    """
    with ThreadPoolExecutor(jobs) as pool:
        rows = [row for found in pool.map(_outcome, check_parts(df, cfg)) for row in found]
    return df.sparkSession.createDataFrame(rows, CHECK_TYPE)


def summarize_checks(checks: DataFrame) -> DataFrame:
    """One row: counts by status, score in percent, and whether no error was found."""
    status = F.col("status")
    score = F.try_divide(F.count_if(status == "passed") * 100.0, F.count(status))
    return checks.agg(
        F.count(status).alias("total_checks"),
        F.count_if(status == "passed").alias("passed"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "warning").alias("warnings"),
        F.coalesce(score, F.lit(100.0)).alias("quality_score"),
        (F.count_if((status == "failed") & (F.col("severity") == "error")) == 0).alias(
            "quality_passed"
        ),
    )


def dataset_info(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min("invoice_date").alias("min_date"),
        F.max("invoice_date").alias("max_date"),
    )
