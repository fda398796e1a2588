"""Analysis jobs: variance, store and department reports, miss rate, ranking, completeness, ageing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import clean, gates, missrate, overlay, variance
from ..operators.joins import enrich, year_round_match
from ..operators.ranking import distinct_on, ranked_output, report_order, visit_rank
from ..operators.sets import union_all


def variance_analysis(
    periods: Sequence[tuple[DataFrame, DataFrame]], plan: DataFrame, bu: str, final: str = "STK2"
) -> DataFrame:
    """Variance KPIs of all periods (report rows, sales rows) with the store's visit number.

    The periods are stored apart but computed together: one aggregate and one join for all.
    """
    period = "__period"
    stk = union_all(*[rows.withColumn(period, F.lit(n)) for n, (rows, _) in enumerate(periods)])
    sales = union_all(*[rows.withColumn(period, F.lit(n)) for n, (_, rows) in enumerate(periods)])
    final_rows = stk.filter(F.col("rpname") == final)
    kpi = variance.variance_kpi(final_rows, ["stcode", "cntdate", "skutype", period])
    rated = variance.variance_to_sales(kpi, sales, [period]).drop(period)
    visits = visit_rank(plan.filter((F.col("atype") == "3F") & (F.col("bu") == bu)))
    return enrich(rated.withColumn("bu", F.lit(bu)), visits, ["bu", "stcode", "cntdate"])


def count_reports(stk: DataFrame, overlay_lines: DataFrame, plan: DataFrame) -> dict[str, DataFrame]:
    """Store and department reports, counted-by-scan stores included; planned stores always show."""
    scanned = overlay.overlay_store_totals(overlay_lines)
    everywhere = clean.with_constants(scanned, dept="ALL", sub_dept="ALL")
    keys = ["stcode", "cntdate"]
    return {
        "store": enrich(plan, union_all(variance.store_report(stk), scanned), keys),
        "dept": enrich(plan, union_all(variance.dept_report(stk), everywhere), keys),
    }


def count_report_levels(stk: DataFrame, overlay_lines: DataFrame, plan: DataFrame) -> DataFrame:
    """Both of ``count_reports`` as one table with a ``level``; the sums are not shuffled again to meet the plan."""
    scanned = overlay.overlay_store_totals(overlay_lines)
    every = F.lit("ALL")
    as_store = F.struct(F.lit("store").alias("level"), F.lit(None).cast("string").alias("dept"), F.lit(None).cast("string").alias("sub_dept"))
    as_dept = F.struct(F.lit("dept").alias("level"), every.alias("dept"), every.alias("sub_dept"))
    both = scanned.withColumn("__at", F.explode(F.array(as_store, as_dept))).select("*", "__at.*").drop("__at")
    keys = ["stcode", "cntdate"]
    # Dealt as the reports are, so that the union is still dealt by these keys.
    return enrich(plan, union_all(variance.reports_by_level(stk), both.repartition(*keys)), keys)


def overlay_count(
    scans: DataFrame,
    edits: DataFrame,
    master: DataFrame,
    plan: DataFrame,
    loaded: DataFrame,
    details: Sequence[str] = (),
) -> DataFrame:
    """Report lines of counts by scan: planned stores, stocktakes not loaded yet."""
    lines = overlay.overlay_edits(scans, edits, master, known_only=True, details=details)
    lines = gates.planned_only(lines, plan, ["stcode", "cntdate"])
    lines = gates.not_loaded(lines, loaded, ["stocktakeid"])
    totals = overlay.overlay_totals(lines, details)
    named = clean.rename_map(totals, {"amount": "qnt_retail", "description": "product_name"})
    return clean.with_constants(named, skutype="Credit", rpname="STK2", dept="All", sub_dept="All")


def overlay_detail(
    scans: DataFrame,
    edits: DataFrame,
    master: DataFrame,
    plan: DataFrame,
    loaded: DataFrame,
    details: Sequence[str] = (),
) -> DataFrame:
    """Single lines of counts by scan in the shape of the final variance detail."""
    lines = overlay.overlay_edits(scans, edits, master, known_only=True, details=details)
    lines = gates.planned_only(gates.not_loaded(lines, loaded, ["stocktakeid"]), plan, ["stcode", "cntdate"])
    named = clean.rename_map(lines, {"description": "product_name", "price": "retail"})
    return clean.with_constants(named, dept="All", sub_dept="All", rpname="VAR2", skutype="Credit")


def append_unseen_missrate(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Miss-rate rows that the target does not hold."""
    return gates.anti_join(new, stored, keys)


def missrate_job(view: DataFrame, stored: DataFrame) -> DataFrame:
    rows = missrate.missrate_vendor(view)
    return append_unseen_missrate(rows, stored, ["bu", "stcode", "cntdate", "vendor"])


def sku_ranking(stk: DataFrame, lo: str, hi: str, stores: Sequence[str] | None = None) -> DataFrame:
    """Outcome counts per SKU of the final report in a period, most counted first."""
    final = clean.between_dates(stk.filter(F.col("rpname") == "STK2"), "cntdate", lo, hi)
    names = distinct_on(final.select("sku", "prname"), ["sku"], ["prname"])
    return ranked_output(variance.sku_outcome_counts(final, names, stores=stores), "overall", ["sku"])


def completeness(plan: DataFrame, result: DataFrame, bu: str, skip_types: Sequence[str], lo: str, hi: str) -> DataFrame:
    """Planned full counts in a period without a final report.

    ``skip_types`` are the store types that do not report, ``policy.TYPES_NOT_REPORTED`` of a unit.
    """
    due = clean.between_dates(
        plan.filter((F.col("bu") == bu) & (F.col("atype") == "3F") & ~F.col("type1").isin(*skip_types)),
        "cntdate",
        lo,
        hi,
    )
    return gates.unreported(due, result.filter(F.col("rpname") == "STK2"))


def business_days(
    df: DataFrame, start: str, end: str, holidays: DataFrame, holiday: str = "date", name: str = "age"
) -> DataFrame:
    """Business days in [start, end); reversed dates count (end, start] as negative.

    Weekdays are counted by arithmetic, for any date; the weekday holidays, a sorted list of a few
    days a year, are counted off per row.
    """
    day = F.col(holiday).cast("date")
    free = holidays.select(day.alias("day")).filter(F.weekday("day") < 5)
    listed = free.agg(F.sort_array(F.collect_set("day")).alias("days")).scalar()

    def between(low: Column, high: Column) -> Column:
        """Business days in [low, high)."""
        off = F.size(F.filter("__free", lambda d: (d >= low) & (d < high)))
        return dates.weekday_number(high) - dates.weekday_number(low) - off

    a, b = F.col(start), F.col(end)
    age = F.when(a <= b, between(a, b)).when(a > b, -between(F.date_add(b, 1), F.date_add(a, 1)))
    return df.withColumn("__free", listed).withColumn(name, age).select(*df.columns, name)


def posting_age(plan: DataFrame, holidays: DataFrame, today: Column) -> DataFrame:
    """Business days from the visit (or count) to posting, with the report's groups."""
    counts = plan.filter(F.col("atype").isin("3F", "3Q"))
    started = year_round_match(counts, plan.filter(F.col("atype") == "4V")).withColumns(
        {"__start": dates.parse_date("start_date"), "__post": dates.parse_date("post_date")}
    )
    aged = business_days(started, "__start", "__post", holidays)
    open_group = F.when(F.col("__start") <= today, "Pending").when(F.col("__start") > today, "Not Yet")
    return aged.withColumns(
        {
            "group": F.coalesce(dates.age_bucket("age"), open_group),
            "age": F.when(F.col("age") >= 0, F.col("age")),
        }
    ).drop("__start", "__post")


def variance_listing(lines: DataFrame) -> DataFrame:
    """Rows of the printed variance listing in its order."""
    codes = ["sbc1", "sbc2", "sbc3", "sbc4", "sbc5"]
    listed = lines.withColumn("barcode", text.join_nonzero(codes))
    # Columns of the listing.
    columns = ["cntnum", "dept", "dept_name", "sub_dpt", "s_dpt_name", "location"]
    columns += ["sku", "ibc", "barcode", "sku_descr", "qnt", "extcst_var"]
    return report_order(clean.keep(listed, columns), ["dept", "sku", "location"])
