"""Outsource plans, day rates, annual plans, time off, calendars and timesheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import layouts, policy
from ..functions import dates, measures
from ..operators import clean, gates
from ..operators.joins import cross_dims, natural_left
from ..operators.ranking import forward_fill
from ..operators.sets import drop_dupes
from ..operators.stock import high_water
from ..sources.tables import spine_per_row


def expiry_fee(bu: str = "bu", store_type: str = "st_type", vendor: str = "outsource_name") -> Column:
    """Fee for expiry checks: by unit, store type and vendor, else 0."""
    applies = (F.col(bu) == policy.EXPIRY_FEE_UNIT) & F.col(store_type).isin(*policy.EXPIRY_FEE_TYPES)
    return measures.first_match(
        [(applies & F.col(vendor).isin(*vendors), fee) for vendors, fee in policy.EXPIRY_FEES], 0
    )


# Header names of the outsource plan sheets.
PIECE_NAMES = {
    "bus.": "bu",
    "store code": "stcode",
    "hub": "shub",
    "type": "st_type",
    "ประเภทการตรวจนับของ outsource": "cnt_type",
    "vendor": "outsource_name",
    "actual manday control": "act_man_control",
    "for checking": "hiring_status",
    "outsource expense": "outsource_expense",
    "van expense": "van_expense",
    "total soh outsource": "total_soh",
    "cost per pieces": "price_per_piece",
    "expired check": "expired_check",
    "est. price": "est_price_per_store",
    "food": "food_soh",
    "nonfood": "nonfood_soh",
    "perishable": "perishable_soh",
    "est. manday": "est_man_total",
}
MANDAY_NAMES = {
    "bus.": "bu",
    "store code": "stcode",
    "hub": "shub",
    "type": "st_type",
    "ประเภทการตรวจนับของ outsource": "cnt_type",
    "vendor": "outsource_name",
    "actual manday": "act_man_outsource",
    "for checking": "hiring_status",
    "cost per manday": "price_per_piece",
    "est. price": "est_price_per_store",
    "est. manday ช่อง outsource หรือ outsource by div": "est_man_total",
}
NOT_STORED = (
    "no",
    "for checking",
    "atype",
    "time",
    "outsource ส่งรายชื่อ excel control",
    "outsource ส่งรายชื่อ excel count",
    "outsource ส่งรายชื่อ excel",
    "actual soh (ตาม miss rate)",
    "actual manday count",
    "actual price",
    "speed est. soh",
    "per_piece",
    "status",
)


def outsource_pieces(raw: DataFrame, speed: DataFrame) -> DataFrame:
    """Hired stores priced by pieces, with days of work from the pieces per day.

    ``speed`` holds the current pieces per day; it joins on every column it shares.
    """
    df = clean.rename_map(clean.normalise_names(raw), PIECE_NAMES)
    df = clean.contains_flag(df, "hiring_status", "YES")
    numbers = ["actual manday count", "act_man_control", "food_soh", "nonfood_soh", "perishable_soh"]
    df = clean.to_number(df, numbers).withColumns(
        {
            "act_man_outsource": F.col("act_man_control") + F.col("`actual manday count`"),
            "expired_check": expiry_fee(),
        }
    )
    df = natural_left(df, speed)
    stock = ["food_soh", "nonfood_soh", "perishable_soh"]
    days = {f"est_man_{c.removesuffix('_soh')}": measures.mandays(c, "per_piece") for c in stock}
    df = df.withColumns(days).withColumn("soh_outsource", sum((F.col(c) for c in stock[1:]), F.col(stock[0])))
    return clean.drop_cols(df, NOT_STORED)


def outsource_mandays(raw: DataFrame) -> DataFrame:
    """Hired stores priced by day."""
    df = clean.rename_map(clean.normalise_names(raw), MANDAY_NAMES)
    return clean.drop_cols(clean.contains_flag(df, "hiring_status", "YES"), NOT_STORED)


def outsource_fixed_rate(df: DataFrame) -> DataFrame:
    """Older yearly sheet: one fixed rate, days only where pieces are outsourced."""
    stock = ["food", "nonfood", "perishable"]
    days = {f"est_man_{c}": measures.mandays_fixed(c, "outsource_pieces") for c in stock}
    people = F.col("control") + F.col("expire_manday") + F.col("counter")
    return clean.require(df, ["bu"]).withColumns(
        {"act_man_control": F.col("control"), "act_man_outsource": people, **days}
    )


def rate_area(province: Column, vendor: Column) -> Column:
    metro = province.isin(*policy.METRO_PROVINCES)
    for place, name in policy.METRO_EXTRA:
        metro = metro | ((province == place) & (vendor == name))
    return F.when(metro, policy.METRO_AREA).otherwise(policy.UPCOUNTRY_AREA)


def rate_price(vendor: Column, season: Column, area: Column, bu: Column, month: Column) -> Column:
    """Price of the first tariff line that fits, else null."""

    def fits(rate: policy.Rate) -> Column:
        test = vendor == rate.vendor
        if rate.season:
            test = test & (season == rate.season)
        if rate.area:
            test = test & (area == rate.area)
        if rate.bu:
            test = test & (bu == rate.bu)
        if rate.not_bu:
            test = test & (bu != rate.not_bu)
        if rate.months:
            test = test & month.isin(*rate.months)
        return test

    return measures.first_match([(fits(r), r.price) for r in policy.RATES])


def day_rates(provinces: DataFrame, units: Sequence[str]) -> DataFrame:
    """Rate grid: every province with every vendor, unit, month and season."""
    grid = cross_dims(
        provinces.select("province"),
        vendorname=policy.VENDORS,
        bu=units,
        mindex__mname=policy.MONTHS,
        seasonindex=policy.SEASONS,
    )
    priced = grid.withColumn("darea", rate_area(F.col("province"), F.col("vendorname"))).withColumn(
        "price",
        rate_price(F.col("vendorname"), F.col("seasonindex"), F.col("darea"), F.col("bu"), F.col("mindex")),
    )
    return priced.select("province", "vendorname", "seasonindex", "bu", "mindex", "mname", "darea", "price")


def annual_plan(
    raw: DataFrame,
    names: Mapping[str, str] = layouts.YEARLY_PLAN,
    keep: Sequence[str] = layouts.YEARLY_PLAN_COLUMNS,
    zero: Sequence[str] = layouts.YEARLY_PLAN_ZERO,
) -> DataFrame:
    """Yearly plan sheet: renamed, empty numbers 0, chosen columns, rows with a unit."""
    df = clean.fill_defaults(clean.rename_map(raw, names), zero, 0)
    return clean.require(clean.keep(df, keep, missing="error"), ["bu"])


def estimate_rows(raw: DataFrame) -> DataFrame:
    """Estimated work days: rows with a readable date of a real employee."""
    df = clean.cast_map(raw, {"date": "timestamp"})
    return clean.exclude_null_safe(df.filter(F.col("date").isNotNull()), "empcode", [0])


# Header names of the time-off export.
TIME_OFF_NAMES = {
    "employee name": "employee_name",
    "employee id": "employee_id",
    "time off type": "time_off_type",
    "time off date": "time_off_date",
    "start time": "start_time",
    "end time": "end_time",
    "value": "value",
    "status": "status",
    "request submitted date": "request_submitted_date",
}


def time_off(raw: DataFrame, stored: DataFrame, month_first_files: str | None = None) -> DataFrame:
    """Time-off requests not stored yet. Names are written once per person and filled downwards."""
    df = clean.rename_map(raw, TIME_OFF_NAMES)
    df = forward_fill(df, ["employee_name", "employee_id"], ["file"], ["line"])
    df = df.filter(F.col("time_off_date").isNotNull())
    month_first = F.col("file").contains(month_first_files) if month_first_files else False
    day = F.date_format(dates.weekday_date("time_off_date", month_first), "yyyy-MM-dd")
    df = drop_dupes(df.withColumn("time_off_date", day).drop("file", "line"))
    df = df.withColumn("time_off_type", F.trim("time_off_type"))
    df = clean.not_in_list(df, "time_off_type", policy.TIME_OFF_EXCLUDED)
    return gates.not_loaded(df, stored, ["employee_id", "time_off_date"])


def intake_log(raw: DataFrame, accepted: DataFrame) -> DataFrame:
    """One log row per file with the number of rows that went in."""
    counted = accepted.groupBy("file").agg(F.count(F.lit(1)).alias("record"))
    status = F.when(F.col("record") > 0, "Data inserted").otherwise("No valid data after filtering")
    return (
        raw.select("file").distinct().join(counted, "file", "left").fillna(0, ["record"]).withColumn("status", status)
    )


# Column names of the timesheet export.
TIMESHEET_NAMES = {
    "employeecode": "empcode",
    "checkin_date": "check_in_date",
    "checkin_hh": "check_in_hour",
    "checkin_mm": "check_in_minute",
    "checkout_date": "check_out_date",
    "checkout_hh": "check_out_hour",
    "checkout_mm": "check_out_minute",
    "transportation_expenses": "transport_expense",
    "timestamp": "stamptime",
    "pda": "pda_no",
}


def timesheet_increment(sheet: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows with an id above the highest stored one."""
    return clean.rename_map(high_water(sheet, stored, "id"), TIMESHEET_NAMES)


def employee_calendar(
    employees: DataFrame, stored: DataFrame, end: str, default_start: str = "2026-01-01"
) -> DataFrame:
    """One row per active employee and day from their first working day, days not stored yet."""
    active = clean.active_as_of(employees, "last_work_date", F.lit(end).cast("date"))
    bounds = active.select(
        "employee_code",
        "hub",
        "position",
        F.coalesce("first_work_date", F.lit(default_start).cast("date")).alias("__from"),
        F.lit(end).cast("date").alias("__to"),
    )
    days = spine_per_row(bounds, "__from", "__to").select(
        "employee_code", F.date_format("date", "yyyy-MM-dd").alias("date"), "hub", "position"
    )
    return gates.not_loaded(days, stored, ["employee_code", "date"])
