"""Report intake: count report workbooks and CSV uploads into the report tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import clean, gates
from ..operators.joins import infer_skutype
from ..operators.keys import key_set
from ..operators.maintain import insert_new_or_reload
from ..operators.sets import drop_dupes
from ..operators.variance import line_variance
from ..session import durable


@dataclass(frozen=True)
class ReportPolicy:
    """How one family of report files is read and checked.

    * ``blank_sku``: ``"empty"`` reads a missing item as '', ``"drop"`` drops the row.
    * ``store_check``: ``"rows"`` keeps the rows of the file's store, ``"file"`` rejects a file
      with a row of another store, ``None`` trusts the name.
    * ``skutype``: ``"countname"`` (second character), ``"var"`` (from variance detail), a fixed
      text, or ``None`` for files that carry their own type.
    * ``date``: count date from the file ``"name"``, the ``"cntnum"`` or a ``"column"``.
    * ``plan_types``: visit types of the plan rows that count; a plan row needs a branch in any case.
    * ``name``: parts of the file name; ``exact_name`` rejects names with another number of them.
    """

    sku: str
    blank_sku: str = "empty"
    dedupe: bool = False
    clean: bool = False
    store: str | None = None
    store_from_cntnum: bool = False
    store_check: str | None = "rows"
    skutype: str | None = "countname"
    date: str = "name"
    name: tuple[str, ...] = ("rpname", "bu", "stcode", "cntdate")
    exact_name: bool = False
    numbers: tuple[str, ...] = ()
    fill: float | None = None
    scale: int | None = None
    uncounted: tuple[str, str] | None = None
    physical: bool = False
    variance: bool = False
    plan_keys: tuple[str, ...] = ("bu", "stcode", "cntdate")
    plan_types: tuple[str, ...] = ("3F",)
    loaded_keys: tuple[str, ...] = ("stcode", "cntdate", "skutype", "rpname")


# Column names, checks and roundings of the report families.
STORE_BOOK = ReportPolicy(sku="sku", store="store")
STORE_BOOK_CREDIT = replace(
    STORE_BOOK, skutype="Credit", numbers=("qty_count", "retail", "cost"), fill=0, scale=3, physical=True
)
STORE_BOOK_FILE = replace(STORE_BOOK, blank_sku="drop", dedupe=True, store_check="file", skutype="Credit")
COUNT_DETAIL = ReportPolicy(
    sku="skcode",
    store="cntnum",
    store_from_cntnum=True,
    skutype=None,
    date="cntnum",
    loaded_keys=("stcode", "cntdate", "prtype", "rpname"),
)
COUNT_DETAIL_CLEAN = replace(COUNT_DETAIL, clean=True, dedupe=True)
STORE_COUNT = replace(COUNT_DETAIL, blank_sku="drop", dedupe=True, store_check="file", date="name")
COUNT_BOOK_CREDIT = ReportPolicy(sku="sku", store="stmerch", skutype="Credit", clean=True)
COUNT_BOOK_CONSIGN = replace(COUNT_BOOK_CREDIT, skutype="Consign")
COUNT_BOOK = ReportPolicy(
    sku="sku", blank_sku="drop", dedupe=True, store="stmerch", store_check="file", skutype="var", date="column"
)
SHEET_BOOK = ReportPolicy(
    sku="sku",
    blank_sku="drop",
    store_check=None,
    skutype="Credit",
    name=("rpname", "bu", "stcode", "cntdate", "part"),
    exact_name=True,
    numbers=("stock", "qnt", "variance", "var_cost", "var_retail", "qnt_cost", "qnt_retail"),
    uncounted=("stock", "qnt"),
    loaded_keys=("stcode", "cntdate"),
)
WHOLESALE_BOOK = ReportPolicy(
    sku="sku",
    store_check=None,
    skutype="Credit",
    name=("rpname", "bu", "stcode", "cntdate", "part"),
    exact_name=True,
    numbers=("cost", "retail", "soh", "qty_count"),
    scale=3,
    variance=True,
)
WHOLESALE_SHORT_NAME = replace(
    WHOLESALE_BOOK, name=("customer", "day", "part"), plan_keys=("stcode", "cntdate")
)
# Header names of the wholesale sheets and of the credit store book.
WHOLESALE_NAMES = {
    "cus_code": "countname",
    "dp_code": "dpt",
    "pr_code": "sku",
    "pr_name": "sku_des",
    "pr_brand": "brnnam",
    "pr_model": "catalogue",
    "color": "coldsc",
    "pr_size": "sizdsc",
    "unit cost": "cost",
    "unit retail": "retail",
    "quantity": "soh",
    "physical count": "qty_count",
    "sum unit retail": "phycnt_rtl",
    "sum unit cost": "physcnt_cst",
}
STORE_BOOK_CREDIT_NAMES = {
    "brnddesc": "brandid",
    "sku_desc": "sku_des",
    "vend_name": "vend_nam",
    "dept": "dpt",
    "sdept": "sdpt",
    "class": "cls",
    "sclass": "scls",
    "stock_oh": "soh",
    "color": "coldsc",
    "size": "sizdsc",
    "brndname": "brnnam",
}


def _named(rows: DataFrame, policy: ReportPolicy, report: str | None) -> DataFrame:
    """Keys from the file name; the report name may be given by the sheet that was read."""
    # A row of its own for the one list of parts: Spark moves the tests of the keys to before a plain expression and would
    # take the name apart once for each of them.
    rows = rows.select("*", F.explode(F.array(text.file_parts("file"))).alias("__parts"))
    found = text.named_parts("__parts", list(policy.name), exact=policy.exact_name)
    keys = {n: found[n] for n in ("rpname", "bu", "stcode", "cntdate") if n in found}
    if "customer" in found:
        keys["stcode"] = F.concat(F.lit("W"), F.right(found["customer"], F.lit(6)))
        keys["cntdate"] = F.replace(found["day"], F.lit("-"), F.lit(""))
    if policy.date != "name":
        keys.pop("cntdate", None)
    if policy.date == "cntnum":
        keys["cntdate"] = dates.date_key(F.substring("cntnum", 7, 6), "ddMMyy")
    if report:
        keys["rpname"] = F.lit(report)
    return rows.withColumns(keys).drop("__parts")


def _typed(rows: DataFrame, policy: ReportPolicy, var: DataFrame | None) -> DataFrame:
    if policy.skutype == "countname":
        return rows.withColumn("skutype", text.skutype_of("countname"))
    if policy.skutype == "var":
        return gates.reject_if_all_unknown(infer_skutype(rows, var), "file")
    return rows.withColumn("skutype", F.lit(policy.skutype)) if policy.skutype else rows


def _checked(rows: DataFrame, policy: ReportPolicy) -> DataFrame:
    if not policy.store or not policy.store_check:
        return rows
    value = text.cntnum_store(policy.store) if policy.store_from_cntnum else F.col(policy.store)
    if policy.store_check == "file":
        # Looked at twice, and read from workbooks: stored once.
        rows = durable(rows)
        return gates.matches_filename(rows, "file", value, F.col("stcode"))
    return gates.rows_matching_filename(rows, value, F.col("stcode"))


def prepare_report(
    raw: DataFrame, policy: ReportPolicy, var: DataFrame | None = None, report: str | None = None
) -> DataFrame:
    """Cleaned report rows with the keys from their file name. ``raw`` has a ``file`` column."""
    rows = raw.drop("line")
    if policy.blank_sku == "drop":
        rows = clean.require(rows, [policy.sku])
    elif not policy.clean:
        rows = clean.fill_defaults(rows, [policy.sku], "")
    if policy.clean:
        rows = clean.clean_cells(rows)
    if policy.dedupe:
        rows = drop_dupes(rows)
    rows = _checked(_typed(_named(rows, policy, report), policy, var), policy)
    numbers = [c for c in policy.numbers if c in rows.columns]
    if numbers:
        rows = clean.to_number(rows, numbers, policy.fill, policy.scale, "decimal(18,3)")
    if policy.uncounted:
        rows = clean.drop_uncounted(rows, *policy.uncounted)
    if policy.physical:
        counted = F.col("qty_count")
        rows = rows.withColumns({"phycnt_rtl": counted * F.col("retail"), "phycnt_cst": counted * F.col("cost")})
    return line_variance(rows) if policy.variance else rows


def _stored_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, stored: Spark knows their size before it plans the gate and sends a few to the report rows.

    Else it finds out only when the rows are shuffled, and a plan names few counts, on which they would all meet.
    """
    return durable(key_set(df, keys))


def import_report(
    raw: DataFrame,
    policy: ReportPolicy,
    plan: DataFrame,
    loaded: DataFrame,
    var: DataFrame | None = None,
    report: str | None = None,
) -> DataFrame:
    """Rows to append: planned and not loaded before."""
    planned = _stored_keys(gates.open_plan(plan, policy.plan_types), policy.plan_keys)
    rows = gates.planned_only(prepare_report(raw, policy, var, report), planned, policy.plan_keys)
    return gates.not_loaded(rows, _stored_keys(loaded, policy.loaded_keys), policy.loaded_keys)


def reload_report(
    raw: DataFrame,
    policy: ReportPolicy,
    plan: DataFrame,
    target: DataFrame,
    delete_keys: Sequence[str],
    var: DataFrame | None = None,
) -> DataFrame:
    """New table: per file, unseen rows are added alone; a file without any replaces its count."""
    planned = _stored_keys(gates.open_plan(plan, policy.plan_types), policy.plan_keys)
    rows = gates.planned_only(prepare_report(raw, policy, var), planned, policy.plan_keys)
    return insert_new_or_reload(target, rows, "file", ["bu", *policy.loaded_keys], delete_keys)


def upload_csv(
    raw: DataFrame,
    plan: DataFrame,
    plan_add: DataFrame,
    loaded: DataFrame,
    sku: str = "skcode",
    plan_types: Sequence[str] = ("3F", "3Q"),
) -> dict[str, DataFrame]:
    """Combined CSV of several counts: accepted rows and both reject reports.

    Additional plan rows count whatever their type.
    """
    rows = drop_dupes(clean.require(raw, [sku])).withColumns(
        {"stcode": text.cntnum_store("cntnum"), "cntdate": text.cntnum_date("cntnum")}
    )
    keys = ["stcode", "cntdate"]
    planned = gates.open_plan(plan, plan_types).select(*keys).unionByName(gates.open_plan(plan_add).select(*keys))
    return dict(gates.upload_gate(rows, planned, loaded, keys, ["cntnum", "rpname"]))


def reconcile_sheet(raw: DataFrame, sheet: str, plan: DataFrame, loaded: DataFrame, remark: str) -> DataFrame:
    """Reconcile or block rows of whole files that are planned and not loaded yet."""
    rows = raw.drop("line")
    if remark in rows.columns:
        rows = rows.withColumnRenamed(remark, "remark")
    rows = clean.default_column(rows, "remark", None)
    found = text.parse_filename("file", ["report", "bu", "stcode", "cntdate"])
    rows = rows.withColumns({n: found[n] for n in ("bu", "stcode", "cntdate")}).withColumns(
        {"skutype": text.skutype_of("countname"), "rpname": F.lit(sheet)}
    )
    file_keys = ["bu", "stcode", "cntdate"]
    planned = gates.open_plan(plan, ["3F"])
    return gates.exists_gate(clean.require(rows, ["sku"]), planned, loaded, file_keys)


def sales_sheet(
    raw: DataFrame, plan: DataFrame, loaded: DataFrame, store: str = "mdstor2", plan_types: Sequence[str] = ("3F",)
) -> DataFrame:
    """Sales rows of the file's own store, planned, not loaded, without duplicates."""
    found = text.parse_filename("file", ["a", "b", "stcode", "cntdate", "e"], exact=True)
    rows = raw.drop("line").withColumns({"__store": found["stcode"], "cntdate": found["cntdate"]})
    rows = rows.filter(F.col(store) == F.col("__store")).drop("__store")
    rows = clean.rename_map(rows, {store: "mdstor"})
    planned = gates.open_plan(plan, plan_types).select(F.col("stcode").alias("mdstor"), "cntdate")
    keys = ["mdstor", "cntdate"]
    return drop_dupes(gates.exists_gate(rows, planned, loaded, keys).drop("file"))
