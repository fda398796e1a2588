"""Book-versus-count reports. All sums run over exact decimals in one partial/final aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import as_double, exact, negative_part, positive_part, ratio


def _sum(c: Column, name: str) -> Column:
    return as_double(F.sum(c)).alias(name)


def variance_kpi(stk: DataFrame, keys: Sequence[str], ext: str = "extcst_var") -> DataFrame:
    """Book value, gain, loss, net, absolute variance and accuracy per key."""
    value = exact(stk, ext)
    sums = stk.groupBy(*keys).agg(
        F.sum(exact(stk, F.col("soh") * F.col("cost"))).alias("__soh"),
        F.sum(positive_part(value)).alias("__gain"),
        F.sum(negative_part(value)).alias("__loss"),
        F.sum(value).alias("__net"),
    )
    absolute = F.col("__gain") - F.col("__loss")
    return sums.select(
        *keys,
        as_double(F.col("__soh")).alias("vsoh"),
        as_double(F.col("__gain")).alias("vgain"),
        as_double(F.col("__loss")).alias("vloss"),
        as_double(F.col("__net")).alias("vnet"),
        as_double(absolute).alias("vabs"),
        (F.lit(1) - ratio(absolute, F.col("__soh"))).alias("acc"),
    )


def sales_by_type(sales: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Sales per store, date and SKU type: the two amount columns become two rows."""
    keys = ["stcode", "cntdate", *also]
    sums = sales.withColumnRenamed("mdstor", "stcode").groupBy(*keys).agg(
        F.sum(exact(sales, "credit")).alias("Credit"), F.sum(exact(sales, "consignment")).alias("Consign")
    )
    return sums.unpivot(keys, ["Credit", "Consign"], "skutype", "amount").withColumn(
        "amount", as_double(F.col("amount"))
    )


def variance_to_sales(kpi: DataFrame, sales: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """KPI rows with their sales amount and net variance per sales (``also``: further join keys)."""
    joined = kpi.join(sales_by_type(sales, also), ["stcode", "cntdate", "skutype", *also], "left")
    return joined.select(
        *kpi.columns, ratio(F.col("vnet"), F.col("amount")).alias("vnet_to_sale"), "amount"
    )


def variance_by_dept(stk: DataFrame, dept: DataFrame, keys: Sequence[str], dept_keys: Sequence[str]) -> DataFrame:
    """KPI per type and department with the department's names."""
    return variance_kpi(stk, [*keys, *dept_keys]).join(dept, list(dept_keys), "left")


def _report_measures() -> list[Column]:
    return [*_report_counts(), *[_sum(c, name) for name, c in _report_values().items()]]


def _report_counts() -> list[Column]:
    variance = F.col("variance")
    return [
        F.count(F.lit(1)).alias("sku_count"),
        F.count_if(variance == 0).alias("sku_eq"),
        F.count_if(variance > 0).alias("sku_gain"),
        F.count_if(variance < 0).alias("sku_loss"),
    ]


def _report_values() -> dict[str, Column]:
    """What the report adds up, by the name of the sum."""
    variance, retail, cost = F.col("variance"), F.col("var_retail"), F.col("var_cost")
    return {
        "qnt_soh": F.col("stock"),
        "qnt_physical": F.col("qnt"),
        "qnt_gain": positive_part(variance),
        "qnt_loss": negative_part(variance),
        "qnt_variance": variance,
        "retail_soh": F.col("qnt_retail") - retail,
        "cost_soh": F.col("qnt_cost") - cost,
        "retail_physical": F.col("qnt_retail"),
        "cost_physical": F.col("qnt_cost"),
        "retail_gain": positive_part(retail),
        "cost_gain": positive_part(cost),
        "retail_loss": negative_part(retail),
        "cost_loss": negative_part(cost),
        "retail_net": retail,
        "cost_net": cost,
    }


VALUES = ("stock", "qnt", "variance", "qnt_retail", "qnt_cost", "var_retail", "var_cost")


def _exact(stk: DataFrame) -> DataFrame:
    return stk.withColumns({c: exact(stk, c) for c in VALUES})


def store_report(stk: DataFrame, keys: Sequence[str] = ("stcode", "cntdate", "rpname", "skutype")) -> DataFrame:
    """Nineteen measures per store, date, report and type."""
    return _exact(stk).groupBy(*keys).agg(*_report_measures())


def dept_report(stk: DataFrame, final: str = "STK2") -> DataFrame:
    """The same measures per department, final report only."""
    return store_report(
        stk.filter(F.col("rpname") == final),
        ["stcode", "cntdate", "rpname", "skutype", "dept", "sub_dept"],
    )


COUNT_KEYS = ("stcode", "cntdate")
STORE_KEYS = (*COUNT_KEYS, "rpname", "skutype")
DEPT_KEYS = (*STORE_KEYS, "dept", "sub_dept")


#: Slots of the hash of a count, and the lines of a count that one task adds up by itself.
SLOTS = 4096
LARGE = 500_000


def _slot() -> Column:
    return F.pmod(F.xxhash64(*COUNT_KEYS), F.lit(SLOTS))


def _large_slots(stk: DataFrame, large: int) -> list[int]:
    """Slots with more lines than one task should add up; a count of that size is always in one of them.

    There are at most a quarter of ``SLOTS``, however many lines there are.
    """
    counted = stk.groupBy(_slot().alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()
    least = max(large, 4 * sum(r["n"] for r in counted) // SLOTS)
    return sorted(r["slot"] for r in counted if r["n"] > least)


def _levels(lines: DataFrame, final: str) -> DataFrame:
    """Sums of lines by store, and of those of the final report by department too."""
    kinds = {c: lines.schema[c].dataType for c in ("dept", "sub_dept")}
    none = [F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
    store = F.struct(F.lit("store").alias("level"), *none)
    dept = F.struct(F.lit("dept").alias("level"), *kinds)
    at = F.explode(F.when(F.col("rpname") == final, F.array(store, dept)).otherwise(F.array(store))).alias("__at")
    rows = lines.select(*STORE_KEYS, *VALUES, at).select("*", "__at.*").drop("__at")
    return rows.groupBy(*DEPT_KEYS, "level").agg(*_report_measures())


def reports_by_level(stk: DataFrame, final: str = "STK2", large: int = LARGE) -> DataFrame:
    """The store report and the department report as one table with a ``level``.

    The lines of a count are dealt to one task, which adds up both levels: they are shuffled once, narrower than the
    sums of their small groups would be. Counts of over ``large`` lines are added up by the tasks that read them first.
    Rows of the store level have no department; those of the department level are the final report's.
    """
    lines = _exact(stk).select(*DEPT_KEYS, *VALUES)
    slots = _large_slots(stk, large)
    if not slots:
        return _levels(lines.repartition(*COUNT_KEYS), final)
    apart = _slot().isin(slots)
    # The few sums of the large counts go to the same tasks as those of the others: a join by count then moves neither.
    few = _levels(lines.filter(apart), final).repartition(*COUNT_KEYS)
    return _levels(lines.filter(~apart).repartition(*COUNT_KEYS), final).unionByName(few)


def sku_outcome_counts(
    stk: DataFrame, names: DataFrame, variance: str = "varianceqnt", store: str = "stmerch", stores: Sequence[str] | None = None
) -> DataFrame:
    """Rows counted equal, gained and lost per SKU, over the chain or a list of stores."""
    rows = stk if stores is None else stk.filter(F.col(store).isin(*stores))
    v = F.col(variance)
    counted = rows.groupBy("sku").agg(
        F.count_if(v == 0).alias("eq0"),
        F.count_if(v > 0).alias("gain"),
        F.count_if(v < 0).alias("loss"),
        F.count(F.lit(1)).alias("overall"),
    )
    return counted.join(names, "sku", "inner").select("sku", "prname", "eq0", "gain", "loss", "overall")


def line_variance(stk: DataFrame, counted: str = "qty_count", book: str = "soh") -> DataFrame:
    """Quantity variance and its value at retail and cost per line."""
    diff = F.col(counted) - F.col(book)
    return stk.withColumns(
        {
            "qty_var": diff,
            "extrtl_var": diff * F.col("retail"),
            "extcst_var": diff * F.col("cost"),
        }
    )
