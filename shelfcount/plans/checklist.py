"""Checklist scoring and its report extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import clean, gates
from ..operators.joins import enrich
from ..operators.ranking import latest_per_group, visit_rank
from ..operators.reshape import unpivot_answers
from ..policy import FORM_NAMES, QUESTIONS, ZONES

FULL_POINT = 5


def questions(form: str) -> list[str]:
    """Question columns of a form, in upper case as the mapping sheet writes them."""
    return [c.upper() for prefix, last in QUESTIONS[form] for c in clean.numbered(prefix, 1, last)]


def prepare_answers(raw: DataFrame, asked: Sequence[str]) -> DataFrame:
    """Typed form entries from an all-text sheet, whatever language its headers are in."""
    named = clean.rename_map(clean.normalise_names(raw), FORM_NAMES)
    named = clean.rename_map(named, {c.lower(): c for c in asked})
    types = {"id": "bigint", "created": "timestamp", "check_date": "timestamp"}
    typed = clean.cast_map(named, {**types, **dict.fromkeys(asked, "bigint")})
    return typed.select(
        "id",
        dates.date_key("created").alias("checkdate"),
        "stcode",
        dates.date_key("check_date").alias("cntdate"),
        *asked,
    )


def score(
    answers: DataFrame,
    asked: Sequence[str],
    mapping: DataFrame,
    plan: DataFrame,
    stored: DataFrame,
    until: str,
) -> DataFrame:
    """Scored answers of the newest entry per store and date, planned and not stored yet.

    ``mapping`` has question_code, bu, zone, weight and descriptive columns. An unmapped
    question has no unit and falls out at the plan gate.
    """
    newest = latest_per_group(answers, ["stcode", "cntdate"], ["id"]).filter(F.col("cntdate") <= until)
    rows = unpivot_answers(newest, [c for c in newest.columns if c not in asked], asked)
    scored = enrich(rows, mapping, ["question_code"]).withColumns(
        {
            "full": F.lit(FULL_POINT) * F.col("weight"),
            "act": F.col("point") * F.col("weight"),
            "zone": text.replace_values("zone", ZONES),
        }
    )
    keys = ["bu", "stcode", "cntdate"]
    return gates.exists_gate(scored.drop("id"), gates.open_plan(plan), stored, keys)


def rename_mapping(mapping: DataFrame) -> DataFrame:
    """Question mapping sheet with the names the score table uses."""
    named = clean.rename_map(
        clean.normalise_names(mapping), {"code": "question_code", "subject": "section", "desceiption": "subject"}
    )
    columns = ["question_code", "bu", "zone", "weight", "no", "section", "subject", "subdescription"]
    return clean.cast_map(clean.keep(named, columns), {"weight": "double"})


def extract(checklist: DataFrame, plan: DataFrame, since: str) -> dict[str, DataFrame]:
    """Scored rows with the store type, and the numbered plan, for the report tool."""
    keys = ["bu", "stcode", "cntdate"]
    counted = plan.filter(F.col("atype").isin("3F", "3Q") & F.col("branch").isNotNull())
    rows = checklist.filter(F.col("checkdate") >= since).join(counted.select(*keys, "type1"), keys, "inner")
    visits = plan.filter((F.col("atype") == "3F") & (F.col("cntdate") >= since))
    return {"checklist": rows, "plan": visit_rank(visits)}
