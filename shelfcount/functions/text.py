"""Text expressions: codes, padding, file names. Every function takes and returns a Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(c: Column | str, width: int) -> Column:
    """Left-pad with zeros; longer text stays whole and a leading sign stays in front."""
    c = _col(c).cast("string")
    signed = F.substring(c, 1, 1).isin("+", "-")
    padded_signed = F.concat(F.substring(c, 1, 1), F.lpad(F.substr(c, F.lit(2)), width - 1, "0"))
    return (
        F.when(F.length(c) >= width, c)
        .when(signed, padded_signed)
        .otherwise(F.lpad(c, width, "0"))
    )


def lpad_code(c: Column | str, width: int) -> Column:
    """SQL padding: longer text is cut to ``width``."""
    return F.lpad(_col(c).cast("string"), width, "0")


def strip_zeros(c: Column | str) -> Column:
    return F.ltrim(_col(c), F.lit("0"))


def slice_text(c: Column | str, start: int, length: int) -> Column:
    return F.substring(_col(c), start, length)


def name_part(c: Column | str, separator: str, n: int) -> Column:
    """n-th part (1-based), empty text when there are fewer parts."""
    return F.split_part(_col(c), F.lit(separator), F.lit(n))


def scrub(c: Column | str) -> Column:
    """Remove line breaks and commas."""
    return F.translate(_col(c), "\n\r,", "")


def clean_cell(c: Column | str, quotes: str = "all") -> Column:
    """Turn line breaks into blanks, trim, empty becomes null; drop single quotes.

    ``quotes``: ``"all"`` drops every quote, ``"edges"`` those around the text.
    """
    c = _col(c)
    if quotes == "edges":
        c = F.translate(F.btrim(c, F.lit("'")), "\n\r", "  ")
    else:
        c = F.translate(c, "\n\r'", "  ")
    return F.nullif(F.trim(c), F.lit(""))


def query_param(url: Column | str, name: str) -> Column:
    """Value after ``name=`` up to ``&amp`` or the end, ``%20`` as blank; null if absent."""
    url = _col(url)
    value = F.regexp_extract(url, rf"{name}=(.*?)(?=&amp|$)", 1)
    return F.when(url.rlike(rf"{name}="), F.replace(value, F.lit("%20"), F.lit(" ")))


def extension(name: Column | str) -> Column:
    """Last ``.ext`` in lower case, null when there is none."""
    return F.nullif(F.lower(F.regexp_extract(_col(name), r"(\.[^.]+)$", 1)), F.lit(""))


def file_stem(path: Column | str) -> Column:
    """File name without folders and without the last extension."""
    # No regular expressions: the rows of a file all carry its name.
    name = F.substring_index(F.substring_index(_col(path), "/", -1), "\\", -1)
    ending = F.length(F.substring_index(name, ".", -1))
    return F.when(F.contains(name, F.lit(".")), F.left(name, F.length(name) - ending - 1)).otherwise(name)


def parse_filename(
    path: Column | str, names: Sequence[str], exact: bool = False
) -> dict[str, Column]:
    """Columns cut from the file stem at ``_``.

    ``exact`` gives nulls everywhere when the number of parts differs; otherwise missing
    parts alone are null and surplus parts are ignored.
    """
    return named_parts(file_parts(path), names, exact)


def file_parts(path: Column | str) -> Column:
    """The file stem cut at ``_``."""
    return F.split(file_stem(path), "_")


def named_parts(parts: Column | str, names: Sequence[str], exact: bool = False) -> dict[str, Column]:
    """``parse_filename`` for the parts of a name."""
    parts = _col(parts)
    out = {}
    for i, name in enumerate(names):
        part = F.get(parts, i)
        out[name] = F.when(F.size(parts) == len(names), part) if exact else part
    return out


def build_name(parts: Sequence[Column | str], repeat: Column | str | None, ext: Column | str) -> Column:
    """``a_b_c.ext``; a repeat number above 0 is added as ``_n`` before the extension."""
    stem = F.concat_ws("_", *[_col(p) for p in parts])
    if repeat is not None:
        repeat = _col(repeat)
        stem = F.when(repeat > 0, F.concat(stem, F.lit("_"), repeat.cast("string"))).otherwise(stem)
    return F.concat(stem, _col(ext))


def skutype_of(countname: Column | str) -> Column:
    """Second character 'B' means Credit, anything else (also null) Consign."""
    return F.when(F.substring(_col(countname), 2, 1) == "B", "Credit").otherwise("Consign")


def cntnum_store(cntnum: Column | str) -> Column:
    return F.left(_col(cntnum), F.lit(5))


def cntnum_date(cntnum: Column | str) -> Column:
    """``ddmmyy`` at positions 7-12 of the count number as ``yyyyMMdd`` text."""
    c = _col(cntnum)
    return F.concat(F.lit("20"), F.substring(c, 11, 2), F.substring(c, 9, 2), F.substring(c, 7, 2))


def cntnum_date_right(cntnum: Column | str) -> Column:
    """Same, counted from the right end (``ddmmyy`` before the 3-digit run number)."""
    six = F.left(F.right(_col(cntnum), F.lit(9)), F.lit(6))
    return F.concat(F.lit("20"), F.substring(six, 5, 2), F.substring(six, 3, 2), F.substring(six, 1, 2))


def century(c: Column | str) -> Column:
    return F.concat(F.lit("20"), _col(c))


def store_code(bu: Column | str, stcode: Column | str) -> Column:
    """Key ``bu‖store``; null if either part is null."""
    return F.concat(_col(bu), _col(stcode))


def split_store_code(code: Column | str, bu_length: int = 3) -> dict[str, Column]:
    code = _col(code)
    return {
        "bu": F.substring(code, 1, bu_length),
        "stcode": F.substr(code, F.lit(bu_length + 1)),
    }


def stocktake_id(*parts: Column | str, separator: str = "", suffix: str = "") -> Column:
    """Identifier joined from its parts (null if any is null) plus a fixed suffix."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i and separator:
            pieces.append(F.lit(separator))
        pieces.append(_col(part))
    if suffix:
        pieces.append(F.lit(suffix))
    return F.concat(*pieces)


def replace_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Exact-value replacement; values outside the mapping stay."""
    c = _col(c)
    out = F
    first = True
    for old, new in mapping.items():
        out = out.when(c == old, new)
        first = False
    return c if first else out.otherwise(c)


THAI = r"[฀-๿]"


def has_script(c: Column | str, char_class: str = THAI) -> Column:
    """True when the text holds a character of the class (default: Thai letters)."""
    return _col(c).rlike(char_class)


def join_nonzero(cols: Sequence[Column | str], zero: str = "0") -> Column:
    """Values other than ``zero`` joined by commas, null when none is left."""
    kept = [F.nullif(_col(c).cast("string"), F.lit(zero)) for c in cols]
    return F.nullif(F.concat_ws(",", *kept), F.lit(""))
