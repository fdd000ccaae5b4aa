"""Columns by name, position or pattern; file and label names; kinds of columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What coordinate and EPSG columns are called.
X_NAMES = r"^(x|lon|long|longitude|easting|center_x|xcoord|x_coord)$"
Y_NAMES = r"^(y|lat|latitude|northing|center_y|ycoord|y_coord)$"
EPSG_NAMES = ("epsg", "srid", "code")

OPERATORS = {
    "numeric": ("==", "!=", ">", ">=", "<", "<=", "between", "in"),
    "datetime": ("==", "between"),
    "string": ("==", "!=", "in"),
    "other": ("==", "!=", "in"),
}


def strip_quotes(text: str) -> str:
    text = text.strip()
    return text[1:-1].strip() if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'" else text


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "string" if isinstance(data_type, T.StringType) else "other"


def kind_of_sql(sql_type: str) -> str:
    """Kind of a declared SQL type."""
    name = (sql_type or "").upper()
    if any(x in name for x in ("DATE", "TIME")):
        return "datetime"
    if any(x in name for x in ("INT", "REAL", "FLOA", "DOUB", "NUM", "DEC")):
        return "numeric"
    return "string" if any(x in name for x in ("CHAR", "TEXT", "CLOB", "STRING")) else "other"


def is_numeric(df: DataFrame, column: str) -> bool:
    return kind_of(df.schema[column].dataType) == "numeric"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if kind_of(f.dataType) == "numeric"]


def indices(spec: str, n: int, base: int = 0, strict: bool = True) -> list[int]:
    """'0,2-5' or 'all' as 0-based places, in order, each once; `base` is the number of the first."""
    if spec.strip().lower() in ("", "all"):
        return list(range(n))
    out = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        m = re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", part)
        if not m:
            if strict:
                raise ValueError(f"not a place or range: {part!r}")
            continue
        first, last = int(m[1]) - base, int(m[2] or m[1]) - base
        for i in range(min(first, last), max(first, last) + 1):
            if 0 <= i < n:
                out.append(i)
            elif strict:
                raise ValueError(f"out of range: {i + base}")
    return list(dict.fromkeys(out))


def columns(spec: str | int | Sequence[str | int] | None, all_columns: Sequence[str], strict: bool = True) -> list[str]:
    """Columns named by a spec that mixes names, places and ranges; empty means all; each once and in order."""
    if spec is None or spec == "" or spec == []:
        return list(all_columns)
    parts = [spec] if isinstance(spec, int) else spec.split(",") if isinstance(spec, str) else list(spec)
    out: list[str] = []
    for part in parts:
        name = part.strip() if isinstance(part, str) else all_columns[part]
        if name in all_columns:
            out.append(name)
        elif re.fullmatch(r"\d+(\s*-\s*\d+)?|all", name, re.IGNORECASE):
            out += [all_columns[i] for i in indices(name, len(all_columns), strict=strict)]
        elif strict:
            raise ValueError(f"no such column: {name}")
    return list(dict.fromkeys(out))


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def xy_columns(names: Sequence[str]) -> tuple[str, str] | None:
    """The coordinate columns by name, or None."""
    found = [next((c for c in names if re.search(p, c, re.IGNORECASE)), None) for p in (X_NAMES, Y_NAMES)]
    return (found[0], found[1]) if all(found) else None


def aliases(name: str) -> list[str]:
    """Other spellings under which a feature may be stored."""
    plain = re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")
    forms = [name, name.strip(), name.lower(), name.upper(), name.replace(" ", "_"), name.replace("-", "_"), name.replace(".", "_"), plain]
    forms += [name.replace("MeL", "MeU"), name.replace("MeU", "MeL")]
    return list(dict.fromkeys(forms))


def safe_filename(label: Column) -> Column:
    """A label as part of a path; null becomes 'NaN'."""
    return F.coalesce(F.regexp_replace(label.cast("string"), r'[\\/:*?"<>|\s]+', "_"), F.lit("NaN"))


def without_patterns(name: Column, patterns: Sequence[str]) -> Column:
    """A file name without these literal parts."""
    for pattern in patterns:
        name = F.replace(name, F.lit(pattern), F.lit(""))
    return name


def with_insert(name: Column, text: str, where: str) -> Column:
    """`text` before the name, before its extension, or both ('head', 'tail', 'both')."""
    stem, ext = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    head = F.lit(text if where in ("head", "both") else "")
    tail = F.lit(text if where in ("tail", "both") else "")
    return F.concat(head, stem, tail, ext)


def renamed_if(name: Column, patterns: Sequence[str], text: str, where: str, every: bool) -> Column:
    """`with_insert` for names that contain all (or any) of the patterns."""
    hits = [F.contains(name, F.lit(p)) for p in patterns]
    met = F.lit(every)
    for hit in hits:
        met = met & hit if every else met | hit
    return F.when(met, with_insert(name, text, where)).otherwise(name)


def epsg_of(df: DataFrame) -> Column:
    """Aggregate: the first non-null of the EPSG column, null if there is none."""
    name = next((c for c in df.columns if c.lower() in EPSG_NAMES), None)
    return F.first(F.col(name), ignorenulls=True) if name else F.lit(None).cast("int")
