"""Pure Column expressions: cleaning, typing, parsing, derived labels.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen.  Parsing always goes through ``try_*`` so that, under ANSI mode, a bad
value becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Market-cap tier thresholds and labels (strict ">" comparisons).
TIER_STRICT_THRESHOLDS = (100_000_000_000, 10_000_000_000, 1_000_000_000)
TIER_STRICT_LABELS = ("Mega", "Large", "Mid", "Small")
# Right-closed tier bins (0, 1e9], (1e9, 1e10], (1e10, 1e11], (1e11, inf).
TIER_BIN_EDGES = (0.0, 1e9, 10e9, 100e9, float("inf"))
TIER_BIN_LABELS = ("Small", "Mid", "Large", "Mega")


# ---------------------------------------------------------------- 2C columns
def case_label(c: ColumnOrName, mapping: dict, default=None) -> Column:
    """CASE WHEN c = k THEN v ... ELSE default."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(_c(c) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(_c(c) == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def zero_if_null(c: ColumnOrName) -> Column:
    """Null or absent numeric becomes 0 before arithmetic."""
    return F.coalesce(_c(c), F.lit(0))


def normalise_key(c: ColumnOrName) -> Column:
    """C11: trim + lower case a key (``' US '`` -> ``us``)."""
    return F.lower(F.trim(_c(c)))


def split_keys(c: ColumnOrName, sep: str = ",") -> Column:
    """C11: ``'US, gb'`` -> ``['us', 'gb']`` (explode it for one row per key)."""
    return F.transform(F.split(_c(c), sep), lambda x: F.lower(F.trim(x)))


# ---------------------------------------------------------------- 2I scalars
def title_case(c: ColumnOrName) -> Column:
    """Strip, then capitalise after every non-letter (Python ``str.title``).

    ``initcap`` only capitalises after white space, so split the text into runs of
    letters and runs of non-letters and capitalise each letter run.
    """
    runs = F.regexp_extract_all(F.trim(_c(c)), F.lit(r"\p{L}+|[^\p{L}]+"), 0)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def tier_strict(c: ColumnOrName, thresholds: Sequence[float] = TIER_STRICT_THRESHOLDS,
                labels: Sequence[str] = TIER_STRICT_LABELS) -> Column:
    """First label whose threshold is strictly exceeded; otherwise the last label.

    Null input is treated as 0 (the snapshot transform coalesces before tiering).
    """
    v = zero_if_null(c)
    expr = F.when(v > F.lit(thresholds[0]), F.lit(labels[0]))
    for t, lab in zip(thresholds[1:], labels[1:]):
        expr = expr.when(v > F.lit(t), F.lit(lab))
    return expr.otherwise(F.lit(labels[len(thresholds)]))


def tier_bins(c: ColumnOrName, edges: Sequence[float] = TIER_BIN_EDGES,
              labels: Sequence[str] = TIER_BIN_LABELS) -> Column:
    """I4: right-closed bins ``(e0, e1], (e1, e2], ...``; outside or null -> null."""
    v = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = v > F.lit(lo)
        if hi != float("inf"):
            cond = cond & (v <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, digits: int | None = None) -> Column:
    """Num / den, null when den is 0 or null, optionally rounded."""
    d = _c(den)
    r = F.when(d != 0, F.try_divide(_c(num).cast("double"), d.cast("double")))
    return F.round(r, digits) if digits is not None else r


def positive_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Num / den only when den > 0, else null (like ratio, engagement rate)."""
    d = _c(den)
    return F.when(d > 0, _c(num).cast("double") / d.cast("double")).otherwise(
        F.lit(None).cast("double"))


def rounded_diff(a: ColumnOrName, b: ColumnOrName, digits: int = 2) -> Column:
    """round(a - b, digits)."""
    return F.round(_c(a) - _c(b), digits)


def parse_instant(c: ColumnOrName) -> Column:
    """I8: ISO-8601 text (``Z`` or offset allowed) -> timestamp; bad text -> null."""
    col = _c(c)
    return F.try_to_timestamp(col.cast("string"))


def days_since(c: ColumnOrName, asof: datetime | str | Column) -> Column:
    """Whole 24-hour days from an instant to ``asof``, floored; unparsable -> null.

    ``asof`` is a parameter so a run is repeatable (never ``now()`` inside logic).
    """
    ts = _c(c).try_cast("timestamp")
    a = asof if isinstance(asof, Column) else F.lit(asof).cast("timestamp")
    return F.floor((F.unix_micros(a) - F.unix_micros(ts)) / F.lit(86_400_000_000)).cast("int")


def parse_yy_dd_mm(c: ColumnOrName) -> Column:
    """``YY.DD.MM`` text -> date (``17.14.11`` -> 2017-11-14); bad text -> null."""
    return F.try_to_date(_c(c), "yy.dd.MM")


def to_day(c: ColumnOrName) -> Column:
    """Timestamp (or timestamp text) -> date; bad text -> null."""
    return _c(c).try_cast("timestamp").cast("date")


def rescale(c: ColumnOrName, factor: float = 1.8, offset: float = 32.0) -> Column:
    """Linear rescale ``v * factor + offset``."""
    return _c(c) * F.lit(factor) + F.lit(offset)


def parse_fields(c: ColumnOrName, pattern: str, names: Sequence[str]) -> list[Column]:
    """Regex with one group per name; empty capture -> null."""
    out = []
    for i, n in enumerate(names, start=1):
        v = F.regexp_extract(_c(c), pattern, i)
        out.append(F.when(v != "", v).alias(n))
    return out


def row_to_json(*cols: ColumnOrName) -> Column:
    """Row -> JSON object text."""
    return F.to_json(F.struct(*[_c(x) for x in cols]))


# Run-stamp formats (Python strftime %Y%m%dT%H%M%S, %Y-%m-%d %H:%M:%S, %Y%m%d_%H%M%S).
RUN_STAMP_FORMATS = {
    "compact": "yyyyMMdd'T'HHmmss",
    "iso": "yyyy-MM-dd HH:mm:ss",
    "underscore": "yyyyMMdd_HHmmss",
    "date": "yyyy-MM-dd",
    "hour": "HH",
}


def run_stamps(ts: ColumnOrName) -> list[Column]:
    """The stamp strings used in file names and folder layouts."""
    return [F.date_format(_c(ts), fmt).alias(f"stamp_{k}") for k, fmt in RUN_STAMP_FORMATS.items()]


def minus_interval(ts: ColumnOrName, interval: str) -> Column:
    """``ts - INTERVAL ...`` (e.g. ``'15 minutes'``, ``'48 hours'``)."""
    return _c(ts) - F.expr(f"INTERVAL {interval}")


def tolerant_cast(c: ColumnOrName, to: str | DataType) -> Column:
    """Text -> number (or any type); bad value -> null."""
    return _c(c).try_cast(to)


def file_basename(path: ColumnOrName) -> Column:
    """Last path segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def url_decode(c: ColumnOrName) -> Column:
    """Percent-decode an object key; malformed escapes -> null."""
    return F.try_url_decode(_c(c))


def time_bin(ts: ColumnOrName, width: str) -> Column:
    """Start of the fixed-width bin holding ``ts`` (``'5 minutes'``)."""
    return F.window(_c(ts), width).start


def decode_payload(c: ColumnOrName) -> Column:
    """base64 -> UTF-8 -> JSON text; text that is not JSON becomes ``{"raw": text}``."""
    text = F.try_to_binary(_c(c), F.lit("base64"))
    text = F.decode(text, "UTF-8")
    return F.when(F.try_parse_json(text).isNull(), F.to_json(F.struct(text.alias("raw")))).otherwise(text)


def resolve_choice(c: ColumnOrName, types: Sequence[str] = ("long", "string")) -> Column:
    """Mixed-type text column -> struct with one field per declared type.

    Each field holds the value when it reads as that type; the ``string`` field
    holds only what no earlier type could take.
    """
    col = _c(c)
    fields = []
    taken = None
    for t in types:
        if t == "string":
            v = col.cast("string")
            if taken is not None:
                v = F.when(taken.isNull(), v)
            fields.append(v.alias("string"))
        else:
            v = col.cast("string").try_cast(t)
            fields.append(v.alias(t))
            taken = v if taken is None else F.coalesce(taken, v)
    return F.struct(*fields)


# ---------------------------------------------------------------- frame-level helpers
def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """C4: ``[(src, src_type, dst, dst_type)]`` rename + cast; unmapped columns dropped;
    a source column absent from the frame becomes a typed null."""
    present = {f.lower(): f for f in df.columns}
    cols = []
    for src, _stype, dst, dtype in mapping:
        name = present.get(src.lower())
        if name is None:
            cols.append(F.lit(None).cast(dtype).alias(dst))
        else:
            cols.append(F.col(f"`{name}`").try_cast(dtype).alias(dst))
    return df.select(*cols)


def ensure_column(df: DataFrame, name: str, default, dtype: str = "string") -> DataFrame:
    """Add ``name`` as ``default`` when absent; otherwise fill its nulls."""
    if name not in df.columns:
        return df.withColumn(name, F.lit(default).cast(dtype))
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(default).cast(dtype)))


def drop_null_fields(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row (one aggregation pass, one summary row)."""
    if not df.columns:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Recursively flatten struct columns into ``parent_child`` names."""
    from pyspark.sql.types import StructType

    def walk(schema: StructType, prefix: list[str]):
        out = []
        for f in schema.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, StructType):
                out.extend(walk(f.dataType, path))
            else:
                ref = ".".join(f"`{p}`" for p in path)
                out.append(F.col(ref).alias(sep.join(path)))
        return out

    return df.select(*walk(df.schema, []))
