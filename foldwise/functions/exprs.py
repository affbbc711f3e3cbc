"""Scalar feature functions as JVM-side ``Column`` expressions.

No Python UDF anywhere: every function returns a ``Column`` that stays inside
whole-stage codegen.  Java regular expressions are ASCII-only for ``\\d`` and
``\\s`` by default; ``(?U)`` gives the Unicode classes of Python's ``re``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Formal ("B") line:
TITLE_SYNONYMS = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
COMMON_TITLES = ["Mr", "Miss", "Mrs", "Master"]
RARE_TITLE = "Rare"
FAMILY_EDGES = [0, 1, 4, 6, float("inf")]
FAMILY_LABELS = ["Solo", "Small", "Medium", "Large"]
AGE_EDGES = [float("-inf"), 12, 18, 35, 50, 65, float("inf")]
AGE_LABELS = ["Child", "Teen", "Young", "Middle", "Senior", "Elder"]
CHILD_AGE_BELOW = 16
SEX_CODES = {"male": 0, "female": 1}
PRIORITY_SEX = "female"
CABIN_UNKNOWN = "U"
TICKET_EMPTY = "NONE"
TICKET_OTHER = "OTHER"
TICKET_MIN_COUNT = 10
CLASS_SEPARATOR = "_P"
# Earlier ("src") line:
SRC_TITLE_MAP = {
    "Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs",
    "Lady": "Royalty", "Countess": "Royalty", "Sir": "Royalty",
    "Jonkheer": "Royalty", "Don": "Royalty", "Dona": "Royalty",
    "Capt": "Officer", "Col": "Officer", "Major": "Officer",
    "Dr": "Dr", "Rev": "Rev",
}
SRC_UNKNOWN_TITLE = "Unknown"
SRC_CABIN_MISSING = "M"
SRC_AGE_CODE_EDGES = [0, 12, 20, 40, 60, 100]
SRC_AGE_CODE_DEFAULT = 2
SRC_AGE_BAND_EDGES = [0, 12, 20, 40, 60, 120]
SRC_AGE_BAND_LABELS = ["Child", "Teen", "Adult", "MiddleAge", "Senior"]
SRC_FARE_BIN_LABELS = ["VeryLow", "Low", "Medium", "High", "VeryHigh"]
SRC_FARE_BIN_DEFAULT = 2
# ---------------------------------------------------------------------------

TITLE_PATTERN = r"(?U),\s*([^.]*)\."          # B line: may capture an empty title
SRC_TITLE_PATTERN = r"(?U),\s*([^.]+)\."      # src line: at least one character


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: str | Column) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace (Spark ``trim`` only removes spaces)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def extract_title(name: str | Column) -> Column:
    """text between the first comma and the next dot, stripped; '' when absent."""
    return py_strip(F.regexp_extract(_c(name), TITLE_PATTERN, 1))


def map_values(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """replace values found in ``mapping``; others unchanged."""
    if not mapping:
        return _c(col)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[_c(col)], _c(col))


def keep_listed(col: str | Column, allowed: Sequence[str], other: str) -> Column:
    """value when in ``allowed``, else ``other`` (NULL also becomes ``other``)."""
    c = _c(col)
    return F.when(c.isin(*allowed), c).otherwise(F.lit(other))


def title_b(name: str | Column, synonyms: Mapping[str, str] = TITLE_SYNONYMS,
            common: Sequence[str] = COMMON_TITLES, rare: str = RARE_TITLE,
            strip_article: bool = False) -> Column:
    """F1-F3, formal line: extract, normalise synonyms, keep common titles, else Rare."""
    t = extract_title(name)
    if strip_article:
        t = F.regexp_replace(t, r"(?i)^the\s+", "")
    # synonyms and the list in one lookup, so that the expressions are worked out once a row
    kept = {v: v for v in common if v not in synonyms} | {k: v for k, v in synonyms.items() if v in common}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in kept.items() for x in kv])[t], F.lit(rare)) if kept else F.lit(rare)


def title_src(name: str | Column, mapping: Mapping[str, str] = SRC_TITLE_MAP,
              unknown: str = SRC_UNKNOWN_TITLE) -> Column:
    """F1+F2, earlier line: extraction needs one character; no match -> Unknown."""
    c = _c(name)
    raw = py_strip(F.regexp_extract(c, SRC_TITLE_PATTERN, 1))
    found = F.when(c.isNotNull() & c.rlike(SRC_TITLE_PATTERN), raw).otherwise(F.lit(unknown))
    return map_values(found, mapping)


def ticket_prefix(ticket: str | Column, empty: str = TICKET_EMPTY) -> Column:
    """drop digits, dots, slashes and whitespace, upper-case; empty -> NONE."""
    cleaned = F.upper(F.regexp_replace(F.coalesce(_c(ticket), F.lit("")), r"(?U)[\d./\s]", ""))
    return F.regexp_replace(cleaned, r"\A\z", empty.replace("\\", "\\\\").replace("$", "\\$"))  # names ``cleaned`` once


def first_letter(col: str | Column, missing: str = CABIN_UNKNOWN, blank_is_missing: bool = True) -> Column:
    """upper-cased first character; NULL (and blank) -> ``missing``."""
    c = _c(col)
    is_missing = c.isNull()
    if blank_is_missing:
        is_missing = is_missing | (py_strip(c) == "")
    return F.when(is_missing, F.lit(missing)).otherwise(F.upper(F.substring(c, 1, 1)))


def family_size(a: str | Column | None, b: str | Column | None) -> Column:
    """a + b + 1; an absent count column counts as 0."""
    ca = F.lit(0) if a is None else _c(a)
    cb = F.lit(0) if b is None else _c(b)
    return (ca + cb + F.lit(1)).cast("int")


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 integer."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def cut_right(col: str | Column, edges: Sequence[float], labels: Sequence, default=None) -> Column:
    """fixed right-closed bins (e0, e1], (e1, e2], ...; outside -> ``default``.

    (MLlib's Bucketizer is left-closed, so it cannot be used here.)
    """
    c = _c(col)
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = None
        if lo != float("-inf"):
            cond = c > F.lit(lo)
        if hi != float("inf"):
            upper = c <= F.lit(hi)
            cond = upper if cond is None else cond & upper
        if cond is None:
            cond = c.isNotNull()
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default))


def edges_below(c: Column, inner_edges: Column, most: int | None = None) -> Column:
    """Number of inner edges strictly below the value; ``most`` is a bound of the number of
    edges where the caller knows one (a lambda keeps a stage out of compiled code)."""
    if most is None:
        return F.size(F.filter(inner_edges, lambda e: e < c))
    below = F.lit(0)
    for i in range(most):
        below = below + F.when(F.get(inner_edges, F.lit(i)) < c, 1).otherwise(0)
    return F.when(inner_edges.isNull(), F.size(inner_edges)).otherwise(below)


def learned_bin(col: str | Column, inner_edges: Column, prefix: str = "Q", most: int | None = None) -> Column:
    """1 + number of inner edges strictly below the value -> ``Q<n>``."""
    c = _c(col)
    n = edges_below(c, inner_edges, most) + 1
    return F.when(c.isNull(), F.lit(None)).otherwise(F.concat(F.lit(prefix), n.cast("string")))


def learned_bin_code(col: str | Column, inner_edges: Column, most: int | None = None) -> Column:
    """F12 (coded form): 0-based bin number from learned inner edges."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(edges_below(c, inner_edges, most))


def two_value_code(col: str | Column, codes: Mapping[str, int] = SEX_CODES, other: int = -1) -> Column:
    """map two known values to codes, anything else (and NULL) -> -1."""
    c = _c(col)
    expr = None
    for k, v in codes.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(other)).cast("int")


def log1p(col: str | Column) -> Column:
    """ln(1 + x); NULL for x <= -1 (never an error)."""
    c = _c(col)
    return F.when(c > -1, F.log1p(c))


def ratio(num: str | Column, den: str | Column) -> Column:
    """F16: num / den; NULL on a zero denominator (ANSI division would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def product(a: str | Column, b: str | Column) -> Column:
    """F17."""
    return _c(a) * _c(b)


def interaction(a: str | Column, b: str | Column, sep: str = CLASS_SEPARATOR) -> Column:
    """``a + sep + str(b)``."""
    return F.concat(_c(a), F.lit(sep), _c(b).cast("string"))


def char_length(col: str | Column) -> Column:
    """number of characters (code points)."""
    return F.coalesce(F.length(_c(col)), F.lit(0)).cast("int")


def priority_rule(sex: str | Column, age: str | Column, priority_value: str = PRIORITY_SEX,
                  below: float = CHILD_AGE_BELOW) -> Column:
    """1 when sex is the priority value or age is below the threshold."""
    return F.when(_c(sex) == priority_value, 1).when(_c(age) < below, 1).otherwise(0)


def safe_cast(col: str | Column, to: str) -> Column:
    """P10: cast that yields NULL for dirty input (a plain cast raises under ANSI)."""
    return _c(col).try_cast(to)


def nan_as_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN means missing: floating columns (of ``columns``, all when None) with
    NaN turned into NULL.  Done at the entry of every fit and apply."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")
                and (columns is None or f.name in columns)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def pct(num: str | Column, den: str | Column, decimals: int = 2) -> Column:
    """rounded percentage."""
    return F.round(F.lit(100.0) * _c(num) / _c(den), decimals)
