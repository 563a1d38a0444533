"""Scalar column expressions (F1-F18).  All are built-in Spark expressions (codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip()/isspace() treat as whitespace,
# written as one regex class that both Java and RE2 accept.
PY_WHITESPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Position codes recognised in page text.
POSITION_CODES = ["ST", "CF", "LW", "RW", "CAM", "CM", "CDM", "CB", "LB", "RB", "GK", "LM", "RM"]
POSITION_CODE_PATTERN = r"\b(" + "|".join(POSITION_CODES) + r")\b"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    ws = PY_WHITESPACE_CLASS
    return F.regexp_replace(_c(x), f"^{ws}+|{ws}+$", "")


def safe_double(x) -> Column:
    """Number text -> double; anything else -> null (ANSI casts would raise)."""
    c = _c(x)
    return F.when(c.rlike(_NUMBER), F.trim(c).cast("double"))


def parse_money(x) -> Column:
    """F1: '€110.5M' -> 110500000, '€500K' -> 500000; no M/K suffix -> 0.

    'M' is tested before 'K' and both are case-sensitive.  An unparsable number
    gives null; callers drop such rows (the reference skips the record).
    """
    c = _c(x)
    m = safe_double(F.regexp_replace(c, "[€M]", "")) * F.lit(1_000_000.0)
    k = safe_double(F.regexp_replace(c, "[€K]", "")) * F.lit(1_000.0)
    return F.when(c.contains("M"), m).when(c.contains("K"), k).otherwise(F.lit(0.0))


def parse_rating(x) -> Column:
    """text before the first '+' or '-' ('75+2' -> '75')."""
    return F.split(_c(x), "[+-]").getItem(0)


def safe_int(x, default: int | None = 0) -> Column:
    """all-digit text -> int, else ``default`` (0 on list pages, null for stats)."""
    c = _c(x)
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint")).otherwise(F.lit(default).cast("bigint"))


def default_fill(x, default) -> Column:
    """empty or null -> default."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(default) if not isinstance(default, Column) else default)


def first_line(x) -> Column:
    """``text.strip().split('\\n')[0].strip()``."""
    return py_strip(F.substring_index(py_strip(x), "\n", 1))


def binarize(x, positive) -> Column:
    """1 where ``x == positive`` else 0."""
    return F.when(_c(x) == F.lit(positive), 1).otherwise(0)


def json_first_int(json_col, path: str) -> Column:
    """F8: first digit run of a JSON field as int; bad JSON / missing -> null."""
    s = F.get_json_object(_c(json_col), path)
    d = F.regexp_extract(s, r"(\d+)", 1)
    return F.when(d != "", d.try_cast("bigint"))


def regex_group(x, pattern: str, idx: int = 1) -> Column:
    """first match group, null when there is no match."""
    c = _c(x)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, idx))


def work_rate_text(x) -> Column:
    """``Work Rate.*?(\\w+)\\s*/\\s*(\\w+)`` (ignore case, Unicode \\w) -> 'a/b'."""
    # fixed value: the text pattern
    p = r"(?iU)Work Rate.*?(\w+)\s*/\s*(\w+)"
    c = _c(x)
    return F.when(c.rlike(p), F.concat(F.regexp_extract(c, p, 1), F.lit("/"), F.regexp_extract(c, p, 2)))


def work_rate_pair(x) -> Column:
    """``(Low|Medium|High)\\s*/\\s*(Low|Medium|High)`` ignore case, capitalised 'A/B'."""
    # fixed value: the text pattern
    p = r"(?i)(Low|Medium|High)\s*/\s*(Low|Medium|High)"
    c = _c(x)
    cap = lambda g: F.initcap(F.lower(F.regexp_extract(c, p, g)))
    return F.when(c.rlike(p), F.concat(cap(1), F.lit("/"), cap(2)))


def safe_name(x) -> Column:
    """spaces -> '_', dots removed."""
    return F.regexp_replace(F.regexp_replace(_c(x), " ", "_"), r"\.", "")


def join_distinct(arr, k: int = 5, sep: str = ", ") -> Column:
    """first-seen de-dup of an ordered array, first k, joined."""
    return F.array_join(F.slice(F.array_distinct(_c(arr)), 1, k), sep)


def position_codes(x) -> Column:
    """Set of position codes found in text, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(_c(x), F.lit(POSITION_CODE_PATTERN), 1)))


def keyword_flag(x, word: str) -> Column:
    """substring containment."""
    return _c(x).contains(word)


def is_position_code(x) -> Column:
    """F16: 2-3 characters, at least one cased character, none lower case."""
    c = _c(x)
    return (F.length(c).between(2, 3) & (F.upper(c) == c) & (F.lower(c) != c))


def sigmoid(z) -> Column:
    """1 / (1 + e^-z); no overflow error in Spark."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def prefix(x, n: int) -> Column:
    """first n characters."""
    return F.substring(_c(x), 1, n)
