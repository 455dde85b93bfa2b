"""String expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a maximal run of letters/digits; everything else is a separator run.
_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def pg_initcap(col: Column | str) -> Column:
    """INITCAP with the PostgreSQL word rule.

    A word starts after *any* non-alphanumeric character (``abbott-munoz`` ->
    ``Abbott-Munoz``, ``o'neil`` -> ``O'Neil``); Spark's built-in ``initcap``
    only splits on blanks.  Built from ``regexp_extract_all`` + ``transform`` so
    it stays a native expression (no Python UDF).
    """
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(F.lower(c), F.lit(_RUNS), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(r.substr(F.lit(1), F.lit(1))),
                                             r.substr(F.lit(2), F.length(r)))),
        "",
    )


def clean_name(col: Column | str) -> Column:
    """Normalised entity key: ``INITCAP(TRIM(x))``."""
    c = F.col(col) if isinstance(col, str) else col
    return pg_initcap(F.trim(c))


# The country canonicalisation rules, in order (first match wins).
# (kind, pattern, canonical)
USA_SPELLINGS = ["USA", "ESTADOS UNIDOS"]
COUNTRY_RULES = [
    ("like", "Pa%ses Bajos", "Países Bajos"),
    ("like", "Espa%a", "España"),
    ("like", "Canad%", "Canadá"),
    ("eq", "Reino Unido", "Reino Unido"),
    ("eq", "Rusia", "Rusia"),
]


def canonical_country(col: Column | str) -> Column:
    """Country clean-up: every USA spelling -> ``USA``; accent-tolerant names;
    otherwise ``INITCAP(TRIM(x))``."""
    c = F.col(col) if isinstance(col, str) else col
    ic = pg_initcap(F.trim(c))
    expr = F.when(F.upper(F.replace(F.trim(c), F.lit("."), F.lit(""))).isin(USA_SPELLINGS), F.lit("USA"))
    for kind, pat, canon in COUNTRY_RULES:
        cond = ic.like(pat) if kind == "like" else (ic == F.lit(pat))
        expr = expr.when(cond, F.lit(canon))
    return expr.otherwise(ic)


def basic_country(col: Column | str) -> Column:
    """Legacy country clean-up: ``TRIM(UPPER(x))`` only (keeps ``U.S.A.``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.upper(c))
