"""Column-expression helpers.  All JVM-side built-ins, no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.schema import KEY, ORDER


def by_ticker(key: str = KEY, order: str = ORDER):
    """The one window spec every per-ticker operator shares (one Exchange + Sort)."""
    return Window.partitionBy(key).orderBy(order)


def rolling(n: int, key: str = KEY, order: str = ORDER):
    return by_ticker(key, order).rowsBetween(-(n - 1), 0)


def safe_div(num, den) -> Column:
    """NULL when the denominator is 0 or NULL (pandas gives inf/NaN; we keep NULL)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den != 0, num / den)


def null_safe_bool(cond: Column) -> Column:
    """Comparisons with NULL operands never count as a violation."""
    return F.coalesce(cond, F.lit(False))


_M = (1 << 31) - 1


def int_mix(*cols, seed: int = 42) -> Column:
    """Portable integer hash in [0, 2^31-1): the same arithmetic runs in DuckDB.

    ((k * 1103515245 + seed * 12345) mod (2^31-1)) applied once per key
    column, chaining the previous value.  Inputs must be non-negative BIGINT.
    """
    h = F.lit(seed).cast("bigint")
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        h = F.pmod(F.pmod(c.cast("bigint") + h * 31, F.lit(_M)) * 1103515245 + 12345, F.lit(_M))
    return h


def int_mix_sql(cols: list[str], seed: int = 42) -> str:
    """DuckDB twin of :func:`int_mix`."""
    h = f"CAST({seed} AS BIGINT)"
    for c in cols:
        h = (f"((((CAST({c} AS BIGINT) + ({h}) * 31) % {_M}) * 1103515245 + 12345) % {_M})")
    return h


def unit_uniform(*cols, seed: int = 42) -> Column:
    """Deterministic U[0,1) from the key columns (replaces a seeded RNG)."""
    return int_mix(*cols, seed=seed).cast("double") / F.lit(float(_M))


# ---- fixed values: erfcc coefficients (Numerical Recipes, Chebyshev fit) ----
ERFC_COEFFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
# ---- end of fixed values ----


def erfc_expr(x: Column) -> Column:
    """erfc(x) for x >= 0 (|relative error| < 1.2e-7); Spark has no erf."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * x)
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


def erfc_sql(x: str) -> str:
    """DuckDB twin of :func:`erfc_expr` (same operation order)."""
    t = f"(1.0 / (1.0 + 0.5 * ({x})))"
    poly = repr(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    return f"({t} * exp(-({x}) * ({x}) + {poly}))"


def ks_pvalue_sql(d: str, n: str, m: str, terms: int = 100) -> str:
    """DuckDB twin of :func:`ks_pvalue_expr`."""
    ne = f"(CAST({n} AS DOUBLE) * CAST({m} AS DOUBLE) / CAST({n} + {m} AS DOUBLE))"
    lam = f"((sqrt({ne}) + 0.12 + 0.11 / sqrt({ne})) * {d})"
    q = (f"(list_reduce(list_transform(range(1, {terms + 1}), lambda j: pow(-1.0, j - 1) * "
         f"exp(-2.0 * j * j * {lam} * {lam})), lambda acc, x: acc + x) * 2.0)")
    return f"(CASE WHEN {lam} < 0.001 THEN 1.0 ELSE greatest(0.0, least(1.0, {q})) END)"


def ks_pvalue_expr(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value.

    lambda = (sqrt(ne) + 0.12 + 0.11/sqrt(ne)) * D with ne = n*m/(n+m);
    Q(lambda) = 2 * sum_{j>=1} (-1)^(j-1) exp(-2 j^2 lambda^2), clipped to [0, 1].
    """
    ne = (n.cast("double") * m.cast("double")) / (n + m).cast("double")
    lam = (F.sqrt(ne) + F.lit(0.12) + F.lit(0.11) / F.sqrt(ne)) * d
    q = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(F.lit(-2.0) * j * j * lam * lam),
    ) * F.lit(2.0)
    return F.when(lam < F.lit(1e-3), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), q)))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (result presentation; the oracle does the same)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def file_safe(name: Column) -> Column:
    """A ticker as part of a file name: dots become underscores."""
    return F.replace(name, F.lit("."), F.lit("_"))


def title_case(name: Column) -> Column:
    """``high_less_than_low`` -> ``High Less Than Low``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(X > x) of a chi-square variable with whole ``dof``: its closed finite sum, term by term in logarithms.

    Even dof: exp(-h) sum of h^j / j! for j < dof / 2, h = x / 2.  Odd dof: erfc(sqrt(h)) + exp(-h) sum of h^(j - 1/2) / Gamma(j + 1/2) for
    j <= (dof - 1) / 2, where erf(sqrt(h)) is its series of positive terms (beyond h = 50 the tail is under 1e-22).
    No degree of freedom or x <= 0 gives 1, a NULL x gives NULL.
    """
    h, odd = x / F.lit(2.0), dof % 2 == 1

    def series(first: Column, count: Column, shift: Column) -> Column:
        """Sum of ``count`` terms; a term's logarithm grows by log(h / (j + shift)) from one to the next."""
        start = F.struct(first.alias("l"), F.exp(first).alias("s"))
        step = lambda a, j: F.struct((a["l"] + F.log(h) - F.log(j + shift)).alias("l"),
                                     (a["s"] + F.exp(a["l"] + F.log(h) - F.log(j + shift))).alias("s"))
        rest = F.when(count > 1, F.sequence(F.lit(1), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(rest, start, step, lambda a: a["s"])

    half = F.lit(0.5) * F.log(F.lit(4.0 / 3.141592653589793)) + F.lit(0.5) * F.log(h) - h  # of exp(-h) h^(1/2) / Gamma(3/2)
    erf = series(half, F.lit(176), F.lit(0.5))
    sums = F.when(odd, F.when(dof == 1, F.lit(0.0)).otherwise(series(half, (dof - 1) / 2, F.lit(0.5)))).otherwise(series(-h, dof / 2, F.lit(0.0)))
    tail = F.when(odd & (h <= 50), F.greatest(F.lit(1.0) - erf, F.lit(0.0))).otherwise(F.lit(0.0)) + sums
    return F.when((dof < 1) | (x <= 0), F.lit(1.0)).when(x.isNotNull(), F.least(tail, F.lit(1.0)))
