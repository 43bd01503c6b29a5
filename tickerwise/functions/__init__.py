from tickerwise.functions.exprs import (  # noqa: F401
    safe_div, int_mix, unit_uniform, erfc_expr, ks_pvalue_expr, round_doubles,
    by_ticker, rolling, null_safe_bool,
)
