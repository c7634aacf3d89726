from edustar.functions.expr import (  # noqa: F401
    credit_band,
    moment_corr,
    pass_rate_pct,
    rate_pct,
    risk_band,
    round_dec,
)
