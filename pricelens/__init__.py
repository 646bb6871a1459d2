"""pricelens: market-segment pricing as Spark DataFrame plans.

The main entry points, re-exported for convenience; every function takes and returns
DataFrames and leaves the session to the caller.
"""

from pricelens.operators.formatting import (  # noqa: F401
    format_rates, format_rents, format_sales, last_n_rates, latest_rates_per_type, merge_rents,
    parse_sales, sales_reject_reason, scope_sales,
)
from pricelens.operators.market import (  # noqa: F401
    attach_rate, attach_rent, enrich, fair_price_estimates, latest_rate, latest_rents, segment_stats,
)
from pricelens.operators.valuation import (  # noqa: F401
    commune_count, latest_estimates, list_communes, market_profiles, quote, unmatched_listings,
    value_listings, verdict_summary,
)
from pricelens.plans.daily import run_daily, run_daily_incremental  # noqa: F401
