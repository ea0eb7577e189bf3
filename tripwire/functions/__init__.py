"""Column-level building blocks (built-in Spark functions only)."""
from tripwire.functions.columns import (  # noqa: F401
    alert_key,
    amount_in_eur,
    clock,
    currency_index,
    fx_rate,
    index_of,
    iso,
    literal_map,
    method_index,
)
