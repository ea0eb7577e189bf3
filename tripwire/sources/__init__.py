"""Batch tables, static dimensions and streaming sources."""
from tripwire.sources.dimensions import city_dimension  # noqa: F401
from tripwire.sources.streams import (  # noqa: F401
    json_line_messages,
    kafka_messages,
    parse_transactions,
    to_messages,
    transaction_file_stream,
)
from tripwire.sources.tables import (  # noqa: F401
    load_places,
    load_transactions,
    places_from_nation,
    table,
    transactions_from_events,
    transactions_from_orders,
)
