from cartwheel.sources.tables import (  # noqa: F401
    clickstream_events, item_property_log, order_transactions, read_table,
)
from cartwheel.sources.files import (  # noqa: F401
    load_events_csv, load_item_props_csv, load_typed, concat_parts, write_table,
    fingerprint, materialize, read_back,
)
