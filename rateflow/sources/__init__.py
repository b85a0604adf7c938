"""Sources and sinks: rating/item files and the driver-table views."""

from rateflow.sources.files import (
    item_genres,
    parse_item_lines,
    parse_rating_lines,
    read_items,
    read_lines,
    read_rating_lines,
    read_ratings,
)
from rateflow.sources.sinks import (
    build_once,
    import_ratings,
    reuse_or_build,
    write_ratings,
    write_shelves,
)
from rateflow.sources.tables import (
    event_rows,
    read_table,
    tpch_items,
    tpch_items_with_genres,
    tpch_rating_lines,
    tpch_ratings,
    tpch_users,
)

__all__ = [
    "build_once", "event_rows", "import_ratings", "item_genres", "parse_item_lines", "parse_rating_lines", "read_items", "read_lines", "read_rating_lines",
    "read_ratings", "read_table",
    "reuse_or_build", "tpch_items", "tpch_items_with_genres", "tpch_rating_lines", "tpch_ratings",
    "tpch_users", "write_ratings", "write_shelves",
]
