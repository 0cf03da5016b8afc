from proplens.sources.tables import (  # noqa: F401
    FEED_COLUMNS, LINEITEM_KEYS, TABLES, prepared_sales, read_table, sales_view,
)
