from basketry.sources.bucketed import read_bucketed_orders, write_bucketed_orders
from basketry.sources.star import StarSchema
from basketry.sources.tables import Sources, read_orders, read_sources, read_table, table_exists, table_folder

__all__ = ["Sources", "StarSchema", "read_bucketed_orders", "read_orders", "read_sources", "read_table", "table_exists", "table_folder", "write_bucketed_orders"]
