from basketry.sinks.outbox import Delivery, NotSent, Retries, publish, publish_once, read_ledger, read_outbox, write_outbox
from basketry.sinks.tables import read_history, replace_table, upsert_history, write_if_nonempty

__all__ = [
    "Delivery",
    "NotSent",
    "Retries",
    "publish",
    "publish_once",
    "read_history",
    "read_ledger",
    "read_outbox",
    "replace_table",
    "upsert_history",
    "write_if_nonempty",
    "write_outbox",
]
