from basketry.operators.baskets import basket_counts, baskets
from basketry.operators.checks import assert_unique, fanout
from basketry.operators.closed import closed_itemsets, expanded
from basketry.operators.dataset import (
    basket_rows,
    eligible_lines,
    listed_codes,
    matched_lines,
    normalized_codes,
    order_lines,
    order_window,
    units_sold,
)
from basketry.operators.documents import mba_documents, ranking_documents, to_messages
from basketry.operators.mining import frequent_itemsets
from basketry.operators.moving import MovingItemsets, family_counts
from basketry.operators.ranking import ranked_units, ranking_topk, top_products
from basketry.operators.rules import association_rules, pair_best_metric, recommendation_pairs
from basketry.operators.snapshot import latest_snapshot, partner_copies

__all__ = [
    "MovingItemsets",
    "assert_unique",
    "association_rules",
    "basket_counts",
    "basket_rows",
    "baskets",
    "closed_itemsets",
    "eligible_lines",
    "expanded",
    "family_counts",
    "fanout",
    "frequent_itemsets",
    "latest_snapshot",
    "listed_codes",
    "matched_lines",
    "mba_documents",
    "normalized_codes",
    "order_lines",
    "order_window",
    "pair_best_metric",
    "partner_copies",
    "ranked_units",
    "ranking_documents",
    "ranking_topk",
    "recommendation_pairs",
    "to_messages",
    "top_products",
    "units_sold",
]
