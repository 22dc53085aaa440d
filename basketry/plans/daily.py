"""The daily run: recommendations, history, ranking, documents and messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from basketry.functions.metrics import METRICS
from basketry.operators import (
    baskets,
    frequent_itemsets,
    matched_lines,
    mba_documents,
    order_lines,
    ranking_documents,
    ranking_topk,
    recommendation_pairs,
    to_messages,
)
from basketry.operators.dataset import eligible_lines
from basketry.operators.documents import MBA, RANKING
from basketry.params import METRIC, MIN_THRESHOLD, TOP_K, MiningParams, OrderFilter, RunWindow
from basketry.sinks import replace_table, upsert_history, write_if_nonempty, write_outbox
from basketry.sources import Sources, read_table, table_exists
from basketry.workspace import Workspace


@dataclass(frozen=True)
class Outputs:
    """Where a run writes, below one root."""

    root: str

    @property
    def pairs(self) -> str:
        return f"{self.root}/recommendation_by_country"

    @property
    def history(self) -> str:
        return f"{self.root}/recommendation_by_country_historical"

    @property
    def ranking(self) -> str:
        return f"{self.root}/ranking_products_by_partner"

    @property
    def mba_documents(self) -> str:
        return f"{self.root}/all_recommendations_mba"

    @property
    def ranking_documents(self) -> str:
        return f"{self.root}/all_recommendations_ranking"

    @property
    def outbox(self) -> str:
        return f"{self.root}/outbox"


def recommendations_by_country(
    rows: DataFrame,
    mining: MiningParams = MiningParams(),
    metric: str = METRIC,
    min_threshold: float = MIN_THRESHOLD,
    workspace: Workspace | None = None,
    exact: bool = False,
) -> DataFrame:
    """Basket rows, repeated or not, to item-to-item pairs; all countries together."""
    itemsets = frequent_itemsets(baskets(rows), mining, workspace)
    return recommendation_pairs(itemsets, metric, min_threshold, exact, workspace)


def run_daily(
    sources: Sources,
    window: RunWindow,
    root: str,
    orders: OrderFilter = OrderFilter(),
    mining: MiningParams = MiningParams(),
    metric: str = METRIC,
    min_threshold: float = MIN_THRESHOLD,
    k: int = TOP_K,
) -> Outputs:
    """One run.

    A metric that pairs do not always carry is a further column of the pairs and their history.
    An empty mining result leaves the pairs and the history as they were; documents and messages
    are made of the pairs as they then stand.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {sorted(METRICS)}, not {metric!r}")
    spark = sources.orders.sparkSession
    out = Outputs(root)
    with Workspace(spark) as workspace:
        # The order facts are read once: both halves take the lines that count from here.
        lines = workspace.save(
            eligible_lines(order_lines(sources.orders), window, orders), "lines"
        )
        rows = matched_lines(lines, sources.products, sources.catalogue, window, orders)
        pairs = workspace.save(
            recommendations_by_country(rows, mining, metric, min_threshold, workspace), "pairs"
        )
        if write_if_nonempty(pairs, out.pairs):
            upsert_history(pairs, out.history, window.run_date)
        replace_table(
            ranking_topk(
                lines,
                sources.products,
                sources.catalogue,
                sources.partner_snapshots,
                sources.categories,
                window,
                orders,
                k,
            ),
            out.ranking,
            sort=("partner_id", "rank"),
        )
    replace_table(ranking_documents(read_table(spark, out.ranking)), out.ranking_documents)
    messages = to_messages(read_table(spark, out.ranking_documents), RANKING)
    if table_exists(spark, out.pairs):
        replace_table(mba_documents(read_table(spark, out.pairs), metric), out.mba_documents)
        mba = to_messages(read_table(spark, out.mba_documents), MBA)
        messages = mba.unionByName(messages)
    write_outbox(messages, out.outbox)
    return out
