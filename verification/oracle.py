"""The same queries in DuckDB SQL, written as plainly as the semantics allow."""

from __future__ import annotations

HEADS = """heads as (
    select o_orderkey as order_id, cast(o_orderdate as date) as registered_date,
           case when c_mktsegment in ('BUILDING', 'MACHINERY') then 2 else 1 end as business_type_id,
           case when o_orderstatus = 'F' then 1 else 0 end as confirmed_order,
           r_regionkey as country_id, r_name as country_name
    from orders
    join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
)"""

LINES = f"""{HEADS},
lines as (
    select heads.*, l_suppkey as partner_id, l_partkey as product_id, l_quantity as quantity
    from heads join lineitem on l_orderkey = order_id
)"""

PRODUCTS = """products as (
    select p_partkey as id,
           case p_partkey % 5
                when 0 then null
                when 1 then 'EAN ' || cast(7790000000000 + p_partkey as varchar)
                when 2 then 'n/a ' || cast(p_partkey as varchar)
                else cast(77900000 + p_partkey as varchar) end as gtin,
           p_brand || ' / ' || cast(p_partkey as varchar) as integration_code
    from part
),
product_codes as (
    select id,
           lpad(case when gtin is not null then nullif(regexp_extract(gtin, '([\\d]*\\d{7})', 1), '')
                     else regexp_replace(integration_code, '[^-0-9a-zA-z]+', '', 'g') end,
                14, '0') as code
    from products
),
catalogue as (
    select id, code as gtin from product_codes where id % 7 <> 0
)"""

def _window(column: str, from_days: int = 365, to_days: int = 1) -> str:
    run_date = "date '2001-08-02'"
    return f"{column} >= {run_date} - {from_days} and {column} < {run_date} - {to_days}"


def _eligible(window: str) -> str:
    return f"{window} and business_type_id = 2 and country_name in ('AMERICA', 'EUROPE')"


def _snapshots(window: str) -> str:
    return f"""snapshots as (
    select user_id as restaurant_id, cast(ts as date) - 8218 as date_id,
           event_type as business_type, 'partner ' || cast(user_id as varchar) as business_name,
           value as is_darkstore, cast(event_id % 7 as int) as business_category_id,
           cast(ts as date) - 8218 as yyyymmdd
    from events
),
latest as (
    select s.restaurant_id, s.date_id, s.business_type, s.business_name,
           max(is_darkstore) as is_darkstore, max(business_category_id) as business_category_id
    from snapshots s
    join (select restaurant_id, max(date_id) as date_id from snapshots where {window} group by 1) m
      on m.restaurant_id = s.restaurant_id and m.date_id = s.date_id
    where {window}
    group by 1, 2, 3, 4
)"""


def _units(catalogue: str, categories: str, days: tuple[int, int] = (365, 1)) -> str:
    """Units sold through all the joins, row by row."""
    return f"""{LINES}, {PRODUCTS}, {_snapshots(_window("yyyymmdd", *days))},
units as (
    select l.country_id, l.partner_id, p.code as gtin, sum(l.quantity) as items_sold
    from lines l
    left join latest h on h.restaurant_id = l.partner_id
    left join product_codes p on p.id = l.product_id
    left join ({catalogue}) c on lpad(c.gtin, 14, '0') = p.code
    left join ({categories}) b on b.business_category_id = h.business_category_id
    where {_eligible(_window("registered_date", *days))} and confirmed_order = 1 and c.id is not null
    group by 1, 2, 3
)"""


def _ranking(units: str, k: int) -> str:
    return f"""{units},
ranking as (
    select country_id, partner_id, gtin,
           row_number() over (partition by country_id, partner_id
                              order by items_sold desc, gtin) as rnk
    from units where items_sold > 0
    qualify rnk <= {k}
)"""


WINDOW = _window("registered_date")
ELIGIBLE = _eligible(WINDOW)
REGIONS = "select r_regionkey as business_category_id from region"
NATIONS = "select n_regionkey as business_category_id from nation"
RANKING_STEPS = _ranking(_units("from catalogue", REGIONS), 30)
RANKING = f"with {RANKING_STEPS}"
RANKING_5 = "with " + _ranking(_units("from catalogue", REGIONS, (3650, 0)), 5)
DOUBLE_UNITS = _units("from catalogue union all from catalogue", NATIONS)

def _itemsets(entries: str, support: str) -> str:
    """Itemsets of any size: every order's itemsets grow by one later item per step, and an itemset
    that too few orders hold is not grown."""
    return f"""{entries},
totals as (
    select country_id, count(distinct order_id) as n_baskets,
           cast(ceil(cast({support} as double) * count(distinct order_id)) as bigint) as min_count
    from entries group by 1
),
kept as (
    select country_id, order_id, gtin, min_count from entries join totals using (country_id)
    qualify count(*) over (partition by country_id, gtin) >= min_count
),
held (country_id, order_id, items, last_item) as (
    select country_id, order_id, [gtin], gtin from kept
    union all
    select country_id, order_id, items, last_item from (
        select h.country_id, h.order_id, list_append(h.items, k.gtin) as items,
               k.gtin as last_item, k.min_count
        from held h
        join kept k on k.country_id = h.country_id and k.order_id = h.order_id
                   and k.gtin > h.last_item
        qualify count(*) over (partition by h.country_id, list_append(h.items, k.gtin)) >= k.min_count
    )
),
itemsets as (
    select country_id, items, n, n_baskets
    from (select country_id, items, count(*) as n from held group by 1, 2)
    join totals using (country_id)
)"""


RULE_STEPS = """masked as (
    select *, unnest(range(1, (1 << len(items)) - 1)) as mask from itemsets where len(items) > 1
),
splits as (
    select country_id, n, n_baskets,
           list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) as a,
           list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) as c
    from masked
),
rules as (
    select s.country_id, s.a, s.c, s.n, sa.n as n_a, sc.n as n_c,
           s.n_baskets, sa.n / s.n_baskets as antecedent_support,
           sc.n / s.n_baskets as consequent_support,
           s.n / s.n_baskets as support,
           (s.n / s.n_baskets) / (sa.n / s.n_baskets) as confidence,
           (s.n / s.n_baskets) / (sa.n / s.n_baskets) / (sc.n / s.n_baskets) as lift
    from splits s
    join itemsets sa on sa.country_id = s.country_id and sa.items = s.a
    join itemsets sc on sc.country_id = s.country_id and sc.items = s.c
)"""

PAIR_STEPS = """crossed as (
    select country_id, antecedents, unnest(c) as consequents, support, confidence, lift
    from (select country_id, unnest(a) as antecedents, c, support, confidence, lift
          from rules where lift >= 1)
),
pairs as (
    select country_id, antecedents, consequents, support, confidence, max(lift) as lift
    from crossed group by 1, 2, 3, 4, 5
),
best as (
    select country_id, antecedents, consequents, max(lift) as lift from pairs group by 1, 2, 3
)"""

def _leverage_steps(least: str) -> str:
    """Pairs by leverage, with their best leverage beside the lift."""
    return f"""crossed as (
    select country_id, antecedents, unnest(c) as consequents, support, confidence, lift, leverage
    from (select *, unnest(a) as antecedents, support - antecedent_support * consequent_support as leverage from rules)
    where leverage >= cast({least} as double)
),
pairs as (
    select country_id, antecedents, consequents, support, confidence, max(lift) as lift, max(leverage) as leverage
    from crossed group by 1, 2, 3, 4, 5
),
best as (
    select country_id, antecedents, consequents, max(leverage) as leverage from pairs group by 1, 2, 3
)"""


BRAND_ENTRIES = f"""{LINES},
entries as (
    select distinct country_id, order_id, p_brand as gtin from lines join part on product_id = p_partkey
)"""

MOVED_ENTRIES = f"{BRAND_ENTRIES[:-1].rstrip()} where order_id % 5 <> 0\n)"

CODE_ENTRIES = f"""entries as (
    select distinct l.country_id, l.order_id, p.code as gtin
    from lines l
    join product_codes p on p.id = l.product_id
    join catalogue c on lpad(c.gtin, 14, '0') = p.code
    where {ELIGIBLE}
)"""

ITEMSETS = f"with recursive {_itemsets(BRAND_ENTRIES, '0.005')}"
RULES = f"{ITEMSETS}, {RULE_STEPS}"
PAIRS = f"{RULES}, {PAIR_STEPS}"

ITEMSET_ROWS = f"""{ITEMSETS}
select country_id, array_to_string(items, '|') as items, len(items) as number_of_items,
       n, n_baskets, n / n_baskets as support
from itemsets"""

MBA_ENTRIES = """select cast(country_id as varchar) as country_id, 'mba' as criteria,
       'antecedent' as type, antecedents as code,
       row_number() over (partition by country_id, antecedents
                          order by lift desc, consequents) as place,
       consequents as recommended, 'lift' as metric, lift as metric_value"""

RANKING_ENTRIES = """select cast(country_id as varchar) as country_id, 'ranking' as criteria,
       'partner_id' as type, cast(partner_id as varchar) as code, rnk as place,
       gtin as recommended, 'rank' as metric, cast(rnk as double) as metric_value"""

ORACLE: dict[str, str] = {
    "order_window": f"with {HEADS} select order_id, registered_date from heads where {WINDOW}",
    "order_lines": f"""with {LINES}
select order_id, registered_date, business_type_id, confirmed_order, country_id, country_name,
       partner_id, product_id, quantity
from lines""",
    "latest_snapshot": f"with {_snapshots(_window('yyyymmdd'))} from latest",
    "normalized_codes": f"with {PRODUCTS} select id, code from product_codes",
    "basket_rows": f"""with {LINES}, {PRODUCTS}
select distinct l.order_id, l.country_name, l.country_id, l.partner_id, p.code as gtin
from lines l
left join product_codes p on p.id = l.product_id
left join catalogue c on lpad(c.gtin, 14, '0') = p.code
where {ELIGIBLE} and c.id is not null""",
    "baskets": f"""with {LINES}
select country_id, order_id, count(distinct p_brand) as n_items,
       string_agg(distinct p_brand, '|' order by p_brand) as items
from lines join part on product_id = p_partkey group by 1, 2""",
    "basket_counts": f"""with {LINES}
select country_id, count(distinct order_id) as n_baskets,
       cast(ceil(cast(0.005 as double) * count(distinct order_id)) as bigint) as min_count
from lines group by 1""",
    "frequent_itemsets": ITEMSET_ROWS,
    "frequent_itemsets_levelwise": ITEMSET_ROWS,
    "frequent_itemsets_mixed": ITEMSET_ROWS,
    "frequent_itemsets_fpgrowth": ITEMSET_ROWS,
    "frequent_itemsets_wide": ITEMSET_ROWS,
    "closed_itemsets": f"""with recursive {_itemsets(BRAND_ENTRIES, '0.0000001')},
below as (
    select country_id, list_filter(items, lambda x: x <> d) as items, max(n) as most
    from (select country_id, items, n, unnest(items) as d from itemsets where len(items) > 1) group by 1, 2
)
select country_id, array_to_string(items, '|') as items, len(items) as number_of_items,
       n, n_baskets, n / n_baskets as support
from itemsets left join below using (country_id, items) where most is null or most < n""",
    "expanded_itemsets": ITEMSET_ROWS,
    "moving_window": f"""with recursive {_itemsets(MOVED_ENTRIES, '0.005')}
select country_id, array_to_string(items, '|') as items, len(items) as number_of_items,
       n, n_baskets, n / n_baskets as support
from itemsets""",
    "bucketed_baskets": f"""with {LINES}
select country_id, order_id, count(distinct p_brand) as n_items,
       string_agg(distinct p_brand, '|' order by p_brand) as items
from lines join part on product_id = p_partkey group by 1, 2""",
    "association_rules": f"""{RULES}
select country_id, array_to_string(a, '|') as antecedents, array_to_string(c, '|') as consequents,
       n, n_a, n_c, support, confidence, lift
from rules where lift >= 1""",
    "rule_metrics": f"""{RULES}
select country_id, array_to_string(a, '|') as antecedents, array_to_string(c, '|') as consequents,
       antecedent_support, consequent_support, support, confidence, lift,
       support - antecedent_support * consequent_support as leverage,
       case when confidence < 1 then (1 - consequent_support) / (1 - confidence) end as conviction
from rules where confidence >= 0.15""",
    "association_rules_exact": f"""{RULES}
select country_id, array_to_string(a, '|') as antecedents, array_to_string(c, '|') as consequents, n, n_a, n_c
from rules where 4::hugeint * n * n_baskets >= 5::hugeint * n_a * n_c""",
    "recommendation_pairs": f"{PAIRS} from pairs",
    "leverage_pairs": f"{RULES}, {_leverage_steps('0.0002')} from pairs",
    "pair_best_metric": f"{PAIRS} from best",
    "units_sold": f"""with {LINES}, {PRODUCTS}
select l.country_id, l.partner_id, p.code as gtin, sum(l.quantity) as items_sold
from lines l
join product_codes p on p.id = l.product_id
join catalogue c on lpad(c.gtin, 14, '0') = p.code
where {ELIGIBLE} and confirmed_order = 1
group by 1, 2, 3""",
    "ranking_topk": f"""{RANKING} select country_id, partner_id, gtin, rnk as "rank" from ranking""",
    "ranking_top5": f"""{RANKING_5} select country_id, partner_id, gtin, rnk as "rank" from ranking""",
    "ranking_fanout": f"with {DOUBLE_UNITS} from units",
    "mba_documents": f"{PAIRS} {MBA_ENTRIES} from best",
    "mba_documents_support": f"""{PAIRS} {MBA_ENTRIES.replace('lift', 'support')}
from (select country_id, antecedents, consequents, max(support) as support from pairs group by 1, 2, 3)""",
    "ranking_documents": f"{RANKING} {RANKING_ENTRIES} from ranking",
    "mba_messages": f"{PAIRS} {MBA_ENTRIES}, 'mba' as event_type from best",
    "ranking_messages": f"{RANKING} {RANKING_ENTRIES}, 'ranking' as event_type from ranking",
    "listed_codes": f"""with {PRODUCTS}
select p.id as product_id, p.code as gtin, count(*) as copies
from product_codes p join catalogue c on lpad(c.gtin, 14, '0') = p.code
group by 1, 2""",
    "partner_copies": f"""with {_snapshots(_window('yyyymmdd'))}
select h.restaurant_id as partner_id, count(*) as partner_copies
from latest h
left join ({NATIONS}) b on b.business_category_id = h.business_category_id
group by 1""",
    "fanout": """select count(*) as n_rows, count(distinct n_regionkey) as n_keys,
       (select max(copies) from (select count(*) as copies from nation group by n_regionkey)) as max_copies
from nation""",
    "daily_run": f"""with recursive {_itemsets(f"{RANKING_STEPS}, {CODE_ENTRIES}", "0.0005")},
{RULE_STEPS}, {PAIR_STEPS}
{MBA_ENTRIES}, 'mba' as event_type from best
union all
{RANKING_ENTRIES}, 'ranking' as event_type from ranking""",
    "daily_run_leverage": f"""with recursive {_itemsets(f"{RANKING_STEPS}, {CODE_ENTRIES}", "0.0005")},
{RULE_STEPS}, {_leverage_steps('0.002')}
{MBA_ENTRIES.replace('lift', 'leverage')}, 'mba' as event_type from best
union all
{RANKING_ENTRIES}, 'ranking' as event_type from ranking""",
    "history_upsert": f"""{PAIRS}
select country_id, antecedents, consequents, support, confidence, lift,
       date '2001-08-01' as audit_date
from pairs where lift >= 1.2
union all
select country_id, antecedents, consequents, support, confidence, lift,
       date '2001-08-02' as audit_date
from pairs""",
}
