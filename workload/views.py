"""Bound views: the driver's tables seen as Bronze datasets.

Each view is one SELECT in Spark SQL; `duckdb_text` gives the same text for
DuckDB. Views with a `{name}` of another view read that view.
"""

import re

VIEWS = {
    # Two arrivals (a quarter, three quarters), some NULL and zero quantities, size suffixes in names.
    "b_pos": """
select cast(l.l_orderkey as string) transaction_id,
 date_add(date'2023-01-01', cast(l.l_orderkey % 181 as int)) transaction_date,
 lpad(cast(6 + l.l_linenumber as string), 2, '0') || ':30:00' transaction_time,
 case when l.l_orderkey % 501 = 0 then null when l.l_orderkey % 499 = 0 then 0 else cast(l.l_quantity as int) end transaction_qty,
 case l.l_suppkey % 3 when 0 then 3 when 1 then 5 else 8 end store_id,
 case l.l_suppkey % 3 when 0 then 'Loc 3' when 1 then 'Loc 5' else 'Loc 8' end store_location,
 cast(l.l_partkey as int) product_id, cast(p.p_retailprice as decimal(10,2)) unit_price,
 p.p_type product_category, p.p_brand product_type,
 p.p_name || case p.p_size % 4 when 0 then '' when 1 then ' Sm' when 2 then ' Rg' else ' Lg' end product_detail,
 case when l.l_orderkey % 4 = 0 then '2023-06-14' else '2023-06-15' end ingestion_date
from {lineitem} l join {part} p on l.l_partkey = p.p_partkey""",
    # Every part has a cost, a tenth of them under a name no line carries; some costs exceed the price.
    "b_costs": """
select case when min(p_partkey) % 10 = 0 then 'former ' || p_name else p_name end product_name, min(p_type) product_category,
 cast(min(p_retailprice) as decimal(10,2)) unit_price_std,
 cast(cast(min(p_retailprice) as decimal(10,2)) * cast(case when min(p_partkey) % 13 = 0 then 120 else 15 + min(p_partkey) % 40 end as int) * cast(0.01 as decimal(3,2)) as decimal(10,4)) unit_cost,
 cast(cast(case when min(p_partkey) % 13 = 0 then 120 else 15 + min(p_partkey) % 40 end as int) * cast(0.01 as decimal(3,2)) as decimal(6,4)) cogs_pct,
 date'2023-01-01' valid_from, date'2023-12-31' valid_to, 'ERP' source_system, '2023-06-15' ingestion_date
from {part} group by p_name""",
    # Dozens to hundreds of price versions for each product, many of them overlapping.
    "b_cost_versions": """
select p.p_name product_name, date_add(date'2023-01-01', cast(l.l_orderkey % 181 as int)) valid_from,
 max(date_add(date'2023-01-01', cast(l.l_orderkey % 181 + l.l_suppkey % 9 as int))) valid_to,
 cast(cast(min(p.p_retailprice) as decimal(10,2)) * cast(cast(15 + 5 * min(l.l_linenumber) as int) * cast(0.01 as decimal(3,2)) as decimal(10,4)) as decimal(10,4)) unit_cost
from {lineitem} l join {part} p on l.l_partkey = p.p_partkey where l.l_orderkey % 3 <> 0 group by 1, 2""",
    # Every product x ingredient; a third of the pairs stands under a name no line carries.
    "b_bom": """
select case when (k + i) % 3 = 0 then product_name when k % 4 = 0 then 'former ' || product_name else product_name || ' (trial)' end product_name, case i when 0 then 'milk_ml' when 1 then 'grounds_g' when 2 then 'syrup_ml' when 3 then 'flour_g' else 'sugar_g' end ingredient_name,
 cast(cast(10 + (k * 7 + i) % 90 as int) * cast(0.01 as decimal(3,2)) as decimal(10,4)) qty_required_per_unit,
 case when i in (0, 2) then 'ml' else 'g' end unit_of_measure,
 cast(case i when 0 then 0.002 when 1 then 0.015 when 2 then 0.006 when 3 then 0.002 else 0.001 end as decimal(10,6)) ingredient_cost_per_unit,
 date'2023-01-01' last_updated, '2023-06-15' ingestion_date
from (select p_name product_name, min(p_partkey) k, explode(sequence(0, 4)) i from {part} group by p_name) p""",
    "b_movements": """
select date_add(date'2023-01-01', cast(event_id % 181 as int)) inventory_date,
 case (event_id div 181) % 3 when 0 then 3 when 1 then 5 else 8 end store_id,
 case (event_id div 543) % 5 when 0 then 'milk_ml' when 1 then 'grounds_g' when 2 then 'syrup_ml' when 3 then 'flour_g' else 'sugar_g' end ingredient_name,
 sum(cast(value as decimal(12,2))) actual_consumed,
 sum(case when event_type = 'purchase' then cast(value * 4 as decimal(12,2)) else cast(0 as decimal(12,2)) end) units_received
from {events} group by 1,2,3""",
    # One shift record per order; daily totals land near the labor limits.
    "b_shifts": """
select date_add(date'2023-01-01', cast(o_orderkey % 181 as int)) shift_date,
 case o_custkey % 3 when 0 then 3 when 1 then 5 else 8 end store_id,
 case o_custkey % 3 when 0 then 'Loc 3' when 1 then 'Loc 5' else 'Loc 8' end store_name,
 o_orderpriority shift_type, '06:00' shift_start, '10:00' shift_end,
 cast(1 + o_orderkey % 3 as int) employees_on_shift, cast(4 as decimal(4,1)) hours_per_employee,
 cast(4 * (1 + o_orderkey % 3) as decimal(6,1)) total_hours, cast(15 as decimal(6,2)) hourly_rate_usd,
 cast(cast(o_totalprice as decimal(12,2)) * cast(0.09 as decimal(3,2)) as decimal(10,2)) labor_cost_usd,
 '2023-06-15' ingestion_date
from {orders}""",
    # Every name; a third of them is listed in another spelling, so that the defaults are exercised too.
    "b_mapping": """
select case when length(product_detail) % 3 = 0 then upper(product_detail) || '!' else product_detail end pos_product_detail, trim(regexp_replace(product_detail, ' +(Sm|Rg|Lg)$', '')) canonical_product_name,
 nullif(regexp_extract(product_detail, ' +(Sm|Rg|Lg)$', 1), '') size_code,
 k % 7 <> 0 cost_required, k % 5 <> 0 recipe_required,
 case when k % 2 = 0 then 'beverage_prepared' else 'food_prepared' end product_group
from (select p_name || case p_size % 4 when 0 then '' when 1 then ' Sm' when 2 then ' Rg' else ' Lg' end product_detail,
 min(p_partkey) k from {part} group by 1) n""",
    # One promotion per product type.
    "b_promotions": """
select 'PROMO_' || p_type promotion_id, ' Deal on ' || p_type || ' ' promotion_name,
 case when min(p_partkey) % 2 = 0 then 'percentage' else 'fixed' end discount_type,
 cast(cast(min(p_size) as int) * cast(0.01 as decimal(3,2)) as decimal(10,2)) discount_value, p_type applicable_category,
 date'2023-02-01' start_date, date'2023-02-28' end_date, 'Mon,Tue' applicable_days, '14:00-17:00' applicable_hours,
 'CRM' source_system
from {part} group by p_type""",
}


def references(text):
    return re.findall(r"\{(\w+)\}", text)


def duckdb_text(text):
    """The view text in DuckDB's dialect."""
    text = re.sub(r"\{(\w+)\}", r"\1", text)
    text = text.replace(" string)", " varchar)").replace(" div ", " // ").replace("explode(sequence(0, 4))", "unnest(range(0, 5))")
    return re.sub(r"date_add\(date'2023-01-01', (cast\(.*? as int\))\)", r"(date '2023-01-01' + \1)", text)
