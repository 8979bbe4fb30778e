"""District ring queries over the ring_values view (orders as ring members)."""

from __future__ import annotations

from gridflow.operators import topology as T
from gridflow.plans.named import register
from gridflow.plans.oracle_views import with_views
from gridflow.sources import views as V

NODES_PER_DISTRICT = 4   # default ring size of the simulation


@register("ring_neighbours", with_views("ring_values") + """
select district, step, rank, v100,
       coalesce(lag(v100) over w, last_value(v100) over wf) as prev_v100,
       coalesce(lead(v100) over w, first_value(v100) over wf) as next_v100
from ring_values
window w as (partition by district, step order by rank),
       wf as (partition by district, step order by rank rows between unbounded preceding and unbounded following)""")
def ring_neighbours(spark, sf):
    return T.ring_neighbours(V.ring_values(spark, sf))


@register("rank_role", with_views("ring_values") + """,
m as (select distinct district, rank from ring_values),
r as (select district, rank, row_number() over (partition by district order by rank) - 1 as district_rank,
             count(*) over (partition by district) as size from m)
select district, rank, district_rank, size,
       case when district_rank = size - 1 then 'ACCUMULATOR'
            when district_rank < floor(size * 6 / 10) then 'PRODUCER' else 'CONSUMER' end as role
from r""")
def rank_role(spark, sf):
    return T.rank_role(V.ring_values(spark, sf))


@register("district_bucket", with_views("ring_values") + f""",
b as (select rank, rank // {NODES_PER_DISTRICT} as district from ring_values)
select rank, district, rank - district * {NODES_PER_DISTRICT} as district_rank,
       count(*) over (partition by district) < {NODES_PER_DISTRICT} as incomplete
from b""")
def district_bucket(spark, sf):
    return T.district_bucket(V.ring_values(spark, sf), NODES_PER_DISTRICT)
