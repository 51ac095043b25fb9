"""The oracle of boosted regression trees: an exact histogram split search in SQL.

A recursive table holds every row's node, target and prediction. A level of a tree is
a step: per node, feature and value the count, sum and sum of squares of the targets;
the split with the largest drop in variance wins (ties: first feature, smallest value).
After the last level of a round a step adds the nodes' means to the predictions (times
the step size from the second round on) and takes twice the residual as next target.
"""

from __future__ import annotations


def boosted(rows: str, features: dict[str, str], target: str, rounds: int, depth: int, rate: float = 0.1) -> str:
    """CTEs ending in ``boosted`` (id, prediction). ``rows``: a query with ``id`` and
    ``target``; ``features``: name -> numeric expression over it, in vector order."""
    long = " union all ".join(f"select id, {i} as f, cast({e} as double) as v from base"
                              for i, e in enumerate(features.values()))
    turn = depth + 1
    return f"""base as materialized ({rows}),
long as materialized ({long}),
st(step, id, node, y, y0, p) as (
  select 0, id, cast(1 as bigint), cast({target} as double), cast({target} as double), cast(0 as double) from base
  union all
  (with h as (select node, f, v, count(*) as n, sum(y) as s, sum(y * y) as q from st join long using (id)
              where step % {turn} < {depth} group by all),
  c as (select node, f, v, sum(n) over l as ln, sum(s) over l as ls, sum(q) over l as lq,
          sum(n) over t as n, sum(s) over t as s, sum(q) over t as q from h
        window l as (partition by node, f order by v), t as (partition by node, f)),
  g as (select node, f, v, (q - s * s / n) / n - (ln / n) * ((lq - ls * ls / ln) / ln)
          - ((n - ln) / n) * (((q - lq) - (s - ls) * (s - ls) / (n - ln)) / (n - ln)) as gain from c where ln < n),
  b as (select node, f, v from g where gain > 0 qualify row_number() over (partition by node order by gain desc, f, v) = 1),
  m as (select st.*, avg(y) over (partition by node) * case when step < {turn} then 1 else {rate}::double end as more from st)
  select step + 1, m.id,
    case when step % {turn} = {depth} then 1 when b.node is null then m.node
         else 2 * m.node + cast(long.v > b.v as bigint) end,
    case when step % {turn} = {depth} then 2 * (y0 - (p + more)) else y end, y0,
    case when step % {turn} = {depth} then p + more else p end
  from m left join b on b.node = m.node left join long on long.id = m.id and long.f = b.f
  where step < {rounds * turn})),
boosted as (select id, p as prediction from st where step = {rounds * turn})"""
