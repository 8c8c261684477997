"""The derived views of FIXTURES.md part B as SQL text for the DuckDB oracle.

The driver registers only the raw tables, so every oracle query starts with
``with_views(...)``, a ``WITH`` chain holding the views it needs (and their
dependencies) in order.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ratings_raw": ((), """
      select o_custkey as user_id, l_partkey as item_id,
             cast(ceil(l_quantity / 5) as double) / 2 as score, l_shipdate as ts,
             l_orderkey, l_linenumber, l_quantity
      from lineitem join orders on l_orderkey = o_orderkey"""),
    "ratings": (("ratings_raw",), """
      select user_id, item_id, score, ts from (
        select r.*, row_number() over (partition by user_id, item_id
               order by ts desc, l_orderkey desc, l_linenumber desc, l_quantity desc) as rn
        from ratings_raw r) x where rn = 1"""),
    "folds": (("ratings",), """
      select ratings.*, cast((user_id * 31 + item_id * 17) % 5 + 1 as int) as fold from ratings"""),
    "ratings_binary": (("ratings",), """
      select user_id, item_id, case when score >= 3.0 then 1 else -1 end as label, ts from ratings"""),
    "tags": ((), """
      select distinct o_custkey as user_id, l_partkey as item_id,
             concat(p_name, ' ', cast(p_size as varchar), ' ', o_orderpriority) as tag
      from lineitem join orders on l_orderkey = o_orderkey join part on p_partkey = l_partkey
      where l_returnflag = 'R'"""),
    "tags_big": ((), """
      select distinct o_custkey as user_id, l_partkey as item_id,
             concat(p_name, ' ', cast(p_size as varchar), ' ', o_orderpriority) as tag
      from lineitem join orders on l_orderkey = o_orderkey join part on p_partkey = l_partkey
      where l_returnflag = 'A'"""),
    "movies": ((), """
      select p_partkey as item_id,
             concat(p_name, ' (', cast(1950 + p_partkey % 70 as varchar), ')') as title,
             concat(p_type, '|', replace(p_name, ' ', '|')) as genres,
             cast(1950 + p_partkey % 70 as varchar) as year, p_brand as country
      from part"""),
    "people": ((), """
      select distinct l_partkey as item_id, s_name as person,
             case when l_suppkey % 5 = 0 then 'director' else 'actor' end as kind
      from lineitem join supplier on s_suppkey = l_suppkey"""),
    "users": ((), """
      select c_custkey as user_id, cast(10 + (c_custkey * 7) % 95 as int) as age,
             case when c_custkey % 2 = 0 then 'M' else 'F' end as gender,
             c_mktsegment as occupation
      from customer"""),
    "documents_en": ((), """
      select doc_id, text from documents where lang = 'en'"""),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` prefix for the named views, then ``extra`` (name, sql) CTEs."""
    parts = [f"{n} as ({VIEWS[n][1]})" for n in _order(names)]
    # "tp" (test cells x item features) is materialised so DuckDB joins the
    # user profiles on all three keys instead of fanning out per user first
    # and the steps of a cascade are, so that each is worked out once
    parts += [f"{n} as {'materialized ' if n == 'tp' or n.startswith('step') else ''}({sql})" for n, sql in (extra or [])]
    return "with " + ",\n".join(parts) + "\n" if parts else ""
