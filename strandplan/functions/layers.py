"""Planning layers derived from the driver's tables by integer arithmetic.

The selects are plain SQL that Spark and DuckDB read alike, so an engine query and its oracle start from equal rows.
The world is five columns of service areas of 2000 m, 25 for every 1500 customers (100 suppliers, 2000 parts), so that it grows with the
data and its density does not; one row in twenty lies in the first 25 areas all the same, which so grow dense.  Every layer's
rows lie in or near their area.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_importable

_SRO = "lpad(cast({n} as string), 5, '0') || '/TST/PMZ/' || lpad(cast({n} as string), 5, '0')"
_CELL_X, _CELL_Y = "(({n}) % 5) * 2000", "cast(floor(({n}) / 5e0) as bigint) * 2000"


def _area(n: str, key: str, size: int) -> str:
    """Number of a row's service area, from its number in a block of 25."""
    return f"(({n}) + 25 * case when {key} % 20 = 0 then 0 else cast(floor(({key} - 1) / {size}e0) as bigint) end)"


def _block(key: str, size: int) -> str:
    return f"cast(floor(({key} - 1) / {size}e0) as bigint)"


_CUSTOMER, _SUPPLIER = _area("c_nationkey", "c_custkey", 1500), _area("s_nationkey", "s_suppkey", 100)
_PART, _ORDER = _area("p_partkey % 25", "p_partkey", 2000), _area("o_custkey % 25", "o_custkey", 1500)
_ZONE = "(c_custkey % 1500 + 25 * cast(floor(c_custkey / 1500e0) as bigint))"


def _at(n: str, key: str, a: int, b: int, room: int = 2003) -> str:
    return f"cast({_CELL_X.format(n=n)} + ({key} * {a}) % {room} as double) as x, cast({_CELL_Y.format(n=n)} + ({key} * {b}) % {room} as double) as y"


def _line(n: str, key: str, a: int, b: int, dx: str, dy: str) -> str:
    x, y = f"{_CELL_X.format(n=n)} + ({key} * {a}) % 2003", f"{_CELL_Y.format(n=n)} + ({key} * {b}) % 2003"
    return f"cast({x} as double) as x1, cast({y} as double) as y1, cast({x} + {dx} as double) as x2, cast({y} + {dy} as double) as y2"


def _box(x: str, y: str, w: str, h: str) -> str:
    return f"cast({x} as double) as x0, cast({y} as double) as y0, cast({x} + {w} as double) as x1, cast({y} + {h} as double) as y1"


#: name: (driver table, select)
LAYERS: dict[str, tuple[str, str]] = {
    "bal": ("customer", f"""select cast(c_custkey as bigint) as seq, 'BAT/' || cast(c_custkey as string) as id_metier, {_SRO.format(n=_CUSTOMER)} as sro,
        case when c_custkey % 11 = 0 then null when c_custkey % 7 = 0 then 'ORPHAN/' || cast(c_custkey % 3 as string) else 'ZAPA/' || cast(c_custkey % 400 as string) end as zapa,
        cast(c_custkey % 13 as int) as prises, {_at(_CUSTOMER, "c_custkey", 7919, 104729)} from customer"""),
    "za_sro": ("customer", f"""select {_SRO.format(n=_ZONE)} as sro, c_name as nom_nro, {_box(_CELL_X.format(n=_ZONE), _CELL_Y.format(n=_ZONE), "2000", "2000")} from customer where c_custkey % 1500 < 25"""),
    "pa": ("supplier", f"""select cast(s_suppkey as bigint) as seq, 'ZAPA/' || cast(s_suppkey as string) as id_metier, {_SRO.format(n=_SUPPLIER)} as sro, {_at(_SUPPLIER, "s_suppkey", 3571, 2711)} from supplier"""),
    "zapa": ("supplier", f"""select cast(s_suppkey as bigint) as seq, case when s_suppkey % 9 = 0 then null else 'ZAPA/' || cast(s_suppkey as string) end as id_metier, {_SRO.format(n=_SUPPLIER)} as sro,
        {_box(_CELL_X.format(n=_SUPPLIER) + " + (s_suppkey * 3571) % 2003 - 150", _CELL_Y.format(n=_SUPPLIER) + " + (s_suppkey * 2711) % 2003 - 150", "300", "300")} from supplier"""),
    "parcelle": ("part", f"""select cast(p_partkey as bigint) as seq, {_SRO.format(n=_PART)} as sro, case when p_size % 3 = 0 then 'COMMUNE DE ' || p_brand when p_size % 11 = 0 then null else p_name end as proprietaire,
        case when p_partkey % 4 = 0 then null else 'P' || cast(p_partkey as string) end as id_metier, case when p_partkey % 8 = 0 then null else 'U' || cast(p_partkey as string) end as idu,
        {_box(_CELL_X.format(n=_PART) + " + (p_partkey * 97) % 1901", _CELL_Y.format(n=_PART) + " + (p_partkey * 61) % 1907", "20 + p_size * 2", "20 + p_size * 3")} from part"""),
    "infra": ("orders", f"""select cast(o_orderkey as bigint) as seq, {_SRO.format(n=_ORDER)} as sro, case cast(o_orderkey % 4 as int) when 0 then 'athd' when 1 then 'bt' when 2 then 'ft' else 'chem' end as src,
        case when o_orderkey % 7 = 0 then null else cast(floor(o_orderkey / 8e0) as bigint) % 4 end as dispopp_ar,
        case cast(o_custkey % 5 as int) when 0 then 'Aérien' when 1 then 'Câble enterré' when 2 then 'CABLE ENTERRE nu' when 3 then null else 'Facade' end as type_de_lien,
        case cast(o_custkey % 3 as int) when 0 then 'E' when 1 then 'C' else null end as statut,
        case cast(o_custkey % 7 as int) when 0 then '4' when 1 then '7' when 2 then 'C7' when 3 then '1' when 4 then '0' when 5 then '' else null end as mode_pose,
        case cast(o_custkey % 4 as int) when 0 then 'C' when 1 then 'C' when 2 then 'P' else null end as cm_avct, case when o_custkey % 6 = 5 then null else '7' end as cm_typ_imp,
        case cast(o_custkey % 3 as int) when 0 then 'TR' when 1 then 'TD' else 'DI' end as cm_typelog,
        {_line(_ORDER, "o_orderkey", 31, 57, "(o_orderkey * 37) % 200 - 100", "(o_custkey * 13) % 200 - 100")} from orders"""),
    "road": ("customer", f"""select cast(c_custkey as bigint) as seq, {_SRO.format(n=_CUSTOMER)} as sro,
        case cast(c_custkey % 6 as int) when 0 then 'residential' when 1 then 'motorway' when 2 then 'service' when 3 then null when 4 then case when c_custkey % 4 = 0 then 'pedestrian' when c_custkey % 7 = 0 then 'track' when c_custkey % 11 = 0 then 'path' when c_custkey % 13 = 0 then 'road' else 'living_street' end else 'cycleway' end as highway,
        case when c_custkey % 5 = 0 then 'yes' else 'no' end as oneway,
        {_line(_CUSTOMER, "c_custkey", 443, 821, "20 + c_custkey % 90", "c_custkey % 41 - 20")} from customer"""),
    "net": ("customer", f"""select cast(c_custkey as bigint) as seq, cast({_CUSTOMER} as bigint) as sro_no, cast((c_custkey * 7) % 23 as bigint) as u, cast((c_custkey * 11 + 1 + c_nationkey) % 23 as bigint) as v,
        cast(5 + (c_custkey * 37) % 71 as bigint) as metres, case cast(c_custkey % 4 as int) when 3 then 'ign_route' when 2 then 'gc_neuf' else 'infra' end as type from customer where (c_custkey * 7) % 23 <> (c_custkey * 11 + 1 + c_nationkey) % 23"""),
    "chain": ("orders", f"""select cast(o_orderkey as bigint) as seq, cast(o_custkey % 997 + 1000 * {_block("o_custkey", 1500)} as bigint) as pb, cast(o_custkey % 997 % 60 + 60 * {_block("o_custkey", 1500)} as bigint) as pa, cast({_ORDER} as bigint) as sro_no, cast(o_orderkey % 47 + 1 as bigint) as metres,
        case cast(floor(o_orderkey / 8e0) as bigint) % 5 when 0 then 'ft' when 1 then 'bt' when 2 then 'ign' when 3 then 'chem' else 'athd' end as src, case when o_orderkey % 29 = 0 then 'virtual' when o_orderkey % 31 = 0 then 'undeliverable' else '' end as defect,
        cast((o_orderkey * 13) % 101 as bigint) as node_a, cast((o_orderkey * 29) % 101 as bigint) as node_b from orders"""),
    "log": ("events", """select cast(event_id as bigint) as line_no, case cast(event_id % 12 as int) when 0 then '=== SRO S' || cast(cast(floor(event_id / 12e0) as bigint) % 40 as string) || ' ===' when 1 then '[IGN] ok' when 2 then 'noise ' || event_type
        when 3 then '[CDC] x' when 4 then '[PB QA] n=1' when 5 then '[ROUTING] Graphe brut' when 6 then '[WELD] w' when 7 then '[TOPO SNAP] s' when 8 then '[INFRA QA] q' when 9 then 'writer : 9' when 10 then '[QML] styles'
        else '[OK] SRO S' || cast(cast(floor(event_id / 12e0) as bigint) % 40 as string) || ' traite' end as line from events"""),
}


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived layer; only the columns used are read from the driver's table."""
    ensure_importable(spark)
    source, select = LAYERS[name]
    return spark.sql(select.replace(f"from {source}", "from {source}"), source=spark.read.parquet(f"{sf_dir}/{source}.parquet"))


def oracle(names: str, select: str, **more: str) -> str:
    """DuckDB SQL: the layers named and further tables as common table expressions, then the select."""
    tables = {n: LAYERS[n][1] for n in names.split()}
    return "with recursive " + ",\n".join(f"{n} as ({t})" for n, t in (tables | more).items()) + f"\n{select}"
