"""DuckDB's SQL for the shared tables, from which the queries' SQL is put together."""

from __future__ import annotations

from ..schemas import LNP_ORDER, LNP_REGIONS, NO_SIGNAL, lnp_detail_rows

CELLS = """cells AS (SELECT event_id AS cell_id,
  CASE WHEN event_id % 17 = 16 THEN 'S2_reg004' ELSE concat('S', CAST(1 + (event_id % 17 - event_id % 17 % 4) / 4 AS INT), '_reg00', event_id % 17 % 4) END AS lnp_region,
  CASE WHEN event_id % 17 = 16 THEN 'reference' ELSE 'LNP' END AS condition,
  CASE event_type WHEN 'view' THEN 'B' WHEN 'signup' THEN 'CD4+ T' WHEN 'purchase' THEN 'CD8+ T' WHEN 'error' THEN 'DC' ELSE 'Macrophage' END AS cell_type,
  CAST((event_id * 7919) % 601 AS DOUBLE) + value / 1000::DOUBLE AS x,
  CAST((event_id * 104729) % 599 AS DOUBLE) + CAST(user_id % 97 AS DOUBLE) / 97 AS y,
  concat('LNP_', lpad(CAST(1 + user_id % 10 AS VARCHAR), 2, '0')) AS lnp_call,
  event_id % 17 <> 16 AND (event_id * 31 + user_id) % 10 < 3 AS lnp_positive,
  (event_id * 37 + user_id) % 10 < 4 AS single_positive,
  value AS Fluc, value * CAST(1 + user_id % 5 AS DOUBLE) / 3 AS OVA, value * CAST(1 + event_id % 7 AS DOUBLE) / 4 AS SIINFEKL,
  CAST((event_id * 13) % 101 AS DOUBLE) AS CD86 FROM events)"""

DETAIL = "detail(lnp_number, lnp_call, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation) AS (VALUES " + ", ".join(f"({r[0]}, {', '.join(repr(x) for x in r[1:])})" for r in lnp_detail_rows()) + ")"
CALLS = f"calls AS (SELECT unnest({list(LNP_ORDER)!r}) AS lnp_call)"
REGIONS = f"regions AS (SELECT 'LNP' AS condition, unnest({list(LNP_REGIONS)!r}) AS lnp_region UNION ALL SELECT 'reference', 'S2_reg004')"
LABELS = f"labels_ AS (SELECT unnest({[*LNP_ORDER, NO_SIGNAL]!r}) AS lnp_label)"
GATES = """gate AS (SELECT round(quantile_cont(Fluc, 0.95), 6) AS t_luc, round(quantile_cont(OVA, 0.95), 6) AS t_ova, round(quantile_cont(SIINFEKL, 0.9), 6) AS t_siin FROM cells WHERE lnp_region = 'S2_reg004'),
gated AS (SELECT cells.*, coalesce(Fluc > t_luc, false) AS luc_pos, coalesce(OVA > t_ova, false) AS ova_pos, coalesce(SIINFEKL > t_siin, false) AS siin_pos FROM cells, gate)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def r(expr: str, places: int = 6) -> str:
    """Rounded as `rounded` does."""
    return f"(round(CAST({expr} AS DOUBLE), {places}) + 0.0::DOUBLE)"


def sem(x: str) -> str:
    return f"CASE WHEN count({x}) <= 1 THEN 0.0 ELSE stddev_samp({x}) / sqrt(count({x})) END"
