"""Tables, orders and codebooks that the analyses share."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# Regions, calls and their formulations.
REFERENCE_REGIONS = ("S2_reg004",)
LNP_REGIONS = tuple(f"S{slide}_reg{region:03d}" for slide in range(1, 5) for region in range(4))
LNP_ORDER = tuple(f"LNP_{i:02d}" for i in range(1, 11))
TISSUE_AVERAGE = "Tissue_average"
NO_SIGNAL = "no_lnp_signal"
AVERAGE_BASIS = "All annotated cells in 16 LNP-treated tissue regions"
CALL_BASIS = "Codebook-matched LNP+ cells"
AVERAGE_FORMULATION = "All cells (tissue average)"
#: Calls whose raw and corrected labels are exchanged.
SWAPPED = {"LNP_01": "LNP_02", "LNP_02": "LNP_01"}
SELECTED_TYPES = ("DC", "CD8+ T", "CD4+ T", "B", "Macrophage")

#: Columns of a cell table.
CELL_COLUMNS = {
    "cell_id": "bigint",
    "lnp_region": "string",
    "condition": "string",
    "cell_type": "string",
    "x": "double",
    "y": "double",
    "lnp_call": "string",
    "lnp_positive": "boolean",
}


# Fixed values: (lnp_number, lnp_call, source_raw_lnp_call, ionizable_lipid, helper_lipid, formulation), the numbers in raw order.
LNP_DETAIL = (
    (1, "LNP_02", "LNP_01", "SM-102", "DSPC", "SM-102 + DSPC"),
    (2, "LNP_01", "LNP_02", "SM-102", "DOTAP", "SM-102 + DOTAP"),
    (3, "LNP_03", "LNP_03", "SM-102", "DDAB", "SM-102 + DDAB"),
    (4, "LNP_04", "LNP_04", "SM-102", "DOPE", "SM-102 + DOPE"),
    (5, "LNP_05", "LNP_05", "SM-102", "18PG", "SM-102 + 18PG"),
    (6, "LNP_06", "LNP_06", "ALC-0315", "DSPC", "ALC-0315 + DSPC"),
    (7, "LNP_07", "LNP_07", "ALC-0315", "DOTAP", "ALC-0315 + DOTAP"),
    (8, "LNP_08", "LNP_08", "ALC-0315", "DDAB", "ALC-0315 + DDAB"),
    (9, "LNP_09", "LNP_09", "ALC-0315", "DOPE", "ALC-0315 + DOPE"),
    (10, "LNP_10", "LNP_10", "ALC-0315", "18PG", "ALC-0315 + 18PG"),
)


def lnp_detail_rows() -> list[tuple[int, str, str, str, str, str]]:
    """The rows of the formulation dimension."""
    return list(LNP_DETAIL)


def lnp_detail(spark: SparkSession) -> DataFrame:
    """The formulation dimension: ten rows."""
    return spark.createDataFrame(lnp_detail_rows(), "lnp_number int, lnp_call string, source_raw_lnp_call string, ionizable_lipid string, helper_lipid string, formulation string")


class Codebook(NamedTuple):
    """Markers in order, codes by call in library order, bits that are on, and the largest tolerated distance."""

    markers: tuple[str, ...]
    calls: tuple[tuple[str, str], ...]
    on_bits: int
    tolerance: int

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, code, call) for i, (code, call) in enumerate(self.calls)], "ordinal int, code string, call string")
