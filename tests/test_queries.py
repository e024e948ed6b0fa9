"""Every query outside of text agrees with its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import connect, same

from cytospark.plans import registry


#: Gated cells of one type near another: the smallest tables have none.
SPARSE = {"G23_dc_cd8_section", "G24_dc_cd4_activation", "G27_panel_statistics"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, small, con, name):
    if name in SPARSE:
        small = small.replace("sf0.001", "sf0.01")
        con = connect(small)
    df = registry.QUERIES[name](spark, small)
    same(df, con, registry.ORACLES[name])
    assert name not in SPARSE or not df.isEmpty()


#: What holds for the rows of each query without SQL.
INVARIANTS = {
    "C1_fit_neighborhoods": lambda t: len(t) == 8 and abs(t.pct_cells.sum() - 100) < 1e-3 and (t.n_cells >= 0).all(),
    "C3_elbow": lambda t: list(t.sort_values("k").inertia) == sorted(t.inertia, reverse=True) and set(t.k) == {5, 8, 10, 12},
    "F9_paired_t_test": lambda t: (t.p_value.isna() | t.p_value.between(0, 1)).all(),
    "F10_signed_rank_test": lambda t: (t.p_value.isna() | t.p_value.between(0, 1)).all(),
    "G23_around_tests": lambda t: len(t) == 7 and ((t.p_value.isna()) | t.p_value.between(0, 1)).all() and (t.p_value.isna() | (t.n_regions >= 2)).all(),
    "G23_dc_cd8_tests": lambda t: len(t) == 1 and (t.p_value.isna() | t.p_value.between(0, 1)).all(),
    "G27_paired_panels": lambda t: set(t.panel) <= PANELS and (t.p_value.isna() | t.p_value.between(0, 1)).all() and not t.duplicated(["panel", "test"]).any(),
    "G28_image_family": lambda t: t.cell.is_unique and (t.lnp_positive == (t.lnp_call != "no_barcode")).all() and set(t.barcode[t.lnp_positive]) <= {"110", "101", "011"},
    "G28_fixed_family": lambda t: t.cell.is_unique and (t.lnp_positive == (t.lnp_call != "no_barcode")).all() and t.barcode.str.count("1").between(0, 3).all(),
    "I5_suppress": lambda t: far(t, ["fov"], 9.0),
    "I6_detect_tiled": lambda t: far(t, ["fov", "tile"], 9.0) and (t.tile == (t.i // 24).clip(upper=3)).all(),
    "S11_manifest": lambda t: t.path.is_unique and t.sha256.str.fullmatch("[0-9a-f]{64}").all() and (t.size_bytes > 0).all() and len(t) == 14,
}
PANELS = {"mean_cd86_siinfekl_positive_dc", "median_cd8_distance", "pct_cd8_presence", "cd4_foxp3_median", "surrounding_cd4_foxp3_median", "ova_b_cd19_median", "ova_b_cd138_median", "ova_b_cd25_median"}


def far(spots, by, distance) -> bool:
    """No two spots of an image (or band) are nearer than the distance."""
    for _, own in spots.groupby(by):
        i, j = own.i.to_numpy(), own.j.to_numpy()
        d = ((i[:, None] - i) ** 2 + (j[:, None] - j) ** 2) ** 0.5
        if ((d < distance) & (d > 0)).any() or own.duplicated(["i", "j"]).any():
            return False
    return True


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, small, name):
    rows = registry.QUERIES[name](spark, small).toPandas()
    assert len(rows) >= 1
    assert INVARIANTS.get(name, lambda t: True)(rows), rows


def test_all_rows_enter(spark, small):
    """No order line, supplier or event is left out."""
    from pyspark.sql import functions as F

    read = lambda t: spark.read.parquet(f"{small}/{t}.parquet")
    run = lambda n: registry.QUERIES[n](spark, small)
    bits = F.bit_count((F.col("l_partkey") * 37 % 4096).cast("int")).alias("n")
    assert run("B8_cell_calls").agg(F.sum("total_barcode_spots")).first()[0] == read("lineitem").agg(F.sum(bits)).first()[0]
    assert run("N17_assign_spots").count() == read("events").count()
    key = [F.expr(x) for x in ("l_suppkey % 3 AS fov", "l_orderkey % 96 AS i", "l_partkey % 96 AS j")]
    inside = read("lineitem").select(*key).join(run("I12_components").select("fov", "i", "j"), ["fov", "i", "j"]).count()
    counted = run("I15_spots_per_cell").agg(F.sum(F.col("barcode1_spot_count") + F.col("barcode2_spot_count"))).first()[0]
    assert counted == inside


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
