"""Declared schemas (no inference) and the flow-field feature schema (SRC-16)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Station page (A1): time text, grid id and 14 measures.
STATION_MEASURES = ("T", "MAXTOFDAY", "SLP", "RHSFC", "V", "WSPD", "WDIR", "WD3SMAXDF", "WD3SMAXDD",
                    "RAIN01H", "RAIN02H", "RAIN03H", "RAIN06H", "RAIN24H")
STATION_PAGE = T.StructType(
    [T.StructField("DDATETIME", T.StringType()), T.StructField("GRIDID", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in STATION_MEASURES])

# Grid dimension (A2) after renaming.
GRID_INFO = T.StructType([T.StructField("grid_id", T.LongType()), T.StructField("lon_min", T.DoubleType()),
                          T.StructField("lat_min", T.DoubleType()), T.StructField("lon_max", T.DoubleType()),
                          T.StructField("lat_max", T.DoubleType())])

# Completeness report (A3), scalar part as written to disk.
COMPLETENESS = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("total_time_points", T.LongType()),
    T.StructField("complete_time_points", T.LongType()),
    T.StructField("incomplete_time_points_count", T.LongType()),
    T.StructField("missing_time_points_count", T.LongType()), T.StructField("expected_points", T.LongType()),
    T.StructField("actual_points", T.LongType()), T.StructField("completeness_ratio", T.DoubleType())])


@dataclass(frozen=True)
class FeatureSchema:
    """SRC-16: a cell table's declared columns and its feature groups with their sizes."""

    columns: tuple[str, ...]
    coords: tuple[str, ...]
    phys: tuple[str, ...]
    grad: tuple[str, ...]
    coords_dim: int
    phys_dim: int
    grad_dim: int
    all_dim: int
    text_columns: tuple[str, ...] = field(default=("cell_type_name",))

    def validate(self) -> None:
        for name, group, dim in (("coords", self.coords, self.coords_dim), ("phys", self.phys, self.phys_dim),
                                 ("grad", self.grad, self.grad_dim)):
            if len(group) != dim:
                raise ValueError(f"{name}: {len(group)} features declared, dimension says {dim}")
            missing = [c for c in group if c not in self.columns]
            if missing:
                raise ValueError(f"{name}: not among the columns: {missing}")
        if self.phys_dim + self.grad_dim != self.all_dim:
            raise ValueError("physical + gradient dimensions must equal the total feature dimension")

    def struct_type(self) -> T.StructType:
        ints = {"cell_id", "cell_type", "nverts"}
        return T.StructType([
            T.StructField(c, T.StringType() if c in self.text_columns else
                          (T.LongType() if c in ints else T.DoubleType())) for c in self.columns])

    @property
    def features(self) -> tuple[str, ...]:
        return self.coords + self.phys + self.grad


# The flow-field cell table's columns and feature groups.
FLOW_CELLS = FeatureSchema(
    columns=("cell_id", "cell_type", "cell_type_name", "nverts",
             "cx", "cy", "cz", "v0", "v1", "v2", "density", "mach_number", "pressure", "temperature",
             "velocity_0", "velocity_1", "velocity_2",
             "grad_density_0", "grad_density_1", "grad_density_2", "grad_u_0", "grad_u_1", "grad_u_2",
             "grad_v_0", "grad_v_1", "grad_v_2", "grad_pressure_0", "grad_pressure_1", "grad_pressure_2"),
    coords=("cx", "cy"),
    phys=("density", "mach_number", "pressure", "temperature", "velocity_0", "velocity_1"),
    grad=("grad_density_0", "grad_density_1", "grad_u_0", "grad_u_1", "grad_v_0", "grad_v_1",
          "grad_pressure_0", "grad_pressure_1"),
    coords_dim=2, phys_dim=6, grad_dim=8, all_dim=14,
)
