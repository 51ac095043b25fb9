"""Table schemas and keyed-table specs shared by training and serving."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The public data sets' column names and types, in file order.
# Users of the original scripts keep their CSV files; these must match them.
# ---------------------------------------------------------------------------

TUTOR_FEATURES = ["age", "years_of_experience", "lesson_price", "qualification", "physics",
                  "chemistry", "biology", "english", "geography", "history"]
TUTOR_STREAM_FEATURES = ["age", "years_of_experience", "lesson_price"]
TUTOR_HISTORY_FEATURES = ["qualification", "physics", "chemistry", "biology", "english",
                          "geography", "history"]
TUTOR_LABEL = "mean_exam_points"

TUTOR_TRAIN_DDL = ("Id int, age float, years_of_experience float, lesson_price float, "
                   "qualification float, physics float, chemistry float, biology float, "
                   "english float, geography float, history float, mean_exam_points string")
TUTOR_STREAM_DDL = "id int, age float, years_of_experience float, lesson_price float"
TUTOR_HISTORY_DDL = ("id int, qualification float, physics float, chemistry float, biology float, "
                     "english float, geography float, history float")

HOUSE_CATEGORICAL = [
    "MSZoning", "Street", "Alley", "LotShape", "LandContour", "Utilities", "LotConfig",
    "LandSlope", "Neighborhood", "Condition1", "Condition2", "BldgType", "HouseStyle",
    "RoofStyle", "RoofMatl", "Exterior1st", "Exterior2nd", "MasVnrType", "ExterQual",
    "ExterCond", "Foundation", "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1",
    "BsmtFinType2", "Heating", "HeatingQC", "CentralAir", "Electrical", "KitchenQual",
    "Functional", "FireplaceQu", "GarageType", "GarageFinish", "GarageQual", "GarageCond",
    "PavedDrive", "PoolQC", "Fence", "MiscFeature", "SaleType", "SaleCondition"]
HOUSE_NUMERIC = [
    "MSSubClass", "LotFrontage", "LotArea", "OverallQual", "OverallCond", "YearBuilt",
    "YearRemodAdd", "MasVnrArea", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF",
    "1stFlrSF", "2ndFlrSF", "LowQualFinSF", "GrLivArea", "BsmtFullBath", "BsmtHalfBath",
    "FullBath", "HalfBath", "BedroomAbvGr", "KitchenAbvGr", "TotRmsAbvGrd", "Fireplaces",
    "GarageYrBlt", "GarageCars", "GarageArea", "WoodDeckSF", "OpenPorchSF", "EnclosedPorch",
    "3SsnPorch", "ScreenPorch", "PoolArea", "MiscVal", "MoSold", "YrSold"]
HOUSE_FLOAT = ["MasVnrArea", "GarageYrBlt"]
HOUSE_LABEL = "SalePrice"
# Stream file order (the training file adds SalePrice at the end).
HOUSE_STREAM_ORDER = [
    "Id", "MSSubClass", "MSZoning", "LotFrontage", "LotArea", "Street", "Alley", "LotShape",
    "LandContour", "Utilities", "LotConfig", "LandSlope", "Neighborhood", "Condition1",
    "Condition2", "BldgType", "HouseStyle", "OverallQual", "OverallCond", "YearBuilt",
    "YearRemodAdd", "RoofStyle", "RoofMatl", "Exterior1st", "Exterior2nd", "MasVnrType",
    "MasVnrArea", "ExterQual", "ExterCond", "Foundation", "BsmtQual", "BsmtCond",
    "BsmtExposure", "BsmtFinType1", "BsmtFinSF1", "BsmtFinType2", "BsmtFinSF2", "BsmtUnfSF",
    "TotalBsmtSF", "Heating", "HeatingQC", "CentralAir", "Electrical", "1stFlrSF", "2ndFlrSF",
    "LowQualFinSF", "GrLivArea", "BsmtFullBath", "BsmtHalfBath", "FullBath", "HalfBath",
    "BedroomAbvGr", "KitchenAbvGr", "KitchenQual", "TotRmsAbvGrd", "Functional", "Fireplaces",
    "FireplaceQu", "GarageType", "GarageYrBlt", "GarageFinish", "GarageCars", "GarageArea",
    "GarageQual", "GarageCond", "PavedDrive", "WoodDeckSF", "OpenPorchSF", "EnclosedPorch",
    "3SsnPorch", "ScreenPorch", "PoolArea", "PoolQC", "Fence", "MiscFeature", "MiscVal",
    "MoSold", "YrSold", "SaleType", "SaleCondition"]
# Id and LotFrontage arrive as text in the stream and are typed after the read.
HOUSE_STREAM_TEXT = ["Id", "LotFrontage"]


def house_stream_schema() -> T.StructType:
    """80 columns of the house stream, file order, types as the stream declares them."""
    fields = []
    for name in HOUSE_STREAM_ORDER:
        if name in HOUSE_CATEGORICAL or name in HOUSE_STREAM_TEXT:
            dtype: T.DataType = T.StringType()
        elif name in HOUSE_FLOAT:
            dtype = T.FloatType()
        else:
            dtype = T.IntegerType()
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def house_train_casts() -> dict[str, str]:
    """Column -> type for the all-string training read (numerics and the label)."""
    casts = {c: ("float" if c in HOUSE_FLOAT else "int") for c in HOUSE_NUMERIC}
    casts[HOUSE_LABEL] = "int"
    return casts


# ---------------------------------------------------------------------------
# Keyed tables
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: typed columns in a fixed order plus the primary key.

    Plays the role of the DDL of a key-value store table. ``conform`` selects,
    renames (case-insensitively), casts and orders a frame to the spec.
    """

    schema: T.StructType
    key: str
    name: str = "table"

    @classmethod
    def from_ddl(cls, ddl: str, key: str, name: str = "table") -> "TableSpec":
        return cls(_ddl(ddl), key, name)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.columns if c != self.key]

    def conform(self, df: DataFrame, strict: bool = True) -> DataFrame:
        """Project ``df`` onto this spec (K01). Missing columns fail when strict,
        else they become typed nulls. A value the column's type cannot hold fails the
        write, as a store would refuse it; bad text is cleaned before (``clean``)."""
        by_lower = {c.lower(): c for c in df.columns}
        cols = []
        for f in self.schema.fields:
            src = by_lower.get(f.name.lower())
            if src is None:
                if strict:
                    raise ValueError(f"{self.name}: input lacks column {f.name!r} (has {df.columns})")
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif df.schema[src].dataType == f.dataType:
                cols.append(F.col(f"`{src}`").alias(f.name))
            else:
                given = F.col(f"`{src}`")
                held = given.try_cast(f.dataType)
                bad = F.raise_error(F.concat(F.lit(f"{self.name}.{f.name} cannot hold "), given.cast("string")))
                cols.append(F.when(given.isNotNull() & held.isNull(), bad.cast(f.dataType))
                            .otherwise(held).alias(f.name))
        return df.select(*cols)


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
          "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(),
          "timestamp_ntz": T.TimestampNTZType(), "timestamp": T.TimestampType(),
          "date": T.DateType()}


def _ddl(ddl: str) -> T.StructType:
    """``"a int, b float"`` -> StructType (flat, primitive columns only)."""
    fields = []
    for part in ddl.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ.lower()], True))
    return T.StructType(fields)


def struct(ddl: str) -> T.StructType:
    return _ddl(ddl)


def tutor_history_table() -> TableSpec:
    """Stored tutor history, table form (11 columns, key ``id``)."""
    return TableSpec(_ddl("id int, " + ", ".join(f"{c} float" for c in TUTOR_FEATURES)), "id",
                     "tutor_history")


def tutor_predictions_table() -> TableSpec:
    return TableSpec(_ddl("id int, " + ", ".join(f"{c} float" for c in TUTOR_FEATURES)
                          + f", {TUTOR_LABEL} float"), "id", "tutor_predictions")


def house_predictions_table() -> TableSpec:
    return TableSpec(_ddl("id int, saleprice int"), "id", "house_predictions")
