"""Missing-value indicators and median imputation fitted on training rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tremorgrid.operators.ordered import column_quantile

NOT_FEATURES = ("day", "target", "split", "row_index")
KEYS = ("horizon_day", "cell_lat", "cell_lon")  # never missing


def base_columns(columns: list[str]) -> list[str]:
    """Model inputs of a matrix: everything but key date, label and helpers."""
    return [c for c in columns if c not in NOT_FEATURES]


@dataclass(frozen=True)
class Imputation:
    """Fitted medians and the columns that get an indicator."""

    columns: list[str]
    indicators: list[str]
    medians: dict[str, float] = field(default_factory=dict)

    @property
    def feature_columns(self) -> list[str]:
        return self.columns + [f"{c}_missing" for c in self.indicators]

    def filled(self, column: str) -> Column:
        value = F.col(column).cast("double")
        if column in KEYS:
            return value
        return F.coalesce(value, F.lit(float(self.medians.get(column, 0.0))))

    def missing(self, column: str) -> Column:
        return F.col(column).isNull().cast("int")

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill gaps in place and append the indicator columns."""
        return df.withColumns({
            **{f"{c}_missing": self.missing(c) for c in self.indicators},
            **{c: self.filled(c) for c in self.columns if c not in KEYS},
        })

    def vector(self) -> Column:
        """All model inputs of a row as one vector, leaving its columns as they are."""
        return array_to_vector(F.array(
            *[self.filled(c) for c in self.columns],
            *[self.missing(c).cast("double") for c in self.indicators]))


def fit_imputation(train: DataFrame, every_part: DataFrame | None = None) -> Imputation:
    """Medians of the training rows; indicators for columns with gaps in any part.

    ``every_part`` holds the rows of all parts, training included. A column
    without any training value is filled with zero and keeps its indicator.
    """
    columns = base_columns(train.columns)
    rows = every_part if every_part is not None else train
    gaps = rows.selectExpr(*[f"count(*) > count(`{c}`) as `{c}`" for c in columns]).first()
    return Imputation(columns, [c for c in columns if gaps[c]], column_quantile(train, columns))
