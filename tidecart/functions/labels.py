"""Labels of the serving queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels shown to the user.
FEMALE = "女"
MALE = "男"
UNDER_20 = "20岁以下"
FROM_20_TO_29 = "20到29岁"
FROM_30 = "30岁以上"

AGE_BANDS = (UNDER_20, FROM_20_TO_29, FROM_30)

# Request parameter to grouping column.
GROUP_COLUMNS = {"age": "user_age", "gender": "user_gender"}


def group_column(by: str) -> str:
    if by not in GROUP_COLUMNS:
        raise ValueError(f"unknown grouping {by!r}: expected one of {sorted(GROUP_COLUMNS)}")
    return GROUP_COLUMNS[by]


def gender_label(gender: Column, female: str = FEMALE, other: str = MALE) -> Column:
    """``F`` is female, everything else takes the other label."""
    return F.when(gender == "F", female).otherwise(other)


def age_band(age: Column, bands: tuple[str, str, str] = AGE_BANDS) -> Column:
    """Below 20, 20 to 29, 30 and above; null for an unknown age."""
    return F.when(age < 20, bands[0]).when(age <= 29, bands[1]).when(age >= 30, bands[2])
