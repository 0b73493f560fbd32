"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "_n"
_BLOCK = 10_000


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Sequence[str]) -> list[Column]:
    return [col(n) for n in names]


def none_null(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & col(n).isNotNull()
    return out


def key_json(names: Sequence[str]) -> Column:
    """JSON object of the named columns, NULLs kept."""
    return F.to_json(F.struct(*cols(names)), {"ignoreNullFields": "false"})


def repeat_rows(df: DataFrame, count: str = COUNT) -> DataFrame:
    """Turn a row that stands for ``count`` equal rows into those rows.

    The count may be huge for one row, so it is cut into blocks of blocks, and these are spread
    over the cluster before they are expanded; no array holds more than a block.
    """
    n = F.col(count)
    for block, size in (("_outer", _BLOCK**2), ("_inner", _BLOCK)):
        df = df.withColumn(block, F.explode(F.sequence(F.lit(0), F.floor((n - 1) / size))))
        df = df.withColumn(count, F.least(F.lit(size).cast("bigint"), n - F.col(block) * size))
    spread = df.repartition(F.xxhash64(*[c for c in df.columns if c != count]))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), n))
    return spread.withColumn("_copy", copies).drop("_copy", "_outer", "_inner", count)
