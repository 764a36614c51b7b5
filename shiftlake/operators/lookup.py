"""Lookup of standard times and the loss bands derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Band limits in seconds.
FUNCTION_BELOW = 10 * 60
TROUBLE_ABOVE = 30 * 60


def loss_band(loss: Column) -> Column:
    return (F.when(loss < FUNCTION_BELOW, F.lit("Function"))
            .when(loss > TROUBLE_ABOVE, F.lit("Trouble")).otherwise(F.lit("Jam")))


def standard_times(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join with ``eqpid, tubeid, st, setst``; a miss leaves zeros and no band.

    No broadcast is forced: the planner broadcasts the dimension when its
    measured size allows, and otherwise the adaptive sort-merge join splits
    the hot keys of the big side.
    """
    dim = dimension.groupBy("eqpid", "tubeid").agg(
        F.max_by(F.struct("st", "setst"), F.struct("st", "setst")).alias("_d"))
    joined = df.join(dim, ["eqpid", "tubeid"], "left")
    hit, st, setst = F.col("_d").isNotNull(), F.col("_d.st"), F.col("_d.setst")
    zero = F.lit(0).cast("long")
    loss, set_loss = F.col("ct") - st, F.col("ct") - setst
    return joined.select(
        *df.columns,
        F.coalesce(st, zero).alias("st"),
        F.coalesce(loss, zero).alias("loss"),
        F.when(hit, loss_band(loss)).alias("sertue"),
        F.coalesce(setst, zero).alias("set_st"),
        F.coalesce(set_loss, zero).alias("set_st_loss"),
        F.when(hit, loss_band(set_loss)).alias("set_st_sertue"),
    )
