"""Python functions next to what built-ins would do."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions.udfs import map_grouped, null_safe, udf_null_audit
from tidemark.queries._registry import query
from tidemark.queries.windows import _Z, _nullable_values


def _band():
    """The banding function, made here so that it travels to the workers whole.

    A function at module level would be sent by name, and the workers of a
    cluster need not have this package.
    """

    def band(value: float) -> str:
        return "high" if value >= 7500 else "mid" if value >= 2500 else "low"

    return band


_BAND = "CASE WHEN {v} >= 7500 THEN 'high' WHEN {v} >= 2500 THEN 'mid' ELSE 'low' END"


@query(f"SELECT c_custkey, {_BAND.format(v='c_acctbal')} AS band FROM customer")
def udf_band(t):
    """The row-at-a-time form, kept for comparison; ``band_case`` says the same built in."""
    return t.customer.select("c_custkey", F.udf(_band(), "string")("c_acctbal").alias("band"))


@query(f"SELECT c_custkey, {_BAND.format(v='c_acctbal')} AS band FROM customer")
def udf_sql(t):
    t.spark.udf.register("balance_band", F.udf(_band(), "string", useArrow=True))
    return t.sql("SELECT c_custkey, balance_band(c_acctbal) AS band FROM {customer}", "customer")


@query(f"""
    SELECT p_partkey, CASE WHEN nullif(p_size, 1) IS NOT NULL THEN {_BAND.format(v='p_size * 200')} END AS band
    FROM part
""")
def udf_null_safe(t):
    size, band = F.nullif("p_size", F.lit(1)), _band()
    return t.part.select("p_partkey", F.udf(null_safe(lambda s: band(s * 200)), "string", useArrow=True)(size).alias("band"))


@query("SELECT count(*) AS row_count, count(*) FILTER (WHERE p_size > 1) AS lost_count FROM part")
def udf_null_audit_report(t):
    """A function declared to give an integer but giving text: every present input is lost."""
    size = F.nullif("p_size", F.lit(1))
    wrong = F.udf(null_safe(lambda s: f"size {s}"), "int")
    return udf_null_audit(t.part.select(size.alias("size"), wrong(size).alias("out")), ["size"], "out")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * 1.1 + 1 AS scaled FROM lineitem")
def pandas_scale(t):
    @F.pandas_udf("double")
    def scale(price: pd.Series) -> pd.Series:
        return price * 1.1 + 1

    return t.lineitem.select("l_orderkey", "l_linenumber", scale("l_extendedprice").alias("scaled"))


@query(f"""
    SELECT event_type, event_id, z FROM ({_Z})
""")
def zscore_grouped(t):
    """Group-wise pandas at any group size: count, mean and squared distances of chunks, combined, then used per chunk."""

    def partial(rows: pd.DataFrame) -> dict:
        v = rows["v"].dropna()
        mean = v.mean() if len(v) else 0.0
        return {"n": len(v), "mean": mean, "off": ((v - mean) ** 2).sum()}

    def combine(states: pd.DataFrame) -> dict:
        n = states["n"].sum()
        mean = (states["n"] * states["mean"]).sum() / n if n else 0.0
        return {"n": n, "mean": mean, "off": (states["off"] + states["n"] * (states["mean"] - mean) ** 2).sum()}

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        spread = (rows["off"] / (rows["n"] - 1).where(rows["n"] > 1)) ** 0.5
        return rows[["event_id", "event_type"]].assign(z=(rows["v"] - rows["mean"]) / spread.where(spread > 0))

    found = map_grouped(
        _nullable_values(t), ["event_type"], partial, combine, score,
        "n long, mean double, off double", "event_id long, event_type string, z double",
    )
    return found.select("event_id", "event_type", (F.round("z", 6) + F.lit(0.0)).alias("z"))
