"""The driver tables seen as the library's inputs, as DataFrames and as SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.config import GROUP, ID, PART_ESTIMATE, PART_UNCERTAINTY, TRUTH
from cohortlens.operators import cohort

THRESHOLDS = (125.0, 150.0, 175.0, 200.0)
CHROM_OFFSET = 160_395_000


class Inputs:
    """Input tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def predictions(self) -> DataFrame:
        estimate = F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1900
        return self.table("lineitem").select(
            F.col("l_orderkey").alias(ID), estimate.alias(PART_ESTIMATE), (estimate * F.col("l_tax")).alias(PART_UNCERTAINTY)
        )

    @cached_property
    def measured(self) -> DataFrame:
        quantity = self.table("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
        people = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        group = (
            F.when(F.col("c_custkey") % 701 == 0, "Other")
            .when(F.col("n_name") == "NATION_8", "CSA")
            .when(F.col("r_name") == "AFRICA", "AFR")
            .when(F.col("r_name") == "AMERICA", "AMR")
            .when(F.col("r_name") == "ASIA", "EAS")
            .when(F.col("r_name") == "EUROPE", "EUR")
            .otherwise("MID")
        )
        rows = (
            self.table("orders")
            .join(people, F.col("o_custkey") == F.col("c_custkey"))
            .join(quantity, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        )
        return rows.select(
            F.col("o_orderkey").alias(ID),
            F.when(F.col("o_orderstatus") != "P", F.coalesce("qty", F.col("o_totalprice") / 2500)).alias(TRUTH),
            group.alias(GROUP),
            (18 + F.col("c_custkey") % 70).cast("double").alias("age"),
            F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("sex"),
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("HTN"),
            (F.col("o_orderpriority") == "5-LOW").alias("DM"),
            (F.col("c_acctbal") < 0).alias("IHD"),
        )

    @cached_property
    def summary(self) -> DataFrame:
        return cohort.pred_summary(self.predictions)

    @cached_property
    def joined(self) -> DataFrame:
        return cohort.join_pred_measured(self.summary, self.measured)

    @cached_property
    def pairs(self) -> DataFrame:
        return cohort.complete_pairs(self.joined)

    @cached_property
    def valid(self) -> DataFrame:
        return cohort.min_group_filter(self.pairs)

    @cached_property
    def raw_calls(self) -> DataFrame:
        """One call per part and supplier: the smallest (order, line, tax, flag) of those present."""
        first = F.min(F.struct("l_orderkey", "l_linenumber", "l_tax", "l_returnflag"))
        per_pair = self.table("lineitem").groupBy("l_partkey", "l_suppkey").agg(first.alias("r"))
        flag = F.col("r.l_returnflag")
        return per_pair.select(
            F.lit("6").alias("chrom"),
            (CHROM_OFFSET + F.col("l_partkey") * 300).alias("pos"),
            F.lit("A").alias("ref"),
            F.when(F.col("l_partkey") % 50 == 0, "G,T").otherwise("G").alias("alt"),
            F.col("l_suppkey").cast("string").alias("sample"),
            F.when(F.col("r.l_tax") == 0, ".|.").when(flag == "N", "0|0").when(flag == "A", "0|1").otherwise("1|1").alias("gt"),
            F.lit("PASS").alias("filter"),
        )

    @cached_property
    def sites(self) -> DataFrame:
        return self.table("part").filter("p_size <= 25").select(
            F.lit("chr6").alias("chrom"),
            (CHROM_OFFSET + F.col("p_partkey") * 300).alias("pos"),
            F.lit("A").alias("ref"),
            F.when(F.col("p_partkey") % 50 == 0, "G,T").otherwise("G").alias("alt"),
        )


# The same tables as SQL: name -> (names it reads, text).
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "predictions": (
        (),
        """SELECT l_orderkey AS "ID", l_extendedprice * (1 - l_discount) / 1900 AS "Lpa_pred_nM",
           l_extendedprice * (1 - l_discount) / 1900 * l_tax AS "min_uncertainty_nM" FROM lineitem""",
    ),
    "measured": (
        (),
        """SELECT o_orderkey AS "ID",
           CASE WHEN o_orderstatus <> 'P' THEN coalesce(qty, o_totalprice / 2500) END AS lpa_nmol_max,
           CASE WHEN c_custkey % 701 = 0 THEN 'Other' WHEN n_name = 'NATION_8' THEN 'CSA'
                WHEN r_name = 'AFRICA' THEN 'AFR' WHEN r_name = 'AMERICA' THEN 'AMR' WHEN r_name = 'ASIA' THEN 'EAS'
                WHEN r_name = 'EUROPE' THEN 'EUR' ELSE 'MID' END AS "GIA",
           (18 + c_custkey % 70)::DOUBLE AS age,
           CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex,
           o_orderpriority IN ('1-URGENT', '2-HIGH') AS "HTN", o_orderpriority = '5-LOW' AS "DM", c_acctbal < 0 AS "IHD"
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey
           LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) q
             ON o_orderkey = l_orderkey""",
    ),
    "pred": (
        ("predictions",),
        """SELECT *, lpa_pred_nm - 1.96 * lpa_pred_se AS lpa_pred_lci95, lpa_pred_nm + 1.96 * lpa_pred_se AS lpa_pred_uci95
           FROM (SELECT "ID", sum("Lpa_pred_nM") AS lpa_pred_nm,
                 sqrt(sum("min_uncertainty_nM" * "min_uncertainty_nM")) AS lpa_pred_se FROM predictions GROUP BY "ID")""",
    ),
    "joined": (
        ("pred", "measured"),
        """SELECT p.*, m.* EXCLUDE ("ID") FROM pred p LEFT JOIN measured m ON p."ID" IS NOT DISTINCT FROM m."ID" """,
    ),
    "pairs": (("joined",), "SELECT * FROM joined WHERE lpa_nmol_max IS NOT NULL AND lpa_pred_nm IS NOT NULL"),
    "valid": (
        ("pairs",),
        """SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY "GIA")::BIGINT AS n FROM pairs) WHERE n > 20""",
    ),
    "raw_calls": (
        (),
        """SELECT '6' AS chrom, (160395000 + l_partkey * 300)::BIGINT AS pos, 'A' AS ref,
           CASE WHEN l_partkey % 50 = 0 THEN 'G,T' ELSE 'G' END AS alt, l_suppkey::VARCHAR AS sample,
           CASE WHEN l_tax = 0 THEN '.|.' WHEN l_returnflag = 'N' THEN '0|0' WHEN l_returnflag = 'A' THEN '0|1'
                ELSE '1|1' END AS gt, 'PASS' AS filter
           FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                   ORDER BY l_orderkey, l_linenumber, l_tax, l_returnflag) AS rn
                 FROM lineitem) WHERE rn = 1""",
    ),
    "calls": (("raw_calls",), "SELECT 'chr6' AS chrom, pos, ref, alt, sample, gt FROM raw_calls"),
    "sites": (
        (),
        """SELECT 'chr6' AS chrom, (160395000 + p_partkey * 300)::BIGINT AS pos, 'A' AS ref,
           CASE WHEN p_partkey % 50 = 0 THEN 'G,T' ELSE 'G' END AS alt FROM part WHERE p_size <= 25""",
    ),
    "extracted": (
        ("calls", "sites"),
        """SELECT * FROM calls c WHERE pos BETWEEN 160400000 AND 160800000 AND EXISTS
           (SELECT 1 FROM sites s WHERE s.chrom = c.chrom AND s.pos = c.pos AND s.ref = c.ref AND s.alt = c.alt)""",
    ),
}


def query(*parts: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named parts (and what they read), then ``extra`` parts in order, then ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _PARTS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for part in parts:
        visit(part)
    clauses = [f"{name} AS ({_PARTS[name][1]})" for name in ordered]
    clauses += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return ("WITH " + ", ".join(clauses) + " " if clauses else "") + body


def rounded_sql(columns: str, body: str, digits: int = 6) -> str:
    """``body`` with the named double columns rounded."""
    replaced = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({body})"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded."""
    return df.select(
        *[F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )
