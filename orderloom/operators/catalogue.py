"""Color and size from the product catalogue, for the retailer that needs them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.attributes import is_pack


def company_id_lookup(companies: DataFrame) -> DataFrame:
    """One id per company name, the smallest when there are several."""
    return companies.groupBy(F.upper("company").alias("catalogue_company")).agg(
        F.min("company_id").alias("company_id")
    )


def catalogue_lookup(companies: DataFrame, product: DataFrame, retail: DataFrame) -> DataFrame:
    """One color and size per company and product: lowest Pid, then color and size.

    A product without retail rows stays with NULLs. Nothing is broadcast by
    hint here: the catalogue may be large, so the planner compares its measured
    size with ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it,
    where adaptive execution splits a product that dominates the lines.
    """
    per_pid = retail.groupBy("pid").agg(F.min(F.struct("color", "size")).alias("look"))
    chosen = (
        product.join(per_pid, "pid", "left")
        .groupBy("company_id", "product_id")
        .agg(F.min(F.struct("pid", "look")).alias("pick"))
    )
    return chosen.join(company_id_lookup(companies), "company_id").select(
        "catalogue_company",
        F.col("product_id").alias("catalogue_product"),
        F.col("pick.look.color").alias("catalogue_color"),
        F.col("pick.look.size").alias("catalogue_size"),
    )


def looks_up() -> Column:
    """Whether a line takes color and size from the catalogue: Belk's, packs excepted."""
    route = F.col("route")
    belk = (route == "BS") | ((route == "BB") & ~is_pack())
    return F.coalesce(belk & F.col("product_id").isNotNull(), F.lit(False))


def catalogue_override(attributed: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue color and size first, the document's as fallback; packs keep theirs.

    Lines that never look anything up get a key of their own, so that a
    shuffled join spreads them instead of gathering missing ids in one task.
    Where lines are stored, the full run joins only those that look up.
    """
    keyed = attributed.withColumn(
        "look_key",
        F.when(looks_up(), F.col("product_id")).otherwise(
            F.concat(F.lit("\0"), F.col("source_id"))
        ),
    )
    joined = keyed.join(
        catalogue,
        (F.upper("company") == F.col("catalogue_company"))
        & (F.col("look_key") == F.col("catalogue_product")),
        "left",
    )
    return joined.withColumns(
        {
            "color": F.coalesce("catalogue_color", "color"),
            "size": F.coalesce("catalogue_size", "size"),
        }
    ).drop(
        "look_key", "catalogue_company", "catalogue_product", "catalogue_color", "catalogue_size"
    )
