"""Fee schedule: wide price sheet to a long fee table keyed to plan and procedure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.functions import scalars as X
from opsledger.operators.aggregates import unpivot_plans
from opsledger.operators.joins import lookup_left
from opsledger.operators.windows import dense_row_id

FEE_IDS = ["cpt_description", "cpt_code", "cpt_group", "mod_1", "mod_2", "resource_provider_type"]

DIMENSION_COLUMNS = ["cpt_description", "cpt_code", "cpt_group", "fee_plan", "fee", "id_fee_plan", "cpt_id",
                     "mod_1", "mod_2", "resource_provider_type"]


def fee_schedule_long(sheet: DataFrame, plans: DataFrame, on_duplicate: str = "raise") -> DataFrame:
    """One row per procedure line and price plan, with plan id and a row number.

    The number follows the plan's place in the sheet, then the procedure columns.
    ``plans``: fee_plan, id_fee_plan.
    """
    places = {name: place for place, name in enumerate(c for c in sheet.columns if c not in FEE_IDS)}
    coded = sheet.withColumn("cpt_code", F.col("cpt_code").cast("string"))
    long = unpivot_plans(coded, FEE_IDS, "fee_plan", "fee")
    keyed = lookup_left(long, plans, ["fee_plan"], ["id_fee_plan"], on_duplicate) \
        .withColumn("id_fee_plan", X.rounded_long("id_fee_plan")) \
        .withColumn("_place", F.try_element_at(
            F.create_map(*[F.lit(x) for pair in places.items() for x in pair]), F.col("fee_plan")))
    order = ["_place", "cpt_code", "cpt_description", "cpt_group", "mod_1", "mod_2", "resource_provider_type", "fee",
             "id_fee_plan"]
    return dense_row_id(keyed, order, "id_cpt_fee").select("id_cpt_fee", *FEE_IDS, "fee_plan", "fee", "id_fee_plan")


def fee_dimension(fees: DataFrame, procedures: DataFrame, on_duplicate: str = "raise") -> DataFrame:
    """Fees with the procedure id. ``procedures``: cpt_id, cpt_code (compared as text)."""
    codes = procedures.select(F.col("cpt_code").cast("string").alias("cpt_code"), F.col("cpt_id").cast("bigint").alias("cpt_id"))
    return lookup_left(fees, codes, ["cpt_code"], ["cpt_id"], on_duplicate).select(*DIMENSION_COLUMNS)
