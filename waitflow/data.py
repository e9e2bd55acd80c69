"""Frames of one input directory, named once and shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.operators.keys import with_surrogate_key
from waitflow.plans import dims, facts, marts
from waitflow.sources import pathways as P
from waitflow.sources.tables import table

SITE = "https://site.example"


class Data:
    """Plans over the tables of one directory; nothing runs until a caller asks for rows."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.directory, name)

    def rows(self, specialty: bool = True, start: str | None = None, end: str | None = None) -> DataFrame:
        return P.pathways(self.spark, self.directory, specialty, start, end)

    def label(self, df: DataFrame) -> DataFrame:
        """Provider, region and (where the code is there) specialty labels."""
        labelled = P.with_provider(df, self.spark, self.directory)
        return P.with_specialty(labelled) if "treatment_function_code" in df.columns else labelled

    # Fact frames carry provider_id; the code needs no join.
    @staticmethod
    def coded(df: DataFrame) -> DataFrame:
        return df.withColumn("provider_org_code", P.provider_code(F.col("provider_id")))

    @staticmethod
    def sourced(df: DataFrame, kind: str) -> DataFrame:
        name = F.concat(F.lit(f"{kind}-"), F.date_format("period_date", "MMMyy"), F.lit(".xlsx"))
        return df.withColumn("source_file", name)

    def incomplete(self) -> DataFrame:
        return self.coded(facts.incomplete(self.rows()))

    def completed(self) -> DataFrame:
        return self.coded(facts.completed(self.rows()))

    def new_periods(self) -> DataFrame:
        return self.coded(facts.new_periods(self.rows()))

    def activity(self, waits: bool = False) -> DataFrame:
        return facts.activity(self.rows(), waits=waits)

    def summary(self, waits: bool = False) -> DataFrame:
        return marts.monthly_summary(self.activity(waits))

    def labelled_summary(self, waits: bool = False) -> DataFrame:
        return self.label(self.summary(waits))

    def specialty_summary(self, waits: bool = False) -> DataFrame:
        return P.with_specialty(self.summary(waits))

    def national(self) -> DataFrame:
        return marts.national_monthly(self.summary())

    def month_totals(self) -> DataFrame:
        """Month totals straight from the rows: the specialty and provider are not needed."""
        return marts.month_totals(facts.activity(self.rows(specialty=False), ["period_date"]))

    def region_summary(self) -> DataFrame:
        """Month x region sums, enough for most dashboard measures."""
        keys = ["period_date", "region_code", "region_name"]
        return self.labelled_summary().groupBy(*keys).agg(*marts.sums(marts.MEASURES))

    # Dimensions.
    def dim_date(self) -> DataFrame:
        """The standard calendar, prolonged to the months of the orders where these lie outside."""
        month = P.period_of(F.to_date("o_orderdate"))
        return dims.dim_date(dims.calendar_with(self.table("orders").select(month.alias("period_date"))))

    def dim_wait_band(self) -> DataFrame:
        return dims.dim_wait_band(self.spark)

    def regions(self) -> DataFrame:
        code = F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
        return self.table("region").select(code.alias("region_code"), F.col("r_name").alias("region_name"))

    def dim_region(self) -> DataFrame:
        return dims.region_dimension(self.regions())

    def specialties(self) -> DataFrame:
        codes = self.table("part").select(F.col("p_brand").alias("treatment_function_code"))
        return P.with_specialty(codes.distinct())

    def dim_treatment_function(self) -> DataFrame:
        return dims.dim_treatment_function(self.specialties())

    def provider_ids(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_suppkey").alias("provider_id")).distinct()

    def dim_trust(self) -> DataFrame:
        """Codes are numbered on their own and labelled afterwards, so the distinct codes are found once."""
        keyed = with_surrogate_key(self.coded(self.provider_ids()), "provider_org_code", "trust_key")
        labelled = P.with_provider(keyed, self.spark, self.directory)
        regions = self.dim_region().select("region_code", "region_key")
        return labelled.join(regions, "region_code", "left").select(
            "trust_key",
            F.col("provider_org_code").alias("trust_code"),
            F.col("provider_org_name").alias("trust_name"),
            F.coalesce("region_key", F.lit(S.DEFAULT_REGION_KEY)).alias("region_key"),
            F.lit(1).alias("is_active"),
        )

    def dimensions(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim_date(),
            "dim_trust": self.dim_trust(),
            "dim_region": self.dim_region(),
            "dim_treatment_function": self.dim_treatment_function(),
            "dim_wait_band": self.dim_wait_band(),
        }
