"""The roles of the operators bound to the order, event and document tables."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.functions.numeric import uniform_hash
from leadtime.operators import point_in_time as pit
from leadtime.session import cut_lineage

OBS_DATES = [date(1997, 1, 1), date(1998, 1, 1), date(1999, 1, 1)]
OBS_YEARS = {1997: "train", 1998: "val", 1999: "test"}
URGENT = ["1-URGENT", "2-HIGH"]
KEY = "entity"
FLAG_CODES = {"flag_urgent": "1-URGENT", "flag_high": "2-HIGH", "flag_medium": "3-MEDIUM",
              "flag_open": "4-NOT SPECIFIED", "flag_low": "5-LOW"}
FLAG_WEIGHTS = {"flag_urgent": 2, "flag_high": 2, "flag_medium": 1, "flag_open": 1, "flag_low": 0}
COST_MARKS = ["cost_"]


class Tables:
    """The tables of one data directory, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        self.__dict__[name] = df
        return df

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    @cached_property
    def cohort(self) -> DataFrame:
        """Every customer at every observation date."""
        return pit.cohort_on(self.customer.select(F.col("c_custkey").alias(KEY)), KEY, OBS_DATES)

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with the customer of their order."""
        owner = self.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias(KEY))
        return self.lineitem.join(owner, "l_orderkey")

    @cached_property
    def sources(self) -> list[pit.Source]:
        """Orders as admissions; line items as two kinds of visits by flag and as prescriptions by part."""
        flag = F.col("l_returnflag")
        return [
            pit.Source("inpatient", self.orders, "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"),
            pit.Source("outpatient", self.lines, KEY, "l_shipdate", "l_extendedprice", where=flag == "R"),
            pit.Source("carrier", self.lines, KEY, "l_shipdate", "l_extendedprice", where=flag.isin("A", "N")),
            pit.Source("prescription", self.lines, KEY, "l_shipdate", "l_extendedprice", "l_partkey"),
        ]

    @cached_property
    def entities(self) -> DataFrame:
        """Customer-years with condition codes (1 yes, 2 no), cost columns, an age and the forward label."""
        seen = (self.orders.where(F.col("o_orderdate") < F.lit(OBS_DATES[0])).groupBy(F.col("o_custkey").alias(KEY))
                .agg(*[F.max((F.col("o_orderpriority") == p).cast("int")).alias(c) for c, p in FLAG_CODES.items()]))
        one = self.customer.select(
            F.col("c_custkey").alias(KEY), F.when(F.col("c_nationkey") < 12, 1).otherwise(2).alias("sex_code"),
            F.col("c_nationkey").alias("race_code"), F.col("c_acctbal").alias("cost_balance"),
            F.col("c_nationkey").cast("double").alias("cost_nation"),
            F.when(F.col("c_acctbal") >= 0, 60.0 + F.col("c_acctbal") / 150.0).alias("AGE"))
        coded = one.join(seen, KEY, "left").withColumns(
            {c: F.when(F.col(c) == 1, 1).otherwise(2) for c in FLAG_CODES})
        dates = F.array(*[F.lit(d) for d in OBS_DATES])
        dated = coded.withColumn("obs_date", F.explode(dates)).withColumn("year", F.year("obs_date"))
        return pit.forward_label(dated, self.orders, KEY, "o_orderdate", OBS_DATES, 6, "label",
                                 codes=("o_orderpriority", URGENT), event_key="o_custkey").drop("obs_date")

    @cached_property
    def stored_entities(self) -> DataFrame:
        """The entity table as a stored table, as the cleaning job would leave it for the feature builds."""
        return cut_lineage(self.entities, "entities")

    @cached_property
    def urgent(self) -> DataFrame:
        return self.orders.where(F.col("o_orderpriority").isin(URGENT))

    @cached_property
    def predictions(self) -> DataFrame:
        """Labelled documents with the scores of three simple models.

        Split by hash: about two thirds validation, one third test.
        """
        p_len = F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0)), 4)
        p_hash = uniform_hash(F.col("doc_id"), seed="s")
        p_src = F.round(F.lit(0.5) * p_len + F.lit(0.5) * uniform_hash(F.col("source"), seed="s"), 4)
        split = F.when(uniform_hash(F.col("doc_id"), seed="split") < 0.66, "validation").otherwise("test")
        return (self.labels.join(self.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id")
                .select("doc_id", "lang", "source", split.alias("split"), F.col("quality").alias("label"), "toxic",
                        p_len.alias("p_len"), F.round(p_hash, 6).alias("p_hash"), p_src.alias("p_src")))

    @cached_property
    def requests(self) -> DataFrame:
        """Events as scoring requests: errors answer 500, the value is the latency in milliseconds."""
        return self.events.select(
            F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("endpoint"), "user_id", "event_id",
            F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
            (F.col("value") / 1000.0).alias("latency_s"), (F.col("value") / 500.0).alias("score"), "props")
