"""The nightly batch: landing files to audited canonical tables.

    landing files -> bronze (keyed Parquet, appended) -> store-days with new records
                  -> quarantine / canonical tables
                  -> row rules, repeated numbers, taxes, discounts, references -> sa_error
                  -> workflow state, gaps, store-days, totals

JSON is parsed and keyed once, into bronze, where a record lands once however often its file
comes; all later steps read columns.  A run rebuilds the store-days that its ingestion date brought
records for, from all their records, and replaces those store-days in the canonical tables, also where a table
gets no rows for one any more (its last gap was closed).  Rejected records are kept by ingestion date.
Every step writes a table, so a lost executor costs the running step only.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tillwarden import reference as ref
from tillwarden.functions import keys as K
from tillwarden.operators import audit, conform, rules, sequence, totals
from tillwarden.schemas import RECORD_KEYS
from tillwarden.session import dropping_shuffles, work_dir
from tillwarden.sources import canonical, landing, rtlog as R


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run(
    spark: SparkSession,
    landing_path: str,
    base: str,
    stores: DataFrame,
    rule_list: list[rules.Rule] | None = None,
    updated: Column | None = None,
    ingest_date: str | None = None,
) -> None:
    with dropping_shuffles(spark):
        _run(spark, landing_path, base, stores, rule_list, updated, ingest_date)


def _run(
    spark: SparkSession,
    landing_path: str,
    base: str,
    stores: DataFrame,
    rule_list: list[rules.Rule] | None,
    updated: Column | None,
    ingest_date: str | None,
) -> None:
    # the date of the run is fixed once, so that a run over midnight stays one ingestion
    ingest_date = ingest_date or datetime.now(UTC).date().isoformat()
    raw = R.read_rtlog(spark, landing_path, lineage=True)
    bronze = f"{base}/bronze"
    keyed = conform.tag_rejections(raw.withColumn("record_key", K.record_key()))
    landing.land_bronze(keyed, bronze, ingest_date)
    schema = StructType(keyed.schema.fields + [StructField("ingest_date", DateType())])
    kept = spark.read.schema(schema).parquet(bronze)
    store_day = [F.col("tran_head.store").alias("_store"), F.col("tran_head.business_date").alias("_date")]
    # store-days are written down: Catalyst sees how few they are, and records need no shuffle to meet them
    touched = _written(
        kept.filter(F.col("ingest_date") == F.lit(ingest_date).cast("date")).select(*store_day).distinct(), "touched-days"
    )
    same_day = F.col("tran_head.store").eqNullSafe(F.col("_store")) & F.col("tran_head.business_date").eqNullSafe(
        F.col("_date")
    )
    landed = kept.join(touched, same_day, "left_semi").drop("ingest_date")

    # records that this ingestion date brought and that no table takes
    bad = kept.filter((F.col("ingest_date") == F.lit(ingest_date).cast("date")) & F.col("rejection_reason").isNotNull())
    canonical.write_quarantine(bad, f"{base}/_quarantine")
    good = landed.filter("rejection_reason is null").drop("rejection_reason", "_corrupt")
    flat_heads = conform.heads(good)
    tables = conform.fan_out(good)

    # everything that needs bronze only
    records = good.select(*RECORD_KEYS, "record_key", *R.PARTITION)
    facts = rules.nested_facts(records, stores)
    hits = rules.run_rules(facts, rule_list).unionByName(audit.duplicate_hits(flat_heads))
    hits = hits.unionByName(audit.nested_sets(records, ref.products(spark), ref.promotions(spark)))
    children = {name: df for name, df in tables.items() if name != "sa_tran_head"}
    first = children | {
        "sa_error": audit.build_sa_error(hits, updated),
        "sa_missing_tran": sequence.sa_missing_tran(flat_heads),
        "sa_store_day": totals.build_store_day(good.select("source_file", "tran_head.*"), stores),
        "sa_error_codes": ref.error_codes(spark),
        "sa_total_head": ref.total_heads(spark),
    }
    touched_days = touched.select(F.col("_store").alias("store"), F.col("_date").alias("business_date"))
    canonical.write_canonical(first, base, touched=touched_days)

    def back(name: str) -> DataFrame:
        # with its schema: a delivery without discounts or additive taxes writes no rows
        return canonical.read_canonical(spark, base, name, first[name].schema)

    heads = tables["sa_tran_head"]
    days = _written(
        heads.select(F.col("store").alias("_store"), F.col("business_date").alias("_date")).distinct(), "rebuilt-days"
    )

    def rebuilt(df: DataFrame) -> DataFrame:
        """Rows of the store-days of this run."""
        on = df["store"].eqNullSafe(F.col("_store")) & df["business_date"].eqNullSafe(F.col("_date"))
        return df.join(days, on, "left_semi")

    # headers with their workflow state, and totals, from the tables just written
    errors = rebuilt(back("sa_error")).select(
        "record_key", "error_code", "store_override_ind", "hq_override_ind"
    )
    head = audit.advance_status(heads, errors, ref.error_codes(spark))
    sums = totals.calc_totals(
        heads,
        *[
            rebuilt(back(f"sa_tran_{child}"))
            for child in ("tender", "tax", "igtax", "disc")
        ],
    )
    canonical.write_canonical(
        {"sa_tran_head": head.drop("n_errors", "n_blocking"), "totals": sums}, base, touched=touched_days
    )
