"""The layers over a folder of source tables, as the query catalogue sees them.

Bronze and Silver are views; what a later layer reads many times (landed Bronze
files, deduplicated Silver, run documents) is written once per application to
the shared folder, as the pipeline itself does between layers.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators import audit, bronze, silver, states
from gondola.operators.dedup_index import DedupIndex
from gondola.session import fresh_path
from gondola.sources import adapter, writers

_WRITTEN: dict[tuple[str, str, str], str] = {}


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return adapter.read(self.spark, self.sf_dir, name)

    @cached_property
    def obs(self) -> DataFrame:
        """Raw records plus the run that collected them: one run per market and month.

        A view: a query shuffles and decodes only the fields it reads.
        """
        return _collected(adapter.observations(self.spark, self.sf_dir))

    @cached_property
    def silver(self) -> DataFrame:
        """Normalised records before deduplication."""
        return silver.normalize(self.obs)

    def _once(self, name: str, write) -> str:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _WRITTEN:
            path = fresh_path(self.spark, name)
            write(path)
            _WRITTEN[key] = path
        return _WRITTEN[key]

    def kept_path(self) -> str:
        """Deduplicated Silver, one folder per market, ordered by collection time.

        The range order keeps files even whatever the market sizes are, and gives
        tight min / max statistics for date filters.
        """
        def write(path: str) -> None:
            (silver.normalize_kept(self.obs).withColumn("out_market", F.col("market"))
             .repartitionByRange("out_market", "collected_at", "record_id")
             .sortWithinPartitions("out_market", "collected_at")
             .write.partitionBy("out_market").parquet(path))
        return self._once("silver", write)

    def kept_paths(self) -> list[str]:
        return [f"{self.kept_path()}/out_market={m}" for m in self.markets()]

    def markets(self) -> list[str]:
        """All markets of the Silver folder, one row each."""
        rows = (self.spark.read.parquet(self.kept_path()).select("out_market").distinct()
                .orderBy("out_market").collect())
        return [r[0] for r in rows]

    @cached_property
    def kept(self) -> DataFrame:
        return self.spark.read.parquet(self.kept_path()).drop("out_market")

    def land_bronze(self, path: str) -> str:
        """Raw rows are dealt by folder; the texts of records, runs and days are made after."""
        raw = _collected(adapter.raw_observations(self.spark, self.sf_dir))
        records = adapter.records(writers.dealt_by_run(raw), ("run_ts", "bronze_run_id"))
        return writers.write_bronze(
            bronze.enrich(records.withColumn("collected_at", _iso("collected_at")),
                          F.col("bronze_run_id"), F.col("run_ts")), path, dealt=True)

    def bronze_path(self) -> str:
        return self._once("bronze", self.land_bronze)

    @cached_property
    def bronze(self) -> DataFrame:
        """Landed Bronze, read back from its partitioned folder."""
        return writers.read_bronze(self.spark, self.bronze_path())

    @cached_property
    def dedup_index(self) -> DedupIndex:
        """Duplicates of Silver, from one run over the older records and one over the rest."""
        late = F.col("collected_at") >= F.lit("1996-01-01").cast("timestamp_ntz")

        def write(path: str) -> None:
            index = DedupIndex(self.spark, path)
            index.add(self.silver.filter(~late), 1).add(self.silver.filter(late), 2)
        return DedupIndex(self.spark, self._once("dedup-index", write))

    def _states(self, name: str, build) -> DataFrame:
        path = self._once(f"states-{name}", lambda path: states.refresh(build(), path))
        return states.read_states(self.spark, path)

    @cached_property
    def raw_months(self) -> DataFrame:
        """Month states of raw prices per market."""
        return self._states("raw", lambda: states.market_states(self.obs, "price"))

    @cached_property
    def months(self) -> DataFrame:
        """Month states of normalised prices per market."""
        return self._states("market", lambda: states.market_states(self.silver))

    @cached_property
    def catalog_months(self) -> DataFrame:
        return self._states("catalog", lambda: states.catalog_states(self.kept))

    @cached_property
    def graphql(self) -> DataFrame:
        return adapter.graphql_payloads(self.spark, self.sf_dir)

    @cached_property
    def search_hits(self) -> DataFrame:
        return adapter.search_hit_payloads(self.spark, self.sf_dir)

    @cached_property
    def html(self) -> DataFrame:
        return adapter.html_payloads(self.spark, self.sf_dir)

    def payload_path(self) -> str:
        return self._once("payloads", lambda path: writers.write_raw_payloads(
            self.graphql.drop("record_id").unionByName(self.search_hits.drop("record_id")), path))

    def audit(self, layer: str | None = None) -> DataFrame:
        """Run documents of one layer or both; a layer that is not asked for is not run."""
        makers = {"bronze": lambda: audit.bronze_runs(self.obs),
                  "silver": lambda: audit.silver_runs(self.kept)}
        docs = [writers.read_audit(self.spark, self._once(
                    f"audit-{name}", lambda path, make=make: writers.write_audit(make(), path)))
                for name, make in makers.items() if layer in (None, name)]
        return docs[0] if len(docs) == 1 else docs[0].unionByName(docs[1])


def _collected(records: DataFrame) -> DataFrame:
    """Records with the run that collected them."""
    ts = F.date_trunc("month", "collected_at").cast("timestamp_ntz")
    month = F.date_format("run_ts", "yyyyMMdd")
    tag = F.substring(F.md5(F.concat_ws("-", "market", month)), 1, 8)
    return (records.withColumn("run_ts", ts)
            .withColumn("bronze_run_id", F.concat(month, F.lit("_000000_"), tag)))


def _iso(name: str):
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss'Z'")
