"""Incremental synchronisation of a source table into a gold table, with state and history.

State is a row a dataset: last_synced_at, watermark, documents_synced, documents_failed, status,
error. A batch is written to the shared folder first, so that what is upserted, counted and noted are
the same rows; the watermark is the highest loaded_at of them, and rows that arrive during a run are
taken by the next. A dataset is in_progress while it runs, then completed; partial if some of its
rows had no key (they are counted as failed, the watermark moves on); or failed, which keeps the old
watermark. If a batch fails as a whole its datasets are tried one by one, so that one does not take
the others with it; what was left in_progress, failed or partial is taken up by resume.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedarloom.io import cut
from cedarloom.operators.stores import Store

STATE = "dataset_id string, last_synced_at timestamp, watermark timestamp, documents_synced bigint, documents_failed bigint, status string, error string"


def newer(source: DataFrame, state: DataFrame, time: str = "loaded_at", updated: str | None = None) -> DataFrame:
    """Source rows above the watermark of their dataset; all of those of new datasets."""
    mark = state.select("dataset_id", F.col("watermark"))
    hit = f"watermark is null or `{time}` > watermark" + (f" or `{updated}` > watermark" if updated else "")
    return source.join(mark, "dataset_id", "left").where(hit).drop("watermark")


def progress(batch: DataFrame, time: str = "loaded_at") -> DataFrame:
    """(dataset_id, documents, watermark) of processed rows."""
    return batch.groupBy("dataset_id").agg(F.count("*").alias("documents"), F.max(time).alias("watermark"))


def gap(source: DataFrame, target: DataFrame) -> DataFrame:
    """(dataset_id, in_source, in_target, gap)."""
    a = source.groupBy("dataset_id").agg(F.count("*").alias("in_source"))
    b = target.groupBy("dataset_id").agg(F.count("*").alias("in_target"))
    at = a.join(b, "dataset_id", "full").na.fill(0, ["in_source", "in_target"])
    return at.withColumn("gap", F.expr("in_source - in_target"))


def status(state: DataFrame) -> DataFrame:
    return state.agg(
        F.count("*").alias("tracked"), F.sum("documents_synced").alias("documents"), F.sort_array(F.expr("collect_list(case when status = 'failed' then dataset_id end)")).alias("failed"), F.max("last_synced_at").alias("last_sync")
    )


def pending(datasets: DataFrame, state: DataFrame) -> DataFrame:
    """Datasets that are not yet completed."""
    return datasets.select("dataset_id").distinct().join(state.where("status = 'completed'"), "dataset_id", "left_anti")


class Sync:
    """Keeps `target` (a Store) in step with a source of documents. `transform` maps the source rows
    to target rows, DataFrame to DataFrame."""

    def __init__(self, spark: SparkSession, target: Store, state_path: str, transform: Callable[[DataFrame], DataFrame] | None = None, time: str = "loaded_at"):
        self.spark, self.target, self.path, self.time = spark, target, state_path.rstrip("/"), time
        self.transform = transform or (lambda df: df)

    def state(self) -> DataFrame:
        """The last row of each dataset in the append-only history."""
        return self.history().groupBy("dataset_id").agg(F.max_by(F.struct(*[c.split()[0] for c in STATE.split(", ")[1:]]), "last_synced_at").alias("s")).select("dataset_id", "s.*")

    def history(self) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(self.path) if self._exists() else self.spark.createDataFrame([], STATE)

    def _exists(self) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _note(self, rows: DataFrame) -> None:
        rows.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in STATE.split(", ")]).coalesce(1).write.mode("append").parquet(self.path)

    def _outcome(self, done: DataFrame, status: str, error: str | None = None) -> DataFrame:
        now = F.lit(datetime.now(timezone.utc))
        if status in ("failed", "in_progress"):  # the watermark stays
            done = done.drop("watermark").join(self.state().select("dataset_id", "watermark"), "dataset_id", "left")
        synced = F.lit(0) if status != "completed" else F.col("documents") - F.col("keyless")
        failed = F.col("documents") if status == "failed" else F.lit(0) if status == "in_progress" else F.col("keyless")
        kind = F.expr("case when keyless > 0 then case when keyless = documents then 'failed' else 'partial' end else 'completed' end") if status == "completed" else F.lit(status)
        return done.withColumns({"documents_synced": synced, "documents_failed": failed, "status": kind, "error": F.lit(error).cast("string"), "last_synced_at": now})

    def run(self, source: DataFrame, datasets: list[str] | None = None, full: bool = False, category: str | None = None, new_only: bool = False, resume: bool = False) -> dict[str, int]:
        """{processed, failed}. With full, documents of the datasets that the source no longer has
        go. category: only its documents (column primary_issue); new_only: only datasets without a
        state; resume: only those whose last run was not completed."""
        if datasets is not None:
            source = source.where(F.col("dataset_id").isin(datasets))
        if category is not None:
            source = source.where(F.col("primary_issue") == category)
        if new_only:
            source = source.join(self.state().select("dataset_id"), "dataset_id", "left_anti")
        if resume:
            source = source.join(self.state().where("status != 'completed'").select("dataset_id"), "dataset_id", "left_semi")
        batch = cut(source if full else newer(source, self.state(), self.time), "batch")
        if batch.isEmpty():
            return {"processed": 0, "failed": 0}
        self._note(self._outcome(cut(progress(batch, self.time).withColumn("keyless", F.lit(0)), "progress"), "in_progress"))
        try:
            return self._take(batch, full)
        except Exception as e:
            done = cut(progress(batch, self.time).withColumn("keyless", F.lit(0)), "progress")
            names = [r[0] for r in done.select("dataset_id").collect()]  # one a dataset
            if len(names) == 1:
                self._note(self._outcome(done, "failed", str(e)[:500]))
                return {"processed": 0, "failed": batch.count()}
        out = {"processed": 0, "failed": 0}
        for d in names:
            own = batch.where(F.col("dataset_id").eqNullSafe(d))
            try:
                got = self._take(own, full)
            except Exception as e:
                self._note(self._outcome(done.where(F.col("dataset_id").eqNullSafe(d)), "failed", str(e)[:500]))
                got = {"processed": 0, "failed": own.count()}
            out = {k: out[k] + got[k] for k in out}
        return out

    def _take(self, batch: DataFrame, full: bool) -> dict[str, int]:
        made = cut(self.transform(batch), "made")
        n = self.target.upsert(made, [F.col(self.time).desc()], replace=full)["stored"]
        keyless = made.where(F.col(self.target.key).isNull()).groupBy("dataset_id").agg(F.count("*").alias("keyless"))
        done = progress(batch, self.time).join(keyless, "dataset_id", "left").na.fill(0, ["keyless"])
        self._note(self._outcome(cut(done, "progress"), "completed"))
        return {"processed": n, "failed": made.where(F.col(self.target.key).isNull()).count()}

    def full_resync(self, source: DataFrame) -> dict[str, int]:
        """Everything anew; the state then stands at the new watermark."""
        self.target.recreate()
        return self.run(source, full=True)

    def stream(self, source: DataFrame, checkpoint: str):
        """The same as a stream: each micro-batch is upserted and noted; a run takes what is there."""

        def each(batch: DataFrame, _: int) -> None:
            if not batch.isEmpty():
                self._take(cut(batch, "batch"), False)

        return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def quick_sync(spark: SparkSession, source: DataFrame, target: Store, state_path: str) -> dict[str, int]:
    """What is new, of all datasets."""
    return Sync(spark, target, state_path).run(source)


def sync_report(spark: SparkSession, target: Store, state_path: str, source: DataFrame) -> DataFrame:
    """(dataset_id, in_source, in_target, gap, status, watermark) of every dataset."""
    return gap(source, target.read()).join(Sync(spark, target, state_path).state().select("dataset_id", "status", "watermark"), "dataset_id", "left")


def index_enriched(records: DataFrame, target: Store) -> dict[str, int]:
    """Indexes what read_enriched gives (source_file, dataset_id, position, record): documents with
    positional ids, dataset:position; {indexed, failed, files}."""
    at = records.selectExpr("concat(coalesce(dataset_id, 'unknown'), ':', position) as _unique_id", "coalesce(dataset_id, 'unknown') as dataset_id", "source_file", "case when schema_of_variant(record) like 'OBJECT%' then to_json(record) end as record")
    at = cut(at, "enriched")  # a document is parsed in one task, and once
    good = at.where("record is not null")
    got = target.upsert(good, [F.col("source_file").desc()])
    whole = at.agg(F.count_if(F.expr("record is null")).alias("bad"), F.count_distinct("source_file").alias("files")).first()
    return {"indexed": got["stored"], "failed": whole["bad"], "files": whole["files"]}


def load(records: DataFrame, dataset: str, bronze_store: Store, silver_store: Store, gold_store: Store) -> dict[str, bool]:
    """Bronze, silver and gold in turn; stops at the first layer that fails, earlier ones stay."""
    from cedarloom.operators.medallion import bronze, gold, silver

    done = {"bronze": False, "silver": False, "gold": False}
    try:
        bronze_store.upsert(bronze(records, dataset).withColumnRenamed("_dataset_id", "dataset_id"))
        done["bronze"] = True
        made = silver(records, dataset)
        silver_store.upsert(made, merge=True)
        done["silver"] = True
        gold_store.upsert(gold(made))
        done["gold"] = True
    except Exception as e:
        done["error"] = str(e)[:500]
    return done
