"""Tables of the layers: upsert, delete, counts. Parquet, partitioned by dataset.

Plain Parquet has no MERGE. An upsert writes the touched datasets to a new folder beside the table;
the old partitions are then moved aside, the new ones moved in, and the old ones deleted. A swap that
was broken off is finished by the next write (one writer a table); nothing is lost in between.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cedarloom.io import cut


def latest(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key; of equal rows in the order one stays."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upserted(old: DataFrame, new: DataFrame, keys: list[str], merge: bool = False) -> DataFrame:
    """old with the rows of new in place of those of the same key. With merge, columns that a new
    row has as null keep their old value. new must have one row a key (see latest)."""
    if not merge:
        return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)
    both = old.alias("o").join(new.alias("n"), keys, "full")
    cols = list(dict.fromkeys([*old.columns, *new.columns]))
    pick = lambda c: F.coalesce(*[F.col(f"{t}.{c}") for t, d in (("n", new), ("o", old)) if c in d.columns])
    return both.select(*keys, *[pick(c).alias(c) for c in cols if c not in keys])


class Store:
    """A table of documents with a key, in `path`, partitioned by `dataset`."""

    def __init__(self, spark: SparkSession, path: str, key: str, dataset: str = "dataset_id"):
        self.spark, self.path, self.key, self.dataset = spark, path.rstrip("/"), key, dataset
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._path(self.path)) and bool(self._fs.listStatus(self._path(self.path)))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _write(self, df: DataFrame, path: str) -> None:
        df.repartition(self.dataset, F.pmod(F.xxhash64(self.key), F.lit(64))).sortWithinPartitions(self.key).write.mode("append").partitionBy(self.dataset).parquet(path)

    def upsert(self, new: DataFrame, order: list | None = None, merge: bool = False, replace: bool = False) -> dict[str, int]:
        """{stored, matched, upserted}, and failed if there are such. Of several rows of one key the last by `order` counts,
        without an order the one with the least digest, whatever the order of the rows. Rows without
        a key fail. With replace, the datasets in `new` lose all rows that are not in it."""
        self._finish()
        hashed = [f.name for f in new.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
        new = cut(latest(new, [self.key], order or [F.xxhash64(*hashed)]), "upsert")
        total = new.count()
        new = new.where(F.col(self.key).isNotNull())
        stored = new.count()
        out = {"stored": stored, "matched": 0, "upserted": stored} | ({"failed": total - stored} if stored < total else {})
        if not stored:
            return out
        if not self.exists():
            self._write(new, self.path)
            return out
        old = self.read()
        matched = old.join(new.select(self.key), self.key, "left_semi")
        out["matched"] = matched.count()
        out["upserted"] = stored - out["matched"]
        # a key whose dataset changed leaves its old partition too
        touched = cut(new.select(self.dataset).union(matched.select(self.dataset)).distinct(), "touched")
        stay = old.join(touched, old[self.dataset].eqNullSafe(touched[self.dataset]), "left_semi")
        if replace:
            stay = stay.join(new.select(self.dataset).distinct(), self.dataset, "left_anti")
        staged = f"{self.path}__swap_{uuid.uuid4().hex}"
        self._write(upserted(stay, new, [self.key], merge), f"{staged}/new")
        self._swap(staged, [r[0] for r in touched.collect()])
        return out

    def _folders(self, root: str) -> dict[str, object]:
        if not self._fs.exists(self._path(root)):
            return {}
        return {s.getPath().getName(): s.getPath() for s in self._fs.listStatus(self._path(root)) if s.isDirectory()}

    def _swap(self, staged: str, datasets: list) -> None:
        have, escape = self._folders(self.path), self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        self._fs.mkdirs(self._path(f"{staged}/old"))
        names = [f"{self.dataset}={escape(str(d)) if d is not None else '__HIVE_DEFAULT_PARTITION__'}" for d in datasets]
        # what is to be swapped is noted before anything moves
        self._fs.mkdirs(self._path(f"{staged}/ready"))
        for name in names:
            if name in have:
                self._fs.rename(have[name], self._path(f"{staged}/old/{name}"))
            if self._fs.exists(self._path(f"{staged}/new/{name}")):
                self._fs.rename(self._path(f"{staged}/new/{name}"), self._path(f"{self.path}/{name}"))
        self._fs.delete(self._path(staged), True)
        self.spark.catalog.refreshByPath(self.path)

    def _finish(self) -> None:
        """Ends a swap that was broken off: partitions that were moved aside and not yet replaced get
        their new version, the others their turn; what was not ready is dropped."""
        parent, base = self.path.rsplit("/", 1)
        for name, at in self._folders(parent).items():
            if name.startswith(f"{base}__swap_"):
                root = f"{parent}/{name}"
                if self._fs.exists(self._path(f"{root}/ready")):
                    aside, made = self._folders(f"{root}/old"), self._folders(f"{root}/new")
                    for part, where in made.items():
                        target = self._path(f"{self.path}/{part}")
                        if part not in aside and self._fs.exists(target):
                            self._fs.rename(target, self._path(f"{root}/old/{part}"))
                        self._fs.rename(where, target)
                self._fs.delete(at, True)

    def delete(self, condition) -> int:
        """Rows that fulfil a condition (SQL or a Column), removed; how many there were."""
        self._finish()
        condition = F.expr(condition) if isinstance(condition, str) else condition
        gone = self.read().where(condition)
        n = gone.count()
        if n:
            touched = cut(gone.select(self.dataset).distinct(), "touched")
            staged = f"{self.path}__swap_{uuid.uuid4().hex}"
            old = self.read()
            rest = old.join(touched, old[self.dataset].eqNullSafe(touched[self.dataset]), "left_semi").where(~F.coalesce(condition, F.lit(False)))
            names = [r[0] for r in touched.collect()]
            self._fs.mkdirs(self._path(f"{staged}/new"))
            self._write(rest, f"{staged}/new")
            self._swap(staged, names)
        return n

    def delete_dataset(self, dataset: str) -> int:
        return self.delete(F.col(self.dataset) == dataset)

    def delete_by_category(self, category: str, column: str = "primary_issue") -> int:
        return self.delete(F.col(column) == category)

    def put(self, values: dict, schema: str, merge: bool = False) -> dict[str, int]:
        """One record."""
        return self.upsert(self.spark.createDataFrame([values], schema), merge=merge)

    def ensure(self, schema: str) -> bool:
        """An empty table with the columns of schema, unless there is one; whether it was made."""
        if self.exists():
            return False
        self.spark.createDataFrame([], schema).write.parquet(self.path)
        return True

    def mapping(self) -> dict[str, str]:
        return dict(self.read().dtypes)

    def stats(self, category: str = "primary_issue") -> DataFrame:
        """(kind, value, n): all documents, distinct datasets, and documents by category."""
        docs = self.read()
        whole = docs.agg(F.count("*").alias("t"), F.count_distinct(self.dataset).alias("d"))
        head = whole.selectExpr("inline(array(struct('documents' as kind, cast(null as string) as value, t as n), struct('datasets' as kind, cast(null as string) as value, d as n)))")
        return head.unionByName(docs.groupBy(F.col(category).cast("string").alias("value")).agg(F.count("*").alias("n")).selectExpr("'category' as kind", "value", "n"))

    def get(self, key: str) -> DataFrame:
        return self.read().where(F.col(self.key) == key).limit(1)

    def by_dataset(self, dataset: str, limit: int | None = None, skip: int = 0) -> DataFrame:
        """A page of a dataset in the order of the key; limit 0 or None: all."""
        page = self.read().where(F.col(self.dataset) == dataset).orderBy(self.key).offset(skip)
        return page.limit(limit) if limit else page

    def count(self, dataset: str | None = None) -> int:
        return (self.read() if dataset is None else self.read().where(F.col(self.dataset) == dataset)).count()

    def datasets(self) -> DataFrame:
        return self.read().select(self.dataset).distinct()

    def recreate(self) -> None:
        self._fs.delete(self._path(self.path), True)
