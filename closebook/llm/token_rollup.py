"""Token counts as delta-maintained rollups.

A change is a signed count: an insert adds a document and its tokens, a
delete takes both away, a revision replaces one count by another. Totals by
source, language and tokenizer version are sums of changes, so a batch of
changes only adds its own signed totals; no document is counted again.

Commits are idempotent by batch id. A batch is a folder of summed changes; an
attempt writes its own folder and publishes it by renaming it to the batch's
name, which fails if that is there. So of several writers of one id, one after
the other or at once, one counts; what a failed attempt left is never read.

``compact`` folds the batches into a base, which holds their totals and their
ids, and then removes them, so totals read a base and the batches since, not
every batch that ever was. A base is published in the same way; a batch that it
holds is not added again by whoever still finds its folder.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm.common import drop_folder

KEYS = ("source", "lang", "tokenizer")
SCHEMA = ("source string, lang string, tokenizer string, n_docs long, n_tokens long, "
          "n_changes long")


def inserted(rows: DataFrame, tokens: Column | str, tokenizer: str) -> DataFrame:
    return _change(rows, tokens, tokenizer, 1)


def deleted(rows: DataFrame, tokens: Column | str, tokenizer: str) -> DataFrame:
    return _change(rows, tokens, tokenizer, -1)


def revised(rows: DataFrame, old: Column | str, new: Column | str, tokenizer: str) -> DataFrame:
    """A new count for documents that stay: the old one out, the new one in."""
    return deleted(rows, old, tokenizer).union(inserted(rows, new, tokenizer))


def _change(rows: DataFrame, tokens: Column | str, tokenizer: str, sign: int) -> DataFrame:
    count = F.col(tokens) if isinstance(tokens, str) else tokens
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"),
                       F.lit(sign).cast("long").alias("sign"),
                       F.coalesce(count, F.lit(0)).cast("long").alias("tokens"))


@dataclass
class TokenRollup:
    """Totals kept under ``path``, a folder that the whole cluster shares.

    Defined cases: null source or language is a group of its own; a null count
    is 0; repeated rows are changes of their own; an empty batch commits and
    adds nothing; groups whose documents are all gone keep a row of zeros in
    the batches and are left out of the totals; other columns of the changed
    rows are not read.
    """

    spark: SparkSession
    path: str

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if that id was committed before (nothing is done)."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        if batch_id in self.batches():
            return False
        sums = changes.groupBy(*KEYS).agg(
            F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("tokens")).alias("n_tokens"),
            F.count(F.lit(1)).alias("n_changes"))
        return self._publish(f"batch={batch_id}", lambda path: sums.write.parquet(path))

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return sorted({*self._held(self._base()), *self._names("batch=*")})

    def compact(self) -> bool:
        """Fold the base and all batches since into a new base; False if there is
        nothing to fold, or another run made that base. Batches are removed once
        the base that holds them is there."""
        old, fresh = self._base(), self._fresh()
        made = False
        if fresh:
            ids = [(i,) for i in (*self._held(old), *fresh)]
            sums = self._summed(self._rows(old, fresh))

            def write(path):
                sums.write.parquet(f"{path}/sums")
                self.spark.createDataFrame(ids, "id string").coalesce(1).write.parquet(f"{path}/ids")

            made = self._publish(f"base={(old or 0) + 1:08d}", write)
        # Also what an earlier run did not get to remove.
        for batch_id in set(self._held(self._base())) & set(self._names("batch=*")):
            drop_folder(self.spark, f"{self.path}/batch={batch_id}")
        return made

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens, n_changes) over all
        committed batches, without the groups that no document is left in."""
        return self._summed(self._rows(self._base(), self._fresh())).where(
            (F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def _names(self, pattern: str) -> list[str]:
        """What stands behind = in the folders of ``pattern``."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(re.search(r"/(?:batch|base)=([^/]+)", s.getPath().toString())[1]
                      for s in found or ())

    def _base(self) -> int | None:
        return max(map(int, self._names("base=*")), default=None)

    def _held(self, base: int | None) -> list[str]:
        """Batch ids of a base: one short string for each batch that ever was."""
        return [] if base is None else [r["id"] for r in self.spark.read.schema(
            "id string").parquet(f"{self.path}/base={base:08d}/ids").collect()]

    def _fresh(self) -> list[str]:
        return sorted(set(self._names("batch=*")) - set(self._held(self._base())))

    def _rows(self, base: int | None, batches: list[str]) -> DataFrame:
        paths = [f"{self.path}/batch={b}" for b in batches]
        paths += [] if base is None else [f"{self.path}/base={base:08d}/sums"]
        return (self.spark.read.schema(SCHEMA).parquet(*paths) if paths
                else self.spark.createDataFrame([], SCHEMA))

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEYS).agg(
            *[F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_changes")])

    def _publish(self, name: str, write) -> bool:
        """Write a folder and give it its name, unless another has it."""
        attempt = f"{self.path}/_attempt-{uuid.uuid4().hex}"
        write(attempt)
        jvm = self.spark._jvm
        hadoop, conf = jvm.org.apache.hadoop.fs, self.spark._jsc.hadoopConfiguration()
        target = hadoop.Path(f"{self.path}/{name}")
        files = hadoop.FileContext.getFileContext(target.toUri(), conf)
        never = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        never[0] = hadoop.Options.Rename.NONE
        try:
            files.rename(hadoop.Path(attempt), target, never)
        except Py4JJavaError as e:
            if not target.getFileSystem(conf).exists(target):
                raise RuntimeError(f"{name} could not be published") from e
            drop_folder(self.spark, attempt)
            return False
        return True
