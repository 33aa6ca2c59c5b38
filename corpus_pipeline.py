"""The corpus pipeline: stages of (name, function); each takes (spark, docs, sf_dir), works on all rows that its
predecessor kept, and returns the columns of ``docs`` (the last one: token counts and digests).

Between stages the rows are written as Parquet to the shared checkpoint folder and read again. Rows that repeat a
doc_id stand or fall together in the line and near-duplicate stages. An empty table passes through. Texts go to the
Python workers in small batches, as what the stages hold there adds up in an executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, langid, line_dedup, shingle_join
from quillspark.llm.queries import remainder, tokenized
from quillspark.session import cut_lineage, small_batches
from quillspark.sources.tables import read_table


class Shield:
    """The rows under other column names, so that no extra column clashes with what an operator appends."""

    def __init__(self, docs: DataFrame):
        self.names = {c: f"_in{i}_{c}" for i, c in enumerate(docs.columns)}
        self.rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in self.names.items()])
        self.id, self.text = self.names["doc_id"], self.names["text"]
        small_batches(docs.sparkSession)

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{n}`").alias(c) for c, n in self.names.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents whose language is rejected go (no letter, or a calibrated confidence that nearly all
    rightly recognised documents exceed)."""
    s = Shield(docs)
    model = langid.fit(docs.where(remainder("doc_id", 3) != 1))
    return s.back(langid.predict(s.rows, s.text, model).where("not rejected"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: repeated lines go but for their first place, and documents that thereby lose their whole text;
    ``n_chars`` follows the text."""
    s = Shield(docs)
    out = line_dedup.dedup(s.rows, s.id, s.text).where(f"size(removed) = 0 or trim(BOTH ' \\n' FROM `{s.text}`) <> ''")
    if "n_chars" in s.names:
        n = s.names["n_chars"]
        kind = dict(s.rows.dtypes)[n]
        out = out.withColumn(n, F.when(F.size("removed") > 0, F.char_length(s.text).cast(kind)).otherwise(F.col(n)))
    return s.back(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join over shingles of five words at 0.8: one document of each group stays, its least id."""
    s = Shield(docs)
    found = shingle_join.find(s.rows, s.id, s.text, 5, 80)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(s.id)).distinct()
    return s.back(s.rows.where(f"`{s.id}` is not null").join(kept, s.id, "left_semi").unionByName(s.rows.where(f"`{s.id}` is null")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark window go."""
    s = Shield(docs)
    return s.back(decontaminate.remove_documents(s.rows, s.text, read_table(spark, sf_dir, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token counts and digests of ids and decoded bytes."""
    small_batches(spark)
    return tokenized(docs)


STAGES = [("language", language), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminated), ("byte_bpe", encoded)]

#: SQL can express neither the language model nor the merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
