"""Pluggable enrichment: a user model applied with ``mapInPandas`` over Arrow
batches; the model is built once per partition. The default enrichment,
extractive summary and TF-IDF tags, is part of the enrich plan.

:class:`ModelResults` keeps answers in a log, keyed by article and content:
what has been answered is never asked again, whichever run asks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import split_tags
from newsloom.session import cut_lineage, task_parallelism

MODEL_OUTPUT = "id string, summary string, tag_text string"

# A model maker returns a function from a batch (pandas frame with ``id`` and
# ``text``) to a frame with ``id, summary, tag_text``.
ModelMaker = Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]


def model_enrichment(df: DataFrame, make_model: ModelMaker, id_col: str = "id",
                     text_col: str = "text") -> DataFrame:
    """``(id, summary, tags)`` from a user model. A row the model fails on
    (exception for the batch row, or an empty summary) gets a NULL summary
    and is later skipped, staying pending."""
    return answered(model_answers(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), make_model))


def answered(answers: DataFrame) -> DataFrame:
    return answers.select("id", F.nullif(F.col("summary"), F.lit("")).alias("summary"),
                          F.coalesce(split_tags(F.col("tag_text")), F.array().cast("array<string>")).alias("tags"))


def model_answers(asked: DataFrame, make_model: ModelMaker, carry: tuple[str, ...] = ()) -> DataFrame:
    """The model's raw answers to ``(id, text)``; ``carry``: more string
    columns of ``asked`` to hand on, looked up by id."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for pdf in batches:
            try:
                out = model(pdf[["id", "text"]])
                out = out[["id", "summary", "tag_text"]]
            except Exception:
                rows = []
                for rid, txt in zip(pdf["id"], pdf["text"]):
                    try:
                        one = model(pd.DataFrame({"id": [rid], "text": [txt]}))
                        rows.append(one[["id", "summary", "tag_text"]].iloc[0].tolist())
                    except Exception:
                        rows.append([rid, None, None])
                out = pd.DataFrame(rows, columns=["id", "summary", "tag_text"])
            for name in carry:
                out = out.assign(**{name: out["id"].map(dict(zip(pdf["id"], pdf[name])))})
            yield out

    return asked.mapInPandas(run, MODEL_OUTPUT + "".join(f", {name} string" for name in carry))


class ModelResults:
    """Answers of a model, appended as they come. ``name``: the log's table
    in the session catalog; ``path`` for a folder outside the warehouse. An
    article whose text changed is asked again; an answer without summary is a
    failure and is not kept."""

    def __init__(self, spark, name: str, path: str | None = None):
        self.spark, self.table = spark, name
        if not spark.catalog.tableExists(name):
            writer = spark.createDataFrame([], f"{MODEL_OUTPUT}, content_hash string").write
            (writer.option("path", path) if path else writer).saveAsTable(name)

    def _read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def complete(self, asked: DataFrame, make_model: ModelMaker, rows_at_a_time: int = 10_000) -> DataFrame:
        """``(id, summary, tags)`` for ``asked`` (``id, text``; one row an
        id, written down). Unanswered rows go to the model in batches of about
        ``rows_at_a_time``; each batch is one append, so a lost executor costs
        the calls of its unfinished tasks and a stopped run those of its last
        batch. The number of batches reaches the driver."""
        keyed = asked.select("id", "text", F.sha2("text", 256).alias("content_hash"))
        todo = cut_lineage(keyed.join(self._read().select("id", "content_hash"), ["id", "content_hash"], "left_anti"))
        n = todo.count()
        batches = -(-n // rows_at_a_time)
        part = F.pmod(F.xxhash64("id"), F.lit(max(1, batches)))
        for b in range(batches):
            some = todo.filter(part == b).repartition(max(1, task_parallelism(self.spark)))
            answers = model_answers(some, make_model, ("content_hash",)).filter("summary <> ''")
            answers.write.mode("append").insertInto(self.table)
        found = (keyed.select("id", "content_hash").join(self._read(), ["id", "content_hash"])
                 .groupBy("id").agg(F.min(F.struct("summary", "tag_text")).alias("a")))
        return cut_lineage(answered(found.select("id", "a.summary", "a.tag_text")))
