"""A document table plus the expression that yields each document's text.

The text is computed where it is used. A run that uses it twice, for linking
and for excerpts, writes it once (``staged``), so the expensive HTML -> text
rewrite never runs twice over a document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.operators.joins import checked_broadcast
from dossier.session import materialize
from dossier.sources.tables import spread


@dataclass(frozen=True)
class Corpus:
    df: DataFrame      # page_id, url and the raw column(s) ``text`` reads
    text: Column       # expression over ``df`` that yields the document text

    def texts(self) -> DataFrame:
        """(page_id, url, text) for every document. A narrow scan is spread
        over all cores first (``spread``), since every document is worked on."""
        return spread(self.df).select("page_id", "url", self.text.alias("text"))

    def staged(self) -> Corpus:
        """The same documents with their text written once, for a run that
        links and cuts excerpts: neither computes it again."""
        return Corpus(materialize(self.texts(), "texts"), F.col("text"))

    def text_for(self, pairs: DataFrame, on: str = "page_id",
                 rows_per_copy: int = 10_000) -> DataFrame:
        """Rows of ``pairs`` joined to their document's text.

        Only referenced documents are read past the scan (a map-side
        semi-join with the per-document fan-out table), and their text is
        computed once per document, not once per pair. A document that many
        pairs reference is copied ceil(pairs / rows_per_copy) times and its
        pairs are dealt over the copies by a hash of the whole pair row, so
        no (document, copy) group of the join holds more than about
        ``rows_per_copy`` pairs, even for a document referenced by a third
        of all rows."""
        fan = (pairs.groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
               .select(on, (F.floor((F.col("_n") - 1) / rows_per_copy) + 1).cast("int").alias("_f")))
        fan = checked_broadcast(fan)     # one row per referenced document
        docs = (self.df.join(fan, on)
                .select(on, "_f", self.text.alias("text"))
                .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_f") - 1)))
                .drop("_f"))
        salted = (pairs.join(fan, on)
                  .withColumn("_salt", F.pmod(F.xxhash64(*pairs.columns), F.col("_f")).cast("int"))
                  .drop("_f"))
        return salted.join(docs, [on, "_salt"]).select(*pairs.columns, "text")


def as_corpus(c) -> Corpus:
    """Accept a Corpus or a plain (page_id, url, text) DataFrame."""
    return c if isinstance(c, Corpus) else Corpus(c, F.col("text"))
