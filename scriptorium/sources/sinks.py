"""Writers: nested JSON documents, one folder per slug, batches and reports (SNK1, SNK4, SNK9 to SNK11, SNK13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import xml_escape
from scriptorium.operators.relational import numbered


def nested_documents(articles: DataFrame) -> DataFrame:
    """(slug, document): one JSON document for each slug, articles in order, null fields left out."""
    article = F.struct("seq", *[c for c in articles.columns if c not in ("slug", "seminar_title", "year", "seq", "problem")])
    grouped = articles.where("problem is null").groupBy("slug").agg(F.first("seminar_title").alias("title"), F.first("year").alias("year"), F.array_sort(F.collect_list(article)).alias("articles"))
    return grouped.select("slug", F.to_json(F.struct("slug", "title", "year", "articles")).alias("document"))


def write_documents(documents: DataFrame, folder: str) -> None:
    """A folder for each slug."""
    documents.write.partitionBy("slug").mode("overwrite").text(folder)


def snapshot(df: DataFrame, folder: str, by: str | None = None) -> None:
    """A full copy as Parquet, partitioned if asked; the table at the folder is replaced (DML1)."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(folder)


def report(df: DataFrame, folder: str) -> None:
    """A report as JSON lines, replaced each time (SNK10)."""
    df.write.mode("overwrite").json(folder)


def report_lines(counts: DataFrame, name: str, n: str) -> DataFrame:
    """(line): ``name: n of total``, the total being that of all rows (SNK13)."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).cast("string")).scalar()
    return counts.select(F.concat_ws("", F.coalesce(F.col(name), F.lit("-")), F.lit(": "), F.col(n).cast("string"), F.lit(" of "), total).alias("line"))



def edition_xml(articles: DataFrame, edition: str, order: str, size: int) -> DataFrame:
    """(edition, batch, document): the articles of an edition in order, so many in a document, authors nested (SNK4).

    An edition of any size is numbered and written by many tasks, a document by one. articles has title and authors, an array of structs (given, family); the first author is the contact.
    """
    element = lambda tag, c: F.concat(F.lit(f"<{tag}>"), xml_escape(F.coalesce(c, F.lit(""))), F.lit(f"</{tag}>"))

    def author(a: Column, i: Column) -> Column:
        contact = F.when(i == 0, ' primary="true"').otherwise("")
        return F.concat(F.lit('<author seq="'), (i + 1).cast("string"), F.lit('"'), contact, F.lit(">"), element("given", a["given"]), element("family", a["family"]), F.lit("</author>"))

    people = F.array_join(F.transform(F.coalesce("authors", F.expr("array()")), author), "")
    one = F.concat(F.lit('<article no="'), F.col("_no").cast("string"), F.lit('">'), element("title", F.col("title")), people, F.lit("</article>"))
    lots = numbered(articles, [order], "_no", edition, split=True).select(edition, F.expr(f"cast((_no - 1) div {int(size)} as bigint)").alias("batch"), "_no", one.alias("_one")).groupBy(edition, "batch")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_no", "_one"))), lambda x: x["_one"]), "\n")
    return lots.agg(F.concat(F.lit("<articles>\n"), body, F.lit("\n</articles>")).alias("document"))
