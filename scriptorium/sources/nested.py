"""Nested document files: three layouts of YAML or JSON, read to one canonical schema (SRC1, SRC2, SRC4, SRC13, PRJ1, PRJ2)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Portuguese names of fields, by the canonical name.
SYNONYMS = {
    "title": "titulo", "subtitle": "subtitulo", "section": "secao", "abstract": "resumo", "abstract_en": "resumo_en", "abstract_es": "resumo_es",
    "keywords": "palavras_chave", "keywords_en": "palavras_chave_en", "keywords_es": "palavras_chave_es", "references": "referencias",
    "file": "arquivo_pdf", "pages": "paginas", "pages_count": "paginas_total", "authors": "autores",
}
#: Articles that a task hands on at a time.
ROWS = 2000
_TEXT = ["title", "subtitle", "section", "locale", "pages", "file", "abstract", "abstract_en", "abstract_es", "doi"]
_LISTS = ["keywords", "keywords_en", "keywords_es", "references"]
_AUTHOR = ["givenname", "familyname", "email", "orcid", "affiliation", "bio", "country"]
SCHEMA = (
    "slug string, seminar_title string, year int, seq int, id string, "
    + ", ".join(f"`{c}` string" for c in _TEXT)
    + ", "
    + ", ".join(f"`{c}` array<string>" for c in _LISTS)
    + ", authors array<struct<"
    + ", ".join(f"{c}:string" for c in _AUTHOR)
    + ", primary_contact:boolean>>, problem string"
)


def _first(record: dict, name: str):
    """The field by its canonical name, else by its synonym; only null is skipped, not what is empty."""
    found = record.get(name)
    return found if found is not None else record.get(SYNONYMS.get(name, name))


def articles(data: dict, slug: str) -> Iterator[dict]:
    """Canonical articles of one file in any of the three layouts."""
    head = data.get("issue") or data
    event = data.get("evento") or {}
    slug = head.get("slug") or slug
    listed = data.get("articles") or data.get("artigos") or []
    for seq, record in enumerate(listed, 1):
        row = {c: None if _first(record, c) is None else str(_first(record, c)) for c in _TEXT}
        for c in _LISTS:
            found = _first(record, c)
            row[c] = None if found is None else [str(x) for x in (found if isinstance(found, list) else [found])]
        people = _first(record, "authors") or []
        row["authors"] = [{**{c: p.get(c) for c in _AUTHOR}, "primary_contact": bool(p.get("primary_contact"))} for p in people]
        year = head.get("year")
        yield {
            "slug": slug, "seminar_title": head.get("title") or event.get("titulo"), "year": int(year) if year is not None else None,
            "seq": seq, "id": record.get("id") or f"{slug}-{seq:03d}", **row, "problem": None,
        }


def read_articles(spark: SparkSession, folder: str, pattern: str = "*.y*ml", exclude: str | None = None) -> DataFrame:
    """One row for each article of the files under a folder; a file that can't be parsed gives one row with its problem.

    Files are read by Spark's own reader, so any store will do. PyYAML parses on
    the executors; JSON files need the standard library only.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")
    return parsed(files.where(~F.col("path").contains(exclude)) if exclude else files)


def parsed(files: DataFrame, as_json: bool = False) -> DataFrame:
    """The articles of files (path, content); all are JSON if so said, else those whose name ends in .json."""
    spark = files.sparkSession
    names = [f.name for f in spark.createDataFrame([], SCHEMA).schema.fields]

    def read(path: str, content: bytes) -> list[dict]:
        slug = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        try:
            text = content.decode("utf-8")
            if as_json or path.endswith(".json"):
                loaded = [json.loads(text)]
            else:
                import yaml

                loaded = list(yaml.safe_load_all(text))
            return [a for data in loaded if isinstance(data, dict) for a in articles(data, slug)]
        except Exception as problem:  # noqa: BLE001  a bad file must not end the job
            return [{"slug": slug, "problem": f"{type(problem).__name__}: {problem}"[:500]}]

    def frame(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame([{n: row.get(n) for n in names} for row in rows], columns=names).astype({"year": "Int32", "seq": "Int32"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[dict] = []
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows += read(path, content)
                if len(rows) >= ROWS:
                    yield frame(rows)
                    rows = []
        if rows:
            yield frame(rows)

    return files.mapInPandas(run, SCHEMA)


def canonical(df: DataFrame, default_locale: str = "pt-BR") -> DataFrame:
    """Articles under canonical names, whichever of the synonyms their columns have (PRJ1, PRJ2).

    Only null is skipped, so an empty text stays; lists become JSON text; empty pages become null.
    """
    kinds = dict(df.dtypes)
    text = lambda c: F.to_json(c) if kinds[c].startswith("array") else F.col(c).cast("string")

    def field(name: str):
        found = [text(c) for c in (name, SYNONYMS.get(name)) if c in kinds]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    fields = {c: field(c) for c in ["id", *_TEXT, *_LISTS]}
    fields["locale"] = F.coalesce(fields["locale"], F.lit(default_locale))
    fields["pages"] = F.nullif(fields["pages"], F.lit(""))
    return df.select(*[c.alias(n) for n, c in fields.items()])
