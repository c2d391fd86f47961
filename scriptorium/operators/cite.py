"""Citation and exchange records over a normal record of an article; parts that are null are left out (SNK3, SNK7).

A record is a struct Column with id, title, subtitle, abstract, locale, pages, doi, isbn, url, page_url, keywords (array of strings), authors (array of structs
given, family, orcid, affiliation, email, bio, country), published (date), event, publisher, place, section.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.text import xml_escape
from scriptorium.operators.serialize import Field, Group, Many, joined
from scriptorium.operators import serialize

#: Name spaces of the exchange format.
NATIVE, INSTANCE = "http://pkp.sfu.ca", "http://www.w3.org/2001/XMLSchema-instance"
_SCHEMA = {"xsi:schemaLocation": f"{NATIVE} native.xsd"}


def bibtex(prefix: str, key: Column, fields: dict[str, Column]) -> Column:
    lines = [F.when(c.isNotNull(), F.concat(F.lit(f"  {name} = {{"), c.cast("string"), F.lit("}"))) for name, c in fields.items()]
    return F.concat(F.lit(f"@article{{{prefix}"), key.cast("string"), F.lit(",\n"), F.concat_ws(",\n", *lines), F.lit("\n}"))


def ris(fields: dict[str, Column], kind: str = "JOUR") -> Column:
    lines = [F.when(c.isNotNull(), F.concat(F.lit(f"{tag}  - "), c.cast("string"))) for tag, c in fields.items()]
    return F.concat_ws("\n", F.lit(f"TY  - {kind}"), *lines, F.lit("ER  - "))


def xml(element: str, key: Column, fields: dict[str, Column]) -> Column:
    parts = [F.when(c.isNotNull(), F.concat(F.lit(f"<{name}>"), xml_escape(c.cast("string")), F.lit(f"</{name}>"))) for name, c in fields.items()]
    return F.concat(F.lit(f'<{element} id="'), key.cast("string"), F.lit('">'), F.concat_ws("", *parts), F.lit(f"</{element}>"))


def _title(r: Column) -> Column:
    return F.concat_ws(": ", r["title"], F.nullif(r["subtitle"], F.lit("")))


def _date(r: Column, form: str) -> Column:
    return F.date_format(r["published"], form)


def _reversed(a: Column) -> Column:
    return F.concat_ws(", ", a["family"], a["given"])


def _orcid(a: Column) -> Column:
    return F.concat(F.lit("https://orcid.org/"), a["orcid"])


def _locale(r: Column) -> Column:
    return F.coalesce(r["locale"], F.lit("pt-BR"))


def csl(r: Column) -> list:
    """CSL-JSON of a conference paper."""
    day = F.array(F.array(*[F.date_part(F.lit(p), r["published"]).cast("int") for p in ("YEAR", "MONTH", "DAY")]))
    return [
        Field("id", r["id"]), Field("type", F.lit("paper-conference")), Field("title", _title(r)), Field("container-title", r["event"]), Field("event-title", r["event"]),
        Field("event-place", r["place"]), Field("publisher-place", r["place"]), Group("issued", [Field("date-parts", day)], when=r["published"].isNotNull()), Field("DOI", r["doi"]),
        Field("ISBN", r["isbn"]), Field("page", r["pages"]), Field("URL", r["url"]), Field("language", _locale(r)),
        Many("author", r["authors"], lambda a: [Field("family", a["family"]), Field("given", a["given"]), Field("ORCID", _orcid(a))]),
    ]


def json_ld(r: Column) -> list:
    """schema.org's ScholarlyArticle, within its book, within its event."""
    kind = lambda x: Field("@type", F.lit(x))
    firm = lambda name, value: Group(name, [kind("Organization"), Field("name", value)], when=value.isNotNull())
    event = Group("isPartOf", [kind("Event"), Field("name", r["event"]), Group("location", [kind("Place"), Field("name", r["place"])], when=r["place"].isNotNull()), Field("startDate", _date(r, "yyyy-MM-dd"))])
    return [
        Field("@context", F.lit("https://schema.org")), kind("ScholarlyArticle"), Field("name", _title(r)), Field("headline", _title(r)), Field("abstract", r["abstract"]),
        Field("datePublished", _date(r, "yyyy-MM-dd")), Field("inLanguage", _locale(r)),
        Group("identifier", [kind("PropertyValue"), Field("propertyID", F.lit("DOI")), Field("value", r["doi"])], when=r["doi"].isNotNull()),
        Field("sameAs", F.concat(F.lit("https://doi.org/"), r["doi"])),
        Many("author", r["authors"], lambda a: [kind("Person"), Field("givenName", a["given"]), Field("familyName", a["family"]), Field("sameAs", _orcid(a)), firm("affiliation", a["affiliation"])]),
        Many("keywords", r["keywords"], lambda k: k),
        Group("isPartOf", [kind("Book"), Field("name", r["event"]), Field("isbn", r["isbn"]), firm("publisher", r["publisher"]), event]), firm("publisher", r["publisher"]),
    ]


def _bounds(r: Column) -> list:
    parts = F.split(r["pages"], "-")
    two = F.size(parts) == 2
    return [Field("citation_firstpage", F.when(two, F.get(parts, F.lit(0)))), Field("citation_lastpage", F.when(two, F.get(parts, F.lit(1))))]


def highwire(r: Column, most: int = 500) -> list:
    """The tags that scholarly search reads."""
    return [
        Field("citation_title", _title(r)),
        Many("author", r["authors"], lambda a: [Field("citation_author", _reversed(a)), Field("citation_author_orcid", _orcid(a)), Field("citation_author_institution", a["affiliation"])]),
        Field("citation_publication_date", _date(r, "yyyy/MM/dd")), Field("citation_conference_title", r["event"]), Field("citation_publisher", r["publisher"]), Field("citation_isbn", r["isbn"]),
        Field("citation_doi", r["doi"]), Field("citation_pdf_url", r["url"]), Field("citation_abstract", F.left(r["abstract"], F.lit(most))), Field("citation_language", _locale(r)), *_bounds(r),
    ]


def dublin_core(r: Column, most: int = 500) -> list:
    return [
        Field("DC.title", _title(r)), Many("DC.creator", r["authors"], _reversed), Many("DC.subject", r["keywords"], lambda k: k), Field("DC.description", F.left(r["abstract"], F.lit(most))),
        Field("DC.publisher", r["publisher"]), Field("DC.date", _date(r, "yyyy-MM-dd")), Field("DC.type", F.lit("ConferencePaper")), Field("DC.format", F.lit("text/html")),
        Field("DC.language", _locale(r)), Field("DC.identifier", r["page_url"]), Field("DC.identifier", F.concat(F.lit("doi:"), r["doi"])),
    ]


def meta_tags(parts: list) -> Column:
    """One meta element a line."""
    attribute = lambda c: F.replace(xml_escape(c), F.lit('"'), F.lit("&quot;"))
    return joined(parts, lambda name, value: F.concat(F.lit('<meta name="'), name, F.lit('" content="'), attribute(value), F.lit('">')), "\n")


def coins(r: Column) -> Column:
    """The OpenURL of an article, as the title of a span."""
    said = [
        Field("ctx_ver", F.lit("Z39.88-2004")), Field("rft_val_fmt", F.lit("info:ofi/fmt:kev:mtx:book")), Field("rft.genre", F.lit("conference")), Field("rft.atitle", _title(r)),
        Field("rft.btitle", r["event"]), Field("rft.date", _date(r, "yyyy")), Many("rft.au", r["authors"], _reversed), Field("rft_id", F.concat(F.lit("info:doi/"), r["doi"])),
        Field("rft.isbn", r["isbn"]), Field("rft.pages", r["pages"]), Field("rft.pub", r["publisher"]), Field("rft.place", r["place"]),
    ]
    return joined(said, lambda name, value: F.concat(name, F.lit("="), F.url_encode(value)), "&amp;")


def ris_record(r: Column) -> Column:
    """A conference paper in RIS, an author and a keyword a line."""
    said = [
        Field("TY", F.lit("CPAPER")), Many("AU", r["authors"], _reversed), Field("TI", _title(r)), Field("T2", r["event"]), Field("PY", _date(r, "yyyy")), Field("DO", r["doi"]), Field("SN", r["isbn"]),
        Field("SP", r["pages"]), Field("PB", r["publisher"]), Field("CY", r["place"]), Field("AB", r["abstract"]), Many("KW", r["keywords"], lambda k: k), Field("UR", r["url"]), Field("LA", _locale(r)), Field("ER", F.lit("")),
    ]
    return joined(said, lambda name, value: F.concat(name, F.lit("  - "), value), "\n")


def bibtex_record(r: Column) -> Column:
    """An inproceedings entry; authors are joined by `` and ``."""
    people = F.array_join(F.transform(r["authors"], _reversed), " and ")
    said = [
        Field("author", F.when(F.size(r["authors"]) > 0, people)), Field("title", _title(r)), Field("booktitle", r["event"]), Field("year", _date(r, "yyyy")), Field("publisher", r["publisher"]),
        Field("address", r["place"]), Field("pages", F.replace(r["pages"], F.lit("-"), F.lit("--"))), Field("doi", r["doi"]), Field("isbn", r["isbn"]), Field("url", r["url"]),
    ]
    return F.concat(F.lit("@inproceedings{"), r["id"], F.lit(",\n"), joined(said, lambda name, value: F.concat(F.lit("  "), name, F.lit(" = {"), value, F.lit("}")), ",\n"), F.lit("\n}"))


def signposts(r: Column) -> Column:
    """Link headers of a landing page: identifier, authors, the file, its kind."""
    link = lambda target, rel: F.concat(F.lit("<"), target, F.lit(f'>; rel="{rel}"'))
    people = F.transform(F.filter(r["authors"], lambda a: a["orcid"].isNotNull()), lambda a: link(_orcid(a), "author"))
    kind = F.lit('<https://schema.org/ScholarlyArticle>; rel="type"')
    return F.array_join(F.concat(F.array(link(F.concat(F.lit("https://doi.org/"), r["doi"]), "cite-as")), F.coalesce(people, F.array().cast("array<string>")), F.array(link(r["url"], "item"), kind)), ", ")


def native_article(a: Column, locale: str = "pt_BR") -> list:
    """An article (a record, with its number ``no`` in the issue) in the exchange format."""
    own = {"locale": locale}
    inner = lambda value: Field("id", value, {"type": "internal", "advice": "ignore"})
    day = _date(a, "yyyy-MM-dd")
    person = lambda p: [
        Field("givenname", p["given"], own), Field("familyname", p["family"], own), Field("affiliation", p["affiliation"], own), Field("country", F.coalesce(p["country"], F.lit("BR"))), Field("email", p["email"]),
        Field("orcid", _orcid(p)), Field("biography", p["bio"], own),
    ]
    publication = Group("publication", [
        inner(a["no"]), Field("title", a["title"], own), Field("subtitle", F.nullif(a["subtitle"], F.lit("")), own), Field("abstract", a["abstract"], own),
        Group("keywords", [Many("keyword", a["keywords"], lambda k: k)], own, F.size(a["keywords"]) > 0), Group("authors", [Many("author", a["authors"], person)], {}, F.size(a["authors"]) > 0), Field("pages", a["pages"]),
    ], {"xmlns:xsi": INSTANCE, **own, "version": "1", "status": "3", "url_path": "", "seq": a["no"] - 1, "date_published": day, "section_ref": a["section"], "access_status": "0", **_SCHEMA})
    return [inner(a["id"]), publication]


def written_article(a: Column, locale: str = "pt_BR") -> Column:
    """The element of an article (a record with its number ``no`` in the issue) as XML."""
    attrs = {"xmlns:xsi": INSTANCE, "locale": locale, "date_submitted": _date(a, "yyyy-MM-dd"), "status": "3", "submission_progress": "0", "current_publication_id": a["no"], "stage": "production"}
    return serialize.xml(Group("article", native_article(a, locale), attrs))


def native_issue(slug: Column, title: Column, year: Column, number: Column, published: Column, sections: Column, articles: Column, locale: str = "pt_BR") -> Column:
    """An issue with its sections (array of strings) and articles (their elements as XML, in order) as XML; one of a single article is the same with one."""
    own = {"locale": locale}
    day = F.date_format(published, "yyyy-MM-dd")
    head = {"xmlns": NATIVE, "xmlns:xsi": INSTANCE, "published": "1", "current": "0", "access_status": "1", "url_path": slug, **_SCHEMA}
    return serialize.xml(Group("issue", [
        Field("id", slug, {"type": "internal", "advice": "ignore"}), Group("issue_identification", [Field("volume", number), Field("number", number), Field("year", year), Field("title", title, own)]),
        Field("date_published", day), Field("last_modified", day), Group("sections", [Many("section", sections, lambda s: [Field("abbrev", s, own), Field("title", s, own)], {"ref": lambda s: s})]),
        Group("articles", [serialize.Written(articles)]),
    ], head))
