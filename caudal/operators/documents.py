"""Nested project records to flat tables, and raw project pages to nested records."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions import markup as M
from caudal.functions import tagstack as G
from caudal.functions.time import iso_day


# The fields of a project record that each flat table is made of.
TABLE_FIELDS = {
    "laws": ("id", "date", "summary", "law_text"),
    "signers": ("id", "signers"),
    "senateCommissions": ("id", "scommissions"),
    "deputyCommissions": ("id", "dcommissions"),
    "results": ("id", "results"),
}


def flat_table(projects: DataFrame, name: str) -> DataFrame:
    """One of the flat tables; rows of empty or missing arrays vanish from the child tables."""
    if name == "laws":
        return projects.select(*TABLE_FIELDS[name])
    if name == "signers":
        return projects.select("id", F.inline("signers")).select("id", "congressman", "district", "party")
    if name == "results":
        return projects.select("id", F.inline("results")).select("id", "chamber", "result", "date")
    return projects.select("id", F.explode(TABLE_FIELDS[name][1]).alias("commission"))


def normalise(projects: DataFrame) -> dict[str, DataFrame]:
    """Five flat tables by name."""
    return {name: flat_table(projects, name) for name in TABLE_FIELDS}


def _section(page: Column, element_id: str) -> Column:
    """Markup from the element with this id up to the next element with an id of the page's own sections.

    A page without the element has an empty section.
    """
    opening = rf"""(?i)\bid\s*+=\s*+["']?{element_id}["']?[^>]*+>"""
    rest = F.coalesce(F.try_element_at(F.split(page, opening, 2), F.lit(2)), F.lit(""))
    return F.element_at(F.split(rest, r"""(?i)<\w++[^>]*?\bid\s*+=\s*+["']?proyectos""", 2), 1)


# Labels of the parts of a project's course.
DEPUTIES_LABEL = " Giro a comisiones en Diputados "
SENATE_LABEL = " Giro a comisiones en Senado "
COURSE_LABEL = " Trámite "

_PARTS = (
    "head array<string>, law_text array<string>, signers array<array<string>>, dcommissions array<string>, "
    "scommissions array<string>, results array<array<string>>"
)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the sections, from the stack of open elements; not decoded."""
    kinds = (pa.list_(pa.string()), pa.list_(pa.list_(pa.string())))
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            laws = [G.law_texts(x) for x in part["text"].to_pylist()]
            signers = [[row for row in G.signer_rows(x) if len(row) == 3] for x in part["signers"].to_pylist()]
            courses = [G.course_parts(x, DEPUTIES_LABEL, SENATE_LABEL, COURSE_LABEL) for x in part["course"].to_pylist()]
            deputies, senate, rows = zip(*courses, strict=True)
            results = [[row for row in x if len(row) == 4] for x in rows]
            columns = [pa.array(x, kinds[deep]) for x, deep in ((laws, 0), (signers, 1), (deputies, 0), (senate, 0), (results, 1))]
            yield pa.RecordBatch.from_arrays(
                [part["head"].cast(kinds[0]), *columns], ["head", "law_text", "signers", "dcommissions", "scommissions", "results"]
            )


def project_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """Project records from pages of the law-project layout.

    Pages of another kind, and pages whose heading does not hold the three texts
    (id, summary, date), give no row. Rows of the signers' table that do not have three
    texts and rows of the results' table that do not have four are left out. Elements may hold others of their
    kind; what the sections hold is found by a stack of open elements.
    """
    class_ = r"""\bclass\s*+=\s*+["'][^"']*"""
    container = rf"(?i)<div\b(?=[^>]*{class_}\bcontainer\b)(?=[^>]*{class_}\btabGral\b)[^>]*+>"
    # explode of no or one value keeps the pages that fit, and keeps later filters from
    # repeating the work on the page
    page = pages.select(F.explode(F.slice(F.split(M.strip_hidden(F.col(html)), container, 2), 2, 1)).alias("page"))

    heading = F.regexp_extract("page", r"(?i)<h3\b[^>]*+>([^<]++)", 1)
    laws = page.withColumn("heading", heading).where(
        f"element_at(split({M.strip(M.collapse(M.decode('lower(heading)')))}, ' '), -1) = 'ley'"
    )

    # the heading stands in a div, beside the three texts and before any further div
    any_div = r"(?i)</?div\b[^>]*+>"
    around = F.split("page", r"(?i)<h3\b", 2)
    before = F.element_at(F.split(around[0], any_div), -1)
    rest = F.try_element_at(F.split(F.get(around, F.lit(1)), r"(?i)</h3\s*+>", 2), F.lit(2))
    after = F.element_at(F.split(rest, any_div, 2), 1)
    texts = F.filter(
        F.concat(M.text_nodes(before), M.text_nodes(after)), lambda t: F.regexp_like(t, F.lit(r"[^ \t\r\n]"))
    )
    parts = laws.select(
        F.explode(F.filter(F.array(texts), lambda t: F.size(t) == 3)).alias("head"), "page"
    ).select(
        "head",
        _section(F.col("page"), "proyectosTexto").alias("text"),
        _section(F.col("page"), "proyectosFirmantes").alias("signers"),
        _section(F.col("page"), "proyectosTramite").alias("course"),
    )

    raw = parts.mapInArrow(_parts, _PARTS).withColumn(
        "law_text", F.array_join(F.transform("law_text", lambda t: F.concat(F.lit(" "), t)), "")
    )

    decoded, stripped = M.decode("t"), M.strip(M.decode("t"))
    clean = raw.select(
        F.expr(f"transform(head, t -> {stripped})").alias("head"),
        F.expr(M.collapse(M.decode("law_text"))).alias("law_text"),
        F.expr(f"transform(signers, r -> transform(r, t -> {stripped}))").alias("signers"),
        F.expr(f"coalesce(transform(dcommissions, t -> {decoded}), array())").alias("dcommissions"),
        F.expr(f"coalesce(transform(scommissions, t -> {decoded}), array())").alias("scommissions"),
        F.expr(f"coalesce(transform(results, r -> transform(r, t -> {decoded})), array())").alias("results"),
    )
    return clean.select(
        F.col("head")[0].alias("id"),
        F.col("head")[1].alias("summary"),
        iso_day(F.col("head")[2]).alias("date"),
        "law_text",
        F.expr(
            "transform(signers, r -> named_struct('congressman', r[0], 'district', r[1], 'party', r[2]))"
        ).alias("signers"),
        "dcommissions",
        "scommissions",
        F.transform(
            "results",
            lambda r: F.struct(r[0].alias("chamber"), r[3].alias("result"), iso_day(F.trim(r[2])).alias("date")),
        ).alias("results"),
    )


def page_records(pages: DataFrame, html: str = "html", *keep: str) -> DataFrame:
    """Title, first heading, number of links and text of any page, by the same means."""
    shown = pages.select(*keep, M.strip_hidden(F.col(html)).alias("shown"))
    raw = shown.select(
        *keep,
        F.regexp_extract("shown", r"(?i)<title\b[^>]*+>([^<]*+)", 1).alias("title"),
        F.regexp_extract("shown", r"(?i)<h1\b[^>]*+>([^<]*+)", 1).alias("heading"),
        F.regexp_count("shown", F.lit(r"(?i)<a\b[^>]*?\bhref\s*+=")).cast("long").alias("links"),
        F.regexp_replace("shown", r"<[^>]*+>", " ").alias("body"),
    )
    return raw.select(
        *keep,
        "links",
        *[F.expr(f"trim({M.collapse(M.decode(name))})").alias(name) for name in ("title", "heading", "body")],
    )
