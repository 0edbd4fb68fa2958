"""Nested records and pages.

A line item serves as a nested project record, a document as the text of a project
page: both are written out as JSON or HTML first, so that the jobs read what they
were made for, over every row of the table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.session import work_dir
from caudal.sources import checked
from caudal.operators import documents as P
from caudal.sources.readers import parse_projects

catalog = Catalog()


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _projects(spark: SparkSession, sf_dir: str, fields: Iterable[str]) -> DataFrame:
    """Line items as JSON project records, read back with the project schema."""
    none = F.array().cast("array<string>")

    def signer(name: Column) -> Column:
        return F.struct(
            name.alias("congressman"), F.col("l_returnflag").alias("district"), F.col("l_linestatus").alias("party")
        )

    signers = F.array(
        signer(F.concat(F.lit("supplier "), _text("l_suppkey"))), signer(F.concat(F.lit("part "), _text("l_partkey")))
    )
    result = F.struct(
        F.col("l_linestatus").alias("chamber"),
        F.col("l_returnflag").alias("result"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
    )
    record = F.struct(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("id"),
        F.concat(F.lit('flag "'), "l_returnflag", F.lit('"')).alias("summary"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("quantity "), F.col("l_quantity").cast("int").cast("string")).alias("law_text"),
        F.when(F.col("l_discount") > 0, signers).otherwise(F.array().cast(signers_type)).alias("signers"),
        F.array("l_returnflag", "l_linestatus").alias("dcommissions"),
        F.when(F.col("l_tax") > 0, F.array("l_linestatus")).otherwise(none).alias("scommissions"),
        F.when(F.col("l_returnflag") != "R", F.array(result)).alias("results"),
    )
    return parse_projects(table(spark, sf_dir, "lineitem").select(F.to_json(record).alias("value")), fields=fields)


signers_type = "array<struct<congressman:string,district:string,party:string>>"


def _add_normalise(name: str, target: str, sql: str) -> None:
    catalog.add(f"normalise_{name}", lambda spark, sf: P.flat_table(_projects(spark, sf, P.TABLE_FIELDS[target]), target), sql)


_ID = "l_orderkey || '-' || l_linenumber AS id"

_add_normalise(
    "laws",
    "laws",
    f"""SELECT {_ID}, strftime(l_shipdate, '%Y-%m-%d') AS date, 'flag "' || l_returnflag || '"' AS summary,
               'quantity ' || l_quantity::INTEGER AS law_text FROM lineitem""",
)
_add_normalise(
    "signers",
    "signers",
    f"""SELECT {_ID}, unnest(['supplier ' || l_suppkey, 'part ' || l_partkey]) AS congressman,
               l_returnflag AS district, l_linestatus AS party FROM lineitem WHERE l_discount > 0""",
)
_add_normalise(
    "senate_commissions",
    "senateCommissions",
    f"SELECT {_ID}, l_linestatus AS commission FROM lineitem WHERE l_tax > 0",
)
_add_normalise(
    "deputy_commissions",
    "deputyCommissions",
    f"SELECT {_ID}, unnest([l_returnflag, l_linestatus]) AS commission FROM lineitem",
)
_add_normalise(
    "results",
    "results",
    f"""SELECT {_ID}, l_linestatus AS chamber, l_returnflag AS result, strftime(l_shipdate, '%Y-%m-%d') AS date
        FROM lineitem WHERE l_returnflag <> 'R'""",
)


def _escaped(text: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("é", "&eacute;"), ("ñ", "&#241;"), ("ä", "&#xE4;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def _project_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as project pages: their lines are the divs of the law text; French ones are no laws.

    A text of many characters has a second signer, and one with an odd number of
    characters a Senate commission and a result.
    """
    lines = F.transform(
        F.split("text", "\n"), lambda line: F.concat(F.lit("<div class='p'>"), _escaped(line), F.lit("</div><p></p>\n"))
    )
    odd = F.col("n_chars") % 2 == 1

    def row(*cells: Column) -> Column:
        parts = [part for cell in cells for part in (F.lit("<td> "), cell, F.lit(" </td>"))]
        return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))

    def commission(chamber: str, name: Column) -> Column:
        return F.concat(
            F.lit(f"<div> Giro a comisiones en {chamber} </div><table><tr><th>C</th></tr><tr><td>"),
            name,
            F.lit("</td></tr></table>"),
        )

    signers = F.concat(
        F.lit("<tr><th>Firmante</th><th>Distrito</th><th>Bloque</th></tr>"),
        row(F.col("source"), F.col("lang"), F.lit("uno &amp; dos")),
        F.when(F.col("n_chars") > 400, row(F.concat(F.lit("co-"), "source"), F.col("lang"), F.lit("tres"))).otherwise(""),
        F.lit("<tr><td>sin distrito</td></tr>"),
    )
    result = F.concat(
        F.lit("<div> Tr&aacute;mite </div><table><tr><th>C</th></tr><tr><td>Senado</td><td>x</td><td> 03/02/2014 </td><td>"),
        F.upper("source"),
        F.lit("</td></tr><tr><td>Senado</td><td></td><td>03/02/2014</td><td>three texts</td></tr></table>"),
    )
    html = F.concat(
        F.lit("<html><head><script>var t='<div class=\"container tabGral\">';</script></head><body>"),
        F.lit('<div id="top">menu</div><div class="row container tabGral"><div><!-- <h3>no</h3> --><h3>Proyecto de '),
        F.when(F.col("lang") == "fr", "Resolución").otherwise("Ley"),
        F.lit("</h3> <b>Expediente:</b> "),
        _text("doc_id"),
        F.lit("-D-2014<br> <b>Sumario:</b> "),
        _escaped(F.col("source")),
        F.lit(" &quot;"),
        F.col("lang"),
        F.lit("&quot; <br><b>Fecha:</b> "),
        F.date_format(F.date_add(F.lit("2014-01-01").cast("date"), (F.col("n_chars") % 365).cast("int")), "dd/MM/yyyy"),
        F.lit(' </div><div id="proyectosTexto">'),
        F.array_join(lines, ""),
        F.lit("<div style='font-style:italic'>firma</div><p>fin</p><div>pie</div></div>"),
        F.lit('<div id="proyectosFirmantes"><table>'),
        signers,
        F.lit('</table></div><div id="proyectosTramite">'),
        commission("Diputados", F.concat(F.lit("Comisi&oacute;n "), "lang")),
        F.when(odd, commission("Senado", F.col("source"))).otherwise(""),
        F.when(odd, result).otherwise(""),
        F.lit('</div></div><div id="proyectosPie">pie</div></body></html>'),
    )
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars").select(html.alias("html"))


def _flat(records: DataFrame) -> DataFrame:
    """Records with their arrays written as text, for comparison."""
    return records.select(
        "id",
        "summary",
        "date",
        "law_text",
        F.array_join(
            F.transform("signers", lambda s: F.concat_ws(",", s["congressman"], s["district"], s["party"])), ";"
        ).alias("signers"),
        F.array_join("dcommissions", ";").alias("dcommissions"),
        F.array_join("scommissions", ";").alias("scommissions"),
        F.array_join(
            F.transform("results", lambda r: F.concat_ws(",", r["chamber"], r["result"], r["date"])), ";"
        ).alias("results"),
    )


catalog.add(
    "project_pages",
    lambda spark, sf: _flat(P.project_records(_project_pages(spark, sf))),
    r"""WITH texts AS (
      SELECT *, list_filter(string_split(text, chr(10)), lambda l: l <> '') AS ls FROM documents WHERE lang <> 'fr')
    SELECT doc_id || '-D-2014' AS id, source || ' "' || lang || '"' AS summary,
           strftime(DATE '2014-01-01' + (n_chars % 365)::INTEGER, '%Y-%m-%d') AS date,
           CASE WHEN len(ls) = 0 THEN '' ELSE regexp_replace(' ' || array_to_string(ls, ' '), '\s+', ' ', 'g') END AS law_text,
           source || ',' || lang || ',uno & dos'
             || CASE WHEN n_chars > 400 THEN ';co-' || source || ',' || lang || ',tres' ELSE '' END AS signers,
           'Comisión ' || lang AS dcommissions,
           CASE WHEN n_chars % 2 = 1 THEN source ELSE '' END AS scommissions,
           CASE WHEN n_chars % 2 = 1 THEN 'Senado,' || upper(source) || ',2014-02-03' ELSE '' END AS results
    FROM texts""",
)

catalog.add(
    "page_records",
    lambda spark, sf: P.page_records(table(spark, sf, "pages"), "html", "page_id"),
    r"""WITH shown AS (
      SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
               '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g') AS h FROM pages),
    cut AS (
      SELECT page_id, regexp_extract(h, '<title[^>]*>([^<]*)', 1) AS title, regexp_extract(h, '<h1[^>]*>([^<]*)', 1) AS heading,
             len(regexp_extract_all(h, '<a [^>]*href="'))::BIGINT AS links, regexp_replace(h, '<[^>]*>', ' ', 'g') AS body
      FROM shown)
    SELECT page_id, links,
           """
    + ",\n           ".join(
        rf"trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace({c}, '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'),"
        rf""" '&quot;', '"'), '&amp;', '&'), '[\s\x{{a0}}]+', ' ', 'g')) AS {c}"""
        for c in ("title", "heading", "body")
    )
    + " FROM cut",
)


def _project_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines in files, those in German broken off; the records and the lines that give none."""
    folder = work_dir(spark)
    whole = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("summary"), F.col("text").alias("law_text")))
    broken = F.when(F.col("lang") == "de", F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    table(spark, sf_dir, "documents").select("lang", whole.alias("line")).select(broken).write.text(f"{folder}/projects")
    read = checked.read_projects(spark, f"{folder}/projects")
    good = read.good.select("id", "summary", F.length("law_text").cast("long").alias("chars"), F.lit(True).alias("readable"))
    lost = read.bad.select(F.regexp_extract("line", '"id":"([0-9]+)"', 1).alias("id"), F.lit(None).cast("string").alias("summary"), F.lit(None).cast("long").alias("chars"), F.lit(False).alias("readable"))
    return good.unionByName(lost)


catalog.add(
    "project_files",
    _project_files,
    """SELECT doc_id::VARCHAR AS id, CASE WHEN lang = 'de' THEN NULL ELSE source END AS summary,
              CASE WHEN lang = 'de' THEN NULL ELSE length(text) END AS chars, lang <> 'de' AS readable FROM documents""",
)
