import json
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from caudal.functions import markup as M
from caudal.functions import tagstack as G
from caudal.operators.documents import page_records, project_records
from caudal.plans.corpus import flat_tables, run_extraction, run_normalise
from caudal.sources.readers import parse_projects
from tests.conftest import rows

PROJECTS = [
    {
        "id": "A", "summary": "sa", "date": "2014-01-01", "law_text": "ta",
        "signers": [{"congressman": "c1", "district": "d1", "party": "p1"}, {"congressman": "c2", "district": "d1", "party": "p2"}],
        "dcommissions": ["X", "Y"], "scommissions": ["Z"],
        "results": [{"chamber": "D", "result": "MEDIA SANCION", "date": "2014-02-01"}, {"chamber": "S", "result": "SANCIONADO", "date": "2014-03-01"}],
    },
    {
        "id": "B", "summary": "sb", "date": "2014-01-02", "law_text": "tb",
        "signers": [{"congressman": "c1", "district": "d1", "party": "p1"}],
        "dcommissions": ["X"], "scommissions": [], "results": [{"chamber": "D", "result": "RETIRADO", "date": "2014-04-01"}],
    },
    {"id": "C", "summary": "sc", "date": "2014-01-03", "law_text": "tc", "signers": [], "dcommissions": ["X"], "results": []},
]


def write_projects(path):
    path.write_text("\n".join(json.dumps(p) for p in PROJECTS) + "\n")
    return str(path)


def test_normalise(spark, tmp_path):
    run_normalise(spark, write_projects(tmp_path / "raw.json"), str(tmp_path / "out"))
    tables = flat_tables(spark, str(tmp_path / "out"))
    assert {name: t.count() for name, t in tables.items()} == {
        "laws": 3, "signers": 3, "deputyCommissions": 4, "senateCommissions": 1, "results": 3,
    }
    assert rows(tables["signers"])[1] == ("A", "c2", "d1", "p2")
    assert rows(tables["results"])[1] == ("A", "S", "SANCIONADO", "2014-03-01")
    assert tables["laws"].columns == ["id", "date", "summary", "law_text"]
    with pytest.raises(Exception, match="already exists"):
        run_normalise(spark, str(tmp_path / "raw.json"), str(tmp_path / "out"))


def test_json_in_a_column(spark):
    lines = spark.createDataFrame([(json.dumps(p),) for p in PROJECTS] + [("no json",)], "value string")
    got = parse_projects(lines)
    assert got.where(F.col("id").isNotNull()).count() == 3


PAGE = """<html><head><style>.container.tabGral {{}}</style></head><body><div class="menu"><h3>Menu ley</h3></div>
<div id="x" class='wide container  tabGral'>
 <div class="head">
  <h3>Proyecto de LEY</h3>
  <strong>Expediente</strong> 0001-D-2014
  <br> R&eacute;gimen &amp; fomento &lt;nuevo&gt; <br/>
  03/02/2014
 </div>
 <div id="proyectosTexto"><h4>Texto</h4>
  <div>Art. 1.- Uno
     y dos</div>
  <div style="font-style:italic">cursiva</div>
  <div>Art. 2.- <b>no</b> Tres</div><p>x</p>
  <div>despues</div>
 </div>
 <div id="proyectosFirmantes"><table><tr><th>F</th></tr>
  <tr><td> P&eacute;rez, A. </td><td>Salta</td><td class="b"> UCR </td></tr>
  <TR><TD>Díaz</TD><TD>Chaco</TD><TD>PJ</TD></TR>
  <tr><td>solo</td><td>dos</td></tr></table></div>
 <div id="proyectosTramite">{course}</div>
</div></body></html>"""

COURSE = """<div><span> Giro a comisiones en Diputados </span></div>
 <table><tr><td>Legislaci&oacute;n</td></tr><tr><td>Presupuesto</td></tr></table>
 <div> Tr&aacute;mite </div><table><tr><th>C</th></tr>
 <tr><td>Diputados</td><td>mov</td><td> 01/12/2014 </td><td>MEDIA SANCION</td></tr>
 <tr><td>Senado</td><td></td><td>01/12/2014</td><td>three texts</td></tr>
 <tr><td>Senado</td><td>mov</td><td>31/31/2014</td><td>SANCIONADO</td></tr></table>"""


def pages(spark, *html):
    return spark.createDataFrame([(h,) for h in html], "html string")


def test_project_page(spark):
    (record,) = project_records(pages(spark, PAGE.format(course=COURSE))).collect()
    assert (record.id, record.summary, record.date) == ("0001-D-2014", "Régimen & fomento <nuevo>", "2014-02-03")
    assert record.law_text == " Art. 1.- Uno y dos Art. 2.- Tres"
    assert [tuple(s) for s in record.signers] == [("Pérez, A.", "Salta", "UCR"), ("Díaz", "Chaco", "PJ")]
    assert record.dcommissions == ["Legislación", "Presupuesto"]
    assert record.scommissions == []
    assert [tuple(r) for r in record.results] == [
        ("Diputados", "MEDIA SANCION", "2014-12-01"),
        ("Senado", "SANCIONADO", None),
    ]


def test_pages_that_give_no_record(spark):
    good = PAGE.format(course="")
    others = [
        good.replace("Proyecto de LEY", "Proyecto de Ley de Resolución"),
        good.replace("<h3>Proyecto de LEY</h3>", ""),
        good.replace("03/02/2014", ""),
        good.replace("tabGral", "tab"),
        "",
    ]
    got = project_records(pages(spark, good, *others)).collect()
    assert len(got) == 1 and got[0].results == [] and got[0].dcommissions == []


def test_a_page_with_a_very_long_text(spark):
    long = " ".join(f"palabra{i}" for i in range(60000))
    html = PAGE.format(course=COURSE).replace("Uno", long).replace("cursiva", "<i>" * 20000)
    (record,) = project_records(pages(spark, html)).collect()
    assert long in record.law_text and len(record.results) == 2


def test_extraction_to_tables(spark, tmp_path):
    run_extraction(pages(spark, PAGE.format(course=COURSE)), str(tmp_path / "out"))
    assert {n: t.count() for n, t in flat_tables(spark, str(tmp_path / "out")).items()} == {
        "laws": 1, "signers": 2, "deputyCommissions": 2, "senateCommissions": 0, "results": 2,
    }


@pytest.mark.parametrize(
    "text, want",
    [
        ("a &amp;lt; b", "a &lt; b"),
        ("&#233;&#xE9;&#XE9;", "ééé"),
        ("&unknown; & && &;", "&unknown; & && &;"),
        ("&#0;&#55296;&#1114112;&#128512;", "&#0;&#55296;&#1114112;\U0001f600"),
        ("it&apos;s &quot;x&quot;&nbsp;", "it's \"x\"\xa0"),
        ("plain", "plain"),
        (None, None),
    ],
)
def test_entities(spark, text, want):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(F.expr(M.decode("t")).alias("t")).first().t == want


def test_any_page(spark):
    html = '<title> A &amp; B </title><script>"<h1>no</h1>"</script><h1>H</h1><p>x<a href="u">l</a>\n y</p><!-- <a href="v"> -->'
    assert rows(page_records(pages(spark, html))) == [(1, "A & B", "H", "A & B H x l y")]


@pytest.mark.parametrize("missing", ["proyectosTexto", "proyectosFirmantes", "proyectosTramite"])
def test_page_without_a_section_has_empty_parts(spark, missing):
    page = """<div class="container tabGral"><h3>PROYECTO DE LEY</h3>1-D-2015<br>Resumen<br>01/02/2015<div></div>
    <div id="proyectosTexto"><div>Art. 1.- Uno</div><p></p></div>
    <div id="proyectosFirmantes"><table><tr><td>A</td><td>B</td><td>C</td></tr></table></div>
    <div id="proyectosTramite"><div> Giro a comisiones en Senado </div><table><tr><td>S</td></tr></table></div></div>"""
    rows = project_records(spark.createDataFrame([(page.replace(missing, "otra"),)], "html string")).collect()
    assert len(rows) <= 1
    for row in rows:
        assert row["law_text"] is not None and row["signers"] is not None and row["results"] is not None


def test_entities_of_the_whole_standard_and_long_numbers(spark):
    texts = ["&hellip;&euml;&mdash;", "&#00000233;&#x000000E9;", "&#0;&nosuch;&amp;", "&fjlig;"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.selectExpr(M.decode("t")).collect()] == ["…ë—", "éé", "&#0;&nosuch;&", "fj"]


# nested markup


class Plain(HTMLParser):
    """A tree of lists: [tag, attributes, children], texts as strings."""

    def __init__(self, markup):
        super().__init__(convert_charrefs=False)
        self.root = ["", {}, []]
        self.open = [self.root]
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), []]
        self.open[-1][2].append(node)
        if tag != "br":
            self.open.append(node)

    def handle_endtag(self, tag):
        assert self.open.pop()[0] == tag

    def handle_data(self, data):
        inside = self.open[-1][2]
        if inside and isinstance(inside[-1], str):
            inside[-1] += data
        else:
            inside.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")


def below(node, tag):
    for child in node[2]:
        if not isinstance(child, str):
            if child[0] == tag:
                yield child
            yield from below(child, tag)


def direct(node, tag):
    """Texts directly in elements of a tag, in the order of the page."""
    for child in node[2]:
        if isinstance(child, str):
            if node[0] == tag:
                yield child
        else:
            yield from direct(child, tag)


def plain_laws(node, own=False):
    for i, child in enumerate(node[2]):
        if isinstance(child, str):
            if own:
                yield child
        else:
            follows = any(not isinstance(c, str) and c[0] == "p" for c in node[2][i + 1 :])
            yield from plain_laws(child, child[0] == "div" and follows and "font-style:italic" not in child[1].get("style", ""))


def plain_rows(node):
    cells = lambda row: [t for c in row[2] if not isinstance(c, str) for t in direct(c, "td")]
    return [cells(row) for row in below(node, "tr") if any(not isinstance(c, str) and c[0] == "td" for c in row[2])]


def random_markup(rng, depth, inside="div"):
    out = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.choice(["text", "text", "div", "b", "table", "br", "p"]) if depth else "text"
        if inside == "p" and kind in ("div", "table", "p"):
            kind = "b"
        if kind == "text":
            if not out or out[-1].endswith(">"):
                out.append(rng.choice([" uno ", "dos", " Tr&aacute;mite ", "x &amp; y"]))
        elif kind == "br":
            out.append("<br>")
        elif kind == "table":
            cell = lambda: f"<td>{random_markup(rng, depth - 1, 'p' if rng.random() < 0.6 else 'td')}</td>"
            out.append("<table>" + "".join("<tr>" + "".join(rng.choice([cell, lambda: "<th>h</th>"])() for _ in range(rng.randint(0, 4))) + "</tr>" for _ in range(rng.randint(0, 3))) + "</table>")
        else:
            style = rng.choice(["", "", ' style="font-style:italic"'])
            out.append(f"<{kind}{style}>{random_markup(rng, depth - 1, 'p' if kind == 'p' or inside == 'p' else kind)}</{kind}>")
    return "".join(out)


def test_the_stack_reads_what_a_parser_reads():
    rng = random.Random(7)
    seen = 0
    for _ in range(1500):
        markup = random_markup(rng, 5)
        root = Plain(markup).root
        laws, rows_ = list(plain_laws(root)), plain_rows(root)
        assert G.law_texts(markup) == laws
        assert G.signer_rows(markup) == rows_
        labelled = lambda node: any("Tr&aacute;mite" in t for t in all_texts(node))
        tables = [c for parent in [root, *everything(root)] for i, c in enumerate(parent[2]) if not isinstance(c, str) and c[0] == "table"
                  and any(not isinstance(b, str) and b[0] == "div" and labelled(b) for b in parent[2][:i])]
        chosen = [r for r in below(root, "tr") if any(r is x for t in tables for x in below(t, "tr"))]
        want = [list(t for c in r[2] if not isinstance(c, str) for t in direct(c, "td")) for r in chosen if any(not isinstance(c, str) and c[0] == "td" for c in r[2])]
        assert G.course_parts(markup, "-", "-", " Trámite ")[2] == want
        seen += bool(laws) + bool(rows_) + bool(want)
    assert seen > 300


def everything(node):
    for child in node[2]:
        if not isinstance(child, str):
            yield child
            yield from everything(child)


def all_texts(node):
    return [t for x in [node, *everything(node)] for t in x[2] if isinstance(t, str)]


def test_a_page_with_nested_elements(spark):
    html = PAGE.format(course=COURSE).replace("Art. 1.- Uno", "<div>dentro</div> Art. 1.- Uno")
    html = html.replace("<td>Salta</td>", "<td>Salta<table><tr><th>x</th></tr></table></td>")
    (record,) = project_records(pages(spark, html)).collect()
    assert record.law_text == "  Art. 1.- Uno y dos Art. 2.- Tres"[1:]
    assert [tuple(s) for s in record.signers] == [("Pérez, A.", "Salta", "UCR"), ("Díaz", "Chaco", "PJ")]


def test_tags_left_open_and_tags_too_many():
    assert G.signer_rows("<table><tr><td>a<td>b</tr><tr><td>c</table></b>") == [["a", "b"], ["c"]]
    assert G.law_texts("<div>a</div></span><p>x</p></div><div>outside</div><p>") == ["a"]
    assert G.law_texts("<div>outer <div>inner</div> tail</div><p>") == ["outer ", " tail"]
    assert G.law_texts("") == [] and G.signer_rows("a < b <") == []
