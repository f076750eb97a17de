"""Nested structure, grids of spanned cells and JSON arguments; expected values are worked out by hand or by a plain search."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.functions import arguments as A
from docweave.operators import package_edit as P
from docweave.sources import package, structure, views
from tests.test_packages import SECTION

MEMBER = "doc string, seq int, entry string, method int, bytes binary"


def _members(spark, sections):
    rows = [(d, i, f"Contents/section{i}.xml", 8, bytearray(x, "utf-8")) for d, xs in sections.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, MEMBER)


def _cell(text, down=1, wide=1, address=""):
    return f'<hp:tc><hp:p><hp:run><hp:t>{text}</hp:t></hp:run></hp:p>{address}<hp:cellSpan rowSpan="{down}" colSpan="{wide}"/></hp:tc>'


def test_page_definition(spark):
    deep = '<hs:sec><hp:p><hp:secPr a="1">' + "<hp:x>" * 300 + "t" + "</hp:x>" * 300 + "</hp:secPr><hp:secPr second='2'/></hp:p></hs:sec>"
    odd = "<hs:sec><hp:secPr q='it\"s' e=\"&#44032;\\\"><![CDATA[a<b]]><!-- no --> <hp:y/>\n</hp:secPr></hs:sec>"
    got = {(r.doc, r.section): json.loads(r.json) for r in structure.page_definitions(views.body_tokens(_members(spark, {"deep": [deep, odd], "one": [SECTION], "none": ["<hs:sec/>", ""]}))).collect()}
    assert set(got) == {("deep", 0), ("deep", 1), ("one", 0)}
    level, x = 0, got["deep", 0]
    assert x["attributes"] == {"a": "1"}
    while isinstance(x["children"][0], dict):
        x, level = x["children"][0], level + 1
    assert level == 300 and x["children"] == ["t"]
    assert got["deep", 1] == {"name": "hp:secPr", "attributes": {"q": 'it"s', "e": "가\\"}, "children": ["a<b", {"name": "hp:y", "attributes": {}, "children": []}]}
    assert got["one", 0]["children"] == [{"name": "hp:pagePr", "attributes": {"width": "59528", "height": "84188"}, "children": [{"name": "hp:margin", "attributes": {"left": "10"}, "children": []}]}]


def test_html(spark):
    members = _members(spark, {"one": [SECTION], "none": ["", "<hs:sec><hp:p/><hp:p></hp:p></hs:sec>"]})
    got = {(r.doc, r.section): r.html for r in structure.html(views.body_tokens(members), members).collect()}
    cell = "<td><p>{}</p></td>".format
    assert got.pop(("one", 0)) == (
        "<header><p> top </p></header><header><p>again</p></header><p>Title &amp; more</p>"
        "<p>before</p><table><tr><td><p>A1</p><table><tr>" + cell("inner") + "</tr></table></td>" + cell("B|1") + "</tr><tr>" + cell("A2") * 2 + "</tr></table><p>after</p>"
        "<p>x\ty</p><aside><p>note one</p><p>line two</p></aside><p><code>a over b</code><img src=\"image1\"></p><p>nobody</p>")
    assert set(got.values()) <= {""} and ("none", 1) in got


def _searched(rows, addresses, downs, wides):
    """Each cell in the first place of its row, behind the cell before it, that no earlier row's cell covers."""
    taken, out, last = set(), [], {}
    for r, address, down, wide in zip(rows, addresses, downs, wides, strict=True):
        col = last.get(r, 0) if address is None else address
        while address is None and any(c == col and top < r < end for c, top, end in taken):
            col += 1
        taken |= {(c, r, r + down) for c in range(col, col + wide)}
        last[r] = col + wide
        out.append(col)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), st.none(), st.none(), st.integers(0, 6)), st.integers(1, 4), st.integers(1, 3)), max_size=5), max_size=6))
def test_grid_columns(table):
    cells = [(r, *c) for r, row in enumerate(table) for c in row]
    columns = [list(x) for x in zip(*cells, strict=True)] or [[], [], [], []]
    assert views.grid_columns(*columns) == _searched(*columns)


def test_wide_spans_take_no_room(spark):
    assert views.grid_columns([0, 0, 1, 1], [None] * 4, [10**9, 1, 1, 1], [10**9, 1, 1, 1]) == [0, 10**9, 10**9, 10**9 + 1]
    xml = "<hs:sec><hp:p><hp:run><hp:tbl><hp:tr>" + _cell("a", 2) + _cell("b", 1, 2) + "</hp:tr><hp:tr>" + _cell("c") + _cell("d", address='<hp:cellAddr colAddr="5" rowAddr="1"/>') + "</hp:tr></hp:tbl><hp:tbl/></hp:run></hp:p></hs:sec>"
    cells = views.table_cells(views.body_tokens(_members(spark, {"d": [xml]}))).orderBy("cell_idx").collect()
    assert [(c.row, c.col, c.text, c.n_rows, c.n_cols) for c in cells] == [(0, 0, "a", 2, 6), (0, 1, "b", 2, 6), (1, 1, "c", 2, 6), (1, 5, "d", 2, 6)]


@pytest.mark.parametrize(("text", "code", "pairs"), [
    ('{"b":"1","2":"x","a":"","1":"y","b":"2","01":"z"}', "ok", [("1", "y"), ("2", "x"), ("b", "2"), ("a", ""), ("01", "z")]),
    ('{"4294967295":"a","4294967294":"b"}', "ok", [("4294967294", "b"), ("4294967295", "a")]),
    ("{}", "ok", []), ('{"\\ud800":"\\ud83d\\ude00"}', "ok", [("�", "😀")]),
    (None, "bad_json", None), ("", "bad_json", None), ("[]", "bad_json", None), ("null", "bad_json", None), ("{'a':'b'}", "bad_json", None), ('{"a":NaN}', "bad_json", None), ('{"a":"b"} x', "bad_json", None),
    ("[" * 100000, "bad_json", None), ('{"a":1}', "bad_value", None), ('{"":"x"}', "empty_key", None),
])
def test_pairs(text, code, pairs):
    got = A.pairs_of(text)
    assert got == (code, None if pairs is None else [{"key": k, "value": v} for k, v in pairs])


def test_items():
    code, items = A.items_of('[{"type":"text","text":1.0},{"type":"image"},7,{"type":"table","headers":["a",true],"rows":[[null,2.5,[1,null]],[]]}]')
    assert code == "ok" and [(x["pos"], x["text"], x["headers"], x["rows"]) for x in items] == [(0, "1", None, None), (3, None, ["a", "true"], [["", "2.5", "1,"], []])]
    assert A.items_of("[]") == ("ok", []) and A.items_of('{"type":"text"}')[0] == "bad_json"
    assert {A.items_of(x)[0] for x in ("[null]", '[{"type":"text"}]', '[{"type":"table","headers":"x","rows":[]}]', '[{"type":"table","headers":[],"rows":["x"]}]')} == {"bad_item"}


def test_fill_each(spark):
    node = lambda *x: "<hs:sec><hp:p>" + "".join(f"<hp:t>{s}</hp:t>" for s in x) + "</hp:p></hs:sec>"
    members = _members(spark, {"a": [node("k1 k1", "&lt;K&gt;"), node("k2 7")], "b": [node("k1")], "c": [node("k1")]})
    arguments = spark.createDataFrame([("a", '{"k2":"k1 $1","k1":"<v>","<K>":"&","7":"k2","none":""}'), ("b", '{"k1":3}'), ("gone", '{"k1":"x"}'), ("empty", None)], "doc string, replacements string")
    edits, outcome = P.fill_each(members, arguments)
    xml = {(e.doc, e.entry[-5]): e.xml for e in edits.collect()}
    # In JavaScript's order 7 comes first, so k2 finds it; the last k1 of a node is replaced.
    assert xml == {("a", "0"): node("k1 &lt;v&gt;", "&amp;"), ("a", "1"): node("k2 &lt;v&gt; $1")}
    said = {r.doc: (r.code, r.n, r.report) for r in outcome.collect()}
    assert said["a"] == ("ok", 5, "총 5건 치환 (5 replacements)\n\n  '7' → 1건\n  'k1' → 2건\n  '<K>' → 1건\n  'k2' → 1건\n  'none' → 0건")
    assert {d: x[0] for d, x in said.items()} == {"a": "ok", "b": "bad_value", "gone": "not_found", "empty": "bad_json"} and said["b"][1:] == (0, None)
    edits, outcome = P.fill_each(members, arguments.filter("doc = 'a'"), all_occurrences=True)
    assert {e.xml for e in edits.collect()} == {node("&lt;v&gt; &lt;v&gt;", "&amp;"), node("&lt;v&gt; $1 &lt;v&gt; $1")} and outcome.first().n == 5  # nodes, not places
    every = P.fill(members.filter("doc = 'a'"), [("k1", "k1k1"), ("7", "\\1")], all_occurrences=True)
    assert {e.xml: list(e.hits) for e in every.collect()} == {node("k1k1 k1k1", "&lt;K&gt;"): [1, 0], node("k2 \\1"): [0, 1]}
    nothing, none = P.fill_each(members, arguments.limit(0))
    assert nothing.count() == none.count() == 0


def test_create_each(spark):
    arguments = spark.createDataFrame([("a", '[{"type":"text","text":"x & y\\nz"}]'), ("b", "[]"), ("c", "nope")], "doc string, content string")
    members, outcome = package.create_each(arguments)
    assert {r.doc: r.code for r in outcome.collect()} == {"a": "ok", "b": "ok", "c": "bad_json"}
    paras = views.paragraphs(views.body_tokens(members)).orderBy("paragraph").collect()
    assert [(p.doc, p.text) for p in paras] == [("a", "x & y"), ("a", "z")] and {r.doc for r in members.select("doc").distinct().collect()} == {"a", "b"}
