"""Parts read where they stand: the same as views of token rows, for no more than a few shuffles."""

import pytest
from pyspark.sql import functions as F

from docweave.operators import package_edit, report
from docweave.plans import registry
from docweave.sources import markup, package, part_views, views
from tests.conftest import SF


def _reads_whole(spark, monkeypatch, name: str) -> str:
    """The query's plan; no token row with all its counters may leave a task."""
    seen = []
    for module in (views, package_edit, package):
        if hasattr(module, "tokens"):
            monkeypatch.setattr(module, "tokens", lambda parts, *only, f=module.tokens: (seen.append(only), f(parts, *only))[1])
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert () not in seen
    return plan


def _section(*body: str) -> str:
    return "<hs:sec>" + "".join(body) + "</hs:sec>"


def _p(*body: str) -> str:
    return f'<hp:p id="1"><hp:run charPrIDRef="0">{"".join(body)}</hp:run></hp:p>'


def _t(text: str) -> str:
    return f"<hp:t>{text}</hp:t>"


def _note(name: str, more: str, *body: str) -> str:
    return f"<hp:ctrl><hp:{name}{more}><hp:subList>{''.join(body)}</hp:subList></hp:{name}></hp:ctrl>"


TABLE = ('<hp:tbl rowCnt="2"><hp:tr><hp:tc rowSpan="2"><hp:subList>' + _p(_t("a &#x41;")) + _p(_t("b")) + "</hp:subList></hp:tc><hp:tc><hp:subList>" + _p(_t("c"), "<hp:tbl><hp:tr><hp:tc><hp:subList>", _p(_t("inner")), "</hp:subList></hp:tc></hp:tr></hp:tbl>")
         + '</hp:subList></hp:tc></hp:tr><hp:tr><hp:tc><hp:subList><hp:p/></hp:subList><hp:cellAddr colAddr="1" rowAddr="1"/></hp:tc></hp:tr></hp:tbl>')
SECTIONS = {
    "a": [_section(_p(_t("x &amp;lt; y<hp:lineBreak/>z<hp:tab/>"), "<hp:t><![CDATA[<raw>]]></hp:t>", _note("header", ' applyPageType="EVEN"', _p(_t(" head ")), _p(_t("two"))), _note("header", ' applyPageType="EVEN"', _p(_t("later")))),
                   _p(TABLE, '<hp:pic><hc:img binaryItemIDRef="image1"/></hp:pic>'), "<hp:p/>", _p(_note("footNote", ' number="7"', _p(_t("note"), TABLE)), _t("tail"), '<hp:equation><hp:script>a &lt; b</hp:script></hp:equation>')),
          _section(_p(_note("footer", "", _p(_t("foot"))), _t("second section")), _p("<hp:equation><hp:script></hp:script></hp:equation>"))],
    "b": [_section(_p('<hp:fieldEnd/><hp:fieldBegin name="o&amp;" type="T"/>', _t("A"), '<hp:fldBegin name="i"/>', _t("B"), "<hp:fldEnd/>", _t("C"), "<hp:fieldEnd/>", _t("D"), '<hp:fieldBegin/>', _t("E")))],
    "c": [_section()], "d": [""],
}


@pytest.fixture
def members(spark):
    rows = [(doc, i, f"Contents/section{i}.xml", 8, bytearray(x.encode())) for doc, parts in SECTIONS.items() for i, x in enumerate(parts)]
    rows += [("a", 7, "BinData/image1.png", 8, bytearray(b"png")), ("e", 0, "mimetype", 0, bytearray(b"m"))]
    return spark.createDataFrame(rows, package.ENTRIES).coalesce(1)


def _same(got, want, columns: list[str]) -> None:
    have, due = (sorted(map(tuple, df.select(*(F.col(c).cast("string") for c in columns)).collect()), key=str) for df in (got, want))
    assert have == due and due


def test_texts_are_those_of_token_rows(members):
    t, docs = views.body_tokens(members), members.select("doc")
    want = report.full_text(docs, views.paragraphs(t), views.headers_footers(t), views.footnotes(t), views.equations(t))
    _same(report.full_text_of(part_views.texts(members), docs), want, ["doc", "text"])
    assert "--- headers ---\n[section 0 EVEN] head" in want.filter("doc = 'a'").first().text


def test_cells_pictures_and_fields_are_those_of_token_rows(members):
    t = views.body_tokens(members)
    _same(part_views.table_cells(members), views.table_cells(t), ["doc", "section", "paragraph", "control", "table", "n_rows", "n_cols", "cell_idx", "row", "col", "row_span", "col_span", "text"])
    _same(part_views.tables(members), views.tables(t), ["doc", "section", "paragraph", "control", "table", "n_rows", "n_cols", "cells"])
    _same(part_views.images(members), views.images(t, members), ["doc", "section", "paragraph", "control", "entry", "mime", "ext", "byte_length"])
    _same(part_views.fields(members), views.fields(t), ["doc", "section", "ord", "name", "type", "value"])


def test_parts_cut_together_count_alone():
    """Counters start anew in each part, also behind one whose elements stay open."""
    parts = ["<hs:sec><hp:p><hp:tbl><hp:tr><hp:tc>", SECTIONS["a"][0], "", SECTIONS["b"][0]]
    whole = markup.Cut(parts)
    for i, xml in enumerate(parts):
        alone, a, b = markup.Cut([xml]), whole.bounds[i], whole.bounds[i + 1]
        assert whole.toks[a:b] == alone.toks
        for c in ("kind", *markup._COUNTERS, "starts_control", "begins_flat"):
            assert getattr(whole, c)[a:b].tolist() == getattr(alone, c).tolist(), (i, c)


def test_scripted_members_are_those_of_apply_script(spark, members):
    """In the first section alone, where documents have several, and with edits that change nothing."""
    from docweave.operators import edit_script

    step = "{}, cast(null as int) table, cast(null as int) row, cast(null as int) col, cast(null as int) count, '{}' text, cast(null as array<string>) texts"
    script = spark.sql(" union all ".join(f"select '{doc}' doc, {i} ord, '{op}' op, " + step.format(f"{at} index", text) for doc, i, op, at, text in (
        ("a", 0, "set_paragraph", 2, "new"), ("a", 1, "append_paragraph", 0, "end"), ("b", 0, "delete_paragraph", 9, ""), ("e", 0, "set_paragraph", 0, "x"), ("a", 2, "what", 0, ""))))
    edits, report = edit_script.apply_script(members, script)
    got, told = edit_script.scripted(members, script)
    columns = ["doc", "seq", "entry", "method", "bytes"]
    _same(got, package_edit.applied(members, edits), columns)
    _same(told, report, ["doc", "ord", "op", "code", "n"])
    assert {(r.doc, r.ord): r.code for r in told.collect()} == {("a", 0): "ok", ("a", 1): "ok", ("a", 2): "bad_op", ("b", 0): "index_range", ("e", 0): "no_section"}
