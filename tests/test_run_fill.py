"""Fills across runs against a plain search of a stretch's joined text."""

import re
from html import escape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.operators.run_fill import BORDER, fill_across_runs
from docweave.sources.markup import TOKEN
from tests.test_structure import _members


def _run(text, ref=0):
    return f'<hp:run charPrIDRef="{ref}"><hp:t>{escape(text, quote=False)}</hp:t></hp:run>'


def _plain(xml, pairs, every):
    """(xml, hits) of a plain fill, character by character."""
    toks, hits, stretch = TOKEN.findall(xml), [0] * len(pairs), []
    in_t = in_lines = False

    def settle():
        if any(BORDER in toks[i] for i in stretch):
            return
        chars = [(c, i) for i in stretch for c in toks[i]]
        for j, (key, value) in enumerate((escape(k, quote=False), escape(v, quote=False)) for k, v in pairs):
            text = "".join(c for c, _ in chars)
            starts = [m.start() for m in re.finditer(re.escape(key), text)] if every else [text.rfind(key)] if key in text else []
            hits[j] += bool(starts)
            for s in reversed(starts):
                chars[s : s + len(key)] = [(c, chars[s][1]) for c in value]
        for i in stretch:
            toks[i] = "".join(c for c, n in chars if n == i)

    for i, tok in enumerate(list(toks)):
        name = re.match(r"</?([^\s/>]*)", tok)[1] if tok[0] == "<" and tok[1] not in "!?" else ""
        if tok[0] == "<" and name == "hp:t":
            in_t = tok[1] != "/" and not tok.endswith("/>")
        elif tok[0] != "<" and in_t:
            stretch.append(i)
        elif name == "hp:linesegarray":
            in_lines = tok[1] != "/"
        elif tok[0] == "<" and name != "hp:run" and not in_lines:
            settle()
            stretch = []
    settle()
    return "".join(toks), hits


SECTIONS = {
    "split": '<hs:sec><hp:p id="1">' + _run("{{na") + _run("me}}, {{", 1) + _run("name") + _run("}}!") + "</hp:p></hs:sec>",
    "apart": "<hs:sec><hp:p>" + _run("{{na") + "</hp:p><hp:p>" + _run("me}}") + "<hp:ctrl/>" + _run("{{name") + "<hp:tbl><hp:tr/></hp:tbl>" + _run("}}") + "</hp:p></hs:sec>",
    "lines": "<hs:sec><hp:p>" + _run("{{name") + '<hp:linesegarray><hp:lineseg a="1"/></hp:linesegarray>' + _run("}}") + "</hp:p></hs:sec>",
    "beside": "<hs:sec><hp:p><hp:run><hp:t>{{name<hp:tab/>{{na</hp:t></hp:run>" + _run("me}} a&b") + "</hp:p></hs:sec>",
    "border": "<hs:sec><hp:p>" + _run(f"{{{{na{BORDER}") + _run("me}}") + "</hp:p></hs:sec>",
    "empty": "",
}


@pytest.mark.parametrize("every", [False, True])
def test_against_plain_search(spark, every):
    pairs = [("{{name}}", "5 $1 \\ & <Kim>"), ("Kim>, ", "x"), ("a&b", ""), ("none", "no")]
    got = {r.doc: (r.xml, list(r.hits), r.n) for r in fill_across_runs(_members(spark, {d: [x] for d, x in SECTIONS.items()}), pairs, every).collect()}
    for doc, xml in SECTIONS.items():
        if xml:
            want, hits = _plain(xml, pairs, every)
            assert got[doc] == (want, hits, sum(hits)), doc
    assert got["split"][1][0] == 1 and got["lines"][1][0] == 1 and got["beside"][1][:3] == [1, 0, 1] and got["border"][0] == SECTIONS["border"]
    assert got["apart"] == (SECTIONS["apart"], [0] * 4, 0) and set(got) == set(SECTIONS) - {"empty"}
    if not every:
        assert got["split"][0] == SECTIONS["split"].replace("{{</hp:t>", "5 $1 \\ &amp; &lt;Kim&gt;</hp:t>").replace("<hp:t>name</hp:t>", "<hp:t></hp:t>").replace("<hp:t>}}!", "<hp:t>!")


def test_refused_and_nothing_to_do(spark):
    members = _members(spark, {"a": [SECTIONS["split"]]})
    for pair in (("", "x"), ("a" + BORDER, "x"), ("a", BORDER)):
        with pytest.raises(ValueError):
            fill_across_runs(members, [pair])
    assert fill_across_runs(members, []).first().xml == SECTIONS["split"]
    assert fill_across_runs(members.filter("false"), [("a", "b")]).count() == 0


texts = st.lists(st.lists(st.text("ab&\U0001F600가", max_size=5), max_size=4), max_size=3)


@settings(max_examples=6, deadline=None)
@given(many=st.lists(texts, min_size=8, max_size=12), pairs=st.lists(st.tuples(st.text("ab&\U0001F600", min_size=1, max_size=12), st.text("ab<$1", max_size=3)), min_size=1, max_size=3), every=st.booleans())
def test_any_split(spark, many, pairs, every):
    xmls = {str(i): "<hs:sec>" + "".join("<hp:p>" + "".join(map(_run, p)) + "</hp:p>" for p in doc) + "</hs:sec>" for i, doc in enumerate(many)}
    got = {r.doc: (r.xml, list(r.hits)) for r in fill_across_runs(_members(spark, {d: [x] for d, x in xmls.items()}), pairs, every).collect()}
    assert got == {d: _plain(x, pairs, every) for d, x in xmls.items()}
