"""Document helpers: paths, JSON conversion, serialization."""

from __future__ import annotations

import pytest

from metaingest.functions import _trees as trees
from metaingest.functions.paths import PathError, check_xpath, path_kind


def first(body, path, is_json=False):
    hit = trees.first_match(trees.parse_document(body, is_json), trees.compile_path(path))
    return None if hit is None else trees.text_of(hit)


@pytest.mark.parametrize(
    "body, path, expected",
    [
        ("<product><ean>1</ean></product>", "//product/ean", "1"),
        ("<product><ean>1</ean></product>", "/product/ean", "1"),
        ("<product><ean>1</ean></product>", "product/ean", "1"),
        ("<product><ean>1</ean></product>", "/ean", None),
        ("<a><b/></a>", "//b", ""),
        ("<a><b>x</b><b>y</b></a>", "//a/b", "x"),
        ("<a><b><![CDATA[<x>]]>&amp;y</b></a>", "//b", "<x>&y"),
        ("<a><b> x </b></a>", "//b", " x "),
        ("<a><b>1<c>2</c>3</b>4</a>", "//b", "123"),
        ("<m><m><e>1</e></m><e>2</e></m>", "//m/e", "1"),
        ("<m><x/><m><e>1</e></m></m>", "//m/e", "1"),
        ("<a><p><k>x</k><v>1</v></p><p><k>y</k><v>2</v></p></a>", "//p[k='y']/v", "2"),
        ("<a><p t='1'>x</p><p t='2'>y</p></a>", "/a/p[@t='2']", "y"),
        ("<a><p>x</p><p>y</p></a>", "//a/p[2]", "y"),
        ("<a><p>x</p><p>y</p></a>", "//a/p[last()]", "y"),
        ("<a><c><b>z</b></c></a>", "/a//b", "z"),
        ("<a><c><b>z</b></c></a>", "/*/*/b", "z"),
        ('<?xml version="1.0" encoding="utf-16"?><a><b>é</b></a>', "/a/b", "é"),
    ],
)
def test_first_match(body, path, expected):
    assert path_kind(path) == "tree"
    assert first(body, path) == expected


@pytest.mark.parametrize("body", ["", "<a>", "<p/>trailing", "text", None, "<a>&nbsp;</a>", "<a/><b/>"])
def test_not_a_document(body):
    assert trees.parse_document(body, False) is None


@pytest.mark.parametrize(
    "path, kind",
    [
        ("//a[b='1' or b='2']", "xpath"),
        ("//a[contains(b,'1')]", "xpath"),
        ("//a[b='1']", "tree"),
        ("//a | //b", "tree"),
        ("//a[b='|'] | c", "tree"),
        ("//a[contains(., '|')]", "xpath"),
        ("../a", "xpath"),
    ],
)
def test_path_kinds(path, kind):
    assert path_kind(path) == kind


@pytest.mark.parametrize("path", ["", "  ", "//a/text()", "//a/@id"])
def test_paths_must_select_elements(path):
    with pytest.raises(PathError):
        path_kind(path)


def test_invalid_xpath_is_rejected(spark):
    check_xpath(spark, "//a[b='1' or b='2']")
    for path in ("//a[", "count(//a)"):
        with pytest.raises(PathError):
            check_xpath(spark, path)


def test_serialized_element_excludes_following_text():
    document = trees.parse_document("<a>0<b x='1'>1<c/></b>2</a>", False)
    hit = trees.first_match(document, trees.compile_path("//b"))
    assert trees.xml_of(hit) == '<b x="1">1<c /></b>'
    assert trees.text_of(document[0]) == "012"


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"product": {"main": {"ean": 9781234567890, "price": 9.90}}}',
         "<product><main><ean>9781234567890</ean><price>9.90</price></main></product>"),
        ('[{"ean": 1}, {"ean": 2}]', "<root><product><ean>1</ean></product><product><ean>2</ean></product></root>"),
        ('{"more": true, "next": null, "product": [{"ean": 1}]}',
         "<root><more>true</more><next /><product><ean>1</ean></product></root>"),
        ('{"a": {"@id": "7", "#text": "x", "b": [1, [2, 3]], "c": {}}}',
         '<a id="7">x<b>1</b><b>2</b><b>3</b><c /></a>'),
        ('{"a": {"b": 1, "b": 2, "odd name": "<&>", "1st": ""}}',
         "<a><b>1</b><b>2</b><odd_x0020_name>&lt;&amp;&gt;</odd_x0020_name><_x0031_st /></a>"),
        ('{"product": [1, 2]}', "<root><product>1</product><product>2</product></root>"),
        ('{"a": "x\\u0001y"}', "<a>x�y</a>"),
    ],
)
def test_json_becomes_a_tree(body, expected):
    assert trees.xml_of(trees.parse_document(body, True)[0]).replace("></next>", " />") == expected.replace("></next>", " />")


@pytest.mark.parametrize("body", ["", "1", '"x"', "{", "nope", '{"a": 1} x'])
def test_not_json(body):
    assert trees.parse_document(body, True) is None


def test_grouped_slots_equal_single_lookups():
    bodies = [
        "<r><m><e>1</e><t/></m></r>",
        "<r><m><e>1</e></m><m><e>2</e><t>b</t></m></r>",
        "<m><m><e>1</e></m><e>2</e><t>c</t></m>",
        "<r/>",
    ]
    paths = ["//m/e", "//m/t", "/r/m/e", "//e", "//m"]
    plans = trees.compile_slots([[(p, False)] for p in paths])
    for body in bodies:
        assert trees.slot_row(body, False, plans, len(paths), False)[:-1] == [first(body, p) for p in paths]


def test_documents_may_be_deeper_than_python_recurses():
    body = "<a>" * 5000 + "</a>" * 5000
    plans = trees.compile_slots([[("/a", True)]])
    assert trees.slot_row(body, False, plans, 1, False) == ["<a>" * 4999 + "<a />" + "</a>" * 4999, True]


@pytest.mark.parametrize(
    "body", ["<a/>", "<a x='1&quot;&#10;'>t&lt;<b>u</b>v<c/>w</a>", "<p:a xmlns:p='u:1' p:x='2'><b xmlns='u:2'>é</b></p:a>"]
)
def test_deep_serialization_is_the_usual_one(body):
    root = trees.parse_document(body, False)[0]
    assert trees._deep_xml(root) == trees.ET.tostring(root, encoding="unicode")


@pytest.mark.parametrize("body", [None, "", "<a>", "</a>", "<a/><b/>", "<a/>x", " <a/>", "<a/>\n", "<a><!--", "<a/>&#32;",
    "<a/><![CDATA[]]>", "<?xml version='1.0'?><a/>", "<a xmlns='u'><b>2</b></a>", "<p:a/>", "<a>&nbsp;</a>", "<a>\ud800</a>"])
def test_bodies_parsed_together_are_what_each_is_alone(body):
    def seen(document):
        return None if document is None else (document.tag, document.text, document[0].tail, trees.xml_of(document[0]))

    bodies = ["<a><b>1</b></a>", body, "--><b/>", "<a/>", body]
    assert list(map(seen, trees.parse_documents(bodies, False))) == [seen(trees.parse_document(b, False)) for b in bodies]


def test_short_bodies_share_a_parser(monkeypatch):
    calls = []
    monkeypatch.setattr(trees.ET, "fromstring", lambda text, parse=trees.ET.fromstring: calls.append(1) or parse(text))
    plans = trees.compile_slots([[("/a/b", False)]])
    rows = list(trees.slot_rows([f"<a><b>{n}</b></a>" for n in range(640)], False, plans, 1, False))
    assert rows == [[str(n), True] for n in range(640)] and len(calls) == 640 // trees.PARSED_TOGETHER
