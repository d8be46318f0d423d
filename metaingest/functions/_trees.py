"""Per-document helpers that run inside Arrow batches on the executors."""

from __future__ import annotations

import codecs
import json
import re
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc

from .paths import WHOLE_TEXT, union_parts

Finder = Callable[[ET.Element], list[ET.Element]]

_CHILD_STEPS = re.compile(r"(//|/|\./|\.//)?([A-Za-z_][\w.\-]*(?:/[A-Za-z_][\w.\-]*)*)")
_BAD_NAME_CHAR = re.compile(r"[^\w.\-]")
_PIECE_BYTES = 1 << 16
#: Up to this length a page is parsed at once: its tree takes no more than a chunk of records.
_PAGE_BYTES = 1 << 19
#: Bodies that are parsed together: how long one may be, and how many.
_SHORT_CHARS, PARSED_TOGETHER = 1 << 12, 64
_PART = f"part-{uuid.uuid4().hex}"
_NOT_XML = re.compile(r"[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")


def parse_document(body: str | None, is_json: bool) -> ET.Element | None:
    """The document's parent node, or None when the text is not a document."""
    if body is None:
        return None
    try:
        root = _json_root(body) if is_json else ET.fromstring(body)
    except (ET.ParseError, ValueError, RecursionError):
        return None
    document = ET.Element("")
    document.append(root)
    return document


def parse_documents(bodies: list[str | None], is_json: bool) -> list[ET.Element | None]:
    """``parse_document`` of each body. Short XML bodies are parsed together, since making
    a parser costs more than reading such a body."""
    short = () if is_json else [i for i, body in enumerate(bodies) if _is_short(body)]
    documents = dict(zip(short, _together([bodies[i] for i in short])))
    return [documents[i] if i in documents else parse_document(body, is_json) for i, body in enumerate(bodies)]


def _is_short(body: str | None) -> bool:
    """What may stand beside elements or reach beyond a body is left to a parser of its own."""
    return body is not None and len(body) <= _SHORT_CHARS and body[:1] == "<" and "<!" not in body and "<?" not in body


def _together(bodies: list[str]) -> list[ET.Element]:
    """Documents of bodies that all are such; none if one is not. No body has the tag that parts them."""
    between = f"</{_PART}><{_PART}>"
    try:
        parts = list(ET.fromstring(f"<{_PART}><{_PART}>{between.join(bodies)}</{_PART}></{_PART}>"))
    except (ET.ParseError, ValueError):
        return []
    if len(parts) != len(bodies) or any(len(part) != 1 or part.text or part[0].tail for part in parts):
        return []
    for part in parts:
        part.tag = ""
    return parts


def records_of_pages(bodies: pa.Array, record_tag: str | None, is_json: bool) -> Iterator[Iterator[ET.Element] | None]:
    """``page_records`` of each body. Short ones are parsed together."""
    by_children = not is_json and (record_tag is None or is_plain_name(record_tag))
    for low in range(0, len(bodies), PARSED_TOGETHER):
        some = bodies.slice(low, PARSED_TOGETHER)
        sizes = pc.binary_length(some).to_pylist() if by_children else []
        texts = {i: some[i].as_py() for i, size in enumerate(sizes) if size is not None and size <= _SHORT_CHARS}
        texts = {i: text for i, text in texts.items() if _is_short(text)}
        documents = dict(zip(texts, _together(list(texts.values()))))
        for i in range(len(some)):
            if i in documents:
                yield iter([child for child in documents[i][0] if record_tag and child.tag == record_tag])
            else:
                yield page_records(some[i], record_tag, is_json)


class _Nothing:
    """A parser's target that keeps nothing."""


def page_records(body: pa.StringScalar, record_tag: str | None, is_json: bool) -> Iterator[ET.Element] | None:
    """The root's children with the record tag one by one, or None for a page
    that is no document. Without a tag there are none."""
    buffer = body.as_buffer()
    if buffer is None:
        return None
    if is_json or not (record_tag is None or is_plain_name(record_tag)):
        document = parse_document(body.as_py(), is_json)
        if document is None:
            return None
        return iter(document[0].findall(record_tag) if record_tag else ())
    if len(buffer) <= _PAGE_BYTES:
        document = parse_document(body.as_py(), is_json)
        return None if document is None else iter([child for child in document[0] if record_tag and child.tag == record_tag])
    if not _is_document(buffer):
        return None
    return _children(buffer, {record_tag}) if record_tag else iter(())


def root_texts(body: pa.StringScalar, tags: list[str], is_json: bool) -> list[str | None] | None:
    """The text of the root's first child with each tag, or None for a page that is no
    document. A long page is read up to the last of them, and its tree is not made."""
    buffer = body.as_buffer()
    if buffer is None:
        return None
    if is_json or len(buffer) <= _PAGE_BYTES or not all(tag == "" or is_plain_name(tag) for tag in tags):
        document = parse_document(body.as_py(), is_json)
        return None if document is None else [child_text(document[0], tag) for tag in tags]
    if not _is_document(buffer):
        return None
    found: dict[str, str] = {}
    wanted = set(tags) - {""}
    for child in _children(buffer, wanted) if wanted else ():
        found.setdefault(child.tag, text_of(child))
        if len(found) == len(wanted):
            break
    return [found.get(tag) for tag in tags]


def _is_document(buffer: pa.Buffer) -> bool:
    checker = ET.XMLParser(target=_Nothing())
    try:
        for piece in _pieces(buffer):
            checker.feed(piece)
        checker.close()
    except (ET.ParseError, ValueError):
        return False
    return True


def _pieces(buffer: pa.Buffer) -> Iterator[str]:
    """The text in pieces. As text, not bytes, since a declared encoding no longer holds."""
    decoder, view = codecs.getincrementaldecoder("utf-8")(), memoryview(buffer)
    for low in range(0, len(view), _PIECE_BYTES):
        yield decoder.decode(view[low : low + _PIECE_BYTES])


def _children(buffer: pa.Buffer, tags: set[str]) -> Iterator[ET.Element]:
    """Children of the root with one of the tags, each dropped from the tree once it is closed."""
    parser, root = ET.XMLPullParser(["start"]), None

    def closed(keep: int) -> list[ET.Element]:
        nonlocal root
        for _, element in parser.read_events():
            if root is None:
                root = element
        if root is None:
            return []
        done = root[: len(root) - keep]
        del root[: len(root) - keep]
        return [child for child in done if child.tag in tags]

    for piece in _pieces(buffer):
        parser.feed(piece)
        yield from closed(1)  # the last child may still be open
    parser.close()
    yield from closed(0)


def _json_root(body: str) -> ET.Element:
    value = json.loads(body, object_pairs_hook=_Members, parse_int=str, parse_float=str, parse_constant=str)
    if isinstance(value, list):
        value = _Members([("root", _Members([("product", value)]))])
    if not isinstance(value, _Members):
        raise ValueError("a JSON document is an object or an array")
    if len(value.pairs) != 1 or isinstance(value.pairs[0][1], list):
        value = _Members([("root", value)])
    holder = ET.Element("")
    _add_json(holder, *value.pairs[0])
    return holder[0]


class _Members:
    """JSON object that keeps repeated names."""

    def __init__(self, pairs):
        self.pairs = pairs


def _add_json(parent: ET.Element, name: str, value) -> None:
    if isinstance(value, list):
        for item in value:
            _add_json(parent, name, item)
    elif name.startswith("@") and not isinstance(value, _Members):
        parent.set(_xml_name(name[1:]), _scalar_text(value))
    elif name == "#text":
        parent.text = (parent.text or "") + _scalar_text(value)
    else:
        element = ET.SubElement(parent, _xml_name(name))
        if isinstance(value, _Members):
            for child, child_value in value.pairs:
                _add_json(element, child, child_value)
        else:
            element.text = _scalar_text(value)


def _scalar_text(value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return _NOT_XML.sub("\ufffd", value)


def _xml_name(name: str) -> str:
    name = _BAD_NAME_CHAR.sub(lambda m: f"_x{ord(m[0]):04X}_", name) or "_"
    return name if name[0].isalpha() or name[0] == "_" else f"_x{ord(name[0]):04X}_{name[1:]}"


def text_of(element: ET.Element) -> str:
    return (element.text or "") if len(element) == 0 else "".join(element.itertext())


def xml_of(element: ET.Element) -> str:
    """The element with its own tag, without the text that follows it."""
    tail, element.tail = element.tail, None
    try:
        out: list[str] = []
        return "".join(out) if _add_plain(element, out) else ET.tostring(element, encoding="unicode")
    except RecursionError:
        return _deep_xml(element)
    finally:
        element.tail = tail


def _add_plain(element: ET.Element, out: list[str]) -> bool:
    """Add what ``tostring`` gives; False if it is not all told since a name has a namespace."""
    tag, attributes = element.tag, element.items()
    if tag[0] == "{" or any(name[0] == "{" for name, _ in attributes):
        return False
    start = tag + "".join(f' {name}="{_attribute(value)}"' for name, value in attributes) if attributes else tag
    text = element.text
    if text or len(element):
        out.append(f"<{start}>{escape(text)}" if text else f"<{start}>")
        for child in element:
            if not _add_plain(child, out):
                return False
        out.append(f"</{tag}>")
    else:
        out.append(f"<{start} />")
    if element.tail:
        out.append(escape(element.tail))
    return True


def marked_xml(record: ET.Element) -> str:
    """``xml_of`` with each element's whole text as the attribute ``WHOLE_TEXT``."""
    own = [(element, element.attrib) for element in record.iter()]
    texts = [text_of(element) for element, _ in own]
    for (element, attributes), text in zip(own, texts):
        element.attrib = {**attributes, WHOLE_TEXT: text}
    try:
        return xml_of(record)
    finally:
        for element, attributes in own:
            element.attrib = attributes


def _deep_xml(root: ET.Element) -> str:
    """The same text for a document nested deeper than Python can recurse."""
    prefixes: dict[str, str] = {}

    def name(tag: str) -> str:
        if not tag.startswith("{"):
            return tag
        uri, _, local = tag[1:].partition("}")
        return f"{prefixes.setdefault(uri, f'ns{len(prefixes)}')}:{local}"

    for element in root.iter():
        for tag in (element.tag, *element.attrib):
            name(tag)
    spaces = "".join(f' xmlns:{prefix}="{_attribute(uri)}"' for uri, prefix in prefixes.items())
    out: list[str] = []
    todo: list[ET.Element | str] = [root]
    while todo:
        element = todo.pop()
        if isinstance(element, str):
            out.append(element)
            continue
        tag, attributes = name(element.tag), "".join(f' {name(k)}="{_attribute(v)}"' for k, v in element.attrib.items())
        out.append(f"<{tag}{spaces if element is root else ''}{attributes}")
        tail = "" if element is root else escape(element.tail or "")
        if element.text or len(element):
            out.append(f">{escape(element.text or '')}")
            todo.append(f"</{tag}>{tail}")
            todo.extend(reversed(element))
        else:
            out.append(f" />{tail}")
    return "".join(out)


def _attribute(value: str) -> str:
    return escape(value, {'"': "&quot;", "\r": "&#13;", "\n": "&#10;", "\t": "&#09;"})


def compile_path(path: str) -> Finder:
    """Matches of a ``tree`` path below a document, at least all first ones per start."""
    parts = union_parts(path)
    if len(parts) > 1:
        finders = [compile_path(part) for part in parts]
        return lambda document: list({id(e): e for finder in finders for e in finder(document)}.values())
    path = path.strip()
    plain = _CHILD_STEPS.fullmatch(path)
    if plain is None:
        relative = path if path.startswith(".") else "." + path if path.startswith("/") else "./" + path
        return lambda document: document.findall(relative)
    steps = plain[2].split("/")
    if plain[1] not in ("//", ".//"):
        return lambda document: _below([document], steps)
    first, rest = steps[0], steps[1:]
    return lambda document: _below(document.iter(first), rest)


def _below(elements: Iterable[ET.Element], steps: list[str]) -> list[ET.Element]:
    found = list(elements)
    for step in steps:
        found = [child for element in found for child in element.findall(step)]
    return found


def first_match(document: ET.Element, finder: Finder) -> ET.Element | None:
    """First match in document order."""
    found = finder(document)
    if len(found) < 2:
        return found[0] if found else None
    wanted = set(map(id, found))
    return next(element for element in document.iter() if id(element) in wanted)


def distinct_texts(document: ET.Element, finder: Finder) -> list[str]:
    """Distinct non-empty texts of all matches, first seen first."""
    found = finder(document)
    if len(found) > 1:
        wanted = set(map(id, found))
        found = [element for element in document.iter() if id(element) in wanted]
    return list(dict.fromkeys(filter(None, map(text_of, found))))


def child_text(element: ET.Element, tag: str) -> str | None:
    child = element.find(tag) if tag else None
    return None if child is None else text_of(child)


def is_plain_name(tag: str | None) -> bool:
    return bool(tag) and re.fullmatch(r"[\w.\-]+", tag) is not None


def compile_slots(slots) -> tuple[list, list]:
    """(grouped, single) plans for slots given as lists of (path, as_xml).

    Plain one-path slots whose elements share a parent path are grouped, so
    the parent is looked up once. The others are (index, [(finder, as_xml)])
    in order of preference.
    """
    parents: dict[str, list] = {}
    single = []
    for index, candidates in enumerate(slots):
        plain = _CHILD_STEPS.fullmatch(candidates[0][0].strip()) if len(candidates) == 1 else None
        if plain is None or "/" not in plain[2]:
            single.append((index, [(compile_path(path), as_xml) for path, as_xml in candidates]))
            continue
        parent, leaf = plain[2].rsplit("/", 1)
        path, as_xml = candidates[0]
        key = ("//" if plain[1] in ("//", ".//") else "/") + parent
        parents.setdefault(key, []).append((index, leaf, compile_path(path), as_xml))
    return [(compile_path(path), leaves) for path, leaves in parents.items()], single


def slot_row(body: str | None, is_json: bool, plans: tuple[list, list], size: int, keep_document: bool) -> list:
    """Slot values of one body, then whether it is a document, then its XML if asked for."""
    return next(slot_rows([body], is_json, plans, size, keep_document))


def slot_rows(
    bodies: list[str | None], is_json: bool, plans: tuple[list, list], size: int, keep_document: bool
) -> Iterator[list]:
    """``slot_row`` of each body."""
    for low in range(0, len(bodies), PARSED_TOGETHER):
        for document in parse_documents(bodies[low : low + PARSED_TOGETHER], is_json):
            if document is None:
                yield [None] * size + [False] + [None] * keep_document
                continue
            row = _slot_values(document, plans, size)
            row.append(True)
            yield row + [xml_of(document[0])] if keep_document else row


def _slot_values(document: ET.Element, plans: tuple[list, list], size: int) -> list:
    values = [None] * size
    grouped, single = plans
    for parents_of, leaves in grouped:
        parents = parents_of(document)
        only = parents[0] if len(parents) == 1 else None
        for index, leaf, finder, as_xml in leaves if parents else ():
            hit = first_match(document, finder) if only is None else only.find(leaf)
            if hit is not None:
                values[index] = xml_of(hit) if as_xml else text_of(hit)
    for index, candidates in single:
        for finder, as_xml in candidates:
            hit = first_match(document, finder)
            if hit is not None:
                values[index] = xml_of(hit) if as_xml else text_of(hit)
                break
    return values
