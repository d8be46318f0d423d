"""Which paths a configuration may use, and how each one is evaluated.

``tree``   element paths that the standard element tree can walk; evaluated
           together, in one parse of the document.
``xpath``  any other XPath 1.0 that selects elements; evaluated by Spark's
           own xpath functions on a document already known to be well-formed.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

_NAME = r"[A-Za-z_][\w.\-]*"
_TEST = rf"(?:{_NAME}|\.)\s*=\s*(?:'[^'\[\]]*'|\"[^\"\[\]]*\")|@{_NAME}(?:\s*=\s*(?:'[^'\[\]]*'|\"[^\"\[\]]*\"))?|{_NAME}"
_STEP = rf"(?:{_NAME}|\*)(?:(?:\[(?:{_TEST})\])*|\[(?:[1-9]\d*|last\(\))\])"
_TREE_PATH = re.compile(rf"(?://?|\./(?:/)?)?{_STEP}(?://?{_STEP})*")
_NOT_ELEMENTS = re.compile(r"(?:^|/)\s*(?:@[\w:.*\-]+|text\(\)|comment\(\)|node\(\))\s*$")

_FILTER_TEXT = r"(?:'[^'\[\]\r\n\t]*'|\"[^\"\[\]\r\n\t]*\")"
_FILTER_STEP = rf"(?:{_NAME}|\*)(?:\[\s*(?:{_NAME}|\.)\s*!?=\s*{_FILTER_TEXT}\s*\])*"
_TREE_FILTER = re.compile(rf"//?{_FILTER_STEP}(?://?{_FILTER_STEP})*")

#: Attribute that holds an element's whole text in a marked document.
WHOLE_TEXT = "metaingest-whole-text"
_QUOTED_OR_ANY_ATTRIBUTE = re.compile(r"'[^']*'|\"[^\"]*\"|((?:@|attribute\s*::)\s*(?:\*|node\(\s*\)))")


class PathError(ValueError):
    """A configured path that cannot be evaluated."""


def path_kind(path: str) -> str:
    """``tree`` or ``xpath``; raises for paths that do not select elements."""
    text = (path or "").strip()
    if not text:
        raise PathError("path is blank")
    if _NOT_ELEMENTS.search(text):
        raise PathError(f"path selects no elements: {text}")
    return "tree" if all(_TREE_PATH.fullmatch(part.strip()) for part in union_parts(text)) else "xpath"


def is_tree_filter(path: str) -> bool:
    """Whether the element tree tells as XPath does if the path selects anything, in
    a document without namespaces: element names with tests for texts, ``!=`` included."""
    return _TREE_FILTER.fullmatch(path.strip()) is not None


def union_parts(path: str) -> list[str]:
    """The alternatives of a path; a bar inside quotes or brackets stays."""
    return re.split(r"\|(?=(?:[^'\"\[\]]|'[^']*'|\"[^\"]*\"|\[(?:[^'\"\[\]]|'[^']*'|\"[^\"]*\")*\])*$)", path)


def whole_text_path(path: str) -> str:
    """XPath of the marks of all elements that ``path`` selects in a marked document.

    Steps to any attribute don't see the mark.
    """
    unseen = _QUOTED_OR_ANY_ATTRIBUTE.sub(lambda m: f"{m[0]}[name() != '{WHOLE_TEXT}']" if m[1] else m[0], path)
    return f"({unseen})/@{WHOLE_TEXT}"


def check_xpath(spark: SparkSession, path: str) -> None:
    """Raise ``PathError`` unless Spark accepts the XPath."""
    literal = path.replace("\\", "\\\\").replace("'", "\\'")
    try:
        spark.sql(f"SELECT xpath('<a/>', '{literal}') AS hit").collect()
    except Exception as error:
        raise PathError(f"path is not valid XPath: {path}") from error
