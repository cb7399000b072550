"""Node selection in malformed HTML: the one place where rows visit Python.

Spark's own ``xpath`` needs well-formed XML and a constant path, so pages go through an
Arrow UDF that builds a small tree and evaluates this subset of XPath:

* steps ``/`` and ``//`` with a tag name, ``*``, ``.``, ``@name`` or ``text()``;
* predicates ``[n]``, ``[last()]``, ``[@name]``, ``[@name="v"]``, ``[contains(@name,"v")]``.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Send this module along with the UDF, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never have content, and elements an opening tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    **{tag: {"p"} for tag in (
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
        "header hr main nav ol p pre section table ul").split()},
}
SCOPES = frozenset("table ul ol dl select body html".split())


class Node:
    """An element, or a text when ``tag`` is None; ``order`` is document order."""

    __slots__ = ("tag", "attrs", "children", "text", "order")

    def __init__(self, tag, order, attrs=(), text=None):
        self.tag, self.order, self.text = tag, order, text
        self.attrs = {name: value or "" for name, value in reversed(attrs)}
        self.children = []


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.count = 0
        self.root = Node("", 0)
        self.open = [self.root]
        self.text = None  # the text node that characters still go to

    def _add(self, *args, **kwargs):
        self.count += 1
        self.text = None
        node = Node(args[0], self.count, *args[1:], **kwargs)
        self.open[-1].children.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        closes = CLOSED_BY.get(tag, ())
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in closes:
                del self.open[depth:]
                break
            if self.open[depth].tag in SCOPES:
                break
        node = self._add(tag, attrs)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.text = None
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                break

    def handle_data(self, data):
        if self.text is None:
            self.text = self._add(None, text=data)
        else:  # the parser hands over one text in parts, as around a stray "<"
            self.text.text += data

    def handle_comment(self, data):
        self.text = None

    def parse_marked_section(self, i, report=1):
        """A section is a bogus comment up to the next ">", as in browsers."""
        self.text = None
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else -1


def tree(html: str) -> Node:
    """The page as a tree. Any text is a page; should the parser fail all the same, the tree
    is empty: nothing is selected, and the checks on required fields name the page."""
    builder = _TreeBuilder()
    try:
        builder.feed(html)
        builder.close()
    except (AssertionError, ValueError, RecursionError):
        return Node("", 0)
    return builder.root


_STEP = re.compile(r"(//?|^)(\.|@[\w:-]+|text\(\)|\*|[\w:-]+)((?:\[[^\]]*\])*)")
_PREDICATE = re.compile(
    r"\[\s*(?:(?P<at>\d+)|(?P<last>last\(\))"
    r"|@(?P<name>[\w:-]+)(?:\s*=\s*(?P<q>[\"'])(?P<value>.*?)(?P=q))?"
    r"|contains\(\s*@(?P<cname>[\w:-]+)\s*,\s*(?P<cq>[\"'])(?P<part>.*?)(?P=cq)\s*\))\s*\]")


def compile_path(path: str) -> list:
    """Steps of a path as (any depth, node test, predicates); rejects what lies outside the
    subset."""
    steps, end = [], 0
    for step in _STEP.finditer(path):
        tests = list(_PREDICATE.finditer(step[3]))
        if step.start() != end or "".join(test[0] for test in tests) != step[3]:
            break
        end = step.end()
        steps.append((step[1] == "//", step[2], [test.groupdict() for test in tests]))
    if not path or end != len(path):
        raise ValueError(f"unsupported path: {path!r}")
    return steps


def _keeps(test: dict, node: Node, position: int, size: int) -> bool:
    if test["at"]:
        return position == int(test["at"])
    if test["last"]:
        return position == size
    if test["cname"]:
        return test["part"] in node.attrs.get(test["cname"], "")
    value = node.attrs.get(test["name"])
    return value is not None and test["value"] in (None, value)


def _self_and_below(node: Node):
    stack = [node]
    while stack:
        node = stack.pop()
        if node.tag is not None:
            yield node
            stack.extend(reversed(node.children))


def _children(node: Node, test: str, predicates: list) -> list:
    if test == ".":
        found = [node]
    elif test == "text()":
        found = [child for child in node.children if child.tag is None]
    else:
        found = [child for child in node.children
                 if child.tag is not None and test in ("*", child.tag)]
    for predicate in predicates:
        found = [child for i, child in enumerate(found, 1)
                 if _keeps(predicate, child, i, len(found))]
    return found


def select(scope: Node, steps: list) -> list:
    """Nodes (or attribute values) a compiled path selects, in document order."""
    context = [scope]
    for deep, test, predicates in steps:
        if deep:
            context = _in_order([node for top in context for node in _self_and_below(top)],
                                len(context) == 1)
        if test.startswith("@"):
            return [node.attrs[test[1:]] for node in context if test[1:] in node.attrs]
        context = _in_order([node for top in context
                             for node in _children(top, test, predicates)], len(context) == 1)
    return context


def _in_order(nodes: list, ordered: bool) -> list:
    """Distinct nodes in document order, which nodes found from a single one already are."""
    if ordered or len(nodes) < 2:
        return nodes
    distinct = {node.order: node for node in nodes}
    return [distinct[order] for order in sorted(distinct)]


def texts(root: Node, scope: Node, path: str, steps: list) -> list[str]:
    """Texts and attribute values; a path from "/" starts at the page, any other at scope."""
    found = select(root if path.startswith("/") else scope, steps)
    return [each if isinstance(each, str) else each.text
            for each in found if isinstance(each, str) or each.tag is None]


_ARROW_RECORDS = pa.list_(pa.list_(pa.list_(pa.string())))
_RECORDS = T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))


@F.arrow_udf(_RECORDS)
def _records(html: pa.Array, scope: pa.Array, paths: pa.Array) -> pa.Array:
    rows, compiled = [], {}

    def steps(path):
        if path not in compiled:
            compiled[path] = compile_path(path)
        return compiled[path]

    for page, record, wanted in zip(html.to_pylist(), scope.to_pylist(), paths.to_pylist()):
        if page is None or wanted is None:
            rows.append(None)
            continue
        root = tree(page)
        scopes = [root] if record is None else select(root, steps(record))
        rows.append([[texts(root, node, path, steps(path)) for path in wanted]
                     for node in scopes])
    return pa.array(rows, type=_ARROW_RECORDS)


# Pages are parsed once: the optimizer may not copy a non-deterministic UDF into the filters
# it infers for generators, nor move it below a repartitioning.
_records = _records.asNondeterministic()


def select_texts(html: Column, paths: Column) -> Column:
    """array<array<string>>: for each path, the texts or attribute values it selects."""
    return F.get(_records(html, F.lit(None).cast("string"), paths), F.lit(0))


def select_records(html: Column, record: str, paths: list[str]) -> Column:
    """array<array<array<string>>>: the paths evaluated inside every node ``record`` selects."""
    for path in (record, *paths):
        compile_path(path)
    return _records(html, F.lit(record), F.array(*map(F.lit, paths)))
