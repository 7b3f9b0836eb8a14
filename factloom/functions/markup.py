"""A small selector over HTML: tags, ids, classes, attributes and descent, enough for saved listing pages."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
STEP = re.compile(r"([a-zA-Z][\w-]*)?((?:[.#][\w-]+|\[[^\]]+\])*)")
MARK = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(?:([*^]?)=\"?([^\"\]]*)\"?)?\]")


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def below(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.below()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__()
        self.root = self.at = Node("", {})

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parsed(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _fits(node: Node, step: str) -> bool:
    tag, marks = STEP.fullmatch(step).groups()
    if tag and node.tag != tag.lower():
        return False
    for kind, name, attr, how, value in MARK.findall(marks):
        have = node.attrs.get(attr) if attr else None
        if kind == "." and name not in node.attrs.get("class", "").split():
            return False
        if kind == "#" and node.attrs.get("id") != name:
            return False
        if attr and (have is None or (value and not (value in have if how == "*" else have.startswith(value) if how == "^" else have == value))):
            return False
    return True


def select(top: Node, selector: str) -> list[Node]:
    """Nodes below `top` that the selector fits, in the order of the page. Steps are parted by blanks (any descent)."""
    *above, last = selector.split()
    found = []
    for node in top.below():
        if not _fits(node, last):
            continue
        steps, up = list(above), node.parent
        while steps and up is not None:
            if _fits(up, steps[-1]):
                steps.pop()
            up = up.parent
        if not steps:
            found.append(node)
    return found
