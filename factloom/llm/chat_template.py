"""A small template language for conversations: parsed to a syntax tree, folded, and compiled to Python closures.

{{ expression }}, {% if %} {% elif %} {% else %} {% endif %}, {% for x in list %} {% endfor %}, {% set x = expression %},
{% generation %} {% endgeneration %}, {# comments #}; a dash inside a delimiter strips the blanks beside it. Expressions have
literals, names, .key and [key], and, or, not, comparisons, in, + - * // %, ~ (joins as text), `a if c else b`, filters after |
and tests after `is`. What stands between the generation marks is recorded as spans of the output, in code points.

The sandbox: a template sees what it is given and what it sets, keys of mappings, items of lists, and the filters named here. It
calls nothing else, reads no attribute of an object, multiplies numbers only, and makes a bounded number of turns of its loops.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

MOST_TURNS = 10_000_000
CHUNK = re.compile(r"""\{(?:\#.*?\#|(?P<kind>[{%])(?P<left>-?)(?P<body>(?:'[^']*'|"[^"]*"|[^'"])*?)(?P<right>-?)[}%])\}""", re.S)
WORD = re.compile(r"""\s*(?:(?P<num>\d+)|(?P<str>'[^']*'|"[^"]*")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|//|[-+*%~<>()\[\].,|=])|(?P<end>$)|(?P<bad>.))""", re.S)
FILTERS: dict[str, Callable] = {
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": len,
    "string": lambda x: _text(x),
    "default": lambda x, other="": other if x is None else x,
    "join": lambda x, by="": by.join(map(_text, x)),
    "tojson": lambda x: json.dumps(x, ensure_ascii=False),
}
TESTS: dict[str, Callable] = {"defined": lambda x: x is not None, "none": lambda x: x is None, "string": lambda x: isinstance(x, str), "mapping": lambda x: isinstance(x, Mapping)}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Node:
    """A node of the syntax tree; what the parts are depends on the kind."""

    kind: str
    parts: tuple = ()


@dataclass
class Output:
    """Rendered text in parts, its length in code points, and the spans between generation marks."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    turns: int = 0

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _text(x) -> str:
    return "" if x is None else str(x) if not isinstance(x, bool) else ("true" if x else "false")


def _words(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while True:
        m = WORD.match(source, at)
        if m.lastgroup == "bad":
            raise TemplateError(f"no expression: {source!r} at {m.start('bad')}")
        out.append((m.lastgroup, m[m.lastgroup]))
        if m.lastgroup == "end":
            return out
        at = m.end()


class _Expression:
    """Precedence climbing over the words of one expression."""

    LEVELS = [["or"], ["and"], None, ["==", "!=", "<", "<=", ">", ">=", "in", "not in", "is"], ["~"], ["+", "-"], ["*", "//", "%"]]

    def __init__(self, source: str):
        self.source, self.words, self.at = source, _words(source), 0

    def peek(self, *texts: str) -> bool:
        kind, text = self.words[self.at]
        return kind in ("name", "op") and text in texts

    def take(self, *texts: str) -> bool:
        found = self.peek(*texts)
        self.at += found
        return found

    def need(self, kind: str, text: str | None = None) -> str:
        k, t = self.words[self.at]
        if k != kind or text is not None and t != text:
            raise TemplateError(f"{text or kind} is missing in {self.source!r}")
        self.at += 1
        return t

    def whole(self) -> Node:
        out = self.choice()
        self.need("end")
        return out

    def choice(self) -> Node:
        value = self.level(0)
        if self.take("if"):
            test = self.level(0)
            other = self.choice() if self.take("else") else Node("const", (None,))
            return Node("choice", (test, value, other))
        return value

    def level(self, n: int) -> Node:
        if n == len(self.LEVELS):
            return self.unary()
        if self.LEVELS[n] is None:
            return Node("not", (self.level(n),)) if self.take("not") else self.level(n + 1)
        left = self.level(n + 1)
        while True:
            if "in" in self.LEVELS[n] and self.peek("not") and self.words[self.at + 1] == ("name", "in"):
                self.at += 2
                left = Node("not", (Node("in", (left, self.level(n + 1))),))
            elif "is" in self.LEVELS[n] and self.take("is"):
                no = self.take("not")
                name = self.need("name")
                if name not in TESTS:
                    raise TemplateError(f"no test {name}")
                left = Node("not", (Node("test", (name, left)),)) if no else Node("test", (name, left))
            elif self.peek(*self.LEVELS[n]):
                op = self.words[self.at][1]
                self.at += 1
                left = Node(op, (left, self.level(n + 1)))
            else:
                return left

    def unary(self) -> Node:
        if self.take("-"):
            return Node("negative", (self.unary(),))
        return self.postfix(self.atom())

    def atom(self) -> Node:
        kind, text = self.words[self.at]
        self.at += 1
        if kind == "num":
            return Node("const", (int(text),))
        if kind == "str":
            return Node("const", (re.sub(r"\\([nt\\])", lambda m: {"n": "\n", "t": "\t", "\\": "\\"}[m[1]], text[1:-1]),))
        if kind == "name":
            known = {"true": True, "false": False, "none": None}
            if text.lower() in known:
                return Node("const", (known[text.lower()],))
            if text.startswith("_"):
                raise TemplateError(f"no name {text}")
            return Node("name", (text,))
        if text == "(":
            out = self.choice()
            self.need("op", ")")
            return out
        raise TemplateError(f"no expression: {self.source!r}")

    def postfix(self, value: Node) -> Node:
        while True:
            if self.take("."):
                value = Node("item", (value, Node("const", (self.need("name"),))))
            elif self.take("["):
                value = Node("item", (value, self.choice()))
                self.need("op", "]")
            elif self.take("|"):
                name, args = self.need("name"), []
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        self.take(",")
                value = Node("filter", (name, value, *args))
            else:
                return value


def parse(source: str) -> list[Node]:
    """The syntax tree of a template: a list of statements."""
    stack: list[tuple[str, list, list[Node]]] = [("", [], [])]
    at, strip = 0, False

    def text(piece: str, last: bool) -> None:
        piece = piece.lstrip() if strip else piece
        piece = piece.rstrip() if last else piece
        if piece:
            stack[-1][2].append(Node("text", (piece,)))

    def close(tag: str) -> tuple[list, list[Node]]:
        if stack[-1][0] != tag:
            raise TemplateError(f"end{tag} closes nothing")
        return stack.pop()[1:]

    for m in CHUNK.finditer(source):
        text(source[at : m.start()], m["left"] == "-")
        at, strip = m.end(), m["right"] == "-"
        if m["kind"] is None:
            continue
        body = m["body"].strip()
        if m["kind"] == "{":
            stack[-1][2].append(Node("out", (_Expression(body).whole(),)))
            continue
        tag, _, rest = body.partition(" ")
        if tag == "if":
            stack.append(("if", [[_Expression(rest).whole(), None]], []))
        elif tag in ("elif", "else"):
            branches, nodes = close("if")
            branches[-1][1] = nodes
            stack.append(("if", [*branches, [_Expression(rest).whole() if tag == "elif" else Node("const", (True,)), None]], []))
        elif tag == "endif":
            branches, nodes = close("if")
            branches[-1][1] = nodes
            stack[-1][2].append(Node("if", tuple((test, tuple(b)) for test, b in branches)))
        elif tag == "for" and (f := re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)):
            stack.append(("for", [f[1], _Expression(f[2]).whole()], []))
        elif tag == "endfor":
            (name, of), nodes = close("for")
            stack[-1][2].append(Node("for", (name, of, tuple(nodes))))
        elif tag == "set" and (f := re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest, re.S)):
            stack[-1][2].append(Node("set", (f[1], _Expression(f[2]).whole())))
        elif tag == "generation":
            stack.append(("generation", [], []))
        elif tag == "endgeneration":
            _, nodes = close("generation")
            stack[-1][2].append(Node("generation", (tuple(nodes),)))
        else:
            raise TemplateError(f"no statement: {body!r}")
    text(source[at:], False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return stack[0][2]


def _is_const(node: Node) -> bool:
    return node.kind == "const"


def folded(nodes, filters: Mapping[str, Callable]) -> list[Node]:
    """The same statements with constant expressions computed, dead branches gone and neighbouring texts joined."""
    out: list[Node] = []

    def add(node: Node) -> None:
        if node.kind == "text" and out and out[-1].kind == "text":
            out[-1] = Node("text", (out[-1].parts[0] + node.parts[0],))
        elif node.kind != "text" or node.parts[0]:
            out.append(node)

    for node in nodes:
        if node.kind == "out":
            value = fold(node.parts[0], filters)
            add(Node("text", (_text(value.parts[0]),)) if _is_const(value) else Node("out", (value,)))
        elif node.kind == "if":
            kept = []
            for test, body in node.parts:
                test = fold(test, filters)
                if _is_const(test) and not test.parts[0]:
                    continue
                kept.append((test, tuple(folded(body, filters))))
                if _is_const(test):
                    break
            if kept and _is_const(kept[0][0]):
                for inner in kept[0][1]:
                    add(inner)
            elif kept:
                add(Node("if", tuple(kept)))
        elif node.kind == "for":
            add(Node("for", (node.parts[0], fold(node.parts[1], filters), tuple(folded(node.parts[2], filters)))))
        elif node.kind == "set":
            add(Node("set", (node.parts[0], fold(node.parts[1], filters))))
        elif node.kind == "generation":
            add(Node("generation", (tuple(folded(node.parts[0], filters)),)))
        else:
            add(node)
    return out


def fold(node: Node, filters: Mapping[str, Callable]) -> Node:
    parts = tuple(fold(p, filters) if isinstance(p, Node) else p for p in node.parts)
    node = Node(node.kind, parts)
    if node.kind not in ("const", "name") and all(_is_const(p) for p in parts if isinstance(p, Node)):
        return Node("const", (expression(node, filters)({}),))
    if node.kind == "choice" and _is_const(parts[0]):
        return parts[1] if parts[0].parts[0] else parts[2]
    return node


def _item(x, key):
    if isinstance(x, Mapping):
        return x.get(key)
    if isinstance(x, (list, tuple)) and isinstance(key, int):
        return x[key] if -len(x) <= key < len(x) else None
    if isinstance(x, str) and isinstance(key, int):
        return x[key : key + 1] if key >= 0 else x[key:][:1]
    return None


def _number(x):
    if isinstance(x, bool) or not isinstance(x, int):
        raise TemplateError(f"no number: {x!r}")
    return x


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: b is not None and a in b,
    "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: a + b,
    "-": lambda a, b: _number(a) - _number(b),
    "*": lambda a, b: _number(a) * _number(b),
    "//": lambda a, b: _number(a) // _number(b),
    "%": lambda a, b: _number(a) % _number(b),
}


def expression(node: Node, filters: Mapping[str, Callable]) -> Callable[[Mapping], object]:
    """A closure that gives the expression's value in a scope."""
    kind, parts = node.kind, node.parts
    made = [expression(p, filters) for p in parts if isinstance(p, Node)]
    if kind == "const":
        value = parts[0]
        return lambda scope: value
    if kind == "name":
        name = parts[0]
        return lambda scope: scope.get(name)
    if kind == "item":
        of, key = made
        if _is_const(parts[1]):
            at = parts[1].parts[0]
            return lambda scope: _item(of(scope), at)
        return lambda scope: _item(of(scope), key(scope))
    if kind == "choice":
        test, yes, no = made
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if kind == "and":
        a, b = made
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        a, b = made
        return lambda scope: a(scope) or b(scope)
    if kind == "not":
        (a,) = made
        return lambda scope: not a(scope)
    if kind == "negative":
        (a,) = made
        return lambda scope: -_number(a(scope))
    if kind == "test":
        (a,), test = made, TESTS[parts[0]]
        return lambda scope: test(a(scope))
    if kind == "filter":
        a, *args = made
        if parts[0] not in filters:
            raise TemplateError(f"no filter {parts[0]}")
        f = filters[parts[0]]
        return (lambda scope: f(a(scope), *[x(scope) for x in args])) if args else (lambda scope: f(a(scope)))
    a, b = made
    op = OPERATORS[kind]
    return lambda scope: op(a(scope), b(scope))


def statements(nodes, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    """A closure that renders statements into an output."""
    made = [_statement(n, filters) for n in nodes]
    if len(made) == 1:
        return made[0]

    def run(scope: dict, out: Output) -> None:
        for f in made:
            f(scope, out)

    return run


def _statement(node: Node, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    if node.kind == "text":
        text = node.parts[0]
        return lambda scope, out: out.add(text)
    if node.kind == "out":
        value = expression(node.parts[0], filters)
        return lambda scope, out: out.add(_text(value(scope)))
    if node.kind == "set":
        name, value = node.parts[0], expression(node.parts[1], filters)
        return lambda scope, out: scope.__setitem__(name, value(scope))
    if node.kind == "generation":
        inner = statements(node.parts[0], filters)

        def marked(scope: dict, out: Output) -> None:
            start = out.length
            inner(scope, out)
            out.spans.append((start, out.length))

        return marked
    if node.kind == "if":
        branches = [(expression(test, filters), statements(body, filters)) for test, body in node.parts]

        def choose(scope: dict, out: Output) -> None:
            for test, body in branches:
                if test(scope):
                    return body(scope, out)

        return choose
    name, of, body = node.parts[0], expression(node.parts[1], filters), statements(node.parts[2], filters)

    def loop(scope: dict, out: Output) -> None:
        values = of(scope) or []
        if not isinstance(values, (list, tuple)):
            raise TemplateError("loops go over lists")
        out.turns += len(values)
        if out.turns > MOST_TURNS:
            raise TemplateError("too many turns of loops")
        for i, value in enumerate(values):
            body({**scope, name: value, "loop": {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(values) - 1, "length": len(values)}}, out)

    return loop


def names(nodes) -> set[str]:
    """Names that statements or expressions read."""
    found: set[str] = set()

    def walk(x) -> None:
        if isinstance(x, Node):
            if x.kind == "name":
                found.add(x.parts[0])
            for p in x.parts:
                walk(p)
        elif isinstance(x, tuple):
            for p in x:
                walk(p)

    walk(tuple(nodes))
    return found


class Template:
    """A compiled template. `filters` are added to those of the language."""

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None):
        self.filters = {**FILTERS, **(filters or {})}
        self.tree = folded(parse(source), self.filters)
        self._render = statements(self.tree, self.filters)
        self._turn = None
        if len(self.tree) == 1 and self.tree[0].kind == "for":
            name, of, body = self.tree[0].parts
            if of == Node("name", ("messages",)) and names(body) <= {name}:
                self._name, self._turn = name, statements(body, self.filters)

    @property
    def by_turn(self) -> bool:
        """Is it one loop over the messages, and a turn's text a function of the turn alone?"""
        return self._turn is not None

    def render(self, messages: list[Mapping], **given) -> Output:
        out = Output()
        self._render({**given, "messages": messages}, out)
        return out

    def render_turn(self, message: Mapping, out: Output) -> None:
        """Adds one turn's text to an output; for templates by turn."""
        self._turn({self._name: message}, out)
