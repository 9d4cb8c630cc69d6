"""A small sandboxed template language, compiled to Python closures.

Source is parsed to a syntax tree, constants are folded, and each node becomes a closure that yields pieces of output, so
that a template renders a conversation of any length while holding one turn.

    {{ expression }}   {% set name = expression %}
    {% for name in expression %} ... {% endfor %}     (inside: loop.index, loop.index0, loop.first, loop.last)
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}          (marks its output as generated)

Expressions have strings, whole numbers, true, false, none, names, ``a.b`` and ``a['b']`` on mappings, ``~`` to join text, ``+ - * %`` on
numbers, comparisons, ``in``, ``and``, ``or``, ``not``, parentheses and filters ``|name``. A ``-`` beside a tag's percent sign or brace strips
the white space there. Templates reach nothing but the values they are given: there are no calls and no attributes of objects, and
an undefined name or key is an error.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping

def escape(text: str) -> str:
    """Backslashes doubled and opening brackets as a backslash and l, so that no control string is left."""
    return text.replace("\\", "\\\\").replace("<", "\\l")


def one_line(text: str) -> str:
    """Line breaks of an escaped text as a backslash and n."""
    return text.replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN.get(m[1], m[1]), text, flags=re.S)


_PLAIN = {"n": "\n", "l": "<"}
FILTERS: dict[str, Callable] = {"escape": escape, "one_line": one_line, "upper": str.upper, "lower": str.lower, "trim": str.strip,
                                "length": len}
_BINARY = {"+": operator.add, "-": operator.sub, "*": operator.mul, "%": operator.mod, "==": operator.eq, "!=": operator.ne,
           "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in"), ("~",), ("+", "-"), ("*", "%"))
_CONSTANTS = {"true": True, "false": False, "none": None}
_TAG = re.compile(r"(\{\{-?|\{%-?)(.*?)(-?\}\}|-?%\})", re.S)
_LEXEME = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+*%~<>().|\[\]=]))""", re.S)
_QUOTED = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """A template that cannot be parsed, or reaches for what it was not given."""


# Expression nodes: ("const", value), ("name", n), ("get", e, key), ("filter", f, e), ("not", e), (operator, a, b).
# Statement nodes: ("text", s), ("print", e), ("set", n, e), ("for", n, e, body), ("if", [(e, body)], other), ("mark", body).


class _Expression:
    """Recursive descent over the lexemes of one tag."""

    def __init__(self, source: str):
        self.lexemes: list[tuple[str, str]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            found = _LEXEME.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.lexemes.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else ("", None)
        return None if kind == "text" else value

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted and self.at < len(self.lexemes):
            self.at += 1
            return True
        return False

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def name(self) -> str:
        kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else ("", "")
        if kind != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return value

    def end(self, node):
        if self.at < len(self.lexemes):
            raise TemplateError(f"unexpected {self.lexemes[self.at][1]!r}")
        return node

    def whole(self):
        return self.end(self.either())

    def either(self):
        node = self.both()
        while self.take("or"):
            node = fold(("or", node, self.both()))
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = fold(("and", node, self.negated()))
        return node

    def negated(self):
        return fold(("not", self.negated())) if self.take("not") else self.binary(0)

    def binary(self, level: int):
        if level == len(_LEVELS):
            return self.filtered()
        node = self.binary(level + 1)
        while (sign := self.peek()) in _LEVELS[level]:
            self.at += 1
            node = fold((sign, node, self.binary(level + 1)))
        return node

    def filtered(self):
        node = self.reached()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = fold(("filter", name, node))
        return node

    def reached(self):
        node = self.atom()
        while True:
            if self.take("."):
                node = fold(("get", node, ("const", self.name())))
            elif self.take("["):
                key = self.either()
                self.need("]")
                node = fold(("get", node, key))
            else:
                return node

    def atom(self):
        if self.take("("):
            node = self.either()
            self.need(")")
            return node
        if self.at == len(self.lexemes):
            raise TemplateError("an expression is missing")
        kind, value = self.lexemes[self.at]
        self.at += 1
        if kind == "text":
            return ("const", re.sub(r"\\(.)", lambda m: _QUOTED.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return ("const", int(value))
        if kind == "name":
            return ("const", _CONSTANTS[value]) if value in _CONSTANTS else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def fold(node):
    """The node, or the constant that it always gives."""
    kind, *parts = node
    inner = [p for p in parts if isinstance(p, tuple)]
    if kind not in ("const", "name") and all(p[0] == "const" for p in inner):
        return ("const", evaluator(node)({}))
    if kind in ("and", "or") and inner[0][0] == "const":
        return inner[1] if bool(inner[0][1]) == (kind == "and") else inner[0]
    return node


def parse(source: str) -> list:
    """The statements of a template, folded."""
    pieces, at, strip = [], 0, False
    for tag in _TAG.finditer(source):
        text = source[at : tag.start()]
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if tag[1].endswith("-") else text))
        if tag[1][:2] == "{{" and not tag[3].endswith("}}") or tag[1][:2] == "{%" and not tag[3].endswith("%}"):
            raise TemplateError("a tag is closed by another sign than it opens with")
        pieces.append(("print" if tag[1][:2] == "{{" else "tag", tag[2].strip()))
        at, strip = tag.end(), tag[3].startswith("-")
    rest = source[at:].lstrip() if strip else source[at:]
    if re.search(r"\{\{|\{%", rest):
        raise TemplateError("a tag is not closed")
    pieces.append(("text", rest))
    pieces.reverse()
    body, closed = _block(pieces, ())
    return body


def _block(pieces: list, ends: tuple[str, ...]) -> tuple[list, str]:
    """Statements up to a tag that begins with one of ``ends``, and that tag."""
    body: list = []
    while pieces:
        kind, source = pieces.pop()
        if kind == "text":
            _add(body, ("text", source))
            continue
        if kind == "print":
            _add(body, ("print", _Expression(source).whole()))
            continue
        word, _, rest = source.partition(" ")
        if word in ends:
            return body, source
        if word == "set":
            reader = _Expression(rest)
            name = reader.name()
            reader.need("=")
            _add(body, ("set", name, reader.whole()))
        elif word == "for":
            reader = _Expression(rest)
            name = reader.name()
            reader.need("in")
            over = reader.whole()
            inner, _ = _block(pieces, ("endfor",))
            _add(body, ("for", name, over, inner))
        elif word == "if":
            branches, other, test = [], [], rest
            while test is not None:
                inner, end = _block(pieces, ("elif", "else", "endif"))
                branches.append((_Expression(test).whole(), inner))
                test = end.partition(" ")[2] if end.startswith("elif") else None
            if end.startswith("else"):
                other, _ = _block(pieces, ("endif",))
            _add_if(body, branches, other)
        elif word == "generation":
            inner, _ = _block(pieces, ("endgeneration",))
            if inner:
                _add(body, ("mark", inner))
        else:
            raise TemplateError(f"unknown tag {source!r}")
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return body, ""


def _add(body: list, node) -> None:
    """Append a statement; constant output becomes text and joins the text before it."""
    if node[0] == "print" and node[1][0] == "const":
        node = ("text", _shown(node[1][1]))
    if node[0] == "text":
        if not node[1]:
            return
        if body and body[-1][0] == "text":
            body[-1] = ("text", body[-1][1] + node[1])
            return
    body.append(node)


def _add_if(body: list, branches: list, other: list) -> None:
    """Append a choice without the branches that are never taken."""
    left = []
    for test, inner in branches:
        if test[0] == "const":
            if not test[1]:
                continue
            other = inner
            break
        left.append((test, inner))
    if left:
        body.append(("if", left, other))
    else:
        for node in other:
            _add(body, node)


def _shown(value) -> str:
    if not isinstance(value, (str, int)) or isinstance(value, bool):
        raise TemplateError(f"{value!r} is neither text nor a number")
    return str(value)


def evaluator(node) -> Callable[[Mapping], object]:
    """A closure that gives the expression's value in an environment."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]

        def look(env):
            if name not in env:
                raise TemplateError(f"{name!r} is not defined")
            return env[name]

        return look
    if kind == "get":
        of, key = evaluator(node[1]), evaluator(node[2])

        def get(env):
            holder, k = of(env), key(env)
            if not isinstance(holder, Mapping) or k not in holder:
                raise TemplateError(f"no {k!r} there")
            return holder[k]

        return get
    if kind == "filter":
        apply, of = FILTERS[node[1]], evaluator(node[2])

        def run(env):
            value = of(env)
            if not isinstance(value, str):
                raise TemplateError(f"filter {node[1]} needs text")
            return apply(value)

        return run
    if kind == "not":
        of = evaluator(node[1])
        return lambda env: not of(env)
    a, b = evaluator(node[1]), evaluator(node[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    if kind == "~":
        return lambda env: _shown(a(env)) + _shown(b(env))
    if kind == "in":
        return lambda env: a(env) in b(env)
    apply = _BINARY[kind]

    def compute(env):
        x, y = a(env), b(env)
        if kind in "+-*%" and not (isinstance(x, int) and isinstance(y, int)):
            raise TemplateError(f"{kind} needs numbers")
        return apply(x, y)

    return compute


Renderer = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def compiled(body: list) -> Renderer:
    """A closure that yields the output of the statements in pieces, each with whether it is generated."""
    steps = [_step(node) for node in body]

    def render(env: dict, marked: bool):
        for step in steps:
            yield from step(env, marked)

    return render


def _step(node) -> Renderer:
    kind = node[0]
    if kind == "text":
        text = node[1]

        def fixed(env, marked):
            yield text, marked

        return fixed
    if kind == "print":
        value = evaluator(node[1])

        def shown(env, marked):
            if text := _shown(value(env)):
                yield text, marked

        return shown
    if kind == "set":
        name, value = node[1], evaluator(node[2])

        def put(env, marked):
            env[name] = value(env)
            return iter(())

        return put
    if kind == "mark":
        inner = compiled(node[1])
        return lambda env, marked: inner(env, True)
    if kind == "if":
        branches, other = [(evaluator(test), compiled(inner)) for test, inner in node[1]], compiled(node[2])

        def choose(env, marked):
            for test, inner in branches:
                if test(env):
                    return inner(env, marked)
            return other(env, marked)

        return choose
    name, over, inner = node[1], evaluator(node[2]), compiled(node[3])

    def loop(env, marked):
        items = over(env)
        if isinstance(items, (str, Mapping)) or not hasattr(items, "__iter__"):
            raise TemplateError("for needs a list")
        rest = iter(items)
        missing = object()
        item, index = next(rest, missing), 0
        while item is not missing:
            after = next(rest, missing)
            own = {**env, name: item, "loop": {"index0": index, "index": index + 1, "first": index == 0, "last": after is missing}}
            yield from inner(own, marked)
            item, index = after, index + 1

    return loop


class Template:
    """A compiled template. ``render`` yields (text, generated) pieces; an iterator given as a list is read once."""

    def __init__(self, source: str):
        self.body = parse(source)
        self._run = compiled(self.body)

    def render(self, **values) -> Iterator[tuple[str, bool]]:
        return self._run(values, False)
