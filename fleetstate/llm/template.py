"""A small template language for conversations, compiled to Python closures.

    {{ expression }}   {% if a %}..{% elif b %}..{% else %}..{% endif %}   {% for m in messages %}..{% endfor %}
    {% set name = expression %}   {% generation %}..{% endgeneration %}   {# comment #}

Expressions: strings, whole numbers, true, false, none, names, m.key, m['key'], loop.first, loop.index0, not, and, or,
==, !=, in, + and ~ (join as text), "a if c else b", and filters after |: upper, lower, trim, length, title, escape.
A minus inside a tag's bracket ({%- -%}, {{- -}}) eats the white space on that side.

The language is sandboxed: there are no calls, no attributes of objects (m.key reads a mapping), and no names beyond
those given to `render` and set in the template. Parts without names are worked out when the template is compiled, and
branches that cannot be reached are dropped. `messages` may be looped over once, so that it can be a stream.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

#: What a rendering yields between the turns of a loop over messages.
TURN = object()


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Apply:
    """An operator or a filter and its arguments."""

    what: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Block:
    items: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: Block
    other: Block


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: Block


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: Block


@lru_cache(maxsize=16)
def _marks(controls: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    parts = "|".join(rf"(?<={re.escape(c[0])})(\\*)(?={re.escape(c[1:])})" for c in controls)
    return re.compile(parts), re.compile(parts.replace(r"(\\*)", r"(\\+)"))


def escape(text: str, controls: tuple[str, ...]) -> str:
    """Break each control string by one more backslash after its first character than it has there already."""
    return _marks(controls)[0].sub(lambda m: m.group() + "\\", text) if controls else text


def unescape(text: str, controls: tuple[str, ...]) -> str:
    return _marks(controls)[1].sub(lambda m: m.group()[1:], text) if controls else text


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _operators(controls: tuple[str, ...]) -> dict[str, Callable]:
    return {
        "==": lambda a, b: a == b,
        "!=": lambda a, b: a != b,
        "in": lambda a, b: _text(a) in _text(b),
        "~": lambda a, b: _text(a) + _text(b),
        "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
        "not": lambda a: not a,
        "upper": lambda a: _text(a).upper(),
        "lower": lambda a: _text(a).lower(),
        "title": lambda a: _text(a).title(),
        "trim": lambda a: _text(a).strip(),
        "length": lambda a: len(_text(a)),
        "escape": lambda a: escape(_text(a), controls),
    }


_TAG = re.compile(r"\{\{-?(?P<out>.*?)-?\}\}|\{%-?(?P<do>.*?)-?%\}|\{#(?P<note>.*?)#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[|.~+()\[\]=]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
_FILTERS = ("upper", "lower", "title", "trim", "length", "escape")


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, token = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == "text" else token

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and self.at < len(self.tokens):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, token: str) -> None:
        if not self.take(token):
            raise TemplateError(f"expected {token!r}")

    def name(self) -> str:
        kind, token = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return token

    def whole(self):
        out = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def choice(self):
        value = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            value = Apply("if", (test, value, self.choice()))
        return value

    def either(self):
        value = self.both()
        while self.take("or"):
            value = Apply("or", (value, self.both()))
        return value

    def both(self):
        value = self.negated()
        while self.take("and"):
            value = Apply("and", (value, self.negated()))
        return value

    def negated(self):
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        value = self.joined()
        if sign := self.take("==", "!=", "in"):
            value = Apply(sign, (value, self.joined()))
        return value

    def joined(self):
        value = self.filtered()
        while sign := self.take("+", "~"):
            value = Apply(sign, (value, self.filtered()))
        return value

    def filtered(self):
        value = self.reached()
        while self.take("|"):
            name = self.name()
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Apply(name, (value,))
        return value

    def reached(self):
        value = self.atom()
        while True:
            if self.take("."):
                value = Key(value, Const(self.name()))
            elif self.take("["):
                value = Key(value, self.choice())
                self.need("]")
            else:
                return value

    def atom(self):
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(token))
        if kind == "name":
            return Const(_WORDS[token]) if token in _WORDS else Name(token)
        raise TemplateError(f"unexpected {token!r}")


def parse(source: str) -> Block:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _TAG.finditer(source):
        before = source[at : m.start()]
        if pieces and pieces[-1][2]:
            before = before.lstrip()
        if m.group().startswith(("{%-", "{{-")):
            before = before.rstrip()
        pieces.append(("text", before, False))
        kind = m.lastgroup
        pieces.append((kind, m[kind], m.group().endswith(("-%}", "-}}"))))
        at = m.end()
    rest = source[at:]
    pieces.append(("text", rest.lstrip() if pieces and pieces[-1][2] else rest, False))
    if any(kind == "text" and re.search(r"\{[{%#]", body) for kind, body, _ in pieces):
        raise TemplateError("a tag has no end")
    block, left = _block(pieces, 0, ())
    if left != len(pieces):
        raise TemplateError(f"unexpected {pieces[left][1].strip()!r}")
    return block


def _block(pieces: list, at: int, ends: tuple[str, ...]) -> tuple[Block, int]:
    items = []
    while at < len(pieces):
        kind, body, _ = pieces[at]
        if kind == "text":
            items += [Text(body)] if body else []
        elif kind == "out":
            items.append(Output(_Expression(body).whole()))
        elif kind == "do":
            words = body.split()
            head = words[0] if words else ""
            if head in ends:
                return Block(tuple(items)), at
            if head == "if":
                node, at = _if(pieces, at, body.strip()[2:])
            elif head == "for":
                e = _Expression(body.strip()[3:])
                name = e.name()
                e.need("in")
                over = e.whole()
                inner, at = _block(pieces, at + 1, ("endfor",))
                node = For(name, over, inner)
            elif head == "generation":
                inner, at = _block(pieces, at + 1, ("endgeneration",))
                node = Generation(inner)
            elif head == "set":
                e = _Expression(body.strip()[3:])
                name = e.name()
                e.need("=")
                node = Set(name, e.whole())
            else:
                raise TemplateError(f"unknown tag {body.strip()!r}")
            if at >= len(pieces):
                raise TemplateError(f"{head} has no end")
            items.append(node)
        at += 1
    if ends:
        raise TemplateError(f"expected {' or '.join(ends)}")
    return Block(tuple(items)), at


def _if(pieces: list, at: int, test: str) -> tuple[If, int]:
    then, at = _block(pieces, at + 1, ("elif", "else", "endif"))
    tag = pieces[at][1].strip()
    if tag.startswith("elif"):
        other, at = _if(pieces, at, tag[4:])
        return If(_Expression(test).whole(), then, Block((other,))), at
    other = Block(())
    if tag == "else":
        other, at = _block(pieces, at + 1, ("endif",))
    return If(_Expression(test).whole(), then, other), at


def fold(node, operators: dict[str, Callable]):
    """The same tree with all parts worked out that hold no names, texts side by side joined, and dead branches gone."""
    if isinstance(node, Key):
        return Key(fold(node.of, operators), fold(node.key, operators))
    if isinstance(node, Apply):
        args = tuple(fold(a, operators) for a in node.args)
        first = args[0]
        if node.what == "if" and isinstance(first, Const):
            return args[1] if first.value else args[2]
        if node.what in ("and", "or") and isinstance(first, Const):
            return args[1] if bool(first.value) == (node.what == "and") else first
        if node.what in operators and all(isinstance(a, Const) for a in args):
            return Const(operators[node.what](*(a.value for a in args)))
        return Apply(node.what, args)
    if isinstance(node, Block):
        items: list = []
        for item in node.items:
            item = fold(item, operators)
            for x in item.items if isinstance(item, Block) else (item,):
                if isinstance(x, Text) and items and isinstance(items[-1], Text):
                    items[-1] = Text(items[-1].value + x.value)
                elif not (isinstance(x, Text) and not x.value):
                    items.append(x)
        return Block(tuple(items))
    if isinstance(node, Output):
        value = fold(node.value, operators)
        return Text(_text(value.value)) if isinstance(value, Const) else Output(value)
    if isinstance(node, If):
        test = fold(node.test, operators)
        then, other = fold(node.then, operators), fold(node.other, operators)
        if isinstance(test, Const):
            return then if test.value else other
        return If(test, then, other)
    if isinstance(node, For):
        return For(node.name, fold(node.over, operators), fold(node.body, operators))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value, operators))
    if isinstance(node, Generation):
        return Generation(fold(node.body, operators))
    return node


def _value(node, operators: dict[str, Callable]) -> Callable[[dict], object]:
    """A closure that works out an expression from the names in scope."""
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        return lambda scope, n=node.name: scope.get(n)
    if isinstance(node, Key):
        of, key = _value(node.of, operators), _value(node.key, operators)

        def read(scope):
            mapping = of(scope)
            return mapping.get(key(scope)) if isinstance(mapping, Mapping) else None

        return read
    args = [_value(a, operators) for a in node.args]
    if node.what == "if":
        return lambda scope: args[1](scope) if args[0](scope) else args[2](scope)
    if node.what == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.what == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    call = operators[node.what]
    if len(args) == 1:
        return lambda scope, a=args[0]: call(a(scope))
    return lambda scope, a=args[0], b=args[1]: call(a(scope), b(scope))


def _writer(node, operators: dict[str, Callable], marked: bool) -> Callable[[dict], Iterator]:
    """A closure that yields (text, whether it is generated), and TURN after each turn of a loop over messages."""
    if isinstance(node, Text):
        piece = (node.value, marked)
        return lambda scope: iter((piece,))
    if isinstance(node, Output):
        value = _value(node.value, operators)
        return lambda scope: iter(((_text(value(scope)), marked),))
    if isinstance(node, Block):
        parts = [_writer(x, operators, marked) for x in node.items]

        def run(scope):
            for part in parts:
                yield from part(scope)

        return run
    if isinstance(node, If):
        test = _value(node.test, operators)
        then, other = _writer(node.then, operators, marked), _writer(node.other, operators, marked)
        return lambda scope: then(scope) if test(scope) else other(scope)
    if isinstance(node, Generation):
        return _writer(node.body, operators, True)
    if isinstance(node, Set):
        value = _value(node.value, operators)

        def put(scope):
            scope[node.name] = value(scope)
            return iter(())

        return put
    over, body = _value(node.over, operators), _writer(node.body, operators, marked)
    outer = node.over == Name("messages")

    def loop(scope):
        for i, item in enumerate(over(scope) or ()):
            yield from body({**scope, node.name: item, "loop": {"index0": i, "first": i == 0}})
            if outer:
                yield TURN

    return loop


def _loops(node) -> int:
    own = isinstance(node, For) and node.over == Name("messages")
    parts = node.items if isinstance(node, Block) else [getattr(node, a) for a in ("then", "other", "body") if hasattr(node, a)]
    return own + sum(_loops(x) for x in parts)


def compile_template(source: str, controls: tuple[str, ...] = ()) -> Callable[[dict], Iterator]:
    """A function from names to pieces. `controls`: strings that the filter escape breaks up."""
    if any(len(c) < 2 for c in controls):
        raise TemplateError("a control string has two characters at least")
    operators = _operators(tuple(controls))
    tree = fold(parse(source), operators)
    if _loops(tree) > 1:
        raise TemplateError("messages can be looped over once")
    write = _writer(tree, operators, False)
    return lambda names: write(dict(names))
