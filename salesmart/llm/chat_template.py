"""A small sandboxed template language for conversations, compiled to Python closures.

A template is text with ``{{ expression }}``, ``{# remark #}`` and the tags ``if`` / ``elif`` /
``else`` / ``endif``, ``set name = expression``, ``generation`` / ``endgeneration`` (what lies
between bears loss) and one ``for message in messages`` / ``endfor`` at the outermost level. What
stands before and after the loop sees only constants, so a conversation can be rendered turn by
turn, and its turns in any number of tasks.

Expressions know strings, integers, ``true``, ``false``, ``none``, names, ``message.field`` for the
fields in ``FIELDS``, ``loop.first``, ``loop.last``, ``loop.index``, ``loop.index0``, ``not``,
``and``, ``or``, ``==``, ``!=``, ``~`` (joins texts) and filters ``value | name``. There are no
calls, no attribute access on Python objects, no other loops and no other names: a template that
uses one is refused when it is compiled, as is one that is longer or more deeply nested than
``MOST_LENGTH`` and ``MOST_DEPTH``. Rendering costs time in proportion to template and texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

MOST_LENGTH = 100_000
MOST_DEPTH = 50
FIELDS = ("role", "text")
LOOP = ("first", "last", "index", "index0")

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


class TemplateError(ValueError):
    """The template is not of this language."""


def escape(text: str) -> str:
    """No ``<|`` is left: one backslash more stands between every ``<`` and ``|`` that only backslashes part."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def label(text: str) -> str:
    """``escape`` for a one-line field: line feeds and backslashes are spelled."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unlabel(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "label": label, "trim": str.strip, "upper": str.upper, "lower": str.lower,
}


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: str
    name: str


@dataclass(frozen=True)
class Filter:
    value: object
    name: str


@dataclass(frozen=True)
class Not:
    value: object


@dataclass(frozen=True)
class Both:
    """``and``, ``or``, ``==``, ``!=`` and ``~``."""

    sign: str
    left: object
    right: object


@dataclass(frozen=True)
class Text:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Let:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|([A-Za-z_]\w*)|(\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*')|(==|!=|[~|.()]))", re.S)
_SPELLED = {"n": "\n", "t": "\t"}
_KEYWORDS = {"true": True, "false": False, "none": None}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, end = 0, len(source.rstrip())
        while at < end:
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            kind = ("int", "name", "str", "sign")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at, self.depth = 0, 0

    def whole(self) -> object:
        found = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def chain(self, below: Callable[[], object], *signs: str) -> object:
        left = below()
        while sign := self.take(*signs):
            left = Both(sign, left, below())
        return left

    def either(self) -> object:
        return self.chain(self.all, "or")

    def all(self) -> object:
        return self.chain(self.negated, "and")

    def negated(self) -> object:
        if self.take("not"):
            self.deeper()
            return Not(self.negated())
        return self.chain(self.joined, "==", "!=")

    def joined(self) -> object:
        return self.chain(self.filtered, "~")

    def filtered(self) -> object:
        value = self.primary()
        while self.take("|"):
            kind, name = self.next()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Filter(value, name)
        return value

    def deeper(self) -> None:
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise TemplateError("too deeply nested")

    def next(self) -> tuple[str, str]:
        if self.at == len(self.tokens):
            raise TemplateError("expression ends early")
        self.at += 1
        return self.tokens[self.at - 1]

    def primary(self) -> object:
        kind, value = self.next()
        if kind == "int":
            return Const(int(value))
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _SPELLED.get(m[1], m[1]), value[1:-1], flags=re.S))
        if value == "(":
            self.deeper()
            found = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return found
        if kind != "name" or value in ("and", "or", "not"):
            raise TemplateError(f"unexpected {value!r}")
        if value in _KEYWORDS:
            return Const(_KEYWORDS[value])
        if self.take("."):
            kind, field = self.next()
            if kind != "name":
                raise TemplateError(f"no field {field!r}")
            return Field(value, field)
        return Name(value)


class _Parser:
    """Tags to a syntax tree."""

    def __init__(self, source: str):
        if len(source) > MOST_LENGTH:
            raise TemplateError("too long")
        self.items: list[tuple[str, str]] = []
        at = 0
        for m in _TAG.finditer(source):
            self.items.append(("text", source[at : m.start()]))
            if m[1] is not None:
                self.items.append(("value", m[1]))
            elif m[2] is not None:
                self.items.append(("tag", m[2].strip()))
            at = m.end()
        self.items.append(("text", source[at:]))
        self.at = 0

    def block(self, *ends: str, depth: int = 0) -> tuple[tuple, str]:
        """Nodes up to one of the tags, and that tag."""
        if depth > MOST_DEPTH:
            raise TemplateError("too deeply nested")
        found: list = []
        while self.at < len(self.items):
            kind, value = self.items[self.at]
            self.at += 1
            if kind == "text":
                if value:
                    found.append(Text(Const(value)))
                continue
            if kind == "value":
                found.append(Text(_Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return tuple(found), value
            if word == "if":
                found.append(self.choice(rest, depth))
            elif word == "set":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {value!r}")
                found.append(Let(m[1], _Expression(m[2]).whole()))
            elif word == "generation" and not rest:
                body, _ = self.block("endgeneration", depth=depth + 1)
                found.append(Generation(body))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
                if not m or depth or any(isinstance(x, For) for x in found):
                    raise TemplateError("there is one loop, over messages, at the outermost level")
                body, _ = self.block("endfor", depth=depth + 1)
                found.append(For(m[1], body))
            else:
                raise TemplateError(f"unexpected tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(found), ""

    def choice(self, test: str, depth: int) -> If:
        then, end = self.block("elif", "else", "endif", depth=depth + 1)
        word, _, rest = end.partition(" ")
        if word == "elif":
            other: tuple = (self.choice(rest, depth + 1),)
        elif word == "else":
            other, _ = self.block("endif", depth=depth + 1)
        else:
            other = ()
        return If(_Expression(test).whole(), then, other)


def parse(source: str) -> tuple:
    """Syntax tree of a template."""
    return _Parser(source).block()[0]


def shown(value: object) -> str:
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


_SIGNS: dict[str, Callable[[object, object], object]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "~": lambda a, b: shown(a) + shown(b),
}


def fold(node: object, known: dict[str, object]) -> object:
    """The expression with all that does not depend on a message worked out."""
    if isinstance(node, Name) and node.name in known:
        return Const(known[node.name])
    if isinstance(node, Filter):
        value = fold(node.value, known)
        return Const(FILTERS[node.name](shown(value.value))) if isinstance(value, Const) else Filter(value, node.name)
    if isinstance(node, Not):
        value = fold(node.value, known)
        return Const(not value.value) if isinstance(value, Const) else Not(value)
    if isinstance(node, Both):
        left, right = fold(node.left, known), fold(node.right, known)
        if node.sign in ("and", "or"):
            if not isinstance(left, Const):
                return Both(node.sign, left, right)
            return right if bool(left.value) == (node.sign == "and") else left
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(_SIGNS[node.sign](left.value, right.value))
        return Both(node.sign, left, right)
    return node


def fold_block(nodes: tuple, known: dict[str, object]) -> tuple:
    """The nodes with constant expressions worked out, dead branches gone and neighbouring texts joined.

    ``known`` gains the constants that ``set`` names; a name that is set to anything else, or in a
    branch, is known no longer.
    """
    found: list = []

    def add(node: object) -> None:
        if isinstance(node, Text) and isinstance(node.value, Const):
            text = shown(node.value.value)
            if found and isinstance(found[-1], Text) and isinstance(found[-1].value, Const):
                text = found.pop().value.value + text
            if text:
                found.append(Text(Const(text)))
        else:
            found.append(node)

    for node in nodes:
        if isinstance(node, Text):
            add(Text(fold(node.value, known)))
        elif isinstance(node, Let):
            value = fold(node.value, known)
            known.pop(node.name, None)
            if isinstance(value, Const):
                known[node.name] = value.value
            found.append(Let(node.name, value))
        elif isinstance(node, If):
            test = fold(node.test, known)
            if isinstance(test, Const):
                for x in fold_block(node.then if test.value else node.other, known):
                    add(x)
                continue
            sides = tuple(fold_block(side, dict(known)) for side in (node.then, node.other))
            for name in _set_names(sides):
                known.pop(name, None)
            found.append(If(test, *sides))
        elif isinstance(node, Generation):
            found.append(Generation(fold_block(node.body, known)))
        else:
            found.append(For(node.name, fold_block(node.body, {k: v for k, v in known.items() if k not in {node.name, *_set_names(node.body)}})))
    return tuple(found)


def _set_names(nodes: object) -> set[str]:
    if isinstance(nodes, tuple):
        return {name for x in nodes for name in _set_names(x)}
    if isinstance(nodes, Let):
        return {nodes.name}
    if isinstance(nodes, If):
        return _set_names(nodes.then) | _set_names(nodes.other)
    return _set_names(nodes.body) if isinstance(nodes, (Generation, For)) else set()


Env = dict[str, object]
Out = list[tuple[str, bool]]


def _value(node: object, names: set[str], message: str | None) -> Callable[[Env], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name
        if name not in names:
            raise TemplateError(f"no name {name!r}")
        return lambda env: env.get(name)
    if isinstance(node, Field):
        if node.of == message and node.name in FIELDS or node.of == "loop" and message and node.name in LOOP:
            key = f"{'loop' if node.of == 'loop' else 'message'}.{node.name}"
            return lambda env: env[key]
        raise TemplateError(f"no field {node.of}.{node.name}")
    if isinstance(node, Filter):
        inner, change = _value(node.value, names, message), FILTERS[node.name]
        return lambda env: change(shown(inner(env)))
    if isinstance(node, Not):
        inner = _value(node.value, names, message)
        return lambda env: not inner(env)
    left, right = _value(node.left, names, message), _value(node.right, names, message)
    if node.sign == "and":
        return lambda env: left(env) and right(env)
    if node.sign == "or":
        return lambda env: left(env) or right(env)
    sign = _SIGNS[node.sign]
    return lambda env: sign(left(env), right(env))


def _run(nodes: tuple, names: set[str], message: str | None, loss: bool) -> Callable[[Env, Out], None]:
    """A closure that appends (text, bears loss) of the nodes."""
    steps: list[Callable[[Env, Out], None]] = []
    for node in nodes:
        if isinstance(node, Text):
            if isinstance(node.value, Const):
                steps.append(lambda env, out, piece=(shown(node.value.value), loss): out.append(piece))
            else:
                steps.append(lambda env, out, f=_value(node.value, names, message): out.append((shown(f(env)), loss)))
        elif isinstance(node, Let):
            if node.name in ("loop", "messages", message):
                raise TemplateError(f"{node.name!r} cannot be set")
            steps.append(lambda env, out, name=node.name, f=_value(node.value, names, message): env.__setitem__(name, f(env)))
            names.add(node.name)
        elif isinstance(node, If):
            test, sides = _value(node.test, names, message), [_run(x, names, message, loss) for x in (node.then, node.other)]
            steps.append(lambda env, out, test=test, sides=sides: sides[0](env, out) if test(env) else sides[1](env, out))
        else:
            if loss:
                raise TemplateError("generation within generation")
            steps.append(_run(node.body, names, message, True))

    def run(env: Env, out: Out) -> None:
        for step in steps:
            step(env, out)

    return run


class Template:
    """A compiled template. ``constants`` are the names that its expressions may use."""

    def __init__(self, source: str, **constants: str | int | bool | None):
        self.tree = fold_block(parse(source), dict(constants))
        loops = [k for k, x in enumerate(self.tree) if isinstance(x, For)]
        if not loops:
            raise TemplateError("no loop over messages")
        before, loop, after = self.tree[: loops[0]], self.tree[loops[0]], self.tree[loops[0] + 1 :]
        names = set(constants)
        self._before = _run(before, names, None, False)
        self._turn = _run(loop.body, set(names), loop.name, False)
        self._after = _run(after, names, None, False)
        self._start = dict(constants)
        head: Out = []
        self._before(self._start, head)
        self._head = [(text, bears) for text, bears in head if text]

    def turn(self, role: str, text: str, index: int, last: bool) -> Out:
        """(text, bears loss) of one turn; the first also holds what stands before the loop, the last what follows it."""
        first = index == 0
        out: Out = list(self._head) if first else []
        env = self._start | {
            "message.role": role, "message.text": text,
            "loop.first": first, "loop.last": last, "loop.index": index + 1, "loop.index0": index,
        }
        self._turn(env, out)
        if last:
            self._after(dict(self._start), out)
        return out


def marked(pieces: Out) -> tuple[str, list[tuple[int, int]]]:
    """The joined text and the code point spans that bear loss; touching spans are one."""
    spans: list[tuple[int, int]] = []
    at = 0
    for text, loss in pieces:
        if loss and text:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        at += len(text)
    return "".join(text for text, _ in pieces), spans
