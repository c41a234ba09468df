"""A sandboxed template language, compiled to Python closures.

Templates have text, `{{ expression }}`, and the statements for, if / elif / else, set, and generation, which marks
what a model is to learn. Expressions are literals, names, members of mappings and lists, comparisons,
`and`, `or`, `not`, `in`, joining with `~`, and filters from a fixed list. They reach nothing but the values
given to them: members are keys of mappings or places of lists, never attributes of objects, and there are no calls.

A template is parsed to a syntax tree, constant parts are folded, and each node becomes one closure.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    """A template that cannot be parsed, or that asks for something it was not given."""


# ---- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Member:
    of: Any
    key: Any


@dataclass(frozen=True)
class Filter:
    name: str
    of: Any


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Not:
    of: Any


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Branch:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


_COMPARE = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    ">": operator.gt,
    "<=": operator.le,
    ">=": operator.ge,
    "in": lambda a, b: a in b,
}


def shown(value: Any) -> str:
    """A value as output."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


# ---- parser

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(
    r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>[0-9]+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<op>==|!=|<=|>=|[<>~|.\[\]()=]))",
    re.DOTALL,
)
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_LITERALS = {"true": True, "false": False, "none": None}
_RESERVED = {"and", "or", "not", "in", *_LITERALS}


class _Expression:
    """Recursive descent over the tokens of one expression or statement."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, end = 0, len(source.rstrip())
        while at < end:
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:].strip()!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return wanted[wanted.index(self.tokens[self.at - 1][1])]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def name(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        if kind != "name" or text in _RESERVED:
            raise TemplateError(f"a name is missing, found {text!r}")
        self.at += 1
        return text

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def whole(self) -> Any:
        value = self.either()
        self.end()
        return value

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Binary("or", left, self.both())
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Binary("and", left, self.negated())
        return left

    def negated(self) -> Any:
        return Not(self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.joined()
        while op := self.take(*_COMPARE):
            left = Binary(op, left, self.joined())
        return left

    def joined(self) -> Any:
        left = self.filtered()
        while self.take("~"):
            left = Binary("~", left, self.filtered())
        return left

    def filtered(self) -> Any:
        value = self.member()
        while self.take("|"):
            value = Filter(self.name(), value)
        return value

    def member(self) -> Any:
        value = self.single()
        while op := self.take(".", "["):
            if op == ".":
                value = Member(value, Const(self.name()))
            else:
                value = Member(value, self.either())
                self.need("]")
        return value

    def single(self) -> Any:
        if self.take("("):
            value = self.either()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, text = self.tokens[self.at]
        if kind == "string":
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), text[1:-1], flags=re.DOTALL))
        if kind == "number":
            self.at += 1
            return Const(int(text))
        if kind == "name" and text in _LITERALS:
            self.at += 1
            return Const(_LITERALS[text])
        return Name(self.name())


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    done = 0
    for m in _PARTS.finditer(source):
        parts.append(("text", source[done : m.start()]))
        parts.append(("output", m[1]) if m[1] is not None else ("statement", m[2]))
        done = m.end()
    parts.append(("text", source[done:]))
    at = 0

    def block(*closers: str) -> tuple[tuple, str, _Expression | None]:
        nonlocal at
        nodes: list[Any] = []
        while at < len(parts):
            kind, body = parts[at]
            at += 1
            if kind == "text":
                nodes += [Output(Const(body))] if body else []
                continue
            reader = _Expression(body)
            if kind == "output":
                nodes.append(Output(reader.whole()))
                continue
            word = reader.name()
            if word in closers:
                return tuple(nodes), word, reader
            nodes.append(statement(word, reader))
        if closers:
            raise TemplateError(f"{closers[-1]!r} is missing")
        return tuple(nodes), "", None

    def closed(body: tuple[tuple, str, _Expression]) -> tuple:
        body[2].end()
        return body[0]

    def statement(word: str, reader: _Expression) -> Any:
        if word == "for":
            name = reader.name()
            reader.need("in")
            over = reader.whole()
            return Loop(name, over, closed(block("endfor")))
        if word == "if":
            return branch(reader)
        if word == "set":
            name = reader.name()
            reader.need("=")
            return Assign(name, reader.whole())
        if word == "generation":
            reader.end()
            return Generation(closed(block("endgeneration")))
        raise TemplateError(f"unknown statement {word!r}")

    def branch(reader: _Expression) -> Branch:
        test = reader.whole()
        then, word, after = block("elif", "else", "endif")
        if word == "elif":
            return Branch(test, then, (branch(after),))
        after.end()
        return Branch(test, then, closed(block("endif")) if word == "else" else ())

    return block()[0]


# ---- folding


def _fold_value(node: Any, filters: Mapping[str, Callable]) -> Any:
    if isinstance(node, Binary):
        left, right = _fold_value(node.left, filters), _fold_value(node.right, filters)
        if node.op in ("and", "or") and isinstance(left, Const):
            return right if bool(left.value) == (node.op == "and") else left
        folded = Binary(node.op, left, right)
        constant = isinstance(left, Const) and isinstance(right, Const)
    elif isinstance(node, Not):
        folded = Not(_fold_value(node.of, filters))
        constant = isinstance(folded.of, Const)
    elif isinstance(node, Filter):
        folded = Filter(node.name, _fold_value(node.of, filters))
        constant = isinstance(folded.of, Const)
    elif isinstance(node, Member):
        folded, constant = Member(_fold_value(node.of, filters), _fold_value(node.key, filters)), False
    else:
        return node
    return Const(_value(folded, filters)({})) if constant else folded


def fold(nodes: Sequence, filters: Mapping[str, Callable]) -> tuple:
    """The tree with constant expressions worked out, dead branches cut and neighbouring texts joined."""
    out: list[Any] = []
    for node in nodes:
        if isinstance(node, Output):
            value = _fold_value(node.value, filters)
            if isinstance(value, Const):
                text = shown(value.value)
                if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                    text = out.pop().value.value + text
                out += [Output(Const(text))] if text else []
                continue
            out.append(Output(value))
        elif isinstance(node, Branch):
            test = _fold_value(node.test, filters)
            then, other = fold(node.then, filters), fold(node.other, filters)
            if isinstance(test, Const):
                out = list(fold([*out, *(then if test.value else other)], filters))
            else:
                out.append(Branch(test, then, other))
        elif isinstance(node, Loop):
            out.append(Loop(node.name, _fold_value(node.over, filters), fold(node.body, filters)))
        elif isinstance(node, Assign):
            out.append(Assign(node.name, _fold_value(node.value, filters)))
        else:
            out.append(Generation(fold(node.body, filters)))
    return tuple(out)


# ---- closures


@dataclass
class Rendered:
    """Output under construction; `spans` are the marked parts, in code points."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    marking: bool = False

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda env, value=node.value: value
    if isinstance(node, Name):

        def read(env: dict, name: str = node.name) -> Any:
            try:
                return env[name]
            except KeyError:
                raise TemplateError(f"{name!r} is not defined") from None

        return read
    if isinstance(node, Member):
        of, key = _value(node.of, filters), _value(node.key, filters)

        def member(env: dict) -> Any:
            holder, k = of(env), key(env)
            if isinstance(holder, Mapping) and k in holder or isinstance(holder, (list, tuple)) and isinstance(k, int) and 0 <= k < len(holder):
                return holder[k]
            raise TemplateError(f"no member {k!r}")

        return member
    if isinstance(node, Not):
        of = _value(node.of, filters)
        return lambda env: not of(env)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        of, function = _value(node.of, filters), filters[node.name]
        return lambda env: function(of(env))
    left, right = _value(node.left, filters), _value(node.right, filters)
    if node.op == "and":
        return lambda env: left(env) and right(env)
    if node.op == "or":
        return lambda env: left(env) or right(env)
    if node.op == "~":
        return lambda env: shown(left(env)) + shown(right(env))
    compare = _COMPARE[node.op]

    def compared(env: dict) -> bool:
        try:
            return compare(left(env), right(env))
        except TypeError as e:
            raise TemplateError(str(e)) from None

    return compared


def _block(nodes: Sequence, filters: Mapping[str, Callable]) -> Callable[[dict, Rendered], None]:
    steps = [_step(n, filters) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env: dict, out: Rendered) -> None:
        for step in steps:
            step(env, out)

    return run


def _step(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict, Rendered], None]:
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            return lambda env, out, text=shown(node.value.value): out.put(text)
        value = _value(node.value, filters)
        return lambda env, out: out.put(shown(value(env)))
    if isinstance(node, Branch):
        test, then, other = _value(node.test, filters), _block(node.then, filters), _block(node.other, filters)
        return lambda env, out: then(env, out) if test(env) else other(env, out)
    if isinstance(node, Assign):
        value = _value(node.value, filters)
        return lambda env, out: env.__setitem__(node.name, value(env))
    if isinstance(node, Loop):
        over, body = _value(node.over, filters), _block(node.body, filters)

        def loop(env: dict, out: Rendered) -> None:
            items = over(env)
            if not isinstance(items, (list, tuple)):
                raise TemplateError("for needs a list")
            # What the body sets ends with the turn.
            for i, item in enumerate(items):
                about = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(items) - 1}
                body({**env, node.name: item, "loop": about}, out)

        return loop
    body = _block(node.body, filters)

    def marked(env: dict, out: Rendered) -> None:
        if out.marking:
            raise TemplateError("generation within generation")
        begin, out.marking = out.length, True
        body(env, out)
        out.marking = False
        out.spans.append((begin, out.length))

    return marked


#: Filters a template has unless it is given others.
FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: shown(v).strip(),
    "upper": lambda v: shown(v).upper(),
    "lower": lambda v: shown(v).lower(),
    "length": len,
}


def compiled(source: str, filters: Mapping[str, Callable] = FILTERS) -> Callable[[Mapping[str, Any]], tuple[str, list[tuple[int, int]]]]:
    """A function from the values of names to the output and its marked parts (code points, end exclusive)."""
    run = _block(fold(parse(source), filters), filters)

    def render(values: Mapping[str, Any]) -> tuple[str, list[tuple[int, int]]]:
        out = Rendered()
        run(dict(values), out)
        return "".join(out.parts), out.spans

    return render
