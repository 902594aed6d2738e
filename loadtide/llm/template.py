"""A small sandboxed template language, compiled to Python closures.

Text, `{{ expression }}`, `{% if %}` `{% elif %}` `{% else %}` `{% endif %}`, `{% for x in list %}` `{% endfor %}`, `{% set x = ... %}`,
`{% generation %}` `{% endgeneration %}` around what a model is to learn, `{# comments #}`; a `-` inside a mark trims white space there.
Expressions: text and whole-number literals, lists, names, `a.key`, `a[key]`, `a | filter(argument)`, `x if test else y`, `or and not`,
`== != < <= > >= in`, `+ - * // %`, and `~` to join as text. In a loop `loop.index0`, `loop.index`, `loop.first`, `loop.last`.

1. The source is cut into marks and text, and parsed into a tree of tuples.
2. Constants are folded: an operation, filter or test whose operands are all constants becomes its value, a branch that can't be
   taken goes, a loop over an empty list goes, neighbouring texts become one.
3. Each node becomes a closure over its children's closures. Nothing is evaluated as Python source.

Sandbox: values are texts, whole numbers, booleans, None, lists and dictionaries; a key is looked up in dictionaries only, never as an
attribute; there are no calls but filters of a given table, no multiplication of texts or lists, and loops only over lists that were handed in
or written out; nesting and the length of an expression are bounded. A missing name or key is None, which prints as nothing. Errors of a template are `TemplateError`.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

MARK = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.S)
TOKEN = re.compile(r"\s*(?:(?P<number>\d+)|(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|//|[-+*%~<>|()\[\],.=]))", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
MAX_DEPTH = 60  # nesting of statements and expressions
MAX_TOKENS = 400  # of one expression


class TemplateError(ValueError):
    pass


def _number(x):
    if isinstance(x, bool) or not isinstance(x, int) or abs(x) >= 1 << 64:
        raise TemplateError("numbers below 2^64 only")
    return x


def _add(a, b):
    if isinstance(a, str) and isinstance(b, str) or isinstance(a, list) and isinstance(b, list):
        return a + b
    return _number(a) + _number(b)


def _divided(by: Callable) -> Callable:
    def run(a, b):
        if _number(b) == 0:
            raise TemplateError("division by zero")
        return by(_number(a), b)

    return run


def _ordered(by: Callable) -> Callable:
    def run(a, b):
        if type(a) is not type(b) or not isinstance(a, (int, str)):
            raise TemplateError("only like values have an order")
        return by(a, b)

    return run


def _within(a, b):
    if isinstance(b, (list, dict)) or isinstance(a, str) and isinstance(b, str):
        return a in b
    raise TemplateError("`in` takes a list, a dictionary or two texts")


def printed(x) -> str:
    if x is None:
        return ""
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, (str, int)):
        return str(x)
    raise TemplateError("lists and dictionaries can't be printed")


OPERATIONS: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": _ordered(operator.lt), "<=": _ordered(operator.le), ">": _ordered(operator.gt),
    ">=": _ordered(operator.ge), "in": _within, "+": _add, "-": lambda a, b: _number(a) - _number(b), "*": lambda a, b: _number(a) * _number(b),
    "//": _divided(operator.floordiv), "%": _divided(operator.mod), "~": lambda a, b: printed(a) + printed(b)}
LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in"), ("~",), ("+", "-"), ("*", "//", "%"))
FILTERS: dict[str, Callable] = {
    "upper": lambda s: printed(s).upper(), "lower": lambda s: printed(s).lower(), "trim": lambda s: printed(s).strip(),
    "capitalize": lambda s: printed(s).capitalize(), "length": lambda s: len(s) if isinstance(s, (str, list, dict)) else 0,
    "default": lambda s, other: other if s is None else s, "join": lambda s, by="": by.join(map(printed, s))}


# --- trees of expressions ---


class Expression:
    """Recursive descent over the tokens of one mark."""

    def __init__(self, source: str):
        self.tokens, at, self.depth = [], 0, 0
        source = source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"what is {source[at:at + 20]!r}?")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.tokens.append(("end", ""))
        if len(self.tokens) > MAX_TOKENS:
            raise TemplateError("too long an expression")
        self.at = 0

    def next(self, kind: str | None = None, value: str | None = None) -> str:
        k, v = self.tokens[self.at]
        if kind and k != kind or value is not None and v != value:
            raise TemplateError(f"{value or kind} expected, {v or 'end'!r} found")
        self.at += 1
        return v

    def has(self, *values: str) -> bool:
        k, v = self.tokens[self.at]
        return k in ("name", "sign") and v in values

    def took(self, value: str) -> bool:
        if self.has(value):
            self.at += 1
            return True
        return False

    def whole(self):
        tree = self.choice()
        self.next("end")
        return tree

    def choice(self):
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        tree = self.either()
        if self.took("if"):
            test = self.either()
            self.next("name", "else")
            tree = ("choose", test, tree, self.choice())
        self.depth -= 1
        return tree

    def either(self):
        tree = self.both()
        while self.took("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self):
        tree = self.inverse()
        while self.took("and"):
            tree = ("and", tree, self.inverse())
        return tree

    def inverse(self):
        turns = 0
        while self.took("not"):
            turns += 1
        tree = self.binary(0)
        return tree if turns == 0 else ("not", tree) if turns % 2 else ("not", ("not", tree))

    def binary(self, level: int):
        if level == len(LEVELS):
            return self.filtered()
        tree = self.binary(level + 1)
        while self.has(*LEVELS[level]):
            tree = ("apply", self.next(), tree, self.binary(level + 1))
        return tree

    def filtered(self):
        tree = self.looked_up()
        while self.took("|"):
            name = self.next("name")
            tree = ("filter", name, [tree, *(self.listed(")") if self.took("(") else [])])
        return tree

    def looked_up(self):
        tree = self.single()
        while self.has(".", "["):
            if self.next() == ".":
                tree = ("key", tree, ("const", self.next("name")))
            else:
                tree = ("key", tree, self.choice())
                self.next("sign", "]")
        return tree

    def listed(self, end: str) -> list:
        out = []
        while not self.took(end):
            out.append(self.choice())
            if not self.has(end):
                self.next("sign", ",")
        return out

    def single(self):
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return ("const", _number(int(value)))
        if kind == "text":
            return ("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if value == "-" and kind == "sign":
            return ("apply", "-", ("const", 0), self.single())
        if value == "(" and kind == "sign":
            tree = self.choice()
            self.next("sign", ")")
            return tree
        if value == "[" and kind == "sign":
            return ("list", self.listed("]"))
        if kind == "name":
            words = {"true": True, "false": False, "none": None}
            return ("const", words[value.lower()]) if value.lower() in words else ("name", value)
        raise TemplateError(f"an expression can't start with {value or 'end'!r}")


# --- trees of statements ---


def _marks(source: str) -> Iterator[tuple[str, str]]:
    at, trim = 0, False
    for m in MARK.finditer(source):
        text = source[at:m.start()]
        text = text.lstrip() if trim else text
        before, inner, after = next((m[k], m[k + 1], m[k + 2]) for k in (1, 4, 7) if m[k + 1] is not None)
        yield "text", text.rstrip() if before else text
        yield {"{{": "print", "{%": "tag", "{#": "none"}[m[0][:2]], inner.strip()
        at, trim = m.end(), bool(after)
    yield "text", source[at:].lstrip() if trim else source[at:]


def parse(source: str) -> list:
    """The statements of a template."""
    marks = list(_marks(source))
    at = 0

    def block(ends: tuple[str, ...], depth: int) -> tuple[list, str, str]:
        nonlocal at
        if depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        out: list = []
        while at < len(marks):
            kind, body = marks[at]
            at += 1
            if kind == "text":
                if body:
                    out.append(("text", body))
            elif kind == "print":
                out.append(("print", Expression(body).whole()))
            elif kind == "tag":
                word, _, rest = body.partition(" ")
                if word in ends:
                    return out, word, rest
                out.append(statement(word, rest, depth))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, "", ""

    def branches(test: str, depth: int) -> tuple:
        then, end, rest = block(("elif", "else", "endif"), depth + 1)
        if end == "elif":
            return ("if", Expression(test).whole(), then, [branches(rest, depth + 1)])
        other = block(("endif",), depth + 1)[0] if end == "else" else []
        return ("if", Expression(test).whole(), then, other)

    def statement(word: str, rest: str, depth: int) -> tuple:
        if word == "if":
            return branches(rest, depth)
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"for x in list, not {rest!r}")
            return ("for", m[1], Expression(m[2]).whole(), block(("endfor",), depth + 1)[0])
        if word == "set":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"set x = value, not {rest!r}")
            return ("set", m[1], Expression(m[2]).whole())
        if word == "generation":
            return ("generation", block(("endgeneration",), depth + 1)[0])
        raise TemplateError(f"no statement {word!r}")

    return block((), 0)[0]


# --- folding ---


def fold(tree, filters: Mapping[str, Callable]):
    """An expression with its constant parts computed."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    if kind == "list":
        parts = [fold(t, filters) for t in tree[1]]
        return ("const", [p[1] for p in parts]) if all(p[0] == "const" for p in parts) else ("list", parts)
    if kind == "filter":
        if tree[1] not in filters:
            raise TemplateError(f"no filter {tree[1]!r}")
        parts, head = [fold(t, filters) for t in tree[2]], tree[:2]
        folded = (*head, parts)
    else:
        n = 2 if kind == "apply" else 1
        parts, head = [fold(t, filters) for t in tree[n:]], tree[:n]
        folded = (*head, *parts)
    if kind in ("choose", "or", "and") and parts[0][0] == "const":
        yes = bool(parts[0][1])
        return (parts[1] if yes else parts[2]) if kind == "choose" else parts[1] if yes == (kind == "and") else parts[0]
    if all(p[0] == "const" for p in parts):
        return ("const", _closure(folded, filters)({}))
    return folded


def fold_all(nodes: Sequence, filters: Mapping[str, Callable]) -> list:
    """Statements with constant expressions computed, dead branches gone, and neighbouring texts joined."""
    out: list = []
    for node in nodes:
        kind = node[0]
        if kind == "print":
            tree = fold(node[1], filters)
            made = [("text", printed(tree[1]))] if tree[0] == "const" else [("print", tree)]
        elif kind == "if":
            test = fold(node[1], filters)
            then, other = fold_all(node[2], filters), fold_all(node[3], filters)
            made = (then if test[1] else other) if test[0] == "const" else [("if", test, then, other)]
        elif kind == "for":
            over = fold(node[2], filters)
            made = [] if over == ("const", []) else [("for", node[1], over, fold_all(node[3], filters))]
        elif kind == "set":
            made = [("set", node[1], fold(node[2], filters))]
        elif kind == "generation":
            made = [("generation", fold_all(node[1], filters))]
        else:
            made = [node]
        for m in made:
            if m[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + m[1])
            elif m != ("text", ""):
                out.append(m)
    return out


# --- closures ---


def _closure(tree, filters: Mapping[str, Callable]) -> Callable:
    """A function of the names' values."""
    kind = tree[0]
    if kind == "const":
        return lambda env, v=tree[1]: v
    if kind == "name":
        return lambda env, n=tree[1]: env.get(n)
    if kind == "list":
        parts = [_closure(t, filters) for t in tree[1]]
        return lambda env: [p(env) for p in parts]
    if kind == "filter":
        fn, parts = filters[tree[1]], [_closure(t, filters) for t in tree[2]]

        def filtered(env):
            try:
                return fn(*[p(env) for p in parts])
            except (TypeError, AttributeError) as e:
                raise TemplateError(f"{tree[1]}: {e}") from e

        return filtered
    parts = [_closure(t, filters) for t in tree[2 if kind == "apply" else 1:]]
    if kind == "apply":
        fn, (a, b) = OPERATIONS[tree[1]], parts
        return lambda env: fn(a(env), b(env))
    if kind == "key":
        a, b = parts

        def looked_up(env):
            owner, key = a(env), b(env)
            if isinstance(owner, dict):
                return owner.get(key) if isinstance(key, (str, int)) else None
            if isinstance(owner, list) and isinstance(key, int):
                return owner[key] if -len(owner) <= key < len(owner) else None
            return None

        return looked_up
    if kind == "choose":
        test, a, b = parts
        return lambda env: a(env) if test(env) else b(env)
    if kind == "not":
        return lambda env, a=parts[0]: not a(env)
    a, b = parts
    return (lambda env: a(env) or b(env)) if kind == "or" else (lambda env: a(env) and b(env))


@dataclass
class Sink:
    """What is written, its length, and the spans between generation marks."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    open: int | None = None

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    @property
    def text(self) -> str:
        return "".join(self.parts)


def _statements(nodes: Sequence, filters: Mapping[str, Callable]) -> Callable:
    """A function of the names' values and a sink."""
    steps = [_statement(n, filters) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env, sink):
        for s in steps:
            s(env, sink)

    return run


def _statement(node, filters: Mapping[str, Callable]) -> Callable:
    kind = node[0]
    if kind == "text":
        return lambda env, sink, t=node[1]: sink.write(t)
    if kind == "print":
        value = _closure(node[1], filters)
        return lambda env, sink: sink.write(printed(value(env)))
    if kind == "set":
        name, value = node[1], _closure(node[2], filters)
        return lambda env, sink: env.__setitem__(name, value(env))
    if kind == "if":
        test, then, other = _closure(node[1], filters), _statements(node[2], filters), _statements(node[3], filters)
        return lambda env, sink: then(env, sink) if test(env) else other(env, sink)
    if kind == "generation":
        body = _statements(node[1], filters)

        def generation(env, sink):
            if sink.open is not None:
                raise TemplateError("generation inside generation")
            sink.open = sink.length
            body(env, sink)
            sink.spans.append((sink.open, sink.length))
            sink.open = None

        return generation
    name, over, body = node[1], _closure(node[2], filters), _statements(node[3], filters)

    def loop(env, sink):
        items = over(env)
        if not isinstance(items, list):
            raise TemplateError("a loop takes a list")
        for k, item in enumerate(items):
            body({**env, name: item, "loop": place(k, len(items))}, sink)

    return loop


def place(index: int, length: int) -> dict:
    return {"index0": index, "index": index + 1, "first": index == 0, "last": index == length - 1, "length": length}


class Template:
    """A compiled template."""

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None):
        self.source, self.filters = source, {**FILTERS, **(filters or {})}
        self.tree = fold_all(parse(source), self.filters)
        self._run = _statements(self.tree, self.filters)

    def render(self, **names) -> tuple[str, list[tuple[int, int]]]:
        """The text, and the spans inside generation marks."""
        sink = Sink()
        self._run(dict(names), sink)
        return sink.text, sink.spans

    def by_turns(self, over: str) -> tuple[Callable, str, Callable, Callable]:
        """(head, name, body, tail): the parts of a template that loops once, at top level, over the list `over`.

        With them a list is rendered item by item, or in pieces on different machines.
        """
        loops = [k for k, n in enumerate(self.tree) if n[0] == "for" and n[2] == ("name", over)]
        if len(loops) != 1:
            raise TemplateError(f"one loop over {over} at top level is needed")
        k = loops[0]
        if _mentions(self.tree[:k] + self.tree[k + 1:] + [("group", self.tree[k][3])], over):
            raise TemplateError(f"{over} may only be looped over")
        head, tail = (_statements(part, self.filters) for part in (self.tree[:k], self.tree[k + 1:]))
        return head, self.tree[k][1], _statements(self.tree[k][3], self.filters), tail


def _mentions(tree, name: str) -> bool:
    return tree == ("name", name) or isinstance(tree, (list, tuple)) and any(_mentions(t, name) for t in tree)
