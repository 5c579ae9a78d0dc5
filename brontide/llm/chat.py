"""Chat formatting: a compiler for a sandboxed template language.

A template is parsed to a syntax tree, constants are folded, and the tree becomes Python closures that
render a conversation and note which characters were written between ``{% generation %}`` markers. The
language has text, ``{{ expression }}``, ``{# comment #}``, ``for``, ``if``/``elif``/``else``, ``set`` and ``generation``.
Expressions have literals, names, ``a.b`` and ``a[b]`` on mappings and lists, ``and or not``, comparisons,
``+`` and the filters below. There are no calls and no attributes of Python objects, so a template
reaches nothing but the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# Strings that steer a model, and the template that marks turns with them.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}<s>[INST]{{ m.role | escape }}[/INST]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</s>{% endfor %}")


class TemplateError(ValueError):
    """The template is not in the language, or asks for what a conversation does not have."""


def escape(text: str, controls: Sequence[str] = CONTROLS) -> str:
    """``text`` without control strings: a backslash follows their first character, and doubles itself."""
    text = text.replace("\\", "\\\\")
    for control in controls:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


# Syntax tree: tuples of a kind and its parts.
Node = tuple
_MARK = re.compile(r"""\{\{(?:'[^']*'|"[^"]*"|(?!\}\}).)*\}\}|\{%(?:'[^']*'|"[^"]*"|(?!%\}).)*%\}|\{\#.*?\#\}""", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'[^']*'|"[^"]*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[<>+.\[\]()|]))""")
_COMPARE: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b}
_CONSTANTS = {"true": True, "false": False, "none": None}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str) -> None:
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, kind: str, value: str | None = None) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind or value not in (None, self.tokens[self.at][1]):
            raise TemplateError(f"expected {value or kind}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Node:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> Node:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Node:
        node = self.sum()
        sign = self.take(*_COMPARE)
        return ("compare", sign, node, self.sum()) if sign else node

    def sum(self) -> Node:
        node = self.filtered()
        while self.take("+"):
            node = ("add", node, self.filtered())
        return node

    def filtered(self) -> Node:
        node = self.atom()
        while True:
            if self.take("."):
                node = ("item", node, ("constant", self.need("name")))
            elif self.take("["):
                node = ("item", node, self.either())
                self.need("sign", "]")
            elif self.take("|"):
                node = ("filter", self.need("name"), node)
            else:
                return node

    def atom(self) -> Node:
        if self.take("("):
            node = self.either()
            self.need("sign", ")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return ("constant", value[1:-1])
        if kind == "number":
            return ("constant", int(value))
        if kind == "name" and value in _CONSTANTS:
            return ("constant", _CONSTANTS[value])
        if kind == "name" and not value.startswith("_"):
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list[Node]:
    """The syntax tree of a template, as the list of its top nodes."""
    stack: list[tuple[str, list, Any]] = [("", [], None)]
    at = 0

    def close(kind: str) -> tuple[list, Any]:
        if stack[-1][0] != kind:
            raise TemplateError(f"end of {kind} without its beginning")
        return stack.pop()[1:]

    for m in _MARK.finditer(source):
        if m.start() > at:
            stack[-1][1].append(("text", source[at:m.start()]))
        at, inner = m.end(), m[0][2:-2].strip()
        if m[0].startswith("{#"):
            continue
        if m[0].startswith("{{"):
            stack[-1][1].append(("put", _Expression(inner).whole()))
            continue
        word, _, rest = inner.partition(" ")
        if word == "for":
            parts = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest.strip(), re.DOTALL)
            if not parts:
                raise TemplateError(f"cannot read {inner!r}")
            stack.append(("for", [], (parts[1], _Expression(parts[2]).whole())))
        elif word == "if":
            stack.append(("if", [], [(_Expression(rest).whole(), [])]))
            stack.append(("branch", stack[-1][2][-1][1], None))
        elif word in ("elif", "else"):
            close("branch")
            if not stack[-1][2]:
                raise TemplateError(f"{word} without if")
            condition = _Expression(rest).whole() if word == "elif" else ("constant", True)
            stack[-1][2].append((condition, []))
            stack.append(("branch", stack[-1][2][-1][1], None))
        elif word == "generation":
            stack.append(("generation", [], None))
        elif word == "set":
            parts = re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest.strip(), re.DOTALL)
            if not parts:
                raise TemplateError(f"cannot read {inner!r}")
            stack[-1][1].append(("set", parts[1], _Expression(parts[2]).whole()))
        elif word == "endfor":
            body, (name, over) = close("for")
            stack[-1][1].append(("for", name, over, body))
        elif word == "endif":
            close("branch")
            _, branches = close("if")
            stack[-1][1].append(("if", branches))
        elif word == "endgeneration":
            body, _ = close("generation")
            stack[-1][1].append(("generation", body))
        else:
            raise TemplateError(f"unknown statement {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} does not end")
    if at < len(source):
        stack[0][1].append(("text", source[at:]))
    return stack[0][1]


Filters = Mapping[str, Callable[[Any], Any]]


def filters(controls: Sequence[str] = CONTROLS) -> Filters:
    return {"escape": lambda x: escape(str(x), controls), "trim": lambda x: str(x).strip(), "upper": lambda x: str(x).upper(),
            "lower": lambda x: str(x).lower(), "length": len, "string": str}


def _fold(node: Node, known: Filters) -> Node:
    """An expression with its constant parts evaluated."""
    kind = node[0]
    if kind in ("constant", "name"):
        return node
    if kind == "filter":
        if node[1] not in known:
            raise TemplateError(f"unknown filter {node[1]!r}")
        inner = _fold(node[2], known)
        return ("constant", known[node[1]](inner[1])) if inner[0] == "constant" else ("filter", node[1], inner)
    if kind == "compare":
        folded = (kind, node[1], _fold(node[2], known), _fold(node[3], known))
    else:
        folded = (kind, *[_fold(n, known) for n in node[1:]])
    operands = folded[2:] if kind == "compare" else folded[1:]
    if all(n[0] == "constant" for n in operands):
        return ("constant", _evaluate(folded, known)({}))
    if kind in ("and", "or") and folded[1][0] == "constant":
        return folded[2] if bool(folded[1][1]) == (kind == "and") else folded[1]
    return folded


def fold(nodes: list[Node], known: Filters) -> list[Node]:
    """The tree with constants evaluated, dead branches removed and neighbouring texts joined."""
    out: list[Node] = []
    for node in nodes:
        kind = node[0]
        if kind == "put":
            value = _fold(node[1], known)
            new = [("text", _written(value[1]))] if value[0] == "constant" else [("put", value)]
        elif kind == "set":
            new = [("set", node[1], _fold(node[2], known))]
        elif kind == "for":
            over, body = _fold(node[2], known), fold(node[3], known)
            new = [("for", node[1], over, body)] if body else []
        elif kind == "generation":
            new = [("generation", fold(node[1], known))]
        elif kind == "if":
            branches = []
            for condition, body in node[1]:
                condition = _fold(condition, known)
                if condition[0] != "constant" or condition[1]:
                    branches.append((condition, fold(body, known)))
                if condition[0] == "constant" and condition[1]:
                    break
            sure = branches and branches[0][0][0] == "constant"
            new = branches[0][1] if sure else [("if", branches)] if branches else []
        else:
            new = [node]
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


def _written(value: Any) -> str:
    return "" if value is None else str(value)


def _item(value: Any, key: Any) -> Any:
    if isinstance(value, Mapping) and key in value:
        return value[key]
    if isinstance(value, (list, tuple)) and isinstance(key, int) and key < len(value):
        return value[key]
    raise TemplateError(f"no item {key!r}")


def _evaluate(node: Node, known: Filters) -> Callable[[dict], Any]:
    """The closure of an expression."""
    kind = node[0]
    if kind == "constant":
        return lambda names, value=node[1]: value
    if kind == "name":
        def look_up(names: dict, name: str = node[1]) -> Any:
            if name not in names:
                raise TemplateError(f"unknown name {name!r}")
            return names[name]
        return look_up
    if kind == "filter":
        apply, inner = known[node[1]], _evaluate(node[2], known)
        return lambda names: apply(inner(names))
    if kind == "compare":
        test, a, b = _COMPARE[node[1]], _evaluate(node[2], known), _evaluate(node[3], known)
        return lambda names: test(a(names), b(names))
    parts = [_evaluate(n, known) for n in node[1:]]
    if kind == "not":
        return lambda names: not parts[0](names)
    if kind == "and":
        return lambda names: parts[0](names) and parts[1](names)
    if kind == "or":
        return lambda names: parts[0](names) or parts[1](names)
    if kind == "add":
        return lambda names: parts[0](names) + parts[1](names)
    return lambda names: _item(parts[0](names), parts[1](names))


class _Output:
    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _closure(nodes: list[Node], known: Filters) -> Callable[[dict, _Output], None]:
    """The closure that renders these nodes."""
    steps = [_step(n, known) for n in nodes]

    def run(names: dict, out: _Output) -> None:
        for step in steps:
            step(names, out)
    return steps[0] if len(steps) == 1 else run


def _step(node: Node, known: Filters) -> Callable[[dict, _Output], None]:
    kind = node[0]
    if kind == "text":
        return lambda names, out, text=node[1]: out.write(text)
    if kind == "put":
        value = _evaluate(node[1], known)
        return lambda names, out: out.write(_written(value(names)))
    if kind == "set":
        name, value = node[1], _evaluate(node[2], known)
        return lambda names, out: names.__setitem__(name, value(names))
    if kind == "if":
        branches = [(_evaluate(c, known), _closure(body, known)) for c, body in node[1]]

        def choose(names: dict, out: _Output) -> None:
            for condition, body in branches:
                if condition(names):
                    return body(names, out)
        return choose
    if kind == "generation":
        body = _closure(node[1], known)

        def mark(names: dict, out: _Output) -> None:
            start = out.length
            body(names, out)
            out.spans.append((start, out.length))
        return mark
    name, over, body = node[1], _evaluate(node[2], known), _closure(node[3], known)

    def repeat(names: dict, out: _Output) -> None:
        values = over(names)
        if not isinstance(values, (list, tuple)):
            raise TemplateError("for needs a list")
        for i, value in enumerate(values):
            loop = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(values) - 1, "length": len(values)}
            body({**names, name: value, "loop": loop}, out)
    return repeat


@dataclass(frozen=True)
class Template:
    """A compiled template: call it with messages for the text and the spans under generation markers."""

    render: Callable[[dict, _Output], None]

    def __call__(self, messages: Sequence[Mapping[str, str]], **names: Any) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        self.render({**names, "messages": list(messages)}, out)
        return "".join(out.parts), out.spans


def compile_template(source: str = TEMPLATE, controls: Sequence[str] = CONTROLS) -> Template:
    known = filters(controls)
    return Template(_closure(fold(parse(source), known), known))


def read_back(text: str) -> list[tuple[str, str]]:
    """Roles and texts from what the default template has written."""
    turns = re.findall(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", text, re.DOTALL)
    if sum(len(r) + len(t) + len("<s>[INST][/INST]</s>") for r, t in turns) != len(text):
        raise ValueError("not a conversation in the default template")
    return [(unescape(r), unescape(t)) for r, t in turns]


FORMATTED = "n_turns long, formatted string, generation array<struct<start:long,stop:long>>"


def format_conversations(rows: DataFrame, template: str = TEMPLATE, controls: Sequence[str] = CONTROLS, conversation: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation: its key, ``n_turns``, the ``formatted`` text and the ``generation`` spans in it.

    Turns go by their number, null first, then by role and text; repeated rows are turns too. Null roles and
    texts are empty; rows with a null key are one conversation. Other columns are not looked at. An empty
    table gives no rows. Rows are sorted by conversation and streamed, so that a task holds one conversation
    and one batch; the text of a conversation has to fit a cell, as the result asks for it.
    """
    compile_template(template, controls)  # a mistake shows before the job starts
    kind = rows.schema[conversation].dataType
    schema = T.StructType([T.StructField(conversation, kind), *T.StructType.fromDDL(FORMATTED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, controls)
        current, messages = None, []
        out: list[tuple] = []

        def finish() -> None:
            if messages:
                formatted, spans = render(messages)
                out.append((current, len(messages), formatted, [{"start": a, "stop": b} for a, b in spans]))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), (), ()]
            types = [key_type, pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.name for f in schema])
            out.clear()
            return done

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, r, t in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if messages and key != current:
                    finish()
                    messages = []
                current = key
                messages.append({"role": r, "text": t})
            yield flush()
        finish()
        if out:
            yield flush()

    cells = rows.select(F.col(conversation).alias("key"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ordered = cells.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    return ordered.select("key", "role", "text").mapInArrow(run, schema)


DIGESTS = "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What is read back from texts in the default template: the turns, and what lies under the loss mask.

    A row per row, null keys among them; turns without text count with their role, and an empty table gives no rows.
    """
    schema = T.StructType([formatted.schema[conversation], formatted.schema["n_turns"], *T.StructType.fromDDL(DIGESTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            out = []
            for value, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(value)
                loss = "".join(unescape(value[s["start"]:s["stop"]]) for s in spans)
                out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(value)))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[f.name for f in schema])

    return formatted.select(conversation, "formatted", "generation").mapInArrow(run, schema)
