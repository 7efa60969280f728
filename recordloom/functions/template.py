"""Templates as Spark expressions.

A template is read once on the driver (or once per distinct text in a task) into
a short list of nodes. Two targets share the nodes: one Column for one template
over a big table, or rows of guarded segments for many templates, which Spark
evaluates with higher-order functions.

Covered: {{ name }}, replace/title/upper/lower/join, string methods of the same
names, inline if/else, if/elif/else, for over a list, raw, comments, with block
tags trimmed (leading blanks before, one newline after).
"""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPEN = re.compile(r"\{\{|\{%|\{#")
_QUOTED = r"'[^']*'|\"[^\"]*\""
_EXPR = re.compile(rf"\{{\{{[-+]?((?:{_QUOTED}|[^'\"}}]|\}}(?!\}}))*?)(-?)\}}\}}")
_BLOCK = re.compile(rf"\{{%[-+]?((?:{_QUOTED}|[^'\"%]|%(?!\}}))*?)([-+]?)%\}}")
_COMMENT = re.compile(r"\{#.*?([-+]?)#\}", re.S)
_RAW = re.compile(r"\{%[-+]?\s*raw\s*(-?)%\}")
_ENDRAW = re.compile(r"\{%([-+]?)\s*endraw\s*([-+]?)%\}")
_FOR = re.compile(r"for\s+(\w+)\s+in\s+(\w+)$")

FILTERS = ("replace", "title", "upper", "lower", "join")


class TemplateError(ValueError):
    pass


# --------------------------------------------------------------------- reading


def _tokens(text: str):
    """Yield (kind, body) with block whitespace already trimmed."""
    pos, line_start, strip_next = 0, True, False

    def data(until: int, sign: str, block: bool) -> str:
        piece = text[pos:until]
        if strip_next:
            piece = piece.lstrip()
        if sign == "-":
            return piece.rstrip()
        cut = piece.rfind("\n") + 1
        if block and sign != "+" and (cut or line_start) and not piece[cut:].strip():
            return piece[:cut]
        return piece

    while True:
        mark = _OPEN.search(text, pos)
        if mark is None:
            rest = text[pos:]
            yield "data", rest.lstrip() if strip_next else rest
            return
        start, kind = mark.start(), mark.group()
        sign = text[start + 2 : start + 3]
        before = data(start, sign, kind != "{{")
        if before:
            yield "data", before
        raw = _RAW.match(text, start) if kind == "{%" else None
        if raw:
            end = _ENDRAW.search(text, raw.end())
            if end is None:
                raise TemplateError("raw block is not closed")
            pos, line_start, strip_next = raw.end(), text[raw.end() - 1] == "\n", raw.group(1) == "-"
            yield "data", data(end.start(), end.group(1), True)
            closing, tail = end, end.group(2)
        else:
            pattern = {"{{": _EXPR, "{%": _BLOCK, "{#": _COMMENT}[kind]
            closing = pattern.match(text, start)
            if closing is None:
                raise TemplateError(f"tag opened at {start} is not closed")
            tail = closing.group(closing.lastindex)
            if kind != "{#":
                yield ("expr" if kind == "{{" else "block"), closing.group(1).strip()
        pos, strip_next, line_start = closing.end(), tail == "-", False
        if kind != "{{" and not tail and text[pos : pos + 1] == "\n":
            pos, line_start = pos + 1, True


def _kind_of(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return {str: "str", int: "num", float: "num", type(None): "none"}.get(type(value), "list")


_CONSTANTS = {"true": True, "false": False, "none": None}


def _literal(node):
    """(True, value) for a constant, (False, name) for a variable."""
    if isinstance(node, ast.Constant):
        return True, node.value
    if isinstance(node, ast.Name):
        if node.id in _CONSTANTS:
            return True, _CONSTANTS[node.id]
        return False, node.id
    raise TemplateError("unsupported expression: " + ast.unparse(node))


def _condition(node, negate=False) -> dict:
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
        return _condition(node.operand, not negate)
    if isinstance(node, ast.Compare) and len(node.ops) == 1:
        op, left, right = node.ops[0], _literal(node.left), _literal(node.comparators[0])
        if isinstance(op, (ast.In, ast.NotIn)):
            if not left[0] or right[0]:
                raise TemplateError("only 'literal in name' is supported")
            name, value, test = right[1], left[1], "in"
        elif isinstance(op, (ast.Eq, ast.NotEq)) and left[0] != right[0]:
            name, value = (right[1], left[1]) if left[0] else (left[1], right[1])
            test = "eq"
        else:
            raise TemplateError("unsupported comparison: " + ast.unparse(node))
        flip = isinstance(op, (ast.NotIn, ast.NotEq))
        return dict(param=name, op=test, value=str(value), kind=_kind_of(value), neg=negate != flip)
    is_value, name = _literal(node)
    if is_value:
        raise TemplateError("a constant is not a condition")
    return dict(param=name, op="truthy", value="", kind="", neg=negate)


def _parse(expression: str):
    try:
        return ast.parse(expression.strip(), mode="eval").body
    except SyntaxError as exc:
        raise TemplateError(f"bad expression {expression!r}: {exc.msg}") from None


def _filter_call(node) -> tuple[str, list[str]]:
    if isinstance(node, ast.Name):
        name, args = node.id, []
    elif isinstance(node, ast.Call) and isinstance(node.func, ast.Name):
        name, args = node.func.id, node.args
    else:
        raise TemplateError("unsupported filter: " + ast.unparse(node))
    values = [_literal(a) for a in args]
    if name not in FILTERS or not all(is_value for is_value, _ in values):
        raise TemplateError("unsupported filter: " + ast.unparse(node))
    return name, [str(v) for _, v in values]


def _apply_python(name: str, args: list[str], text: str) -> str:
    return getattr(text, name)(*args)


def _value_nodes(node) -> list[dict]:
    if isinstance(node, ast.IfExp):
        test = _condition(node.test)
        return [
            dict(
                kind="if",
                branches=[([test], _value_nodes(node.body))],
                orelse=_value_nodes(node.orelse),
            )
        ]
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.BitOr):
        base, call = _value_nodes(node.left), _filter_call(node.right)
    elif isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute):
        base = _value_nodes(node.func.value)
        method = ast.Call(ast.Name(node.func.attr), node.args, [])
        call = _filter_call(ast.copy_location(method, node))
    else:
        is_value, value = _literal(node)
        if is_value:
            return [dict(kind="text", value=str(value))]
        return [dict(kind="var", value=value, filters=[])]
    if len(base) != 1 or base[0]["kind"] == "if":
        raise TemplateError("a filter needs a plain value")
    name, args = call
    item = base[0]
    if item["kind"] == "text":
        if name == "join":
            raise TemplateError("join needs a list")
        return [dict(kind="text", value=_apply_python(name, args, item["value"]))]
    a, b = [*args, "", ""][:2]
    return [dict(item, filters=[*item["filters"], dict(name=name, a=a, b=b)])]


def parse_template(text: str) -> list[dict]:
    """Nodes of a template; raises TemplateError outside the covered subset."""
    if text.endswith("\n"):
        text = text[:-1]
    root: list[dict] = []
    stack: list[tuple[dict, list]] = []  # (open block, list receiving its nodes)
    out = root
    for kind, body in _tokens(text):
        if kind == "data":
            out.append(dict(kind="text", value=body))
        elif kind == "expr":
            out.extend(_value_nodes(_parse(body)))
        elif body.startswith("if "):
            block = dict(kind="if", branches=[([_condition(_parse(body[3:]))], [])], orelse=[])
            out.append(block)
            stack.append((block, out))
            out = block["branches"][0][1]
        elif body.startswith("elif ") and stack and stack[-1][0]["kind"] == "if":
            branch = ([_condition(_parse(body[5:]))], [])
            stack[-1][0]["branches"].append(branch)
            out = branch[1]
        elif body == "else" and stack and stack[-1][0]["kind"] == "if":
            out = stack[-1][0]["orelse"]
        elif _FOR.match(body):
            name, source = _FOR.match(body).groups()
            block = dict(kind="for", loop=name, value=source, body=[])
            out.append(block)
            stack.append((block, out))
            out = block["body"]
        elif body in ("endif", "endfor") and stack and stack[-1][0]["kind"] == body[3:]:
            out = stack.pop()[1]
        else:
            raise TemplateError(f"unexpected tag {body!r}")
    if stack:
        raise TemplateError(f"{stack[-1][0]['kind']} block is not closed")
    return root


# ----------------------------------------------------- target 1: a single Column


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def title_filter(col: Column) -> Column:
    """Upper-case the first character after blanks, hyphens and opening brackets, lower-case the rest."""
    return F.array_join(
        F.transform(
            F.regexp_extract_all(col, F.lit(_TITLE_RUNS), F.lit(1)),
            lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, _ALL))),
        ),
        "",
    )


_ALL = 2**31 - 1
_TITLE_BREAKS = r"\-\s\x1C-\x1F\x{85}\p{Z}(\{\[<"
_TITLE_RUNS = rf"([{_TITLE_BREAKS}]+|[^{_TITLE_BREAKS}]+)"


def _title_sql(text: str) -> str:
    runs = f"regexp_extract_all({text}, r'{_TITLE_RUNS}', 1)"
    return f"array_join(transform({runs}, r -> concat(upper(substring(r, 1, 1)), lower(substring(r, 2)))), '')"


def _double_text(col: Column) -> Column:
    """Shortest digits, plain from 1e-4 up to 1e16, else with a two-digit exponent."""
    shown = col.cast("string")
    plain = F.regexp_replace(shown.cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    parts = F.split(shown, "E")
    power = F.get(parts, F.lit(1)).cast("int")
    sign = F.when(power < 0, F.lit("-")).otherwise(F.lit("+"))
    digits = F.abs(power).cast("string")
    digits = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    wide = F.concat(F.regexp_replace(parts[0], r"\.0$", ""), F.lit("e"), sign, digits)
    return (
        F.when(F.isnan(col), F.lit("nan"))
        .when(F.abs(col) == float("inf"), F.when(col > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~F.contains(shown, F.lit("E")), shown)
        .when((F.abs(col) >= 1e-4) & (F.abs(col) < 1e16), plain)
        .otherwise(wide)
    )


def _text_of(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        shown = F.when(col, F.lit("True")).otherwise(F.lit("False"))
        return F.when(col.isNull(), F.lit("None")).otherwise(shown)
    shown = _double_text(col) if isinstance(dtype, T.DoubleType) else col.cast("string")
    return F.coalesce(shown, F.lit("None"))


def _apply_filter(name: str, a, b, col: Column) -> Column:
    return {
        "replace": lambda: F.replace(col, a, b),
        "title": lambda: title_filter(col),
        "upper": lambda: F.upper(col),
        "lower": lambda: F.lower(col),
    }[name]()


def _filtered(node: dict, col: Column, dtype: T.DataType) -> Column:
    filters = node["filters"]
    if filters and filters[0]["name"] == "join":
        if not isinstance(dtype, T.ArrayType):
            raise TemplateError(f"join needs a list column: {node['value']}")
        text, filters = F.array_join(col.cast("array<string>"), filters[0]["a"]), filters[1:]
    else:
        text = _text_of(col, dtype)
    for f in filters:
        if f["name"] == "join":
            raise TemplateError("join must come first")
        text = _apply_filter(f["name"], F.lit(f["a"]), F.lit(f["b"]), text)
    return text


def _holds_on(col: Column, dtype: T.DataType, cond: dict) -> Column:
    if cond["op"] == "truthy":
        if isinstance(dtype, T.BooleanType):
            test = col
        elif isinstance(dtype, T.NumericType):
            test = col != 0
        elif isinstance(dtype, (T.ArrayType, T.MapType)):
            test = F.size(col) > 0
        else:
            test = col.cast("string") != ""
    elif cond["op"] == "eq":
        test = _text_of(col, dtype) == F.lit(cond["value"])
    elif isinstance(dtype, T.ArrayType):
        test = F.array_contains(col.cast("array<string>"), cond["value"])
    else:
        test = F.contains(col.cast("string"), F.lit(cond["value"]))
    test = F.coalesce(test, F.lit(False))
    return ~test if cond["neg"] else test


def template_column(text: str, schema: T.StructType) -> Column:
    """One expression that renders `text` from the columns of a table."""
    scope = {f.name: (F.col(f"`{f.name}`"), f.dataType) for f in schema.fields}
    return _nodes_column(parse_template(text), scope)


def _nodes_column(nodes: list[dict], scope: dict) -> Column:
    parts = []
    for node in nodes:
        if node["kind"] == "text":
            parts.append(F.lit(node["value"]))
        elif node["kind"] == "var":
            # an unknown name renders as nothing
            parts.append(_filtered(node, *scope[node["value"]]) if node["value"] in scope else F.lit(""))
        elif node["kind"] == "for":
            if node["value"] not in scope:
                continue
            source, dtype = scope[node["value"]]
            if not isinstance(dtype, T.ArrayType):
                raise TemplateError(f"not a list column: {node['value']}")
            parts.append(
                F.array_join(
                    F.transform(
                        source,
                        lambda x: _nodes_column(
                            node["body"], {**scope, node["loop"]: (x, dtype.elementType)}
                        ),
                    ),
                    "",
                )
            )
        else:
            chain = None
            for conds, body in node["branches"]:
                test = F.lit(True)
                for cond in conds:
                    if cond["param"] in scope:
                        test = test & _holds_on(*scope[cond["param"]], cond)
                    else:
                        test = test & F.lit(cond["neg"])
                then = _nodes_column(body, scope)
                chain = F.when(test, then) if chain is None else chain.when(test, then)
            parts.append(chain.otherwise(_nodes_column(node["orelse"], scope)))
    return F.concat(*parts) if parts else F.lit("")


def render_table(df: DataFrame, template: str, out: str = "text") -> DataFrame:
    """Render one template for every row; columns are the variables."""
    return df.withColumn(out, template_column(template, df.schema))


# ------------------------------------------- target 2: segments, many templates

_FILTER = "array<struct<name:string,a:string,b:string>>"
_GUARD = "array<struct<param:string,op:string,value:string,kind:string,neg:boolean>>"
_BODY = f"array<struct<kind:string,value:string,filters:{_FILTER}>>"
SEGMENTS = f"array<struct<kind:string,value:string,filters:{_FILTER},guards:{_GUARD},body:{_BODY}>>"
COMPILED = f"struct<error:string,segments:{SEGMENTS}>"

# one bound value: shown text, kind (str/num/bool/none/list), items of a list
VALUE = "struct<v:string,k:string,items:array<string>>"


def _flatten(nodes: list[dict], guards: list[dict]) -> list[dict]:
    flat = []
    for node in nodes:
        base = dict(kind=node["kind"], value=node.get("value", ""), filters=node.get("filters", []))
        if node["kind"] == "text" and flat and flat[-1]["kind"] == "text" and flat[-1]["guards"] == guards:
            flat[-1]["value"] += node["value"]
        elif node["kind"] in ("text", "var"):
            flat.append(dict(base, guards=guards, body=[]))
        elif node["kind"] == "for":
            body = []
            for item in node["body"]:
                if item["kind"] not in ("text", "var"):
                    raise TemplateError("nested blocks in a loop are not supported here")
                is_loop = item["kind"] == "var" and item["value"] == node["loop"]
                body.append(
                    dict(
                        kind="item" if is_loop else item["kind"],
                        value=item["value"],
                        filters=item.get("filters", []),
                    )
                )
            flat.append(dict(base, guards=guards, body=body))
        else:
            failed: list[dict] = []
            for conds, body in node["branches"]:
                flat += _flatten(body, guards + failed + conds)
                failed = failed + [dict(c, neg=not c["neg"]) for c in conds]
            flat += _flatten(node["orelse"], guards + failed)
    return flat


def compile_json(text: str | None) -> str:
    try:
        return json.dumps(dict(error=None, segments=_flatten(parse_template(text or ""), [])))
    except TemplateError as exc:
        return json.dumps(dict(error=str(exc), segments=[]))


@F.pandas_udf(T.StringType())
def _compile_udf(texts: pd.Series) -> pd.Series:
    return texts.map({t: compile_json(t) for t in texts.unique()})


def compiled(col: Column) -> Column:
    """struct<error, segments> of a template text column."""
    return F.from_json(_compile_udf(col), COMPILED)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _compile_list_udf(lists: pd.Series) -> pd.Series:
    done = {t: compile_json(t) for texts in lists for t in texts}
    return lists.map(lambda texts: [done[t] for t in texts])


def compiled_list(col: Column) -> Column:
    """array<struct<error, segments>> of an array of template texts."""
    return F.transform(_compile_list_udf(col), lambda j: F.from_json(j, COMPILED))


# The evaluation is written as SQL text: one parsed expression instead of a tree of
# some hundred calls per use.


def _filtered_sql(text: str, items: str, filters: str) -> str:
    return rf"""CASE WHEN size({filters}) = 0 THEN {text} ELSE aggregate({filters},
      CASE WHEN exists({filters}, f -> f.name = 'join')
        THEN array_join({items}, get({filters}, 0).a) ELSE {text} END,
      (acc, f) -> CASE f.name
        WHEN 'replace' THEN replace(acc, f.a, f.b)
        WHEN 'title' THEN {_title_sql('acc')}
        WHEN 'upper' THEN upper(acc)
        WHEN 'lower' THEN lower(acc)
        ELSE acc END) END"""


_HOLDS = """coalesce(CASE g.op
  WHEN 'truthy' THEN CASE b.k
    WHEN 'str' THEN b.v <> ''
    WHEN 'num' THEN try_cast(b.v AS double) <> 0
    WHEN 'bool' THEN b.v = 'True'
    WHEN 'list' THEN size(b.items) > 0
    ELSE false END
  WHEN 'eq' THEN CASE
    WHEN b.k = 'num' AND g.kind = 'num' THEN try_cast(b.v AS double) = try_cast(g.value AS double)
    ELSE b.k = g.kind AND b.v = g.value END
  ELSE CASE
    WHEN b.k = 'list' THEN array_contains(b.items, g.value)
    ELSE b.k = 'str' AND contains(b.v, g.value) END
  END, false) <> g.neg"""


def segments_sql(segments: str, ctx: str) -> str:
    """SQL for the text of the segments whose guards hold under the bound context."""

    def shown(name: str) -> str:
        return f"coalesce(try_element_at({ctx}, {name}).v, '')"

    def items(name: str) -> str:
        return f"coalesce(try_element_at({ctx}, {name}).items, array())"

    def variable(part: str) -> str:
        return _filtered_sql(shown(f"{part}.value"), items(f"{part}.value"), f"{part}.filters")

    body = f"""CASE p.kind WHEN 'text' THEN p.value
      WHEN 'item' THEN {_filtered_sql("x", "array(x)", "p.filters")}
      ELSE {variable("p")} END"""
    # the bound value is looked up once per guard, then tested
    holds = f"get(transform(array(try_element_at({ctx}, g.param)), b -> {_HOLDS}), 0)"
    return f"""array_join(transform(
      filter({segments}, s -> forall(s.guards, g -> {holds})),
      s -> CASE s.kind WHEN 'text' THEN s.value
        WHEN 'for' THEN array_join(transform({items("s.value")},
          x -> array_join(transform(s.body, p -> {body}), '')), '')
        ELSE {variable("s")} END), '')"""


def render_segments(segments: str, ctx: str) -> Column:
    """Text of a segments column under a context column."""
    return F.expr(segments_sql(segments, ctx))


def render_segment_lists(lists: str, ctx: str) -> Column:
    """One text per element of an array of segments."""
    return F.expr(f"transform({lists}, t -> {segments_sql('t', ctx)})")
