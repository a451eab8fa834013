"""Attribute filters in the dialect of data-frame queries (==, !=, in [..], and/or/not, &, |, ~) as SQL expressions."""

from __future__ import annotations

import ast
import io
import tokenize

WORDS = {"&": "and", "|": "or", "~": "not"}
COMPARED = {ast.Eq: "=", ast.Lt: "<", ast.LtE: "<=", ast.Gt: ">", ast.GtE: ">="}
COUNTED = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/", ast.Mod: "%"}


class NotADialect(ValueError):
    """The text is no expression of this dialect."""


def _plain(text: str) -> tuple[str, dict[str, str]]:
    """The text as an expression that parses, and the names that stood in backticks. Strings stay as they are."""
    names: dict[str, str] = {}
    parts = text.split("`")
    if len(parts) % 2 == 0:
        raise NotADialect(text)
    for k in range(1, len(parts), 2):
        names[f"__name{k}"] = parts[k]
        parts[k] = f"__name{k}"
    out = []
    try:
        for t in tokenize.generate_tokens(io.StringIO("".join(parts)).readline):
            if t.type in (tokenize.NEWLINE, tokenize.NL, tokenize.ENDMARKER):
                continue
            out.append(WORDS.get(t.string, t.string) if t.type == tokenize.OP else t.string)
    except (tokenize.TokenError, SyntaxError, IndentationError) as e:
        raise NotADialect(text) from e
    return " ".join(out), names


def _sql(n: ast.AST, names: dict[str, str]) -> str:
    sql = lambda x: _sql(x, names)
    match n:
        case ast.Constant(value=str() as v):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        case ast.Constant(value=v):
            return {True: "true", False: "false", None: "NULL"}[v] if v is None or isinstance(v, bool) else repr(v)
        case ast.Name(id=v):
            return "`" + names.get(v, v) + "`"
        case ast.UnaryOp(op=ast.USub(), operand=x):
            return f"-{sql(x)}"
        case ast.UnaryOp(op=ast.Not(), operand=x):
            return f"NOT coalesce({sql(x)}, false)"  # a comparison with nothing is false, so its opposite is true
        case ast.BoolOp(op=op, values=xs):
            return "(" + (" AND " if isinstance(op, ast.And) else " OR ").join(map(sql, xs)) + ")"
        case ast.BinOp(left=a, op=op, right=b) if type(op) in COUNTED:
            return f"({sql(a)} {COUNTED[type(op)]} {sql(b)})"
        case ast.List(elts=xs) | ast.Tuple(elts=xs):
            return "(" + (", ".join(map(sql, xs)) or "NULL") + ")"
        case ast.Call(func=ast.Attribute(value=x, attr="isin"), args=[ast.List() | ast.Tuple() as many]):
            return f"{sql(x)} IN {sql(many)}"
        case ast.Call(func=ast.Attribute(value=x, attr="isna" | "isnull"), args=[]):
            return f"{sql(x)} IS NULL"
        case ast.Call(func=ast.Attribute(value=x, attr="notna" | "notnull"), args=[]):
            return f"{sql(x)} IS NOT NULL"
        case ast.Compare(left=a, ops=ops, comparators=bs):
            out = []
            for op, b in zip(ops, bs, strict=True):
                many = isinstance(b, ast.List | ast.Tuple)
                if isinstance(op, ast.In) or isinstance(op, ast.Eq) and many:
                    out.append(f"{sql(a)} IN {sql(b)}")
                elif isinstance(op, ast.NotIn) or isinstance(op, ast.NotEq) and many:
                    out.append(f"NOT coalesce({sql(a)} IN {sql(b)}, false)")
                elif isinstance(op, ast.NotEq):
                    out.append(f"NOT ({sql(a)} <=> {sql(b)})")
                elif type(op) in COMPARED:
                    out.append(f"{sql(a)} {COMPARED[type(op)]} {sql(b)}")
                else:
                    raise NotADialect(ast.dump(op))
                a = b
            return "(" + " AND ".join(out) + ")"
    raise NotADialect(ast.dump(n))


def translated(where: str) -> str:
    """The filter as a SQL expression; what is no expression of the dialect is taken to be SQL already."""
    try:
        text, names = _plain(where)
        return _sql(ast.parse(text, mode="eval").body, names)
    except (NotADialect, SyntaxError):
        return where
