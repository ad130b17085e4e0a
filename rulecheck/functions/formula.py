"""Rule formulas -> typed Spark Columns.

A formula such as ``((A + B) / C) * 100`` is read with Python's ``ast`` and
turned into Columns over the named columns. It may hold ``+ - * / // % **``,
unary signs, comparisons (also chained), ``and or not`` (``& | ~`` mean the
same and bind as loosely), ``in [..]``, numbers, texts, ``True``/``False``,
the functions of ``FUNCTIONS`` and names; names that are no identifiers stand
in back-quotes.

Types follow pandas. Whole numbers stay whole (``long``) through ``+ - * // %
**`` and ``abs``; ``/`` gives a double; decimals stay exact decimals as long as
the result fits 38 digits; anything with a double is a double; comparisons
give booleans, which count as 0 and 1 beside numbers. Missing values stay
missing in arithmetic and make a comparison false (``!=`` true). Division
follows IEEE (x/0 = +-inf, 0/0 = missing).

Every value carries, beside its exact Column, the same value in doubles. The
exact one is NULL where it does not exist (a whole number beyond 64 bits,
``7 // 0``); the doubles then decide.
"""

from __future__ import annotations

import ast
import operator
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, IntegralType, NumericType, StringType

from .numbers import RuleError, apply_operator, no_nan, round_half_even, safe_divide

_QUOTED = re.compile(r"`([^`]+)`")
_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Value:
    """``kind``: long, decimal (of ``digits``: precision and scale), double,
    bool or text. ``exact``: the Column of that type; ``approx``: the value as
    a double (None for text)."""

    kind: str
    exact: Column
    approx: Column | None
    digits: tuple[int, int] = (0, 0)

    @property
    def is_whole(self) -> bool:
        return self.kind in ("long", "bool")

    def column(self) -> Column:
        """The value as a double; NaN is missing."""
        return no_nan(self.as_number().approx)

    def as_number(self) -> Value:
        """Booleans as 0 and 1; text as the double it spells, else missing."""
        if self.kind == "bool":
            return Value("long", self.exact.cast("bigint"), self.approx)
        if self.kind == "text":
            return double(self.exact.try_cast("double"))
        return self


def double(c: Column) -> Value:
    return Value("double", c, c)


def whole(c: Column, approx: Column | None = None) -> Value:
    return Value("long", c, c.cast("double") if approx is None else approx)


def boolean(c: Column) -> Value:
    return Value("bool", c, c.cast("double"))


def decimal(c: Column, precision: int, scale: int, approx: Column) -> Value:
    """A decimal result; a double where the exact one would not fit."""
    return Value("decimal", c, approx, (precision, scale)) if precision <= 38 else double(approx)


def typed(c: Column, dtype: DataType) -> Value:
    """The value of a column of a table."""
    if isinstance(dtype, BooleanType):
        return boolean(c)
    if isinstance(dtype, IntegralType):
        return whole(c.cast("bigint"))
    if isinstance(dtype, DecimalType):
        return Value("decimal", c, c.cast("double"), (dtype.precision, dtype.scale))
    if isinstance(dtype, NumericType):
        return double(c.cast("double"))
    if isinstance(dtype, StringType):
        return Value("text", c, None)
    raise RuleError(f"a column of type {dtype.simpleString()} in a formula")


def constant(value) -> Value:
    if isinstance(value, bool):
        return boolean(F.lit(value))
    if isinstance(value, int) and _LONG_MIN <= value <= _LONG_MAX:
        return whole(F.lit(value).cast("bigint"), F.lit(float(value)))
    if isinstance(value, (int, float)):
        return double(F.lit(float(value)))
    if isinstance(value, str):
        return Value("text", F.lit(value), None)
    if isinstance(value, Decimal):
        sign, digits, exponent = value.as_tuple()
        scale = max(0, -exponent)
        precision = max(len(digits) + max(0, exponent), scale, 1)
        return Value("decimal", F.lit(value).cast(f"decimal({precision},{scale})"), F.lit(float(value)), (precision, scale))
    raise RuleError(f"unsupported constant {value!r}")


# ---------------------------------------------------------------------------- arithmetic
def _floor_mod(n: Column, d: Column) -> Column:
    """Python's modulo (sign of the divisor) for longs or doubles; NULL for a zero divisor."""
    rest = F.when(d != 0, n % d)
    return F.when((rest != 0) & ((rest < 0) != (d < 0)), rest + d).otherwise(rest)


def _floor_div_double(n: Column, d: Column) -> Column:
    rest = _floor_mod(n, d)
    quotient = _floor_double((n - rest) / F.when(d != 0, d) + F.lit(0.5))  # n - rest is a multiple of d: nearest whole number
    return F.when(d == 0, safe_divide(n, d)).otherwise(quotient)


def _floor_div_long(n: Column, d: Column) -> Column:
    """NULL for a zero divisor and for the one quotient that has no long."""
    usable = (d != 0) & ~((n == F.lit(_LONG_MIN)) & (d == -1))
    quotient = F.call_function("div", F.when(usable, n), F.when(usable, d))
    return F.when(n % F.when(usable, d) == 0, quotient).when((n < 0) != (d < 0), quotient - 1).otherwise(quotient)


def _floor_double(x: Column) -> Column:
    """floor as a double; infinities and large values are whole already."""
    return F.when(F.abs(x) < F.lit(2.0**53), F.floor(x).cast("double")).otherwise(x)


def _ceil_double(x: Column) -> Column:
    return F.when(F.abs(x) < F.lit(2.0**53), F.ceil(x).cast("double")).otherwise(x)


def _power_long(base: Column, exponent: Value, power: int | None) -> Column:
    """Exact power of a long for a constant whole exponent; for any other, exact below 2^53."""
    if power is None or power > 64:
        p = F.pow(base.cast("double"), exponent.approx)
        return F.when((exponent.exact >= 0) & (F.abs(p) < F.lit(2.0**53)), F.rint(p).cast("bigint"))
    out, square = None, base
    while power:
        if power & 1:
            out = square if out is None else F.try_multiply(out, square)
        power >>= 1
        square = F.try_multiply(square, square) if power else square
    return F.lit(1).cast("bigint") if out is None else out


def _as_decimal(v: Value) -> Value:
    return v if v.kind == "decimal" else Value("decimal", v.exact.cast("decimal(19,0)"), v.approx, (19, 0))


def _arithmetic(op: type, a: Value, b: Value, power: int | None) -> Value:
    if a.kind == b.kind == "bool":
        if op is ast.Add:
            return boolean(a.exact | b.exact)
        if op is ast.Mult:
            return boolean(a.exact & b.exact)
        raise RuleError(f"{op.__name__} is not defined for two truth values")
    a, b = a.as_number(), b.as_number()
    x, y = a.approx, b.approx
    if op is ast.Div:
        return double(safe_divide(x, y))
    if op is ast.FloorDiv:
        rough = _floor_div_double(x, y)
    elif op is ast.Mod:
        rough = _floor_mod(x, y)
    elif op is ast.Pow:
        rough = F.when((y == 0) | (x == 1), F.lit(1.0)).otherwise(F.pow(x, y))  # so it is for a missing other side, too
    elif op in (ast.Add, ast.Sub, ast.Mult):
        rough = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul}[op](x, y)
    else:
        raise RuleError(f"unsupported operator {op.__name__}")
    if a.kind == b.kind == "long":
        exact = {
            ast.Add: lambda: F.try_add(a.exact, b.exact), ast.Sub: lambda: F.try_subtract(a.exact, b.exact),
            ast.Mult: lambda: F.try_multiply(a.exact, b.exact), ast.Mod: lambda: _floor_mod(a.exact, b.exact),
            ast.FloorDiv: lambda: _floor_div_long(a.exact, b.exact), ast.Pow: lambda: _power_long(a.exact, b, power),
        }[op]()
        return whole(exact, rough)
    if {a.kind, b.kind} <= {"long", "decimal"} and op in (ast.Add, ast.Sub, ast.Mult):
        a, b = _as_decimal(a), _as_decimal(b)
        (p, s), (q, t) = a.digits, b.digits
        if op is ast.Mult:
            return decimal(F.try_multiply(a.exact, b.exact), p + q + 1, s + t, rough)
        exact = F.try_add(a.exact, b.exact) if op is ast.Add else F.try_subtract(a.exact, b.exact)
        return decimal(exact, max(p - s, q - t) + max(s, t) + 1, max(s, t), rough)
    return double(rough)


def _signed(op: ast.unaryop, v: Value) -> Value:
    if isinstance(op, (ast.Not, ast.Invert)) or v.kind == "bool" and isinstance(op, ast.USub):
        if v.kind == "bool":
            return boolean(~v.exact)
        if v.kind == "long":
            return whole(F.bitwise_not(v.exact))
        raise RuleError(f"'not' of a {v.kind}")
    if isinstance(op, ast.UAdd):
        return v if v.kind == "bool" else v.as_number()
    return _arithmetic(ast.Sub, constant(0), v, None) if v.kind in ("long", "decimal") else double(-v.as_number().approx)


def _log(f: Callable[[Column], Column], at: float) -> Callable[[Column], Column]:
    """A logarithm with its pole: -inf at ``at``, missing below."""
    return lambda x: F.when(x == F.lit(at), F.lit(float("-inf"))).when(x > F.lit(at), f(x))


#: Functions a formula may call, with their number of arguments.
FUNCTIONS: dict[str, tuple[int, Callable[..., Column]]] = {
    "sin": (1, F.sin), "cos": (1, F.cos), "tan": (1, F.tan), "arcsin": (1, F.asin), "arccos": (1, F.acos), "arctan": (1, F.atan),
    "sinh": (1, F.sinh), "cosh": (1, F.cosh), "tanh": (1, F.tanh), "arcsinh": (1, F.asinh), "arccosh": (1, F.acosh),
    "arctanh": (1, F.atanh), "arctan2": (2, F.atan2), "exp": (1, F.exp), "expm1": (1, F.expm1), "sqrt": (1, F.sqrt),
    "log": (1, _log(F.ln, 0.0)), "log10": (1, _log(F.log10, 0.0)), "log1p": (1, _log(F.log1p, -1.0)),
    "floor": (1, _floor_double), "ceil": (1, _ceil_double), "abs": (1, F.abs),
}


def _call(name: str, args: list[Value]) -> Value:
    if name not in FUNCTIONS or FUNCTIONS[name][0] != len(args):
        raise RuleError(f"unknown function {name!r} of {len(args)} values")
    whole_too = name in ("abs", "floor", "ceil")  # they leave whole numbers and truth values what they are
    args = [a if a.kind == "bool" and whole_too else a.as_number() for a in args]
    rough = no_nan(FUNCTIONS[name][1](*[a.approx for a in args]))
    v = args[0]
    if whole_too and v.is_whole:
        return whole(F.when(v.exact != F.lit(_LONG_MIN), F.abs(v.exact)), rough) if name == "abs" and v.kind == "long" else v
    if name == "abs" and v.kind == "decimal":
        return Value("decimal", F.abs(v.exact), rough, v.digits)
    return double(rough)


# ---------------------------------------------------------------------------- comparisons
_COMPARE = {ast.Lt: "<", ast.LtE: "<=", ast.Gt: ">", ast.GtE: ">=", ast.Eq: "==", ast.NotEq: "!="}


def holds(a: Value, op: str, b: Value) -> Column:
    """``a <op> b``; NULL where a side is missing. Whole numbers and decimals
    compare exactly where both have their exact value, else as doubles."""
    if a.kind == b.kind == "text":
        return apply_operator(a.exact, op, b.exact)
    a, b = a.as_number(), b.as_number()
    rough = apply_operator(no_nan(a.approx), op, no_nan(b.approx))
    if "double" in (a.kind, b.kind):
        return rough
    return F.coalesce(apply_operator(a.exact, op, b.exact), rough)


def threshold_value(threshold) -> Callable[[Value], Value]:
    """The threshold in the type that compares exactly with a value: a whole
    number beside whole numbers, the decimal it is written as beside decimals."""
    def beside(v: Value) -> Value:
        if v.kind == "decimal":
            return constant(Decimal(str(threshold)))
        if v.is_whole and float(threshold).is_integer():
            return constant(int(threshold))
        return constant(float(threshold))

    return beside


def differs_rounded(a: Value, b: Value, places: int) -> Column:
    """``round(a, places) != round(b, places)`` (half to even); true where a side is missing."""
    if "text" in (a.kind, b.kind):
        a, b = a.as_number(), b.as_number()
    rough = round_half_even(no_nan(a.approx), places) != round_half_even(no_nan(b.approx), places)
    if "double" in (a.kind, b.kind):
        return F.coalesce(rough, F.lit(True))
    rounded = [v.exact if v.is_whole and places >= 0 else F.bround(v.exact, places) for v in (a.as_number(), b.as_number())]
    return F.coalesce(rounded[0] != rounded[1], rough, F.lit(True))


def _compare(op: ast.cmpop, a: Value, b: Value) -> Value:
    if type(op) not in _COMPARE:
        raise RuleError(f"unsupported comparison {type(op).__name__}")
    return boolean(F.coalesce(holds(a, _COMPARE[type(op)], b), F.lit(isinstance(op, ast.NotEq))))


def _both(op: ast.boolop, a: Value, b: Value) -> Value:
    if a.kind == b.kind == "bool":
        return boolean(a.exact & b.exact if isinstance(op, ast.And) else a.exact | b.exact)
    if a.is_whole and b.is_whole:
        a, b = a.as_number(), b.as_number()
        return whole(a.exact.bitwiseAND(b.exact) if isinstance(op, ast.And) else a.exact.bitwiseOR(b.exact))
    raise RuleError(f"{type(op).__name__} of a {a.kind} and a {b.kind}")


# ---------------------------------------------------------------------------- reading
def formula_names(formula: str) -> list[str]:
    """Column names a formula refers to, in order of appearance."""
    tree, quoted = _parse(formula)
    called = {id(n.func) for n in ast.walk(tree) if isinstance(n, ast.Call)}
    names = sorted((n.col_offset, n.id) for n in ast.walk(tree) if isinstance(n, ast.Name) and id(n) not in called)
    seen: list[str] = []
    for _, name in names:
        if (own := quoted.get(name, name)) not in seen:
            seen.append(own)
    return seen


def _loose_signs(text: str) -> str:
    """``&`` and ``|`` as ``and`` and ``or`` (as pandas reads them), outside of texts."""
    out = re.split(r"('[^']*'|\"[^\"]*\")", text)
    return "".join(p if k % 2 else p.replace("&", " and ").replace("|", " or ") for k, p in enumerate(out))


def _parse(formula: str) -> tuple[ast.Expression, dict[str, str]]:
    """The formula's tree, and the back-quoted name that each stand-in means."""
    prefix = "_q"
    while prefix in formula:
        prefix += "_"
    quoted: dict[str, str] = {}

    def stand_in(found: re.Match) -> str:
        quoted[name := f"{prefix}{len(quoted)}"] = found[1]
        return f" {name} "

    try:
        return ast.parse(_loose_signs(_QUOTED.sub(stand_in, formula)).strip(), mode="eval"), quoted
    except SyntaxError as e:
        raise RuleError(f"bad formula {formula!r}: {e.msg}") from e


def formula_value(formula: str, resolve: Callable[[str], Value]) -> Value:
    """The typed value of ``formula``; ``resolve`` gives a name's value or raises KeyError."""
    tree, quoted = _parse(formula)

    def walk(node: ast.AST) -> Value:
        if isinstance(node, ast.Expression):
            return walk(node.body)
        if isinstance(node, ast.Constant):
            return constant(node.value)
        if isinstance(node, ast.Name):
            name = quoted.get(node.id, node.id)
            try:
                return resolve(name)
            except KeyError as e:
                raise RuleError(f"unknown column {name!r} in formula {formula!r}") from e
        if isinstance(node, ast.UnaryOp):
            if isinstance(node.op, ast.USub) and isinstance(node.operand, ast.Constant) and type(node.operand.value) in (int, float):
                return constant(-node.operand.value)
            return _signed(node.op, walk(node.operand))
        if isinstance(node, ast.BinOp):
            power = node.right.value if isinstance(node.right, ast.Constant) and type(node.right.value) is int else None
            return _arithmetic(type(node.op), walk(node.left), walk(node.right), power)
        if isinstance(node, ast.BoolOp):
            values = [walk(v) for v in node.values]
            out = values[0]
            for v in values[1:]:
                out = _both(node.op, out, v)
            return out
        if isinstance(node, ast.Compare):
            left, out = walk(node.left), None
            for op, right in zip(node.ops, node.comparators, strict=True):
                if isinstance(op, (ast.In, ast.NotIn)):
                    value, right = _member(op, left, right, walk), left
                else:
                    right = walk(right)
                    value = _compare(op, left, right)
                out = value if out is None else _both(ast.And(), out, value)
                left = right
            return out
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and not node.keywords:
            return _call(node.func.id, [walk(a) for a in node.args])
        raise RuleError(f"unsupported element {type(node).__name__} in formula {formula!r}")

    return walk(tree)


def _member(op: ast.cmpop, left: Value, listed: ast.AST, walk: Callable[[ast.AST], Value]) -> Value:
    if not isinstance(listed, (ast.List, ast.Tuple)):
        raise RuleError("'in' needs a list")
    found = F.lit(False)
    for item in listed.elts:
        found = found | _compare(ast.Eq(), left, walk(item)).exact
    return boolean(~found if isinstance(op, ast.NotIn) else found)


def formula_column(formula: str, resolve: Callable[[str], Column] | Mapping[str, Column]) -> Column:
    """Column of doubles computing ``formula`` over columns taken as doubles."""
    lookup = resolve if callable(resolve) else resolve.__getitem__
    return formula_value(formula, lambda name: double(lookup(name).try_cast("double"))).column()
