"""Formulas as SQL text: the column functions that take a module of elementary functions also take ``Sql``."""

from __future__ import annotations


class Text:
    """An SQL expression with the operators of a column."""

    def __init__(self, text: object):
        self.text = text.text if isinstance(text, Text) else f"CAST({text!r} AS DOUBLE)" if isinstance(text, float) else str(text)

    def __str__(self) -> str:
        return self.text

    __repr__ = __str__

    def cast(self, kind: str) -> Text:
        return Text(f"CAST({self.text} AS {kind})")


def _operator(symbol: str):
    return (lambda a, b: Text(f"({Text(a)} {symbol} {Text(b)})")), (lambda a, b: Text(f"({Text(b)} {symbol} {Text(a)})"))


for _name, _symbol in (("add", "+"), ("sub", "-"), ("mul", "*"), ("truediv", "/")):
    _left, _right = _operator(_symbol)
    setattr(Text, f"__{_name}__", _left)
    setattr(Text, f"__r{_name}__", _right)
for _name, _symbol in (("lt", "<"), ("gt", ">"), ("le", "<="), ("ge", ">=")):
    setattr(Text, f"__{_name}__", _operator(_symbol)[0])
Text.__neg__ = lambda a: Text(f"(-{a})")


class _Case:
    def __init__(self, condition: object, value: object):
        self.condition, self.value = condition, value

    def otherwise(self, other: object) -> Text:
        return Text(f"CASE WHEN {self.condition} THEN {Text(self.value)} ELSE {Text(other)} END")


class Sql:
    """The elementary functions as text."""

    when = _Case
    lit = Text


for _name in ("sin", "cos", "tan", "sqrt", "radians", "degrees", "least", "greatest", "pow"):
    setattr(Sql, _name, staticmethod(lambda *a, _n=_name: Text(f"{_n}({', '.join(str(Text(x)) for x in a)})")))
