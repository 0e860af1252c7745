"""Statement text: quoted names, rendered types, and the type-name map."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The PostgreSQL key words that may not stand unquoted as a name
# (reserved, type or function name, column name), from its published key word table.
KEY_WORDS = (
    "all analyse analyze and any array as asc asymmetric authorization between bigint binary bit "
    "boolean both case cast char character check coalesce collate collation column concurrently "
    "constraint create cross current_catalog current_date current_role current_schema current_time "
    "current_timestamp current_user dec decimal default deferrable desc distinct do else end except "
    "exists extract false fetch float for foreign freeze from full grant greatest group grouping "
    "having ilike in initially inner inout int integer intersect interval into is isnull join json "
    "json_array json_arrayagg json_exists json_object json_objectagg json_query json_scalar "
    "json_serialize json_table json_value lateral leading least left like limit localtime "
    "localtimestamp merge_action national natural nchar none normalize not notnull null nullif "
    "numeric offset on only or order out outer overlaps overlay placing position precision primary "
    "real references returning right row select session_user setof similar smallint some substring "
    "symmetric system_user table tablesample then time timestamp to trailing treat trim true union "
    "unique user using values varchar variadic verbose when where window with xmlattributes "
    "xmlconcat xmlelement xmlexists xmlforest xmlnamespaces xmlparse xmlpi xmlroot xmlserialize "
    "xmltable"
).split()


def quote_ident(name: str) -> Column:
    """The SQL expression ``name`` as it has to be written in a statement."""
    # parsed as one text: a list of literals would cost one JVM call per key word
    words = ", ".join(f"'{w}'" for w in KEY_WORDS)
    plain = f"({name}) RLIKE r'^[a-z_][a-z0-9_]*\\z' AND ({name}) NOT IN ({words})"
    return F.expr(f"""CASE WHEN {plain} THEN ({name}) ELSE concat('"', replace(({name}), '"', '""'), '"') END""")


def qualified(schema: str, name: str) -> Column:
    return F.concat(quote_ident(schema), F.lit("."), quote_ident(name))


def text(*parts: Column | str) -> Column:
    """Concatenation in which a NULL part prints nothing."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def type_text(type_: Column, length: Column) -> Column:
    """Type name, with ``(length)`` for character types unless it is absent or -1."""
    sized = type_.ilike("%char%") & (F.coalesce(length, F.lit(-1)) != -1)
    return F.when(sized, text(type_, "(", length, ")")).otherwise(type_)


def render_type(type_: Column, length: Column, nullable: Column, default: Column) -> Column:
    """Type text with its NOT NULL and DEFAULT suffixes."""
    return text(
        type_text(type_, length),
        F.when(~nullable, F.lit(" NOT NULL")),
        F.when(default.isNotNull(), F.concat(F.lit(" DEFAULT "), default)),
    )


# Catalog type names and the Spark types that hold them.
_SPARK_TYPES: dict[str, T.DataType] = {
    "int2": T.ShortType(),
    "int4": T.IntegerType(),
    "int8": T.LongType(),
    "float4": T.FloatType(),
    "float8": T.DoubleType(),
    "text": T.StringType(),
    "varchar": T.StringType(),
    "bpchar": T.StringType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "bytea": T.BinaryType(),
    "json": T.StringType(),
    "jsonb": T.StringType(),
    # types without a Spark type of their own are held as their text
    "uuid": T.StringType(),
    "time": T.StringType(),
    "timetz": T.StringType(),
    "interval": T.StringType(),
    "inet": T.StringType(),
    "cidr": T.StringType(),
    "macaddr": T.StringType(),
    "xml": T.StringType(),
    "bit": T.StringType(),
    "varbit": T.StringType(),
    "name": T.StringType(),
    "char": T.StringType(),
    '"char"': T.StringType(),
    "oid": T.LongType(),
    "money": T.DecimalType(19, 2),
}
_TYPMOD_HEADER = 4  # a type modifier counts four bytes more than what was declared


def spark_type(type_: str, length: int | None = None) -> T.DataType:
    """Spark type for a catalog type name and its type modifier."""
    if type_.startswith("_"):
        return T.ArrayType(spark_type(type_[1:], length))
    if type_ == "numeric":
        if length is None or length < _TYPMOD_HEADER:
            return T.DecimalType(38, 18)
        packed = length - _TYPMOD_HEADER
        return T.DecimalType((packed >> 16) & 0xFFFF, packed & 0x7FF)
    if type_ not in _SPARK_TYPES:
        raise ValueError(f"no Spark type for catalog type {type_!r}")
    return _SPARK_TYPES[type_]


def declared_chars(type_: str, length: int | None) -> int | None:
    """n of varchar(n) and char(n), None where any length fits."""
    if type_.strip('"') == "char":  # one byte, without a modifier
        return 1
    if not re.search("char", type_, re.IGNORECASE) or type_.startswith("_") or length is None or length < _TYPMOD_HEADER:
        return None
    return length - _TYPMOD_HEADER


# Type names as casts in catalog texts write them, and Spark's names.
_CAST_TYPES = {
    "character varying": "string",
    "character": "string",
    "varchar": "string",
    "bpchar": "string",
    "text": "string",
    "name": "string",
    "uuid": "string",
    "smallint": "smallint",
    "integer": "int",
    "bigint": "bigint",
    "numeric": "decimal(38,18)",
    "real": "float",
    "double precision": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp without time zone": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
}
# Matching operators of catalog texts, and how Spark says them; of a regular expression, whether case counts.
_LIKE = {"~~": "LIKE", "!~~": "NOT LIKE", "~~*": "ILIKE", "!~~*": "NOT ILIKE"}
_REGEX = {"~": ("RLIKE", True), "!~": ("NOT RLIKE", True), "~*": ("RLIKE", False), "!~*": ("NOT RLIKE", False)}
# Operators that both write alike.
_SAME = frozenset("= <> != < > <= >= + - * / % || & | . , ( )".split())
# Character classes of regular expressions, and Java's names.
_CLASSES = {
    "alpha": r"\p{IsAlphabetic}", "digit": r"\d", "alnum": r"\p{IsAlphabetic}\d", "space": r"\s", "upper": r"\p{IsUppercase}",
    "lower": r"\p{IsLowercase}", "punct": r"\p{Punct}", "xdigit": r"\p{XDigit}", "blank": r"\p{Blank}", "cntrl": r"\p{Cntrl}",
}
_TOKEN = re.compile(
    r"(?P<space>\s+)|(?P<escaped>[eE]'(?:[^'\\]|''|\\.)*')|(?P<text>'(?:[^']|'')*')|(?P<name>\"(?:[^\"]|\"\")+\")"
    r"|(?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?[A-Za-z]*)|(?P<word>[^\W\d]\w*)"
    r"|(?P<mark>::|->>|->|@>|<@|&&|!~~\*|!~~|~~\*|~~|!~\*|!~|~\*|<=|>=|<>|!=|\|\||.)",
    re.DOTALL,
)
_INTERVAL = re.compile(
    r"(?:(?P<y>-?\d+) years? ?)?(?:(?P<mo>-?\d+) mons? ?)?(?:(?P<d>-?\d+) days? ?)?(?:(?P<sign>-?)(?P<h>\d+):(?P<mi>\d\d):(?P<s>\d\d(?:\.\d+)?))?"
)


class _Tokens:
    """A catalog text, token by token; operands are found by their place."""

    def __init__(self, catalog_text: str):
        self.text = catalog_text
        found = [(m.lastgroup, m[0]) for m in _TOKEN.finditer(catalog_text)]
        self.kinds = [k for k, _ in found if k != "space"]
        self.tokens = [t for k, t in found if k != "space"]

    def unknown(self, what: str) -> ValueError:
        return ValueError(f"{what} in {self.text!r} has no counterpart here")

    def at(self, i: int) -> str:
        return self.tokens[i].upper() if i < len(self.tokens) and self.kinds[i] in ("word", "mark") else ""

    def closing(self, i: int) -> int:
        """The place of the bracket that ends the one at ``i``."""
        depth = 0
        for k in range(i, len(self.tokens)):
            depth += (self.at(k) in ("(", "[")) - (self.at(k) in (")", "]"))
            if not depth:
                return k
        raise self.unknown("an open bracket")

    def operand(self, i: int) -> int:
        """The place behind the operand that begins at ``i``: a value, a name, a call or a bracket, with its casts."""
        if self.at(i) in ("-", "+"):
            return self.operand(i + 1)
        if self.at(i) == "(":
            i = self.closing(i) + 1
        elif i < len(self.tokens) and self.kinds[i] != "mark":
            i += 1
            while self.at(i) == ".":
                i += 2
            if self.at(i) in ("(", "["):
                i = self.closing(i) + 1
        else:
            raise self.unknown("a missing operand")
        while self.at(i) == "::":
            i = self.cast(i)[1]
        return i

    def cast(self, i: int) -> tuple[str, int]:
        """The type that the cast at ``i`` names, as Spark says it, and the place behind it."""
        name, end = None, i + 1
        for k in range(min(len(self.tokens), i + 5), i + 1, -1):
            said = " ".join(t.lower() for t in self.tokens[i + 1 : k])
            if said in _CAST_TYPES or said == "interval":
                name, end = said, k
                break
        if name is None:
            raise self.unknown(f"the type {' '.join(self.tokens[i + 1 : i + 2])}")
        kind = _CAST_TYPES.get(name, name)
        if self.at(end) == "(":
            close = self.closing(end)
            if name == "numeric":
                kind = f"decimal({''.join(self.tokens[end + 1 : close])})"
            end = close + 1
        if self.at(end) == "[" and self.at(end + 1) == "]":
            kind, end = f"array<{kind}>", end + 2
        return kind, end

    def items(self, i: int) -> tuple[int, int, int]:
        """For ``(ARRAY[...])`` at ``i``, with brackets and casts around the list: where its items begin and end, and what follows."""
        close = self.closing(i)
        start = i + 1
        while self.at(start) == "(":
            start += 1
        if self.at(start) != "ARRAY" or self.at(start + 1) != "[":
            raise self.unknown("ANY or ALL of anything but a list")
        return start + 2, self.closing(start + 1), close + 1

    def string(self, i: int) -> str:
        """The value of the string at ``i``."""
        token = self.tokens[i]
        if self.kinds[i] == "text":
            return token[1:-1].replace("''", "'")
        plain = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
        return re.sub(r"''|\\(.)", lambda m: "'" if m[0] == "''" else plain.get(m[1], m[1]), token[2:-1], flags=re.DOTALL)

    def regex(self, start: int, end: int) -> str:
        """A pattern as Java writes it; one that is no string is taken as it is."""
        if self.kinds[start] not in ("text", "escaped"):
            return self.written(start, end)
        pattern = self.string(start)
        if pattern.startswith("***") or re.search(r"\\[mM<>]|\[\[[.=]", pattern):
            raise self.unknown(f"the pattern {pattern}")
        pattern = re.sub(r"\[:(\w+):\]", lambda m: _CLASSES.get(m[1], m[0]), pattern).replace(r"\y", r"\b").replace(r"\Y", r"\B")
        return _quoted(pattern)

    def interval(self, i: int) -> str:
        m = _INTERVAL.fullmatch(self.string(i).strip())
        if not m or not self.string(i).strip():
            raise self.unknown(f"the interval {self.tokens[i]}")
        part = {k: m[k] or "0" for k in ("y", "mo", "d", "h", "mi", "s")}
        sign = m["sign"] or ""
        return f"make_interval({part['y']}, {part['mo']}, 0, {part['d']}, {sign}{part['h']}, {sign}{part['mi']}, {sign}{part['s']})"

    def written(self, i: int, end: int) -> str:
        """The tokens from ``i`` up to ``end`` as a Spark expression."""
        out: list[str] = []
        while i < end:
            kind, token, word = self.kinds[i], self.tokens[i], self.at(i)
            if kind in ("text", "escaped"):
                if self.at(i + 1) == "::" and self.at(i + 2) == "INTERVAL":
                    out.append(self.interval(i))
                    i = self.cast(i + 1)[1]
                    continue
                out.append(_quoted(self.string(i)))
            elif kind == "name":
                out.append("`" + token[1:-1].replace('""', '"').replace("`", "``") + "`")
            elif word == "::":
                named, i = self.cast(i)
                if named == "interval":
                    raise self.unknown("an interval that is no string")
                out.append(f"::{named}")
                continue
            elif word == "ARRAY" and self.at(i + 1) == "[":
                close = self.closing(i + 1)
                out.append(f"array({self.written(i + 2, close)})")
                i = close
            elif word in _LIKE or word in _REGEX or (word in ("=", "<>") and self.at(i + 1) in ("ANY", "ALL")):
                said, i = self._matched(i)
                out.append(said)
                continue
            elif kind in ("number", "word") or word in _SAME:
                if word == "(":
                    self.closing(i)
                out.append(token)
            else:
                raise self.unknown(f"the operator {token}")
            i += 1
        return " ".join(out).replace(" ::", "::").replace(" . ", ".")

    def _matched(self, i: int) -> tuple[str, int]:
        """An operator that Spark writes in another way, with what stands behind it."""
        operator, quantifier = self.at(i), self.at(i + 1) if self.at(i + 1) in ("ANY", "ALL") else ""
        if operator in _REGEX:
            if quantifier:
                raise self.unknown(f"{operator} {quantifier}")
            said, exact = _REGEX[operator]
            end = self.operand(i + 1)
            pattern = self.regex(i + 1, end)
            return (f"{said} {pattern}" if exact else f"{said} concat('(?i)', {pattern})"), end
        if not quantifier:
            self.operand(i + 1)  # there has to be one
            return _LIKE[operator], i + 1
        start, stop, end = self.items(i + 2)
        listed = self.written(start, stop)
        if operator in _LIKE:
            return f"{_LIKE[operator]} {quantifier} ({listed})", end
        if (operator, quantifier) not in (("=", "ANY"), ("<>", "ALL")):
            raise self.unknown(f"{operator} {quantifier}")
        return f"{'IN' if operator == '=' else 'NOT IN'} ({listed})", end


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spark_expression(catalog_text: str) -> str:
    """A default or check, as a catalog stores it, as a Spark SQL expression.

    The CHECK around a condition goes; casts name Spark's types, quoted names and
    strings are written Spark's way; ``= ANY (ARRAY[...])`` becomes IN, ``~~`` and
    its kin LIKE and ILIKE, ``~`` and its kin RLIKE with the pattern in Java's
    writing, an interval ``make_interval``. What is alike in both stays; an
    operator, type, pattern or interval without a counterpart is an error that
    gives the text. Numbers of a sequence cannot be drawn in an expression: a text
    with ``nextval`` is an error.
    """
    if re.search(r"\bnextval\s*\(", catalog_text, re.IGNORECASE):
        raise ValueError(f"{catalog_text!r} draws from a sequence; use assign_sequence")
    found = re.fullmatch(r"\s*CHECK\s*\((?P<inner>.*)\)(?:\s*NO INHERIT)?(?:\s*NOT VALID)?\s*", catalog_text, re.IGNORECASE | re.DOTALL)
    tokens = _Tokens(found["inner"] if found else catalog_text)
    return tokens.written(0, len(tokens.tokens))
