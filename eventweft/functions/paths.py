"""Dotted document paths as Spark columns.

Path text: ``a.b`` steps into objects, ``a[]`` takes every element of an array, ``a[2]`` takes one.

The paths a model uses give the shape of its documents: nested structs and arrays with text at the
ends. Text is parsed once into that shape, skipping all else; paths are then plain field access in
generated code. A document that does not fit the shape is read again through VARIANT, step by step.

Functions ending in ``_sql`` give expression text over named columns. A model has a thousand paths,
and one parse of their text is far quicker than a call into the JVM for each step.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK, HASH = "_check", "_hash"
#: Where a value does not fit, the whole parse must give NULL.
PARTIAL = "spark.sql.json.enablePartialResults"


@dataclass(frozen=True)
class Step:
    key: str
    index: int | None = None
    every: bool = False


def steps(path: str) -> tuple[Step, ...]:
    """Split path text; the empty path is the document itself."""
    out = []
    for part in path.split(".") if path else []:
        key, bracket, rest = part.partition("[")
        inside = rest.removesuffix("]")
        sound = rest.endswith("]") and (inside == "" or inside.isdecimal()) if bracket else True
        if not sound or not key.replace("_", "a").isalnum():
            raise ValueError(f"bad step {part!r} in path {path!r}")
        out.append(Step(key, int(inside) if inside else None, bool(bracket) and inside == ""))
    return tuple(out)


def fans_out(path: str) -> bool:
    return any(s.every for s in steps(path))


# Shape


def shape(paths: Iterable[str], kept: Iterable[str] = ()) -> T.StructType:
    """The part of a document that the paths reach. Ends are text, those in ``kept`` are VARIANT,
    which tells a JSON number or boolean from a text of the same letters."""
    root: dict = {}
    arrays: dict[tuple[str, ...], bool] = {}
    for path in paths:
        here, trail = root, ()
        for step in steps(path):
            trail += (step.key,)
            is_array = step.every or step.index is not None
            if arrays.setdefault(trail, is_array) != is_array:
                raise ValueError(f"{'.'.join(trail)} is read both as an array and as one value")
            here = here.setdefault(step.key, {})
    ends = {tuple(s.key for s in steps(p)) for p in paths}
    variants = {tuple(s.key for s in steps(p)) for p in kept}

    def build(node: dict, trail: tuple[str, ...]) -> T.DataType:
        if not node:
            kind: T.DataType = T.VariantType() if trail in variants else T.StringType()
        else:
            if trail in ends and trail:
                raise ValueError(f"{'.'.join(trail)} is read both as text and as an object")
            kind = T.StructType([T.StructField(k, build(v, (*trail, k))) for k, v in sorted(node.items())])
        return T.ArrayType(kind) if arrays.get(trail) else kind

    whole = build(root, ())
    return whole if isinstance(whole, T.StructType) else T.StructType([])


def with_document(events: DataFrame, raw: str, kind: T.StructType, name: str = "doc", fitted: str | None = None) -> DataFrame:
    """Replace raw text by its document in the given shape; NULL where no object can be parsed.

    A parser stops after the first value and takes the last of repeated keys, so neither the text alone
    nor an object around it shows that the text is one document. It is parsed as the first of two elements
    of an array, whose second holds the text's hash: text that ends the document and goes on, with members,
    further documents or the end of the array, leaves no array of exactly these two.

    The document comes out of a generator, below which no filter on it can be moved: there the optimizer would put
    the parse in place of each mention of the document. ``fitted`` names a column that tells whether the quick parse did.
    """
    if CHECK in kind.fieldNames():
        raise ValueError(f"a document path can't begin with {CHECK}")
    if events.sparkSession.conf.get(PARTIAL) != "false":
        raise ValueError(f"{PARTIAL} must be false, or values that do not fit get lost: see session.prepare")
    elements = T.ArrayType(T.StructType([*kind.fields, T.StructField(CHECK, T.LongType())]))
    others = [F.col(c) for c in events.columns if c != raw]
    # Steps, so that the hash and the parse are done once and then used twice.
    hashed = events.select(*others, F.col(raw), F.xxhash64(raw).alias(HASH))
    fast = hashed.select(*others, F.col(raw), F.col(HASH), F.from_json(F.expr(_enclosed_sql(f"`{raw}`", HASH)), elements).alias("_fast"))
    first = F.get("_fast", F.lit(0))
    fits = (F.size("_fast") == 2) & (F.get("_fast", F.lit(1))[CHECK] == F.col(HASH)) & first.isNotNull()
    whole = F.struct(*[first[f.name].alias(f.name) for f in kind.fields]) if kind.fields else F.struct()
    careful = F.expr(read_variant_sql(repaired_variant_sql(raw), kind))
    told = [F.coalesce(fits, F.lit(False)).alias(fitted)] if fitted else []
    return fast.select(*others, *told, F.explode_outer(F.array(F.when(fits, whole).otherwise(careful))).alias(name))


def _enclosed_sql(text: str, digest: str) -> str:
    return f"""concat('[', {text}, ',{{"{CHECK}":', {digest}, '}}]')"""


def strict_variant_sql(text: str) -> str:
    """VARIANT of a text that is one JSON value and nothing more, else NULL."""
    parsed = f"try_parse_json({_enclosed_sql('x.t', 'x.h')})"
    ended = f"try_variant_get(v, '$[1].{CHECK}', 'bigint') = x.h"
    inside = f"get(transform(array({parsed}), v -> CASE WHEN {ended} THEN try_variant_get(v, '$[0]', 'variant') END), 0)"
    return f"get(transform(array(named_struct('t', {text}, 'h', xxhash64({text}))), x -> {inside}), 0)"


# Texts that a careless export has wrapped in quotes or whose quotes it has doubled.
_OPENING, _CLOSING, _QUOTED = r'^\s*"(?=\s*[\{\[])', r'(?<=[\}\]])"\s*$', r'^\s*"'


def raw_forms_sql(raw: str) -> tuple[str, str]:
    """The text without an outer pair of quotes, and that with doubled quotes made single."""
    unwrapped = f"regexp_replace(regexp_replace(`{raw}`, r'{_OPENING}', ''), r'{_CLOSING}', '')"
    return unwrapped, _single_quotes(unwrapped)


def _single_quotes(text: str) -> str:
    return f"""replace({text}, '""', '"')"""


def quoted_whole_sql(raw: str) -> str:
    return f"`{raw}` rlike r'{_QUOTED}'"


def repaired_variant_sql(raw: str) -> str:
    """VARIANT of raw text, mended if need be; no text is parsed twice, as text that does not parse costs most."""
    unwrapped, _ = raw_forms_sql(raw)
    sound = f"CASE WHEN NOT {quoted_whole_sql(raw)} THEN {strict_variant_sql(f'`{raw}`')} END"
    second = f"CASE WHEN {quoted_whole_sql(raw)} OR u <> `{raw}` THEN {strict_variant_sql('u')} END"
    third = f"CASE WHEN m <> u THEN {strict_variant_sql('m')} END"
    forms = f"get(transform(array({unwrapped}), u -> coalesce({second}, get(transform(array({_single_quotes('u')}), m -> {third}), 0))), 0)"
    return f"coalesce({sound}, {forms})"


def read_variant_sql(value: str, kind: T.DataType) -> str:
    """A VARIANT read into a shape: what does not fit is NULL, a lone value stands for an array of one."""
    if isinstance(kind, T.VariantType):
        return value
    if isinstance(kind, T.StringType):
        return f"try_variant_get({value}, '$', 'string')"
    if isinstance(kind, T.ArrayType):
        elements = "coalesce(try_variant_get(v, '$', 'array<variant>'), array(v))"
        inside = f"transform({elements}, x -> {read_variant_sql('x', kind.elementType)})"
    else:
        inside = "named_struct(" + ", ".join(f"'{f.name}', {_field_sql(f)}" for f in kind.fields) + ")"
    bound = f"CASE WHEN v IS NOT NULL AND NOT is_variant_null(v) THEN {inside} END"
    return f"get(transform(array({value}), v -> {bound}), 0)"


def _field_sql(f: T.StructField) -> str:
    if isinstance(f.dataType, T.StringType):
        return f"try_variant_get(v, '$.{f.name}', 'string')"
    return read_variant_sql(f"try_variant_get(v, '$.{f.name}', 'variant')", f.dataType)


# Reading


def walk_sql(value: str, run: Iterable[Step]) -> str:
    for step in run:
        value = f"{value}.`{step.key}`"
        if step.index is not None:
            value = f"get({value}, {step.index})"
    return value


def scalar_sql(doc: str, path: str) -> str:
    if fans_out(path):
        raise ValueError(f"{path!r} yields many values; use every()")
    return walk_sql(doc, steps(path))


def nodes_sql(doc: str, path: str) -> str:
    """``array<struct<node, ord array<int>>>``: what the path reaches, in document order.

    Missing keys and JSON nulls are passed over. ``ord`` holds the position in each array passed
    on the way, so that rows can be related by place.
    """
    runs: list[list[Step]] = [[]]
    for step in steps(path):
        runs[-1].append(step)
        if step.every:
            runs.append([])
    *heads, tail = runs
    here = None
    for head in heads:
        if here is None:
            here = f"transform({walk_sql(doc, head)}, (x, i) -> named_struct('node', x, 'ord', array(i)))"
        else:
            below = walk_sql("n.node", head)
            children = f"transform({below}, (x, i) -> named_struct('node', x, 'ord', concat(n.ord, array(i))))"
            here = f"flatten(transform(filter({here}, n -> {below} IS NOT NULL), n -> {children}))"
    if here is None:
        here = f"array(named_struct('node', {walk_sql(doc, tail)}, 'ord', cast(array() AS array<int>)))"
    elif tail:
        here = f"transform({here}, n -> named_struct('node', {walk_sql('n.node', tail)}, 'ord', n.ord))"
    return f"filter({here}, n -> n.node IS NOT NULL)"


def every_sql(doc: str, path: str) -> str:
    return f"transform({nodes_sql(doc, path)}, n -> n.node)"


def scalar(doc: str, path: str) -> Column:
    """One value as text: NULL when a step is missing or JSON null; objects give JSON text."""
    return F.expr(scalar_sql(doc, path))


def nodes(doc: str, path: str) -> Column:
    return F.expr(nodes_sql(doc, path))


def every(doc: str, path: str) -> Column:
    """Every value the path reaches, as texts in document order; NULL when there is none."""
    texts = every_sql(doc, path)
    return F.expr(f"CASE WHEN size({texts}) > 0 THEN {texts} END")
