"""Nested documents: shapes, validation, flattening and parameter rows."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.storage import stored


def skeleton(template: str) -> dict:
    """The JSON object from the first '{' to the last '}' of a template; empty where there is none."""
    a, b = template.find("{"), template.rfind("}")
    try:
        got = json.loads(template[a : b + 1]) if 0 <= a < b else {}
    except ValueError:
        got = {}
    return got if isinstance(got, dict) else {}


def shape(node) -> T.DataType:
    """Spark type of a skeleton: objects are structs, lists take their first element's type, leaves are strings."""
    if isinstance(node, dict):
        return T.StructType([T.StructField(k, shape(v)) for k, v in node.items()])
    if isinstance(node, list):
        return T.ArrayType(shape(node[0]) if node else T.StringType())
    return T.StringType()


def _typed(kind: T.DataType) -> str:
    """A type's text with quoted names."""
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join('`' + f.name.replace('`', '``') + '`: ' + _typed(f.dataType) for f in kind.fields)}>"
    return f"array<{_typed(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


def coerce(doc: Column, node) -> Column:
    """A JSON text as a struct in the skeleton's shape, at every depth, with texts as leaves; ``coerced`` has the rules and keeps what the skeleton does not know."""
    return F.try_variant_get(coerced(F.try_parse_json(doc), node), "$", _typed(shape(node)))


def _step(name: str) -> str:
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"a key with both kinds of quotes: {name}")
    return f"[{quote}{name}{quote}]"


def coerced(v: Column, node) -> Column:
    """A VARIANT in the skeleton's shape at every depth.

    Objects get all keys of the skeleton, null where missing, and keep the keys that it does not know;
    what is no object becomes an object of nulls. What is no list becomes an empty one; each element of
    a list takes the shape of the skeleton's first. Leaves stay as they are.
    """
    return F.transform(F.array(v), lambda x: _shaped(x, node, "$"))[0]  # bound to a variable, so that a text is parsed once


def _shaped(v: Column, node, path: str) -> Column:
    if isinstance(node, dict):
        src = F.coalesce(F.try_variant_get(v, path, "map<string,variant>"), F.create_map().cast("map<string,variant>"))
        if not node:
            return F.to_variant_object(src)
        known = F.map_from_arrays(F.array(*map(F.lit, node)), F.array(*[_shaped(v, x, path + _step(k)) for k, x in node.items()]))
        return F.to_variant_object(F.map_concat(known, F.map_filter(src, lambda k, _: ~k.isin(list(node)))))
    if isinstance(node, list):
        items = F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
        return F.to_variant_object(F.transform(items, lambda x: _shaped(x, node[0], "$")) if node else items)
    return F.coalesce(F.try_variant_get(v, path, "variant"), F.parse_json(F.lit("null")))


def _walk(v: Column, node, at: str, path: Column) -> Column | None:
    """Faults (array of texts) of a VARIANT against a skeleton; ``at`` is the way from ``v``, ``path`` the one from the record."""
    none = F.array().cast("array<string>")
    if isinstance(node, dict):
        below = [_walk(v, x, at + _step(k), F.concat(path, F.when(path == "", F.lit(k)).otherwise(F.lit(f".{k}")))) for k, x in node.items()]
        below = [x for x in below if x is not None]
        fault = F.array(F.concat(F.when(path == "", F.lit("root")).otherwise(path), F.lit(" must be an object")))
        return F.when(F.try_variant_get(v, at, "map<string,variant>").isNull(), fault).otherwise(F.concat(none, *below))
    if isinstance(node, list):
        items = F.try_variant_get(v, at, "array<variant>")
        inner = none if not node or not isinstance(node[0], dict | list) else F.flatten(F.transform(items, lambda x, i: _walk(x, node[0], "$", F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        return F.when(items.isNull(), F.array(F.concat(path, F.lit(" must be a list")))).otherwise(inner)
    return None


#: A list of parameters, and the two older ones of which both must be lists where the first is none.
REGISTRY, LEGACY = ("parameters", "registry"), (("elastic_parameters", "constants"), ("plastic_parameters", "parameters"))


def faults(docs: DataFrame, node: dict, doc: str = "doc", key: str = "record_id") -> DataFrame:
    """(key, ord, fault): everything in which a JSON text departs from the skeleton, in its order, with paths like ``a.b[3].c``.

    First missing top-level keys, then lists of parameters that are none (an absent one passes), then
    every place that must be an object or a list, in lists of objects too. A null text, one that is no
    object and one that is no JSON have the one fault that says so.
    """

    def found(v: Column) -> Column:
        keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
        missing = F.filter(F.array(*map(F.lit, node)), lambda k: ~F.array_contains(keys, k))

        def is_list(outer: str, inner: str) -> Column:
            at = F.try_variant_get(v, f"$.{outer}.{inner}", "variant")
            return at.isNull() | F.try_variant_get(v, f"$.{outer}.{inner}", "array<variant>").isNotNull()

        older = [F.when(~is_list(*REGISTRY) & ~is_list(*x), F.array(F.lit(f"{'.'.join(x)} must be a list"))).otherwise(F.array().cast("array<string>")) for x in LEGACY]
        every = F.concat(F.transform(missing, lambda k: F.concat(F.lit("missing top-level key: "), k)), *older, _walk(v, node, "$", F.lit("")))
        return F.when(keys.isNull(), F.array(F.lit("payload is not an object"))).otherwise(every)

    return docs.select(key, F.posexplode(F.transform(F.array(F.try_parse_json(F.col(doc))), found)[0]).alias("ord", "fault"))


def problems(docs: DataFrame, node: dict, doc: str = "doc", key: str = "record_id") -> DataFrame:
    """(key, path, problem) for every place where a JSON text misses the skeleton's top keys or has another kind there; ``faults`` looks below them. A text that is no object misses all."""
    v = F.try_parse_json(F.col(doc))
    rows = []
    for name, want in node.items():
        kind = F.schema_of_variant(F.try_variant_get(v, f"$['{name}']", "variant"))
        present = F.coalesce(F.array_contains(F.json_object_keys(F.col(doc)), name), F.lit(False))
        text = F.when(~present, "missing")
        if isinstance(want, dict):
            text = text.when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), "not an object")
        elif isinstance(want, list):
            text = text.when(~F.coalesce(kind.startswith("ARRAY"), F.lit(False)), "not a list")
        rows.append(F.struct(F.lit(name).alias("path"), text.alias("problem")))
    return docs.select(key, F.explode(F.array(*rows)).alias("x")).select(key, "x.path", "x.problem").filter("problem is not null")


def depth(doc: Column) -> Column:
    """How deep the objects and lists of a JSON text are nested; 0 for a scalar."""
    unescaped = F.when(F.contains(doc, F.lit("\\")), F.regexp_replace(doc, r"\\.", "")).otherwise(doc)
    marks = F.translate(F.regexp_replace(F.regexp_replace(unescaped, '"[^"]*"', ""), r"[^\[\]{}]+", ""), "{}", "[]")
    up = lambda s, c: s["now"] + F.when(c == "[", 1).otherwise(-1)
    step = lambda s, c: F.struct(up(s, c).alias("now"), F.greatest(s["most"], up(s, c)).alias("most"))

    def level(m: Column, rounds: int) -> Column:
        if not rounds:
            return F.when(m == "", 0).otherwise(F.aggregate(F.split(m, "(?<=.)(?=.)"), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step)["most"])
        # Without its innermost pairs, which are most of the marks, a text is one level less deep.
        return F.when(m == "", 0).otherwise(1 + F.transform(F.array(F.replace(m, F.lit("[]"), F.lit(""))), lambda x: level(x, rounds - 1))[0])

    return F.transform(F.array(marks), lambda x: level(x, 3))[0]


def deepest(docs: DataFrame, doc: str = "doc") -> int:
    """The depth of the deepest JSON text that can be read."""
    return docs.filter(F.try_parse_json(doc).isNotNull()).agg(F.max(depth(F.col(doc)))).first()[0] or 0


#: Levels that one plan opens; deeper documents take more rounds.
LEVELS = 8


def flatten(docs: DataFrame, key: str = "record_id", doc: str = "doc") -> DataFrame:
    """(key, path, value) of every leaf of JSON texts, paths like ``a.b[0].c``; empty objects and lists have no leaves.

    Each level is one generator over VARIANT values, as many as the deepest text has; leaves pass
    through. Null leaves keep a row, and so does a scalar, with an empty path. Null texts, and texts
    that are no JSON or nested deeper than 1000 levels, give none.
    """
    path, v, spark = F.col("path"), F.col("v"), docs.sparkSession
    step = F.when(F.col("_key").isNull(), F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).when(path == "", F.col("_key")).otherwise(F.concat(F.lit("."), F.col("_key")))
    # What gives no element is a leaf, or an empty object or list.
    empty = F.col("_pos").isNull() & F.coalesce(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)<"), F.lit(False))
    at = docs.select(F.col(key), F.lit("").alias("path"), F.try_parse_json(doc).alias("v")).filter("v is not null")
    for level in range(deepest(docs, doc)):
        if level and level % LEVELS == 0:
            at = stored(at, "levels")
        inner = spark.tvf.variant_explode_outer(v.outer()).toDF("_pos", "_key", "_value")
        at = at.lateralJoin(inner).filter(~empty).select(key, F.when(F.col("_pos").isNull(), path).otherwise(F.concat(path, step)).alias("path"), F.when(F.col("_pos").isNull(), v).otherwise(F.col("_value")).alias("v"))
    return at.select(key, "path", v.cast("string").alias("value"))


def spaced(text: Column) -> Column:
    """A compact JSON text with one space after each comma and colon outside strings. Control characters, which such a text never holds, stand for its escapes meanwhile."""
    held = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    parts = F.transform(F.split(held, '"'), lambda x, i: F.when(i % 2 == 0, F.regexp_replace(x, "([,:])", "$1 ")).otherwise(x))
    return F.replace(F.replace(F.array_join(parts, '"'), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


#: Levels that strip_internal opens in one expression; the analyzer resolves no more than about 12.
MOST_LEVELS = 10


@F.pandas_udf(T.StringType())
def _strip_deep(texts: pd.Series) -> pd.Series:
    """The same for texts that are nested deeper, with a stack of its own."""

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        root = [json.loads(text)]
        todo = [root]
        while todo:
            x = todo.pop()
            if isinstance(x, dict):
                for k in [k for k in x if k.startswith("_")]:
                    del x[k]
            todo += [v for v in (x.values() if isinstance(x, dict) else x) if isinstance(v, dict | list)]
        return json.dumps(root[0], ensure_ascii=False, sort_keys=True)

    return texts.map(one)


def strip_internal(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """JSON texts without keys that begin with '_', at any depth; keys come out in code point order.

    A text that is no JSON, or nested deeper than 1000 levels, stays as it is, and so does a null.
    Only where the table holds a text of more than 10 levels do these, and no others, go through Python.
    """

    def cut(v: Column, levels: int) -> Column:
        if not levels:
            return v
        inner = F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, _: ~k.startswith("_"))
        items = F.try_variant_get(v, "$", "array<variant>")
        cells = F.coalesce(F.map_entries(inner), F.transform(items, lambda x: F.struct(F.lit("").alias("key"), x.alias("value"))))
        done = F.transform(cells, lambda e: F.struct(e["key"].alias("key"), cut(e["value"], levels - 1).alias("value")))
        # Bound to a variable, since an expression that is written twice at each level doubles with each.
        whole = lambda d: F.when(items.isNotNull(), F.to_variant_object(F.transform(d, lambda e: e["value"]))).when(inner.isNotNull(), F.to_variant_object(F.map_from_entries(d))).otherwise(v)
        return F.transform(F.array(done), whole)[0]

    v, levels = F.try_parse_json(doc), deepest(docs, doc)
    near = spaced(F.to_json(cut(v, min(levels, MOST_LEVELS))))
    if levels > MOST_LEVELS:
        near = F.coalesce(_strip_deep(F.when(v.isNotNull() & (depth(F.col(doc)) > MOST_LEVELS), F.col(doc))), near)
    return docs.withColumn(doc, F.coalesce(near, F.col(doc)))


def drop_keys(struct: Column, *names: str) -> Column:
    return struct.dropFields(*names)


def typed_path(doc: Column, path: str, kind: str = "string") -> Column:
    """A JSON path of a text as a type; null where absent or of another kind."""
    return F.try_variant_get(F.try_parse_json(doc), path, kind)


def chunk_metadata(path: Column, index: Column) -> Column:
    return F.to_json(F.struct(path.alias("path"), index.alias("chunk_index")))


def deep_merge(base: dict, over: dict) -> dict:
    """Nested dicts merged, everything else overwritten; neither input changes."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
