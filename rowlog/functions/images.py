"""Row images as JSON text, built from column names + JSON-literal cells.

A cell is the JSON text of one value (`1`, `"a"`, `100.00`) or SQL NULL. The
image keeps column order and keeps null values as JSON `null`. Diffs compare
cell text null-safely, so `1.0` -> `1.00` counts as a change, as a decimal
compare with scale would.
"""
from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowlog.functions.time import IMAGE_TIME_FORMAT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_string(c) -> Column:
    """JSON string literal (quoted, escaped) for a text value."""
    return F.regexp_extract(F.to_json(F.array(_c(c))), r"^\[(.*)\]$", 1)


def quoted_names(names) -> Column:
    """Column names as JSON keys. Where their JSON array shows that no name is
    escaped or null, as is common, it is the only JSON text that is made."""
    names = _c(names)
    plain = F.concat(F.lit('["'), F.array_join(names, '","'), F.lit('"]')) == all_columns(names)
    return F.when(plain, F.transform(names, lambda n: F.concat(F.lit('"'), n, F.lit('"')))).otherwise(F.transform(names, lambda n: json_string(n)))


def _cell(x: Column) -> Column:
    return F.coalesce(x, F.lit("null"))


def row_image(qnames, cells) -> Column:
    """`{"c1":v1,"c2":v2,..}` from quoted names and cells, in cell order."""
    qnames, cells = _c(qnames), _c(cells)
    body = F.transform(
        cells, lambda v, i: F.concat(F.element_at(qnames, i + 1), F.lit(":"), _cell(v))
    )
    return F.when(cells.isNotNull(), F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}")))


def changed_index(before, after) -> Column:
    """0-based positions whose cell text differs, null-safe, in column order."""
    before, after = _c(before), _c(after)
    idx = F.transform(after, lambda a, i: i)
    return F.filter(idx, lambda i: ~F.get(before, i).eqNullSafe(F.get(after, i)))


def row_diff(qnames, before, after, idx=None) -> Column:
    """`{"col":{"old":..,"new":..},..}` for changed cells; `{}` for a no-op update."""
    qnames, before, after = _c(qnames), _c(before), _c(after)
    idx = changed_index(before, after) if idx is None else _c(idx)
    body = F.transform(
        idx,
        lambda i: F.concat(
            F.element_at(qnames, i + 1),
            F.lit(':{"old":'),
            _cell(F.get(before, i)),
            F.lit(',"new":'),
            _cell(F.get(after, i)),
            F.lit("}"),
        ),
    )
    return F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}"))


def changed_columns(names, idx) -> Column:
    """JSON array of the names at `idx`."""
    names = _c(names)
    return F.to_json(F.transform(_c(idx), lambda i: F.element_at(names, i + 1)))


def all_columns(names) -> Column:
    return F.to_json(_c(names))


_NUMBER = r"-?[0-9][0-9.eE+-]*"


def _key_pattern(name: str) -> str:
    """A key of the outermost object, as the images write it; inside a string
    value its quotes would be escaped."""
    key = json.dumps(name, ensure_ascii=False)
    return r"[{,]" + re.sub(r"([^\w\s])", r"\\\1", key) + ":"


def _exact(value: Column, source: Column, pattern: str) -> Column:
    """A number as it stands in the text; a JSON parser drops the scale of decimals."""
    text = F.regexp_extract(source, pattern, 1)
    return F.when(value.rlike(r"\A" + _NUMBER + r"\z") & (text != ""), text).otherwise(value)


def parsed(image) -> Column:
    """A JSON image as a variant: parsed once, then read by path. Where the
    exact text of a number matters, readers look it up in the text beside it."""
    return F.try_parse_json(_c(image))


def once(value: Column, read) -> Column:
    """`read` of a value that is computed once for a row, however often
    `read` uses it (a lambda's variable is never inlined)."""
    return F.get(F.transform(F.array(value), lambda v: read(v)), F.lit(0))


def _step(name: str) -> str:
    """A key as a step of a variant path. A key that holds both kinds of
    quotes can't be written as one."""
    if '"' not in name:
        return f'["{name}"]'
    if "'" not in name:
        return f"['{name}']"
    raise ValueError(f"no variant path can name the key {name!r}")


def image_col(image, name: str, type_: str = "string", variant: Column | None = None) -> Column:
    """One column of a JSON image: strings unquoted, other values as their
    JSON text (`100.00` keeps its scale), JSON null as null. The name is a
    key, not a path, so dots and quotes in it are plain. `variant` is the
    image `parsed`, which saves parsing it again."""
    image = _c(image)
    if variant is None:
        v = F.from_json(image, "map<string,string>").getItem(name)
    else:
        v = F.try_variant_get(variant, "$" + _step(name), "string")
    v = _exact(v, image, _key_pattern(name) + f"({_NUMBER})")
    return v if type_ == "string" else v.try_cast(type_)


def change_col(changed, name: str, side: str, variant: Column | None = None) -> Column:
    """The `old` or `new` value of one column in a diff, read as `image_col` does."""
    changed = _c(changed)
    if variant is None:
        v = F.from_json(changed, "map<string,struct<old:string,new:string>>").getItem(name).getField(side)
    else:
        v = F.try_variant_get(variant, f"${_step(name)}.{side}", "string")
    # Atomic, so that only the column's own new value can follow.
    skip = "" if side == "old" else '(?>(?s:.*?),"new":)'
    before = r'\{"old":' + skip
    return _exact(v, changed, _key_pattern(name) + before + f"({_NUMBER})" + (',"new":' if side == "old" else r"\}"))


def value_text(value) -> str | None:
    """A Python value as `image_col` reads it from an image."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value) if isinstance(value, (bool, dict, list)) else str(value)


def has_change(changed, name: str, variant: Column | None = None) -> Column:
    if variant is not None:
        return F.try_variant_get(variant, "$" + _step(name), "variant").isNotNull()
    return F.array_contains(F.json_object_keys(_c(changed)), F.lit(name))


def image_has(image, name: str, variant: Column | None = None) -> Column:
    """True when the image has the key, even if its value is null."""
    if variant is not None:  # a JSON null is a variant, a missing key is none
        return F.try_variant_get(variant, "$" + _step(name), "variant").isNotNull()
    return F.array_contains(F.json_object_keys(_c(image)), F.lit(name))


def typed_image(struct_col) -> Column:
    """Image of a typed struct (snapshot rows): keeps nulls, ISO times with offset."""
    return F.to_json(
        _c(struct_col),
        {"ignoreNullFields": "false", "timestampFormat": IMAGE_TIME_FORMAT},
    )


def cell_literal(c) -> Column:
    """JSON literal text of a typed value, the cell encoding of the input contract."""
    c = _c(c)
    return F.when(c.isNotNull(), F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1))
