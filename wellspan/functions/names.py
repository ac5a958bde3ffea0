"""Names of wells, stacks, files and experiments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fields an experiment must have, by label.
REQUIRED = {"user": "User", "project": "Project", "instrument": "Instrument", "modality": "Modality", "cell_type": "Cell type", "well_type": "Well type"}


def well_id(row: Column, column: Column) -> Column:
    """``A01`` for row 1 and column 1; columns take as many digits as they need."""
    return F.concat(F.char(row + 64), F.format_string("%02d", column))


def well_row(well: Column) -> Column:
    """Row from 1 of a well name (A to P in any case, then one or two digits, blanks around it allowed), else null."""
    name = F.upper(F.trim(well))
    return F.when(name.rlike(r"^[A-P]\d{1,2}$"), F.ascii(name) - 64)


def well_column(well: Column) -> Column:
    """Column of a well name, else null."""
    return F.regexp_extract(F.upper(F.trim(well)), r"^[A-P](\d{1,2})$", 1).try_cast("int")


def basename(title: Column, row: Column, column: Column, kind: Column, position: Column, timeline: Column, action_index: Column, action: Column, magnification: Column, split_acq: Column) -> Column:
    """``title_A01_F01_L1_A1_BF_60x_R02``: the last part only for stacks kept apart by acquisition.

    Without a title (null or empty) the name starts with the well; a null magnification is written ``None``, as
    an objective that is not listed is 0 and a listed one without a value is null.
    """
    start = F.coalesce(F.concat(F.nullif(title, F.lit("")), F.lit("_")), F.lit(""))
    middle = F.format_string("_%s%02d_L%d_A%d_%s_%sx", F.when(kind == "tile", "M").otherwise("F"), position, timeline, action_index, action, F.coalesce(magnification.cast("string"), F.lit("None")))
    return F.concat(start, well_id(row, column), middle, F.when(split_acq.isNull(), "").otherwise(F.format_string("_R%02d", split_acq)))


def stem(name: Column) -> Column:
    """A file or folder name without ``.ome.tif`` or ``.ome.zarr``, or else without its last suffix."""
    return F.when(name.rlike(r"\.ome\.(tif|zarr)$"), F.regexp_replace(name, r"\.ome\.(tif|zarr)$", "")).otherwise(F.regexp_replace(name, r"(?<=.)\.[^./]+$", ""))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)/?$", 1)


def shape_label(axes: Column, shape: Column) -> Column:
    """``TCYX=2×3×64×64`` of an array of axis names and one of sizes; empty without sizes."""
    return F.when(F.coalesce(F.size(shape), F.lit(0)) <= 0, "").otherwise(F.concat(F.upper(F.array_join(axes, "")), F.lit("="), F.array_join(F.transform(shape, lambda x: x.cast("string")), "×")))


def action_color(action: Column, colors: int = 10) -> Column:
    """Stable colour number of a name: h = (31 h + code) mod 2**32 over its characters, then modulo."""
    codes = F.transform(F.filter(F.split(action, ""), lambda x: x != ""), lambda x: F.ascii(x).cast("long"))
    return (F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: (h * 31 + c).bitwiseAND(F.lit(4294967295))) % colors).cast("int")


def comma_list(text: Column) -> Column:
    """Items of a comma-separated list, trimmed, blanks left out; null gives an empty list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def stem_kept(name: Column, exclude: Sequence[str] = (), include: Sequence[str] = ()) -> Column:
    """Whether a stem holds none of ``exclude`` and, if any are given, one of ``include``, in any case."""
    low = F.lower(name)
    holds = lambda words: F.exists(F.array(*[F.contains(low, F.lit(w.lower())) for w in words]), lambda x: x)
    words = [w for w in exclude if w]
    kept = ~holds(words) if words else F.lit(True)
    return kept & holds(include) if include else kept


def display_path(path: Column, inner: str, shown: str) -> Column:
    """A path below ``inner`` as it is shown, below ``shown``; others stay."""
    root = inner.rstrip("/")
    below = (path == root) | path.startswith(f"{root}/")
    return F.when(below, F.concat(F.lit(shown.rstrip("/")), F.substr(path, F.lit(len(root) + 1)))).otherwise(path)


def missing_fields(fields: Mapping[str, str] = REQUIRED) -> Column:
    """Labels of the required columns that are null or empty."""
    return F.filter(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(label)) for c, label in fields.items()]), lambda x: x.isNotNull())


def json_string(text: Column) -> Column:
    """A JSON string in ASCII: quotes, backslashes and control characters escaped, others above ``~`` as ``\\uXXXX``."""

    def one(c: Column) -> Column:
        code = F.ascii(c)
        pair = code - 0x10000
        short = F.when(c == '"', '\\"').when(c == "\\", "\\\\").when(c == "\n", "\\n").when(c == "\r", "\\r").when(c == "\t", "\\t").when(c == "\b", "\\b").when(c == "\f", "\\f")
        wide = F.format_string("\\u%04x\\u%04x", F.shiftright(pair, 10) + 0xD800, pair.bitwiseAND(F.lit(0x3FF)) + 0xDC00)
        return short.when((code >= 0x20) & (code <= 0x7E), c).when(code >= 0x10000, wide).otherwise(F.format_string("\\u%04x", code))

    inner = F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")
    return F.concat(F.lit('"'), inner, F.lit('"'))


def json_object(fields: Mapping[str, Column], kinds: Mapping[str, str]) -> Column:
    """A JSON object with sorted keys, ``", "`` between fields and ``": "`` inside; kinds are Spark type names."""

    def value(name: str) -> Column:
        c = fields[name]
        text = json_string(c.cast("string")) if kinds[name] == "string" else c.cast("string")
        return F.coalesce(text, F.lit("null"))

    parts = [F.concat(F.lit(f'"{name}": '), value(name)) for name in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def experiment_id(fields: Mapping[str, Column], kinds: Mapping[str, str]) -> Column:
    """First 12 hexadecimal digits of the SHA-256 of the experiment's fields as sorted JSON."""
    return F.substring(F.sha2(json_object(fields, kinds).cast("binary"), 256), 1, 12)


def experiment_label(parts: Sequence[Column], multi_day: Column, path: Column) -> Column:
    """Parts that aren't empty joined by `` | ``, a mark for several days, then the path."""
    shown = F.concat_ws(" | ", *[F.nullif(p, F.lit("")) for p in parts])
    return F.concat(shown, F.when(multi_day, " [multi-day]").otherwise(""), F.lit(" — "), path)
