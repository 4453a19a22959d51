"""Column expressions for names, paths, hints and coerced defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words after a stem that tell a role, not content. Fixed values.
ROLE_SUFFIXES = "real|fake|gt|mask|copy|dup|duplicate"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or(c: Column | str, default: str = "unknown") -> Column:
    """Any type as text, null as default."""
    return F.coalesce(col(c).cast("string"), F.lit(default))


def number_or(c: Column | str, default: float) -> Column:
    """Any type as a number, what isn't one as default."""
    return F.coalesce(col(c).cast("string").try_cast("double"), F.lit(float(default)))


def norm(c: Column | str) -> Column:
    """Trimmed (spaces of any kind) and lower-cased."""
    return F.lower(F.regexp_replace(col(c), r"^\s+|\s+$", ""))


def split_hint(c: Column | str) -> Column:
    """Trimmed and lower-cased; null and blank are ``seen``."""
    h = norm(c)
    return F.when(h.isNull() | (h == ""), "seen").otherwise(h)


def slug(c: Column | str) -> Column:
    """Lower case, everything but letters, digits, ``_ - .`` as one underscore, none at the ends."""
    s = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    s = F.regexp_replace(s, r"[^0-9a-z_\-.]+", "_")
    return F.btrim(F.regexp_replace(s, "_+", "_"), F.lit("_"))


def stem_id(c: Column | str) -> Column:
    """Slug of a file stem without trailing role words and version; ``unknown`` if nothing is left."""
    s = F.regexp_replace(slug(c), f"(_({ROLE_SUFFIXES}))+$", "")
    s = F.regexp_replace(s, r"_v\d+$", "")
    return F.when(s == "", "unknown").otherwise(s)


def path_parts(path: Column | str) -> Column:
    return F.filter(F.split(col(path), "/"), lambda x: (x != "") & (x != "."))


def file_name(path: Column | str) -> Column:
    return F.get(F.reverse(path_parts(path)), F.lit(0))


def file_stem(path: Column | str) -> Column:
    """File name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def group_token(path: Column | str, level: Column | int = 1) -> Column:
    """Name of the level-th directory above the file (1 = parent; lower levels count as 1), the
    next higher one if it is blank, else the file stem."""
    level = F.lit(level) if isinstance(level, int) else level
    up = F.slice(F.reverse(path_parts(path)), F.greatest(F.coalesce(level, F.lit(1)), F.lit(1)) + 1, F.lit(1_000_000))
    named = F.filter(F.transform(up, lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.get(named, F.lit(0)), F.nullif(file_stem(path), F.lit("")), F.lit("unknown"))


def source_of_path(path: Column | str) -> Column:
    """Parent directory, ``unknown`` if there is none."""
    parent = F.trim(F.get(F.reverse(path_parts(path)), F.lit(1)))
    return F.when(parent.isNull() | (parent == ""), "unknown").otherwise(parent)


def source_or_path(source: Column | str, path: Column | str) -> Column:
    return F.coalesce(col(source), source_of_path(path))


def pair_group(dataset: Column | str, name: Column | str, path: Column | str, family: str) -> Column:
    """``family:body`` for sources named family_body_real and family_body_fake of one dataset,
    else by the second directory below the family's, else ``family:unknown``; blank for other datasets."""
    n = slug(name)
    body = F.regexp_replace(F.regexp_extract(n, f"^{family}_(.*)$", 1), "_(real|fake)$", "")
    parts = F.transform(path_parts(path), slug)
    below = F.when(F.array_position(parts, family) > 0, F.get(parts, (F.array_position(parts, family) + 1).cast("int")))
    found = F.coalesce(F.nullif(body, F.lit("")), F.nullif(below, F.lit("")), F.lit("unknown"))
    return F.when(slug(dataset) == family, F.concat(F.lit(f"{family}:"), found)).otherwise("")


def prompt_group(dataset: Column | str, path: Column | str, family: str, enabled: bool = True) -> Column:
    """``family:stem`` for files of the family's dataset, else blank."""
    if not enabled:
        return F.lit("")
    return F.when(slug(dataset) == family, F.concat(F.lit(f"{family}:"), stem_id(file_stem(path)))).otherwise("")


def generator_default(label: Column | str) -> Column:
    return F.when(col(label) == 0, "real").otherwise("unknown")


def first_present(df: DataFrame, candidates: Sequence[str], fallback: str = "path") -> str:
    """The first candidate that df has, else fallback."""
    return next((c for c in candidates if c in df.columns), fallback)


def column_or(df: DataFrame, name: str, source: str = "source") -> Column:
    """The column as text, null as ``unknown``; if df lacks it, the source derived from the path, the
    label, or ``unknown``."""
    if name in df.columns:
        return text_or(name)
    if name == source and "path" in df.columns:
        return source_of_path("path")
    return text_or("label") if name == "label_source" and "label" in df.columns else F.lit("unknown")


def smooth_target(label: Column | str, smoothing: float) -> Column:
    """The label drawn to one half by ``smoothing``."""
    return col(label) * (1.0 - smoothing) + 0.5 * smoothing


def group_key(columns: Sequence[str], separator: str = "|") -> Column:
    """Joined text of the columns; ``all`` for none."""
    return F.concat_ws(separator, *[text_or(c) for c in columns]) if columns else F.lit("all")


def parse_list(text: str | None) -> list[str]:
    """Comma-separated names, trimmed, blanks dropped."""
    return [x.strip() for x in (text or "").split(",") if x.strip()]
